"""Size-checked broadcast.

A side is broadcast only after one distributed aggregation has measured it: at most
``max_rows`` rows and at most ``BROADCAST_BYTES`` bytes of values. Otherwise the frame is
returned unchanged and the planner / AQE picks a shuffle join, with skew-join
splitting of hot partitions. The result of the join is the same either way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Dimension tables are broadcast when they have at most this many rows.
DIM_BROADCAST_ROWS = 1_000_000
# ... and at most this many bytes of values; wide rows (JSON, arrays) reach it first.
BROADCAST_BYTES = 64 << 20


def measured(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df``: strings and binaries by length, nested values by their text form,
    other values as 16 bytes. Partial sums per task meet in one row; no rows are moved."""
    width = F.lit(16 * len(df.columns)).cast("long")
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType)):
            c = c.cast("string")
        elif not isinstance(f.dataType, (T.StringType, T.BinaryType)):
            continue
        width = width + F.coalesce(F.octet_length(c), F.lit(0))
    r = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return r["rows"], r["bytes"]


def fits(df: DataFrame, max_rows: int, max_bytes: int = BROADCAST_BYTES) -> bool:
    rows, size = measured(df)
    return rows <= max_rows and size <= max_bytes


def bounded_broadcast(
    df: DataFrame, max_rows: int = DIM_BROADCAST_ROWS, materialize: bool = False, max_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Broadcast ``df`` if it has at most ``max_rows`` rows and ``max_bytes`` bytes.

    With ``materialize`` the frame is first written to the shared checkpoint folder
    (``spark.checkpoint.dir``), so an expensive lineage (e.g. a gate verdict computed
    from a full scan) runs once for both the size check and the join.
    """
    if materialize:
        from strata.session import ensure_checkpoint_dir

        ensure_checkpoint_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
    return F.broadcast(df) if fits(df, max_rows, max_bytes) else df
