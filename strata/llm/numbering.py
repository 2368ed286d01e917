"""Numbering the rows of a table in a global order, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import store


def numbered(df: DataFrame, order: list[Column], into: str, name: str) -> tuple[DataFrame, int]:
    """(``df`` with ``into``, the place 0, 1, ... of each row in ``order``; number of rows).

    Rows are range-partitioned and sorted; a row's place is its partition's offset, the rows of all
    partitions before, plus its place within. Only one count for each partition passes the driver. The
    sorted rows are stored before they are counted, so places do not change when a task is run again.
    Put a column that tells rows apart last in ``order``: equal rows cannot be split.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    at = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    at = store(at.withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", 33)
    counts = dict(map(tuple, at.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect()))
    offsets, total = [], 0
    for p in range(max(counts, default=0) + 1):
        offsets.append(total - (p << 33))
        total += counts.get(p, 0)
    return at.select(*df.columns, (F.col("_at") + F.get(F.lit(offsets).cast("array<long>"), part.cast("int"))).alias(into)), total
