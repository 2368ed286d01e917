"""Column profiles, value counts, correlated-NULL rows, partition fingerprints."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.IntegerType, T.LongType, T.DoubleType, T.FloatType, T.DecimalType, T.ShortType)


def column_profile(
    df: DataFrame,
    columns: list[str] | None = None,
    group_by: list[str] | None = None,
    approx: bool = True,
    accuracy: int = 10000,
) -> DataFrame:
    """Long-form profile, one row per (group, column), from a single aggregation.

    rows, nulls, null_fraction, min/max (as strings), mean for numeric columns, and with
    ``approx`` also an HLL distinct count and p50/p95/p99 sketches (bounded memory).
    """
    g = group_by or []
    cols = columns or [c for c in df.columns if c not in g]
    types = {f.name: f.dataType for f in df.schema.fields}
    aggs = [F.count(F.lit(1)).alias("__n")]
    for i, c in enumerate(cols):
        col = F.col(c)
        aggs += [F.count_if(col.isNull()).alias(f"n{i}"), F.min(col).cast("string").alias(f"lo{i}"),
                 F.max(col).cast("string").alias(f"hi{i}")]
        numeric = isinstance(types[c], NUMERIC)
        aggs.append((F.avg(col).cast("double") if numeric else F.lit(None).cast("double")).alias(f"mu{i}"))
        if approx:
            aggs.append(F.approx_count_distinct(col).alias(f"d{i}"))
            if numeric:
                aggs.append(F.percentile_approx(col.cast("double"), [0.5, 0.95, 0.99], accuracy).alias(f"q{i}"))
    stats = df.groupBy(*g).agg(*aggs)
    rows = []
    for i, c in enumerate(cols):
        fields = [
            F.lit(c).alias("column_name"),
            F.col("__n").alias("row_count"),
            F.col(f"n{i}").alias("null_count"),
            (F.col(f"n{i}") / F.nullif(F.col("__n"), F.lit(0))).alias("null_fraction"),
            F.col(f"lo{i}").alias("min_value"),
            F.col(f"hi{i}").alias("max_value"),
            F.col(f"mu{i}").alias("mean"),
        ]
        if approx:
            numeric = isinstance(types[c], NUMERIC)
            fields += [F.col(f"d{i}").alias("approx_distinct")]
            for j, name in enumerate(("p50", "p95", "p99")):
                fields.append((F.col(f"q{i}")[j] if numeric else F.lit(None).cast("double")).alias(name))
        rows.append(F.struct(*fields))
    return stats.select(*g, F.explode(F.array(*rows)).alias("r")).select(*g, "r.*")


def value_counts(df: DataFrame, column: str, group_by: list[str] | None = None) -> DataFrame:
    """Count per value (per group), NULL kept as its own value."""
    return df.groupBy(*(group_by or []), column).agg(F.count("*").alias("count"))


def all_null_rows(df: DataFrame, columns: list[str], by: str) -> DataFrame:
    """Per ``by`` value: rows, and rows where all of ``columns`` are NULL at once."""
    all_null = F.lit(True)
    for c in columns:
        all_null = all_null & F.col(c).isNull()
    return df.groupBy(by).agg(F.count("*").alias("rows"), F.count_if(all_null).alias("all_null_rows"))


FINGERPRINT_NULL = "<null>"


def partition_fingerprint(
    df: DataFrame, group_by: list[str], exclude: list[str] | None = None, method: str = "xxhash64"
) -> DataFrame:
    """Order-insensitive content hash per partition: row count and the sum of row hashes.

    Run metadata (``exclude``) is left out, so reloading the same data gives the same
    fingerprint; the sum is taken as DECIMAL(38,0) so it cannot overflow. ``xxhash64``
    is the fast default; ``md5`` (first 60 bits of the md5 of the '|'-joined string
    forms) can be recomputed by other engines.
    """
    skip = set(exclude or []) | set(group_by)
    cols = sorted(c for c in df.columns if c not in skip)
    if method == "xxhash64":
        h = F.xxhash64(*[F.col(c) for c in cols])
    elif method == "md5":
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit(FINGERPRINT_NULL)) for c in cols])
        h = F.conv(F.substring(F.md5(text), 1, 15), 16, 10)
    else:
        raise ValueError(method)
    return df.groupBy(*group_by).agg(F.count("*").alias("rows"), F.sum(h.cast("decimal(38,0)")).alias("content_hash"))
