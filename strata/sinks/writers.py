"""Table writes: partition overwrite, append, replace; counts observed during the write."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def overwrite_partitions(
    df: DataFrame,
    path: str,
    partition_col: str = "pickup_month",
    months: list[dt.date] | None = None,
    fmt: str = "parquet",
) -> int:
    """Idempotent dynamic partition overwrite; returns the rows written.

    With ``months`` only rows of those partitions are written, so stray rows of a
    neighbouring month can never replace that month's partition, and a named partition
    that receives no row is cleared: dynamic overwrite alone would leave its old rows.
    The counts come from an Observation on the same job (no second scan).
    """
    return _overwrite(df, path, partition_col, months, fmt)[0]


def overwrite_months(df: DataFrame, path: str, months: list[dt.date], partition_col: str = "pickup_month") -> dict[dt.date, int]:
    """:func:`overwrite_partitions` of several months; the rows written of each."""
    return _overwrite(df, path, partition_col, months, "parquet")[1]


def _overwrite(df: DataFrame, path: str, partition_col: str, months: list[dt.date] | None, fmt: str) -> tuple[int, dict[dt.date, int]]:
    if months:
        df = df.filter(F.col(partition_col).isin([F.lit(m) for m in months]))
    obs = Observation("rows_written")
    per_month = [F.count_if(F.col(partition_col) == F.lit(m)).alias(f"m{i}") for i, m in enumerate(months or [])]
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"), *per_month)
    (
        observed.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition_col)
        .format(fmt)
        .save(path)
    )
    found = obs.get
    by_month = {m: int(found[f"m{i}"]) for i, m in enumerate(months or [])}
    clear_partitions(df.sparkSession, path, partition_col, [m for m, n in by_month.items() if not n])
    return int(found["rows"]), by_month


def clear_partitions(spark: SparkSession, path: str, partition_col: str, months: list[dt.date]) -> None:
    """Remove the named partitions of a stored table; those that are not there are no error."""
    for m in months:
        part = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{partition_col}={m.isoformat()}")
        part.getFileSystem(spark._jsc.hadoopConfiguration()).delete(part, True)


def append(df: DataFrame, path: str, partition_cols: list[str] | None = None, fmt: str = "parquet") -> int:
    obs = Observation("rows_appended")
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("append").format(fmt)
    if partition_cols:
        w = w.partitionBy(*partition_cols)
    w.save(path)
    return int(obs.get["rows"])


def replace(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Create-or-replace full refresh."""
    obs = Observation("rows_replaced")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format(fmt).save(path)
    return int(obs.get["rows"])


def write_split(df: DataFrame, route_col: str, targets: dict[str, str], partition_col: str, fmt: str = "parquet") -> None:
    """Write each route value of ``df`` to its own table (e.g. in-month vs late_or_early)."""
    for value, path in targets.items():
        part = df.filter(F.col(route_col) == value).drop(route_col)
        part.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).format(fmt).save(path)
