"""File-size telemetry and compaction of small files."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.ops.profile import partition_fingerprint

TARGET_FILE_BYTES = 256 * 1024 * 1024


def file_sizes(spark: SparkSession, path_glob: str) -> DataFrame:
    """(path, bytes) per file from the file listing; file contents are not read."""
    return spark.read.format("binaryFile").load(path_glob).select("path", F.col("length").alias("bytes"))


def file_telemetry(files: DataFrame, group_col: str, target_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """Per partition: file count, total / min / mean / max bytes, small files, and the
    file count compaction would produce."""
    small = F.col("bytes") < F.lit(target_bytes // 4)
    g = files.groupBy(group_col).agg(
        F.count("*").alias("files"),
        F.sum("bytes").alias("total_bytes"),
        F.min("bytes").alias("min_bytes"),
        F.avg("bytes").alias("avg_bytes"),
        F.max("bytes").alias("max_bytes"),
        F.count_if(small).alias("small_files"),
    )
    return g.withColumn(
        "target_files", F.greatest(F.lit(1), F.ceil(F.col("total_bytes") / F.lit(target_bytes))).cast("long")
    )


def table_file_telemetry(df: DataFrame, partition_col: str, target_bytes: int = TARGET_FILE_BYTES) -> DataFrame:
    """Telemetry of a table read from files, using each row's ``_metadata``: one row per
    file first (partial aggregation), then per partition."""
    per_file = df.select(
        partition_col, F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("bytes")
    ).groupBy(partition_col, "path").agg(F.max("bytes").alias("bytes"))
    return file_telemetry(per_file, partition_col, target_bytes)


def _merged(stored: DataFrame, n: int) -> DataFrame:
    """``stored`` in ``n`` partitions: whole file splits put together, or dealt anew where there are fewer splits."""
    return stored.coalesce(n) if stored.rdd.getNumPartitions() >= n else stored.repartition(n)


def compact_partition(
    spark: SparkSession,
    table_path: str,
    partition_col: str,
    value: str,
    staging_path: str,
    target_bytes: int = TARGET_FILE_BYTES,
) -> dict:
    """Rewrite one partition into ~``target_bytes`` files without changing its content.

    The partition is rewritten to a staging path first; its fingerprint must equal the
    source's before the staged data replaces the partition by dynamic overwrite. A task
    reads the stored files that make one new file, so no unpacked row is shuffled.
    """
    src = spark.read.parquet(table_path).filter(F.col(partition_col) == F.lit(value))
    size = src.select(F.col("_metadata.file_path").alias("p"), F.col("_metadata.file_size").alias("b")).distinct().agg(
        F.sum("b").alias("bytes"), F.count("*").alias("files")
    ).first()
    n = max(1, math.ceil((size["bytes"] or 0) / target_bytes))
    _merged(src, n).write.mode("overwrite").partitionBy(partition_col).parquet(staging_path)
    staged = spark.read.parquet(staging_path).filter(F.col(partition_col) == F.lit(value))
    before = partition_fingerprint(src, [partition_col]).first()
    after = partition_fingerprint(staged, [partition_col]).first()
    if before != after:
        raise RuntimeError(f"compaction changed the content of {partition_col}={value}")
    _merged(staged, n).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(table_path)
    return {"files_before": int(size["files"]), "files_after": n}
