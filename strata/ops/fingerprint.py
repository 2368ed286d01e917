"""Incremental content fingerprint: an additive hash for each file, the table's as their sum.

The hash of a row does not depend on its place, and a file's is the sum over its rows, so the table's
fingerprint follows from stored file rows: a new file adds, a removed one subtracts, a changed one
does both. A refresh lists the files and reads those that are new or changed, and no others.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.ops.profile import partition_fingerprint
from strata.session import scratch_path

STATE = "path string, bytes long, modified timestamp, part string, rows long, content_hash decimal(38,0)"


def _listed(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def refresh(
    spark: SparkSession, table: str, state: str, partition_col: str, exclude: list[str] | None = None, method: str = "xxhash64"
) -> tuple[DataFrame, int]:
    """(the state rows of ``table``'s files, brought up to date and stored at ``state``; files read).

    A file counts as unchanged if its name, size and modification time are those on record. ``exclude``
    and ``method`` are as for :func:`partition_fingerprint` and must stay the same for a state.
    """
    known = spark.read.schema(STATE).parquet(state) if _exists(spark, state) else spark.createDataFrame([], STATE)
    listed = _listed(spark, table)
    same = known.join(listed, ["path", "bytes", "modified"], "left_semi")
    todo = listed.join(same.select("path"), "path", "left_anti")
    paths = [r["path"] for r in todo.select("path").collect()]  # changed files, by name
    if paths:
        rows = spark.read.option("basePath", table).parquet(*paths)
        part = F.col(partition_col).cast("string").alias("part")
        rows = rows.select("*", part, F.col("_metadata.file_path").alias("path"))
        hashed = partition_fingerprint(rows, ["path", "part"], [*(exclude or []), partition_col], method)
        fresh = todo.join(hashed, "path")
        now = same.unionByName(fresh.select(*same.columns))
    else:
        now = same
    stage = scratch_path(spark, f"fingerprint-{uuid.uuid4().hex}")  # the state is not read while it is written
    now.select(*same.columns).write.parquet(stage)
    spark.read.schema(STATE).parquet(stage).coalesce(1).write.mode("overwrite").parquet(state)
    return spark.read.schema(STATE).parquet(state), len(paths)


def table_fingerprint(state: DataFrame, *group_by: str) -> DataFrame:
    """Rows and content hash of the table, or of each ``part``, from its file rows alone."""
    return state.groupBy(*group_by).agg(F.sum("rows").alias("rows"), F.sum("content_hash").cast("decimal(38,0)").alias("content_hash"))
