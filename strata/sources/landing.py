"""Landing-zone readers: monthly files, CSV seeds, manifests and month slices."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.schemas import MANIFEST_SCHEMA, ZONE_SEED_SCHEMA
from strata.sizing import bounded_broadcast
from strata.sources.filehash import hash_files


def landing_path(root: str, year: int, month: int) -> str:
    """``<root>/year=YYYY/month=MM`` (zero-padded month)."""
    return os.path.join(root, f"year={year:04d}", f"month={month:02d}")


def read_landing(spark: SparkSession, root: str, months: list[dt.date] | None = None) -> DataFrame:
    """Landed Parquet under ``year=/month=`` folders, with the file each row came from.

    With ``months`` only those folders are listed; otherwise partition discovery finds
    all of them and a filter on year/month prunes folders.
    """
    reader = spark.read.option("basePath", root)
    if months:
        df = reader.parquet(*[landing_path(root, m.year, m.month) for m in months])
    else:
        df = reader.parquet(root)
    return df.withColumn("_source_file", F.col("_metadata.file_path"))


def read_seed_csv(spark: SparkSession, path: str, schema: T.StructType = ZONE_SEED_SCHEMA) -> DataFrame:
    """CSV seed with header and an explicit schema; malformed rows fail the read."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def read_manifest(spark: SparkSession, *paths: str) -> DataFrame:
    """Manifest sidecars (one indented JSON object each) as a typed frame.

    Sidecars are named like ``_manifest.json``; Spark's file sources skip names that start
    with ``_`` or ``.``, so each sidecar (one small metadata record per landing month, not
    data) is opened through the Hadoop FileSystem API of the session, which reaches the
    same storage as the data.
    """
    import json

    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    rows = []
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        stream = p.getFileSystem(conf).open(p)
        try:
            text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        rec = json.loads(text)
        rows.append(tuple(rec.get(f.name) for f in MANIFEST_SCHEMA.fields))
    return spark.createDataFrame(rows, MANIFEST_SCHEMA)


def build_manifest(spark: SparkSession, path: str, count_rows: bool = True, hashes: bool = True) -> DataFrame:
    """Recompute (path, sha256, byte_size, row_count) for data files, distributed over files.

    ``path`` is a folder, a file or a glob of Parquet files; names are as in ``_metadata.file_path``,
    so they match the rows read from these files whatever characters they hold. Files of any size are
    hashed in chunks, see :func:`strata.sources.filehash.hash_files`; without ``hashes`` only the
    listing is read and ``sha256`` is NULL. Row counts need no column. Both sides are one row per file.
    """
    if hashes:
        files = hash_files(spark, path)
    else:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(path)
        files = files.select(F.col("_metadata.file_path").alias("path"), F.col("length").alias("byte_size"), F.lit(None).cast("string").alias("sha256"))
    if not count_rows:
        return files
    counts = (
        spark.read.option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").parquet(path)
        .select(F.col("_metadata.file_path").alias("path"))
        .groupBy("path")
        .agg(F.count("*").alias("row_count"))
    )
    return files.join(counts, "path", "left")


def declared_manifest(spark: SparkSession, folder: str) -> DataFrame | None:
    """The sidecar of a landing folder, or None where nothing is declared."""
    path = os.path.join(folder, "_manifest.json")
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return None
    return read_manifest(spark, path)


class ManifestMismatch(ValueError):
    """A landing folder does not hold what its sidecar declares."""


def checked_files(spark: SparkSession, folder: str, verify_sha: bool = True) -> DataFrame:
    """(path, sha256) of a landing folder's files, after a check against its sidecar.

    The sidecar describes one landing file: its bytes and rows must be those of the folder, and with
    ``verify_sha`` its sha256 that of the file. Without ``verify_sha`` file contents are not read and
    the declared sha256 stands. Without a sidecar the hashes are computed. Files may have any size.
    """
    declared = declared_manifest(spark, folder)
    if declared is None:
        return build_manifest(spark, folder, count_rows=False).select("path", "sha256")
    d = declared.first()
    files = build_manifest(spark, folder, hashes=verify_sha)
    found = files.agg(
        F.sum("byte_size").alias("byte_size"), F.sum("row_count").alias("row_count"),
        F.count(F.lit(1)).alias("files"), F.min("sha256").alias("sha256"),
    ).first()
    wrong = [c for c in ("byte_size", "row_count") if found[c] != d[c]]
    if found["files"] != 1:
        wrong.append("files")
    elif not d["sha256"] or (verify_sha and found["sha256"] != d["sha256"]):
        wrong.append("sha256")
    if wrong:
        raise ManifestMismatch(f"{folder}: {', '.join(wrong)} differ from the declared manifest")
    return files.select("path", F.lit(d["sha256"]).alias("sha256"))


def validate_manifest(declared: DataFrame, recomputed: DataFrame, key: str = "path") -> DataFrame:
    """Per file: declared vs recomputed hash / size / rows, ``status`` and ``valid``.

    status: valid, altered (hash, size or rows differ, or no rows), missing (declared, not there),
    undeclared (there, not declared).
    """
    d = declared.select(
        F.col(key), F.col("sha256").alias("declared_sha256"), F.col("byte_size").alias("declared_bytes"),
        F.col("row_count").alias("declared_rows"), F.lit(True).alias("_declared"),
    )
    j = d.join(recomputed.withColumn("_found", F.lit(True)), key, "full_outer")
    same = (
        F.col("declared_sha256").eqNullSafe(F.col("sha256"))
        & F.col("declared_bytes").eqNullSafe(F.col("byte_size"))
        & F.col("declared_rows").eqNullSafe(F.col("row_count"))
        & F.coalesce(F.col("row_count") > 0, F.lit(False))
    )
    status = F.when(F.col("_found").isNull(), "missing").when(F.col("_declared").isNull(), "undeclared").when(same, "valid").otherwise("altered")
    return j.withColumn("status", status).withColumn("valid", F.col("status") == "valid").drop("_declared", "_found")


def month_slice(df: DataFrame, months: list[dt.date] | DataFrame, col: str = "pickup_month") -> DataFrame:
    """Rows of some months: an IN filter on the partition column (static pruning), or a
    semi join with a frame of months (dynamic partition pruning on partitioned tables)."""
    if isinstance(months, DataFrame):
        m = bounded_broadcast(months.select(F.col(months.columns[0]).alias(col)).distinct(), max_rows=100_000,
                              materialize=True)
        return df.join(m, col, "left_semi")
    return df.filter(F.col(col).isin([F.lit(m) for m in months]))
