"""SparkSession construction and the few session-level settings the library relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session used by the library should carry. AQE re-plans joins and
# coalesces shuffle partitions at runtime; skew join splits hot partitions; UTC keeps
# timestamp <-> string conversions stable between Spark and other engines.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.parquet.enableVectorizedReader": "true",
    "spark.ui.enabled": "false",
}


# Settings for a large cluster (hundreds of executors, tens of TB per job). Shuffles
# start wide and AQE coalesces them towards the advisory size; scan splits match the
# 256 MB target file size; hot partitions above 512 MB (and 5x the median) are split.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.files.maxRecordsPerFile": "0",
    "spark.sql.parquet.compression.codec": "zstd",
}


def get_spark(
    app: str = "strata",
    master: str | None = None,
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library's base settings.

    On a cluster pass ``master=None`` and let spark-submit decide, and pass
    ``extra=CLUSTER_CONF`` (its shuffle width overrides ``shuffle_partitions``).
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})  # explicit settings win over the defaults above
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting wins. Only a local-mode session without a setting (tests,
    bench) gets a scratch folder under the system temp dir; on a cluster a missing
    setting is an error, because a machine-local folder would not survive a lost node.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        configured = tempfile.mkdtemp(prefix="strata-ckpt-")
        spark.conf.set("spark.checkpoint.dir", configured)
    spark.sparkContext.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for intermediate tables, under the shared checkpoint folder."""
    return os.path.join(ensure_checkpoint_dir(spark), name)
