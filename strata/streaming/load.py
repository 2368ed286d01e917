"""Incremental bronze load from a stream of landed files, with a ledger by file and month.

A batch writes its rows under (month, file): a replayed batch writes the same partitions again, and a
month that arrives in several files or batches is the sum of them. The ledger has a row for each file
and month that was loaded, written after the data, and says what a file that is landed anew had
brought before: months that it no longer has are cleared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER = "file string, pickup_month date, rows long, file_id string"


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def ledger(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(path) if _exists(spark, path) else spark.createDataFrame([], LEDGER)


def bronze_loader(bronze_path: str, ledger_path: str, to_bronze: Callable[[DataFrame], DataFrame], file_col: str = "_file") -> Callable[[DataFrame, int], None]:
    """A batch function for ``foreachBatch``.

    ``to_bronze`` turns a batch, whose ``file_col`` names each row's file, into bronze rows with
    pickup_month; it must keep ``file_col``.
    """

    def write(df: DataFrame, path: str, *by: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)

    def load(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        rows = to_bronze(batch).withColumn("file_id", F.md5(file_col))
        # A task reads whole files or a split of a large one, so its rows fall into few (month, file)
        # partitions as they are: no shuffle.
        write(rows, bronze_path, "pickup_month", "file_id")
        now = rows.groupBy(F.col(file_col).alias("file"), "pickup_month", "file_id").agg(F.count("*").alias("rows")).checkpoint(eager=True)
        before = ledger(spark, ledger_path).join(now.select("file_id").distinct(), "file_id", "left_semi")
        gone = before.join(now.select("file_id", "pickup_month"), ["file_id", "pickup_month"], "left_anti")
        for r in gone.select("pickup_month", "file_id").collect():  # months of files that were landed anew
            p = spark._jvm.org.apache.hadoop.fs.Path(f"{bronze_path}/pickup_month={r['pickup_month'].isoformat()}/file_id={r['file_id']}")
            p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        write(now.coalesce(1), ledger_path, "file_id")

    return load
