"""Uniqueness of a new month's keys against all stored months, without moving the stored ones.

The keys of every loaded month are kept in one table, partitioned by month and bucketed by the key:
equal keys of all months are in files of one bucket number. New keys are dealt to as many
partitions by the same hash, so the join reads each bucket where it lies and only the new side is
shuffled. A month that is loaded anew replaces its own partition.

A key has one row a month with the number of its rows, so a key that a third of all rows share
is no more than a row for each month.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Buckets of a key table; fixed for its life. About the cores that read it at once, or more.
BUCKETS = 64


@dataclass(frozen=True)
class KeyHistory:
    """The key table ``name`` at ``path``, with one string, number or date column for each of ``types``."""

    spark: SparkSession
    name: str
    path: str
    types: dict[str, str]
    buckets: int = BUCKETS

    def open(self) -> "KeyHistory":
        """Make the table known to the session, with the months that are stored already."""
        cols = ", ".join(f"`{c}` {t}" for c, t in self.types.items())
        keys = ", ".join(f"`{c}`" for c in self.types)
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.name} ({cols}, n BIGINT, month DATE) USING parquet "
            f"PARTITIONED BY (month) CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'"
        )
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at):
            self.spark.sql(f"MSCK REPAIR TABLE {self.name}")
        return self

    def forget(self) -> None:
        """Drop the table's name; its files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def _counted(self, rows: DataFrame, *more: str) -> DataFrame:
        keys = [F.col(c).cast(t).alias(c) for c, t in self.types.items()]
        return rows.select(*keys, *more).groupBy(*self.types, *more).agg(F.count("*").alias("n"))

    def store(self, rows: DataFrame, month_col: str = "month") -> None:
        """Keep the keys of the months in ``rows``; months that are stored already are replaced."""
        counted = self._counted(rows.withColumn("month", F.col(month_col).cast("date")), "month")
        # One file a bucket and month: a task has one bucket.
        counted = counted.repartition(self.buckets, *self.types).select(*self.types, "n", "month")
        before = self.spark.conf.get("spark.sql.sources.partitionOverwriteMode")
        self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        try:
            counted.write.insertInto(self.name, overwrite=True)
        finally:
            self.spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)

    def repeated(self, rows: DataFrame, month: dt.date) -> DataFrame:
        """(key columns, new_rows, history_rows, months, first_month): keys of ``rows`` that a month other
        than ``month`` has, or that ``rows`` has twice. Keys with a null are not judged."""
        complete = F.lit(True)
        for c in self.types:
            complete = complete & F.col(c).isNotNull()
        new = self._counted(rows).where(complete).withColumnRenamed("n", "new_rows").repartition(self.buckets, *self.types)
        old = self.spark.table(self.name).where(F.col("month") != F.lit(month))
        # Stored rows stream past a hash table of the bucket's new keys; only those that match go on.
        met = old.join(new.hint("shuffle_hash"), list(self.types)).select(*self.types, "new_rows", "n", "month")
        twice = new.where("new_rows > 1").select(*self.types, "new_rows", F.lit(0).cast("long").alias("n"), F.lit(None).cast("date").alias("month"))
        return met.unionByName(twice).groupBy(*self.types).agg(
            F.max("new_rows").alias("new_rows"), F.sum("n").alias("history_rows"),
            F.count("month").alias("months"), F.min("month").alias("first_month"),
        )


def key_types(df: DataFrame, columns: list[str]) -> dict[str, str]:
    """The declared types of key columns, for :class:`KeyHistory`."""
    plain = (T.StringType, T.IntegralType, T.DateType, T.TimestampType, T.DecimalType)
    wrong = [c for c in columns if not isinstance(df.schema[c].dataType, plain)]
    if wrong:
        raise TypeError(f"no keys: {wrong}")
    return {c: df.schema[c].dataType.simpleString() for c in columns}
