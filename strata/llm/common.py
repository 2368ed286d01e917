"""Small helpers of the operators: tables, stored intermediate results, joins of checked size."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import ensure_checkpoint_dir

#: A side is broadcast only if its stored files hold at most so many bytes; else the planner
#: shuffles both sides and AQE splits skewed partitions. The rows are the same either way.
BROADCAST_BYTES = 32 << 20
#: Python works on slices of an Arrow batch with at most about so many bytes of text.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder of ``spark.checkpoint.dir`` and read it back.

    This cuts the lineage: a lost executor costs the tasks that read these files, not the work
    that made them. Every call takes a new path, so jobs that run at the same time do not meet.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files behind a stored table, as the file listing of its plan has them."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def attach(docs: DataFrame, side: DataFrame, on: str) -> DataFrame:
    """``docs`` left join the stored table ``side``; null keys meet null keys.

    ``side`` has one row a key. It is broadcast if its stored size is within BROADCAST_BYTES
    (text then stays where it was read), else both sides are shuffled on the key.
    """
    key = side.withColumnRenamed(on, "_key")
    if stored_bytes(side) <= BROADCAST_BYTES:
        key = F.broadcast(key)
    return docs.join(key, docs[on].eqNullSafe(key["_key"]), "left").drop("_key")


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the text of each piece stays near ``limit`` bytes (one row at least)."""
    import numpy as np
    import pyarrow.compute as pc

    for b in batches:
        if not b.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes, dtype=np.int64)
        at = 0
        while at < b.num_rows:
            before = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, before + limit, "right")))
            yield b.slice(at, to - at)
            at = to


def path_under(spark: SparkSession, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark), name)
