"""Available-now pick-up: new files are processed once; a second run finds nothing."""

import os
import shutil

from strata.streaming.pickup import ingest_available_now

SF = "/root/testdata/sf0.001"


def test_available_now_processes_each_file_once(spark, tmp_dir):
    src = os.path.join(tmp_dir, "landing")
    os.makedirs(src)
    shutil.copy(os.path.join(SF, "events.parquet"), os.path.join(src, "part-1.parquet"))
    schema = spark.read.parquet(os.path.join(SF, "events.parquet")).schema
    seen = []

    def batch(df, epoch):
        seen.append(df.count())

    ckpt = os.path.join(tmp_dir, "ckpt")
    assert ingest_available_now(spark, src, schema, ckpt, batch) == 1
    assert ingest_available_now(spark, src, schema, ckpt, batch) == 0
    shutil.copy(os.path.join(SF, "events.parquet"), os.path.join(src, "part-2.parquet"))
    assert ingest_available_now(spark, src, schema, ckpt, batch) == 1
    assert seen == [1000, 1000]
