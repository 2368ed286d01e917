"""As-of join, incremental fingerprint and incremental load against the whole computation."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from strata.operators import asof, scd2
from strata.ops import fingerprint
from strata.ops.profile import partition_fingerprint
from strata.sinks.writers import clear_partitions, overwrite_partitions
from strata.streaming.load import bronze_loader, ledger
from strata.streaming.pickup import ingest_available_now

T0 = dt.datetime(2020, 1, 1)


def hours(n):
    return None if n is None else T0 + dt.timedelta(hours=n)


@pytest.mark.parametrize("seed, slice_seconds", [(0, 3600), (1, 86400), (2, 10**9)])
def test_as_of_equals_point_in_time(spark, seed, slice_seconds):
    rng = random.Random(seed)
    versions = []
    for k in range(6):
        at = rng.randrange(40)
        for v in range(rng.randrange(5)):
            end = at + rng.randrange(1, 60)
            versions.append((k, hours(at), None if rng.random() < 0.3 and v == 3 else hours(end), f"{k}.{v}", rng.choice([None, "z"])))
            at = end + rng.choice([0, 0, 7])  # adjoining, or with a gap
    facts = [(i, rng.choice([0, 0, 0, 0, 1, 2, 3, 4, 5, 9, None]), hours(rng.choice([None, rng.randrange(300)])), "x") for i in range(400)]
    facts += [(1000 + i, k, a, "edge") for i, (k, a, b, *_) in enumerate(versions)] + [(2000 + i, k, b, "edge") for i, (k, a, b, *_) in enumerate(versions)]
    f = spark.createDataFrame(facts, "id int, k int, at timestamp, _version string")
    h = spark.createDataFrame(versions + [(1, None, None, "never", None)], "dk int, valid_from timestamp, valid_to timestamp, name string, other string")
    args = (f, h, "k", "dk", "at", ["name", "other"])
    want, got = scd2.point_in_time(*args), asof.as_of(*args, slice_seconds)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_as_of_spreads_a_hot_key_without_a_broadcast(spark):
    f = spark.range(20_000).select(F.lit(7).alias("k"), (F.lit(T0).cast("long") + F.col("id") * 60).cast("timestamp").alias("at"))
    h = spark.createDataFrame([(7, T0, None, "a")], "dk int, valid_from timestamp, valid_to timestamp, name string")
    j = asof.as_of(f, h, "k", "dk", "at", ["name"], 3600)
    assert "Broadcast" not in j._jdf.queryExecution().optimizedPlan().toString()
    assert j.where("dim_name = 'a'").count() == 20_000
    per = j.groupBy(F.floor(F.unix_timestamp("at") / 3600)).count().agg(F.max("count")).first()[0]
    assert per == 60  # a group of the scan is a key's hour
    none = asof.as_of(f.limit(0), h, "k", "dk", "at", ["name"])
    assert none.count() == 0 and asof.as_of(f, h.limit(0), "k", "dk", "at", ["name"]).where("dim_name IS NULL").count() == 20_000


def table(spark, months, seed=0):
    rng = random.Random(seed)
    rows = [(dt.date(2020, m, 1), rng.randrange(50), rng.choice([None, "a", "b"]), "run") for m in months for _ in range(40)]
    return spark.createDataFrame(rows, "pickup_month date, n int, s string, _run_id string")


def test_fingerprint_follows_changes_and_reads_only_them(spark, tmp_dir):
    path, state = tmp_dir + "/t", tmp_dir + "/state"
    skip = ["_run_id"]

    def checked():
        now, read = fingerprint.refresh(spark, path, state, "pickup_month", skip)
        whole = spark.read.parquet(path)
        want = {(str(r.pickup_month), r.rows, r.content_hash) for r in partition_fingerprint(whole, ["pickup_month"], skip).collect()}
        assert {tuple(r) for r in fingerprint.table_fingerprint(now, "part").collect()} == want
        return read

    overwrite_partitions(table(spark, [1, 2, 3]).coalesce(1), path)
    assert checked() == 3 and checked() == 0
    overwrite_partitions(table(spark, [4], 4).coalesce(1), path)
    assert checked() == 1  # added
    before = fingerprint.table_fingerprint(spark.read.parquet(state)).first()
    overwrite_partitions(table(spark, [2], 9).coalesce(1), path)
    assert checked() == 1 and fingerprint.table_fingerprint(spark.read.parquet(state)).first() != before
    clear_partitions(spark, path, "pickup_month", [dt.date(2020, 1, 1)])
    assert checked() == 0  # removed
    again = spark.read.parquet(path).where("pickup_month = DATE'2020-03-01'").withColumn("_run_id", F.lit("other")).repartition(3)
    again.checkpoint(eager=True).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("pickup_month").parquet(path)
    whole = fingerprint.table_fingerprint(spark.read.parquet(state)).first()
    assert checked() == 3 and fingerprint.table_fingerprint(spark.read.parquet(state)).first() == whole  # the same rows, other files


SCHEMA = "pickup_month date, n int"


def files(spark, root, name, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{root}/stage-{name}")
    made = next(f for f in os.listdir(f"{root}/stage-{name}") if f.endswith(".parquet"))
    os.makedirs(f"{root}/landing", exist_ok=True)
    os.replace(f"{root}/stage-{name}/{made}", f"{root}/landing/{name}.parquet")


def test_replays_and_split_months_give_one_result(spark, tmp_dir):
    jan, feb, mar = (dt.date(2020, m, 1) for m in (1, 2, 3))
    files(spark, tmp_dir, "a", [(jan, i) for i in range(10)] + [(feb, 1)])
    files(spark, tmp_dir, "b", [(jan, 100 + i) for i in range(5)])
    files(spark, tmp_dir, "c", [(mar, 7)])
    bronze, book = tmp_dir + "/bronze", tmp_dir + "/ledger"
    load = bronze_loader(bronze, book, lambda b: b)
    schema = spark.createDataFrame([], SCHEMA).schema

    def run(checkpoint, fn=load, per=1):
        named = lambda s: s.withColumn("_file", F.col("_metadata.file_path"))
        return ingest_available_now(spark, tmp_dir + "/landing", schema, f"{tmp_dir}/{checkpoint}", fn, named, per)

    def state():
        rows = sorted((r.pickup_month, r.n) for r in spark.read.parquet(bronze).collect())
        return rows, sorted((r.file[-9:], r.pickup_month, r.rows) for r in ledger(spark, book).collect())

    assert ledger(spark, book).count() == 0
    assert run("one") == 3
    want = state()
    assert len(want[0]) == 17 and want[1] == [("a.parquet", jan, 10), ("a.parquet", feb, 1), ("b.parquet", jan, 5), ("c.parquet", mar, 1)]
    assert run("one") == 0 and state() == want  # nothing new
    assert run("two", per=10) == 1 and state() == want  # everything once more, in one batch

    def dies(batch, epoch):
        load(batch, epoch)
        raise RuntimeError("after the write, before the checkpoint")

    files(spark, tmp_dir, "d", [(mar, 8)])
    with pytest.raises(Exception, match="after the write"):
        run("one", dies)
    assert run("one") == 1
    grown = state()
    assert grown[0] == sorted([*want[0], (mar, 8)]) and len(grown[1]) == 5

    files(spark, tmp_dir, "a", [(jan, 1)])  # landed anew with less: its February is gone
    assert run("three", per=10) == 1
    rows, on_record = state()
    assert [n for m, n in rows if m == feb] == [] and [n for m, n in rows if m == jan] == [1, 100, 101, 102, 103, 104]
    assert ("a.parquet", jan, 1) in on_record and len(on_record) == 4
