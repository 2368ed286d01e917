"""Plans of the trip source and of the steps that store it: what is shuffled, how often and how wide."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from strata.operators import privacy
from strata.sources import testbed

SF0001 = "/root/testdata/sf0.001"


def optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_line_items_are_shuffled_once(spark):
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = testbed.trips_raw(spark, SF0001)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    keys = sorted(re.findall(r"Exchange hashpartitioning\((\w+)#", plan))
    assert keys == ["c_custkey", "l_orderkey", "o_custkey", "o_orderkey"]


def test_repeated_and_null_keys_join_as_before(spark, tmp_dir):
    def put(name, rows):
        spark.createDataFrame(rows, testbed.SCHEMAS[name]).write.parquet(f"{tmp_dir}/{name}.parquet")

    day = dt.datetime(1997, 3, 1)
    put("lineitem", [(k, 1, s, 1, 1.0, 10.0, 0.1, 0.1, "N", "O", day) for k, s in ((1, 7), (1, 8), (2, 7), (3, 7), (None, 7), (1, None))])
    put("orders", [(1, 5, "O", 1.0, day, "1-URGENT"), (2, 5, "O", 1.0, day, "2-HIGH"), (2, 6, "O", 1.0, day, "3-LOW"), (3, None, "O", 1.0, day, "1-URGENT")])
    put("customer", [(5, "a", 1, 1.0, "x"), (5, "b", 2, 1.0, "x"), (6, "c", 3, 1.0, "x")])
    put("supplier", [(7, "s", 1, 1.0), (7, "t", 2, 1.0)])
    got = testbed.trips_raw(spark, tmp_dir).groupBy("PULocationID", "DOLocationID", "payment_type").count().collect()
    # order 1: supplier 7 twice x customer 5 twice; order 2: the same, and customer 6; order 3 has no customer.
    want = {(p, d, t): 1 for p in (2, 3) for d, t in ((2, 0), (3, 0), (2, 1), (3, 1), (4, 2))}
    assert {tuple(r)[:3]: r["count"] for r in got} == want


def test_token_seed_is_computed_once_a_row(spark):
    t = dt.datetime(2023, 1, 15, 8, 0)
    b = spark.createDataFrame([(2, t), (None, t), (1, None)], "VendorID int, tpep_pickup_datetime timestamp")
    fresh = privacy.tokenize_with_fresh_lookup(b, "s", 1)
    assert optimized(fresh).count("cast(tpep_pickup_datetime#") <= 1  # folded into literals for local rows, or one cast
    stored = b.repartition(2)
    assert optimized(privacy.tokenize_with_fresh_lookup(stored, "s", 1)).count(" AS _pii_seed#") == 1
    joined = privacy.tokenize_bronze(b, privacy.build_pii_lookup(b), "s", 1)
    assert fresh.columns == [*b.columns, *[c for c in joined.columns if c not in b.columns]]
    assert sorted(map(str, fresh.select(*joined.columns).collect())) == sorted(map(str, joined.collect()))


def test_landing_tasks_of_the_compaction_grow_with_the_rows(spark, monkeypatch):
    from strata.plans import q_ops

    monkeypatch.setattr(q_ops, "LANDING_ROWS", 500)
    rows = q_ops.q_compact_partition(spark, SF0001).collect()
    assert sum(r.rows for r in rows) == testbed.trips_raw(spark, SF0001).count()
    assert min(r.files for r in rows) == 1 and max(r.files for r in rows) > 4


def test_compaction_shuffles_no_rows(spark, tmp_dir):
    from strata.ops import files

    spark.range(1000).repartition(8).write.parquet(f"{tmp_dir}/t")
    t = spark.read.parquet(f"{tmp_dir}/t")
    merged = files._merged(t, 1)
    assert merged.rdd.getNumPartitions() == 1 and "Repartition 1, false" in optimized(merged)
    parts = t.rdd.getNumPartitions()
    assert files._merged(t, parts + 3).rdd.getNumPartitions() == parts + 3


def spied(monkeypatch, module):
    plans, write = {}, module.overwrite_partitions

    def spy(df, path, *a, **k):
        plans.setdefault(path.rsplit("/", 1)[-1], optimized(df))
        return write(df, path, *a, **k)

    monkeypatch.setattr(module, "overwrite_partitions", spy)
    return plans


def test_stored_trips_are_shuffled_before_tokens(spark, tmp_dir, monkeypatch):
    from strata.plans import q_history
    from strata.plans.models import TripModels
    from strata.plans.monthly import Tables

    plans = spied(monkeypatch, q_history)
    q_history.stored_tables(TripModels.from_testbed(spark, SF0001), Tables(f"{tmp_dir}/tables"))
    assert plans["bronze"].index("sha2(") < plans["bronze"].index("RebalancePartitions")  # the plan's root comes first
    for name in ("stg_trips", "fct_trips"):
        assert "Rebalance" not in plans[name] and "Join" not in plans[name]


def test_fingerprinted_rows_are_shuffled_before_tokens(spark, monkeypatch):
    from strata.plans import q_history

    plans = spied(monkeypatch, q_history)
    q_history.q_incremental_fingerprint(spark, SF0001)
    first = next(iter(plans.values()))
    assert first.index("sha2(") < first.index("RebalancePartitions")


def test_incremental_load_does_not_shuffle_the_batch(spark, tmp_dir, monkeypatch):
    from strata.streaming.load import bronze_loader, ledger

    batch = spark.createDataFrame([("f", dt.date(2023, 1, 1), 1), ("f", dt.date(2023, 2, 1), 2), ("g", None, 3)], "_file string, pickup_month date, x int")
    monkeypatch.setattr(type(batch), "hint", lambda *a: pytest.fail("the batch is dealt anew"))
    bronze_loader(f"{tmp_dir}/b", f"{tmp_dir}/l", lambda b: b)(batch, 0)
    assert spark.read.parquet(f"{tmp_dir}/b").agg(F.sum("x")).first()[0] == 6
    assert ledger(spark, f"{tmp_dir}/l").count() == 3


def test_small_lookup_is_broadcast_in_the_whole_run(spark, tmp_dir, monkeypatch):
    from strata.plans import graph
    from strata.plans.monthly import Tables, land_months

    class Seen(Exception):
        pass

    def tokens(keep, lookup, salt, version, broadcast_rows=None):
        raise Seen(broadcast_rows)

    month = dt.date(1997, 1, 1)
    raw = testbed.trips_raw(spark, SF0001).where("trunc(tpep_pickup_datetime, 'month') = DATE '1997-01-01'")
    land_months(raw, f"{tmp_dir}/landing", F.trunc("tpep_pickup_datetime", "month"))
    monkeypatch.setattr(graph.privacy, "tokenize_bronze", tokens)
    for most, want in ((10**6, 10**6), (1, None)):
        monkeypatch.setattr(graph, "LOOKUP_BROADCAST_ROWS", most)
        with pytest.raises(Seen) as e:
            graph.run_graph(spark, Tables(f"{tmp_dir}/t{most}"), f"{tmp_dir}/landing", [month], testbed.zone_seed(spark, SF0001))
        assert e.value.args == (want,)
