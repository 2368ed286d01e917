"""The monthly run when the gate turns, a month is empty, or a run breaks off; gate bounds."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import ingest
from strata.operators.quality import expectations as X
from strata.operators.scd2 import duplicate_source_keys, scd2_merge
from strata.plans import monthly
from strata.plans.monthly import Tables, backfill, land_months, run_month
from strata.sources import testbed

GOOD = [X.E(X.ROW_COUNT, min_value=1)]
BAD = [X.E(X.ROW_COUNT, min_value=10**9)]
PUBLISHED = ("stg_trips", "fct_trips", "fct_trips_daily", "fct_tokenization_audit")


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    raw = testbed.trips_raw(spark, "/root/testdata/sf0.001")
    months = [r.m for r in raw.select(F.trunc("tpep_pickup_datetime", "month").alias("m")).distinct().orderBy("m").limit(2).collect()]
    root = str(tmp_path_factory.mktemp("landing"))
    month = F.trunc("tpep_pickup_datetime", "month")
    land_months(raw.where(month.isin(months)), root, month)
    return root, months


def rows(spark, path, month):
    if not monthly._exists(spark, path):
        return 0
    try:
        return spark.read.parquet(path).where(F.col("pickup_month") == F.lit(month)).count()
    except monthly.AnalysisException:
        return 0


def test_gate_flip_leaves_one_side_populated(spark, landing, tmp_dir):
    root, (m, _) = landing
    t = Tables(tmp_dir + "/w")
    for suite, ok in ((GOOD, True), (BAD, False), (GOOD, True)):
        out = run_month(spark, t, root, m, suite=suite)
        assert out["status"] == ("SUCCESS" if ok else "QUARANTINED")
        assert all((rows(spark, getattr(t, x), m) > 0) == ok for x in PUBLISHED)
        assert (rows(spark, t.quarantine, m) > 0) != ok


def test_empty_month_fails_the_gate_and_does_not_block(spark, landing, tmp_dir):
    root, (m, after) = landing
    t, strays = Tables(tmp_dir + "/w"), tmp_dir + "/strays"
    raw = spark.read.parquet(root).where(F.trunc("tpep_pickup_datetime", "month") == F.lit(m)).drop("year", "month")
    land_months(raw, strays, F.lit(dt.date(2030, 1, 1)))
    assert run_month(spark, t, strays, dt.date(2030, 1, 1), suite=GOOD)["status"] == "QUARANTINED"
    assert run_month(spark, t, root, after, suite=GOOD)["status"] == "SUCCESS"


def test_broken_run_is_on_record_and_loaded_again(spark, landing, tmp_dir, monkeypatch):
    root, (m, _) = landing
    t, name = Tables(tmp_dir + "/w"), f"{m:%Y-%m}"

    def broken(*a, **k):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(monthly.facts, "fct_trips", broken)
        with pytest.raises(RuntimeError):
            run_month(spark, t, root, m, suite=GOOD)
    assert [r.status for r in spark.read.parquet(t.pipeline_audit).collect()] == ["FAILED"]
    assert len(backfill(spark, t, root, name, name, suite=GOOD)) == 1
    assert backfill(spark, t, root, name, name, suite=GOOD) == []


@pytest.mark.parametrize(("bad", "n", "mostly"), [(1, 10, 0.9), (1, 100, 0.99), (1, 1000, 0.999), (1, 10000, 0.9999)])
def test_mostly_holds_at_its_bound(spark, bad, n, mostly):
    suite = [X.E(X.BETWEEN, column="v", min_value=0, max_value=1, mostly=mostly)]
    for k, ok in ((bad, True), (bad + 1, False)):
        df = spark.range(n).select(F.when(F.col("id") < k, 9).otherwise(1).alias("v"))
        assert X.evaluate_suite(df, suite).first().success == ok


def test_absent_column_fails_unless_optional(spark):
    df = spark.range(3)
    suite = [X.E(X.NOT_NULL, column="gone"), X.E(X.LENGTH_EQ, column="passenger_id_token", value=64), X.E(X.ROW_COUNT, min_value=1)]
    v = X.gate_verdict(X.evaluate_suite(df, suite)).first()
    assert (v.evaluated, v.success) == (2, False)
    assert X.gate_verdict(X.evaluate_suite(df, suite, skip_optional=False)).first().evaluated == 3


def test_align_schema_casts_to_the_stored_type(spark):
    target = T.StructType().add("k", T.IntegerType()).add("extra", T.DoubleType())
    out, added = ingest.align_schema(spark.createDataFrame([(1, "2.5"), (2**40, "x")], "k long, extra string"), target)
    assert out.schema.simpleString() == "struct<k:int,extra:double>" and not added
    assert sorted(map(tuple, out.collect()), key=str) == sorted([(1, 2.5), (None, None)], key=str)


def test_scd2_repeated_source_keys_count_once(spark):
    src = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k long, v string")
    first = scd2_merge(None, src, "k", ["v"], "2024-01-01 00:00:00")
    again = scd2_merge(first, src, "k", ["v"], "2024-01-02 00:00:00")
    assert first.count() == again.count() == 2 and again.where("valid_to IS NULL").count() == 2
    assert [tuple(r) for r in duplicate_source_keys(src, "k").collect()] == [(1, 2)]
