"""The whole run over several months: every step on record, broken runs, repeated keys, re-runs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from strata.operators.quality import expectations as X
from strata.ops.steps import Steps
from strata.plans import graph
from strata.plans.graph import RepeatedKeys, TestsFailed, run_graph
from strata.plans.models import RunParams
from strata.plans.monthly import Tables, land_months, run_month
from strata.sources import testbed
from tests.conftest import SF0001

MONTHS = [dt.date(1996, 1, 1), dt.date(1996, 2, 1)]
GOOD, BAD = [X.E(X.ROW_COUNT, min_value=1)], [X.E(X.ROW_COUNT, min_value=10**9)]
ORDER = ["landing_to_bronze", "ge_bronze", "silver", "silver_tests", "dimensions", "gold", "serving", "gold_tests", "ge_gold"]
P = RunParams(run_id="r")


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("landing"))
    raw = testbed.trips_raw(spark, SF0001)
    shifted = F.date_trunc("month", F.col("tpep_pickup_datetime") + F.expr("INTERVAL 4 DAYS")).cast("date")  # last days arrive late
    land_months(raw.where(shifted.isin(MONTHS)), root, shifted)
    return root, testbed.zone_seed(spark, SF0001)


def content(spark, path, drop=("_source_url", "_source_sha256")):
    df = spark.read.parquet(path)
    return sorted(map(str, df.select(*sorted(c for c in df.columns if c not in drop)).collect()))


def test_steps_and_tables_are_those_of_the_monthly_runs(spark, landing, tmp_dir):
    root, zones = landing
    t, single = Tables(tmp_dir + "/graph"), Tables(tmp_dir + "/single")
    audit = run_graph(spark, t, root, MONTHS, zones, P, GOOD, GOOD).collect()
    for m in MONTHS:
        run_month(spark, single, root, m, P, suite=GOOD, zone_seed=zones)
    for name in ("bronze", "late_or_early", "pii_lookup", "pii_filters", "stg_trips", "fct_trips", "fct_trips_daily", "fct_tokenization_audit"):
        assert content(spark, getattr(t, name)) == content(spark, getattr(single, name)), name
    tasks = sorted({(r.started_at, r.task_id) for r in audit})
    assert [x for _, x in tasks] == ORDER
    assert all(r.finished_at > r.started_at and r.duration_sec > 0 for r in audit)
    by = {(r.task_id, r.run_id): r for r in audit}
    for m in MONTHS:
        load, gate = by["landing_to_bronze", f"r-{m:%Y%m}"], by["ge_bronze", f"r-{m:%Y%m}"]
        kept = spark.read.parquet(t.bronze).where(F.col("pickup_month") == F.lit(m)).count()
        assert load.rows_in > load.rows_out == kept == gate.rows_out and gate.status == "SUCCESS"
    tests = by["gold_tests", "r"]
    assert tests.rows_in == spark.read.parquet(t.gold_tests).count() > 15
    assert spark.read.parquet(t.v_trips_summary).count() == spark.read.parquet(t.fct_trips_daily).count() > 0
    snapshot = content(spark, t.zone_snapshot)
    run_graph(spark, t, root, MONTHS, zones, P, GOOD, GOOD)
    assert content(spark, t.zone_snapshot) == snapshot and content(spark, t.fct_trips) == content(spark, single.fct_trips)


def test_a_failing_month_stops_at_the_gate(spark, landing, tmp_dir):
    root, zones = landing
    t = Tables(tmp_dir + "/w")
    first = spark.read.parquet(root).groupBy("month").count().orderBy("count").collect()
    suite = [X.E(X.ROW_COUNT, min_value=first[0]["count"], max_value=10**9)]  # the smaller month has lost its strays
    audit = run_graph(spark, t, root, MONTHS, zones, P, suite, BAD).collect()
    gate = {r.run_id: r for r in audit if r.task_id == "ge_bronze"}
    failed = [k for k, r in gate.items() if r.status == "QUARANTINED"]
    assert len(gate) == 2 and 1 <= len(failed) <= 2
    assert all(gate[k].rows_quarantined == gate[k].rows_in and gate[k].ge_failed_expectations for k in failed)
    later = {(r.task_id, r.run_id) for r in audit if r.task_id in ("silver", "gold", "serving", "ge_gold")}
    assert not any(k == run for _, run in later for k in failed)
    assert all(r.status == "FAILED" and r.error_message for r in audit if r.task_id == "ge_gold")


def test_a_broken_step_is_on_record(spark, landing, tmp_dir, monkeypatch):
    root, zones = landing
    t = Tables(tmp_dir + "/w")
    monkeypatch.setattr(graph.facts, "fct_trips", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost it")))
    with pytest.raises(RuntimeError):
        run_graph(spark, t, root, MONTHS, zones, P, GOOD, GOOD)
    rows = spark.read.parquet(t.step_audit).collect()
    assert {r.task_id for r in rows if r.status == "FAILED" and "lost it" in (r.error_message or "")} == {"gold"}
    assert {r.task_id for r in rows} == set(ORDER[: ORDER.index("gold") + 1])


def test_repeated_zone_keys_are_refused(spark, landing, tmp_dir):
    root, zones = landing
    t = Tables(tmp_dir + "/w")
    with pytest.raises(RepeatedKeys, match=r"\[1\]"):
        run_graph(spark, t, root, MONTHS[:1], zones.unionByName(zones.where("LocationID = 1")), P, GOOD, GOOD)
    failed = spark.read.parquet(t.step_audit).where("status = 'FAILED' AND task_id = 'dimensions'").collect()
    assert len(failed) == 1 and "RepeatedKeys" in failed[0].error_message


def test_a_run_can_stop_at_failed_tests(spark, landing, tmp_dir):
    root, zones = landing
    t = Tables(tmp_dir + "/w")
    with pytest.raises(TestsFailed, match="borough"):
        run_graph(spark, t, root, MONTHS[:1], zones, P, GOOD, GOOD, stop_at_failed_tests=True)  # the test zones have other boroughs
    assert {r.task_id for r in spark.read.parquet(t.step_audit).collect()} == set(ORDER[:4])


def test_clock_and_defaults_of_a_step(spark, tmp_dir):
    ticks = iter(dt.datetime(2024, 1, 1, 0, 0, s) for s in (1, 4))
    with Steps(spark, tmp_dir + "/a", "x", clock=lambda: next(ticks)).audited("t", "gold", "g", [MONTHS[0]]) as step:
        step.report(MONTHS[0], rows_in=3)
    r = spark.read.parquet(tmp_dir + "/a").first()
    assert (r.run_id, r.status, r.rows_in, r.rows_out, r.duration_sec) == ("x-199601", "SUCCESS", 3, 0, 3.0)
