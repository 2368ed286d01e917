"""Monthly run end to end: idempotent re-runs, order independence, strays, backfill."""

import datetime as dt
import glob
import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from strata.operators.quality import expectations as X
from strata.ops.profile import partition_fingerprint
from strata.plans.monthly import Tables, backfill, land_months, run_month
from strata.sinks.writers import overwrite_partitions
from strata.sources import testbed
from strata.sources.landing import ManifestMismatch, landing_path

SF = "/root/testdata/sf0.001"
SUITE = [X.E(X.ROW_COUNT, min_value=1, max_value=10**9), X.E(X.BETWEEN, column="PULocationID", min_value=1, max_value=265)]
META = ["_run_id", "_source_url", "_source_sha256", "_ingested_at", "_schema_version"]
JAN, FEB, MAR = dt.date(1996, 1, 1), dt.date(1996, 2, 1), dt.date(1996, 3, 1)


def landing(spark, tmp_dir):
    root = os.path.join(tmp_dir, "landing")
    raw = testbed.trips_raw(spark, SF).filter(F.year("tpep_pickup_datetime") == 1996)
    # a file holds the trips of its month whose pickup + 1 day falls in it: pickups of a
    # month's last day arrive late, in the next month's file
    land_months(raw, root, F.date_trunc("month", F.col("tpep_pickup_datetime") + F.expr("INTERVAL 1 DAY")).cast("date"))
    return root


def fp(spark, path):
    df = spark.read.parquet(path)
    return sorted(tuple(r) for r in partition_fingerprint(df, ["pickup_month"], META).collect())


def test_rerun_and_order_give_same_tables(spark, tmp_dir):
    root = landing(spark, tmp_dir)
    a, b = Tables(os.path.join(tmp_dir, "a")), Tables(os.path.join(tmp_dir, "b"))
    for m in (JAN, FEB, MAR):
        run_month(spark, a, root, m, suite=SUITE)
    for m in (MAR, JAN, FEB, FEB):  # out of order, and February twice
        run_month(spark, b, root, m, suite=SUITE)
    assert fp(spark, a.bronze) == fp(spark, b.bronze)
    assert fp(spark, a.fct_trips) == fp(spark, b.fct_trips)
    months = {r.pickup_month for r in spark.read.parquet(a.bronze).select("pickup_month").distinct().collect()}
    assert months == {JAN, FEB, MAR}  # strays never reach neighbour partitions
    assert spark.read.parquet(a.late_or_early).count() > 0
    shas = spark.read.parquet(a.bronze).select("_source_url", "_source_sha256").distinct().collect()
    assert shas and all(len(r._source_sha256) == 64 and r._source_url.endswith(".parquet") for r in shas)
    audit = spark.read.parquet(b.pipeline_audit)
    assert audit.count() == 4 and audit.filter(F.col("status") == "SUCCESS").count() == 4


def test_failing_gate_quarantines_the_month(spark, tmp_dir):
    root = landing(spark, tmp_dir)
    t = Tables(os.path.join(tmp_dir, "q"))
    out = run_month(spark, t, root, JAN, suite=[X.E(X.ROW_COUNT, min_value=10**9, max_value=10**10)])
    assert out["status"] == "QUARANTINED" and out["quarantined"] == out["bronze"] and out["silver"] == 0
    q = spark.read.parquet(t.quarantine)
    assert q.select("_failure_reason").distinct().first()[0].startswith(X.ROW_COUNT)


def test_backfill_skips_loaded_months_unless_forced(spark, tmp_dir):
    root = landing(spark, tmp_dir)
    t = Tables(os.path.join(tmp_dir, "bf"))
    first = backfill(spark, t, root, "1996-01", "1996-02", suite=SUITE)
    again = backfill(spark, t, root, "1996-01", "1996-03", suite=SUITE)
    assert [r["month"] for r in first] == [JAN, FEB] and [r["month"] for r in again] == [MAR]
    forced = backfill(spark, t, root, "1996-01", "1996-01", force=True, suite=SUITE)
    assert len(forced) == 1


def test_overwrite_restricted_to_target_month(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    df = spark.createDataFrame([(JAN, 1), (FEB, 2), (FEB, 3)], "pickup_month date, v int")
    overwrite_partitions(df, path)
    stray = spark.createDataFrame([(JAN, 9), (FEB, 99)], "pickup_month date, v int")
    n = overwrite_partitions(stray, path, months=[JAN])
    out = sorted((r.pickup_month, r.v) for r in spark.read.parquet(path).collect())
    assert n == 1 and out == [(JAN, 9), (FEB, 2), (FEB, 3)]


def test_schema_evolution_across_months(spark, tmp_dir):
    """Old months land without the optional columns, a later month with a new column:
    bronze gains the columns, earlier months read them as NULL (silver coalesces to 0)."""
    root = os.path.join(tmp_dir, "landing")
    raw = testbed.trips_raw(spark, SF).filter(F.year("tpep_pickup_datetime") == 1996)
    month = F.date_trunc("month", "tpep_pickup_datetime").cast("date")
    old = raw.filter(F.month("tpep_pickup_datetime") == 1).drop("congestion_surcharge", "airport_fee")
    land_months(old, root, month)
    new = raw.filter(F.month("tpep_pickup_datetime") == 2).withColumn("cbd_fee", F.lit(0.75))
    land_months(new, root + "-new", month)
    t = Tables(os.path.join(tmp_dir, "evo"))
    run_month(spark, t, root, JAN, suite=SUITE)
    run_month(spark, t, root + "-new", FEB, suite=SUITE)
    b = spark.read.option("mergeSchema", "true").parquet(t.bronze)
    assert {"congestion_surcharge", "airport_fee", "cbd_fee"} <= set(b.columns)
    assert dict(b.dtypes)["cbd_fee"] == "double"  # new columns keep their real type
    jan = b.filter(F.col("pickup_month") == JAN)
    assert jan.filter(F.col("airport_fee").isNotNull() | F.col("cbd_fee").isNotNull()).count() == 0
    stg = spark.read.parquet(t.stg_trips).filter(F.col("pickup_month") == JAN)
    assert stg.filter(F.col("airport_fee") != 0).count() == 0 and stg.count() == jan.count()


def test_quarantine_append_mode_keeps_every_run(spark, tmp_dir):
    root = landing(spark, tmp_dir)
    t = Tables(os.path.join(tmp_dir, "qa"))
    fail = [X.E(X.ROW_COUNT, min_value=10**9, max_value=10**10)]
    from strata.plans.models import RunParams

    a = run_month(spark, t, root, JAN, RunParams(run_id="r1"), suite=fail, quarantine_mode="append")
    run_month(spark, t, root, JAN, RunParams(run_id="r2"), suite=fail, quarantine_mode="append")
    q = spark.read.parquet(t.quarantine)
    assert q.count() == 2 * a["quarantined"]
    assert {r[0] for r in q.select("_quarantine_run_id").distinct().collect()} == {"r1", "r2"}


def test_declared_manifest_is_checked_before_loading(spark, tmp_dir):
    base = os.path.join(tmp_dir, "with space")  # paths that Spark encodes
    raw = testbed.trips_raw(spark, SF).filter(F.date_trunc("month", "tpep_pickup_datetime") == F.lit(JAN))
    land_months(raw.coalesce(1), os.path.join(base, "landing"), F.lit(JAN))
    root = os.path.join(base, "landing")
    folder = landing_path(root, 1996, 1)
    file = glob.glob(os.path.join(folder, "*.parquet"))[0]
    sha = hashlib.sha256(open(file, "rb").read()).hexdigest()
    rec = {"url": "x", "sha256": sha, "byte_size": os.path.getsize(file), "row_count": raw.count(), "ingested_at": "t"}

    def declare(**change):
        with open(os.path.join(folder, "_manifest.json"), "w") as f:
            json.dump(rec | change, f)

    t = Tables(os.path.join(base, "w"))
    for change in ({"row_count": rec["row_count"] + 1}, {"byte_size": 1}, {"sha256": "0" * 64}):
        declare(**change)
        with pytest.raises(ManifestMismatch, match=next(iter(change))):
            run_month(spark, t, root, JAN, suite=SUITE)
    assert not os.path.exists(t.bronze)
    assert {r.status for r in spark.read.parquet(t.pipeline_audit).collect()} == {"FAILED"}
    declare()
    for verify in (True, False):
        assert run_month(spark, t, root, JAN, suite=SUITE, verify_sha=verify)["status"] == "SUCCESS"
        assert [r[0] for r in spark.read.parquet(t.bronze).select("_source_sha256").distinct().collect()] == [sha]
