"""Audit records and run metrics, profiles, fingerprints, file manifest and telemetry."""

import datetime as dt
import glob
import hashlib
import os

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from strata.ops import audit as A
from strata.ops import files, profile
from strata.sources.landing import build_manifest, validate_manifest

SF = "/root/testdata/sf0.001"
T0 = dt.datetime(2023, 1, 15, 2, 0, 0)


def rec(**kw):
    base = dict(run_id="run-123", dag_id="d", task_id="landing_to_bronze", layer="bronze", table_name="bronze.t",
                started_at=T0, finished_at=T0 + dt.timedelta(minutes=5), status="SUCCESS")
    base.update(kw)
    return A.AuditRecord(**base)


def test_audit_defaults_duration_and_quotes(spark):
    r = rec(error_message="it's \"quoted\"", status="FAILED")
    df = A.audit_frame(spark, [r, rec(run_id="run-124", started_at=T0 + dt.timedelta(days=1),
                                      finished_at=T0 + dt.timedelta(days=1, minutes=1))])
    row = df.orderBy("run_id").first()
    assert row.duration_sec == 300.0 and row.rows_in == 0 and row.ge_pass_rate == 1.0
    assert row.ge_failed_expectations == [] and row.triggered_by == "scheduled" and row.schema_version == 1
    assert row.error_message == "it's \"quoted\""
    m = A.latest_metrics(df).first()
    assert m.status_code == 1 and m.last_finished_ts == T0 + dt.timedelta(days=1, minutes=1)
    lb = A.failed_leaderboard(df).first()
    assert lb.failed_runs == 1 and lb.unsuccessful_runs == 1


def test_status_codes(spark):
    df = spark.createDataFrame([("SUCCESS",), ("FAILED",), ("QUARANTINED",)], "s string")
    assert [r[0] for r in df.select(A.status_code(F.col("s"))).collect()] == [1, 0, -1]


def test_fingerprint_ignores_order_and_metadata(spark):
    a = spark.createDataFrame([(1, "x", "r1"), (2, "y", "r1")], "v int, s string, _run_id string").withColumn("p", F.lit(1))
    b = spark.createDataFrame([(2, "y", "r2"), (1, "x", "r2")], "v int, s string, _run_id string").withColumn("p", F.lit(1))
    c = spark.createDataFrame([(2, "y", "r2"), (1, "z", "r2")], "v int, s string, _run_id string").withColumn("p", F.lit(1))
    fa, fb, fc = (profile.partition_fingerprint(d, ["p"], ["_run_id"]).first() for d in (a, b, c))
    assert fa == fb and fa != fc


def test_profile_and_all_null_rows(spark):
    df = spark.createDataFrame([(0, None, None), (0, 1.0, None), (1, None, None)], "pt int, a double, b double")
    p = {r.column_name: r for r in profile.column_profile(df, ["a"], approx=True).collect()}
    assert p["a"].null_count == 2 and p["a"].min_value == "1.0" and p["a"].p50 == 1.0
    out = {r.pt: r.all_null_rows for r in profile.all_null_rows(df, ["a", "b"], "pt").collect()}
    assert out == {0: 1, 1: 1}


def test_manifest_matches_files_on_disk(spark):
    m = {os.path.basename(r.path): r for r in build_manifest(spark, os.path.join(SF, "*.parquet")).collect()}
    for path in glob.glob(os.path.join(SF, "*.parquet")):
        r = m[os.path.basename(path)]
        assert r.sha256 == hashlib.sha256(open(path, "rb").read()).hexdigest()
        assert r.byte_size == os.path.getsize(path)
        assert r.row_count == pq.ParquetFile(path).metadata.num_rows
    declared = build_manifest(spark, os.path.join(SF, "lineitem.parquet"))
    bad = declared.withColumn("row_count", F.col("row_count") + 1)
    assert validate_manifest(declared, declared).first().valid
    assert not validate_manifest(bad, declared).first().valid


def test_file_telemetry_matches_listing(spark):
    fs = files.file_sizes(spark, os.path.join(SF, "*.parquet")).withColumn("t", F.lit("all"))
    r = files.file_telemetry(fs, "t", target_bytes=1024 * 1024).first()
    sizes = [os.path.getsize(p) for p in glob.glob(os.path.join(SF, "*.parquet"))]
    assert (r.files, r.total_bytes, r.min_bytes, r.max_bytes) == (len(sizes), sum(sizes), min(sizes), max(sizes))


def test_compaction_keeps_content(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    df = spark.range(1000).select((F.col("id") % 3).alias("p"), "id")
    df.repartition(10).write.partitionBy("p").parquet(path)
    before = profile.partition_fingerprint(spark.read.parquet(path), ["p"]).orderBy("p").collect()
    out = files.compact_partition(spark, path, "p", "1", path + "-staging", target_bytes=1 << 30)
    after = profile.partition_fingerprint(spark.read.parquet(path), ["p"]).orderBy("p").collect()
    assert before == after and out["files_after"] == 1
    assert len(glob.glob(os.path.join(path, "p=1", "*.parquet"))) == 1
