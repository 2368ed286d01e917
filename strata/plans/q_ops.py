"""Registered queries: audit-derived run metrics, profiles, fingerprints, files, streaming."""

from __future__ import annotations

import math
import os
import uuid

from pyspark.sql import functions as F

from strata.operators import ingest
from strata.ops import audit as A
from strata.ops import files, profile
from strata.plans import oracle as O
from strata.plans.models import TripModels
from strata.plans.q_quality import BRONZE_M, CHAIN_GATE, GOLD_RESULTS, GOLD_VERDICT, bronze_m, gold_verdict
from strata.plans.registry import models, register
from strata.schemas import SOURCE_TYPES
from strata.session import scratch_path
from strata.sources import testbed
from strata.streaming.pickup import ingest_available_now

AS_OF = "2002-01-01 00:00:00"


def audit_log(spark, sf_dir):
    """The audit table of one monthly run per data month (built once per session)."""
    from strata.plans.registry import built

    return built(spark, ("audit_log", sf_dir), lambda: _audit_log(spark, sf_dir))


def _audit_log(spark, sf_dir):
    """The audit table of one monthly run per data month (derived from the data and its gates).

    The bronze suite is evaluated once: its row-count results give the month counts and
    its verdict the gate outcome. Suite results and the gold verdict (one row per month)
    are materialised to the checkpoint folder, as the pipeline stores gate outcomes.
    """
    from strata.operators.quality import expectations as X
    from strata.plans.q_quality import bronze_results

    results = bronze_results(spark, sf_dir).checkpoint(eager=True)
    counts = results.filter(F.col("expectation_type") == X.ROW_COUNT).select(
        "pickup_month", F.col("element_count").alias("rows"))
    verdict = X.gate_verdict(results, ["pickup_month"], "testbed_bronze")
    # gate outcomes are per-month summaries the pipeline stores; materialise the gold one too
    gold = gold_verdict(spark, sf_dir).checkpoint(eager=True)
    return testbed.simulated_audit(counts, verdict, gold)


def _audit_sql() -> list[str]:
    def row(task, layer, table, rows_in, rows_out, quar, suite, rate, failed, s, f, status, err, where="TRUE"):
        return (
            f"SELECT 'run-' || strftime(pickup_month, '%Y%m') AS run_id, '{A.DAG_ID}' AS dag_id, '{task}' AS task_id, "
            f"'{layer}' AS layer, '{table}' AS table_name, 'testbed://lineitem' AS source_url, '' AS source_sha256, "
            f"CAST(1 AS INTEGER) AS schema_version, CAST({rows_in} AS BIGINT) AS rows_in, CAST({rows_out} AS BIGINT) AS rows_out, "
            f"CAST({quar} AS BIGINT) AS rows_quarantined, CAST({suite} AS VARCHAR) AS ge_suite_name, "
            f"CAST({rate} AS DOUBLE) AS ge_pass_rate, {failed} AS ge_failed_expectations, {s} AS started_at, {f} AS finished_at, "
            f"CAST(epoch_us({f}) - epoch_us({s}) AS DOUBLE) / 1e6 AS duration_sec, {status} AS status, "
            f"CAST({err} AS VARCHAR) AS error_message, 'scheduled' AS triggered_by FROM tt WHERE {where}"
        )

    empty = "CAST([] AS VARCHAR[])"
    return [
        GOLD_RESULTS,
        GOLD_VERDICT,
        "mc AS (SELECT pickup_month, COUNT(*) AS rows FROM bronze_m GROUP BY 1)",
        """jt AS (SELECT mc.pickup_month, mc.rows, b.pass_rate AS b_rate, b.failed_expectations AS b_failed,
    coalesce(b.success, false) AS b_ok, b.suite_name AS b_suite, g.pass_rate AS g_rate,
    g.failed_expectations AS g_failed, coalesce(g.success, false) AS g_ok, g.suite_name AS g_suite
  FROM mc LEFT JOIN bronze_verdict b ON mc.pickup_month = b.pickup_month
  LEFT JOIN gold_verdict g ON mc.pickup_month = g.pickup_month)""",
        """tt AS (SELECT *, s0, make_timestamp(epoch_us(s0) + 30000000 + rows * 10000) AS t1,
    make_timestamp(epoch_us(s0) + 30000000 + rows * 10000 + 10000000 + rows * 1000) AS t2,
    make_timestamp(epoch_us(s0) + 30000000 + rows * 10000 + 2 * (10000000 + rows * 1000)) AS t3
  FROM (SELECT *, CAST(pickup_month + INTERVAL 1 MONTH AS TIMESTAMP) + INTERVAL 2 HOUR AS s0 FROM jt))""",
        "audit AS ("
        + row("landing_to_bronze", "bronze", "bronze.trips", "rows", "rows", "0", "''", "1.0", empty,
              "s0", "t1", "'SUCCESS'", "NULL")
        + "\nUNION ALL\n"
        + row("ge_bronze", "bronze", "bronze.trips", "rows", "CASE WHEN b_ok THEN rows ELSE 0 END",
              "CASE WHEN b_ok THEN 0 ELSE rows END", "b_suite", "b_rate", f"coalesce(b_failed, {empty})", "t1", "t2",
              "CASE WHEN b_ok THEN 'SUCCESS' ELSE 'QUARANTINED' END", "NULL")
        + "\nUNION ALL\n"
        + row("ge_gold", "gold", "gold.fct_trips", "rows", "rows", "0", "g_suite", "g_rate", f"coalesce(g_failed, {empty})",
              "t2", "t3", "CASE WHEN g_ok THEN 'SUCCESS' ELSE 'FAILED' END",
              "CASE WHEN NOT g_ok THEN substr(array_to_string(g_failed, ';'), 1, 500) END", where="b_ok")
        + ")",
    ]


CHAIN_AUDIT = CHAIN_GATE + O.CHAIN_FCT[len(O.CHAIN_BRONZE):] + _audit_sql()
STATUS_SQL = "CASE {c} WHEN 'SUCCESS' THEN 1 WHEN 'FAILED' THEN 0 WHEN 'QUARANTINED' THEN -1 END"


@register("audit_log", O.with_(CHAIN_AUDIT, "SELECT * FROM audit"))
def q_audit_log(spark, sf_dir):
    return audit_log(spark, sf_dir)


@register(
    "recent_runs",
    O.with_(
        CHAIN_AUDIT,
        """SELECT run_id, dag_id, task_id, status, started_at, finished_at, duration_sec, rows_out FROM audit
ORDER BY finished_at DESC, run_id, task_id LIMIT 20""",
    ),
)
def q_recent_runs(spark, sf_dir):
    """Newest 20 task runs (a top-n report)."""
    return A.recent_runs(audit_log(spark, sf_dir), 20)


@register(
    "latest_metrics",
    O.with_(
        CHAIN_AUDIT,
        f"""SELECT dag_id, task_id, layer, duration_sec, rows_out AS rows_written, rows_quarantined, ge_pass_rate AS pass_rate,
  {STATUS_SQL.format(c="status")} AS status_code, finished_at AS last_finished_ts
FROM (SELECT *, row_number() OVER (PARTITION BY dag_id, task_id, layer ORDER BY finished_at DESC, run_id DESC) AS rn FROM audit)
WHERE rn = 1""",
    ),
)
def q_latest_metrics(spark, sf_dir):
    return A.latest_metrics(audit_log(spark, sf_dir))


@register(
    "duration_last12",
    O.with_(
        CHAIN_AUDIT,
        """SELECT dag_id, task_id, CAST(run_rank AS INTEGER) AS run_rank, run_id, started_at, duration_sec FROM (
  SELECT *, row_number() OVER (PARTITION BY dag_id, task_id ORDER BY started_at DESC, run_id DESC) AS run_rank FROM audit)
WHERE run_rank <= 12""",
    ),
)
def q_duration_last12(spark, sf_dir):
    return A.last_runs(audit_log(spark, sf_dir), 12)


@register(
    "rows_band",
    O.with_(
        CHAIN_AUDIT,
        """SELECT dag_id, task_id, run_id, started_at, rows_out, round(mu - 2.0 * sd, 6) AS band_low, round(mu + 2.0 * sd, 6) AS band_high,
  rows_out < mu - 2.0 * sd OR rows_out > mu + 2.0 * sd AS outside_band
FROM (SELECT *, avg(rows_out) OVER w AS mu, stddev_samp(rows_out) OVER w AS sd FROM audit
  WINDOW w AS (PARTITION BY dag_id, task_id ORDER BY started_at, run_id ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING))""",
    ),
)
def q_rows_band(spark, sf_dir):
    r = A.rows_band(audit_log(spark, sf_dir), 14, 2.0)
    return r.withColumn("band_low", F.round("band_low", 6)).withColumn("band_high", F.round("band_high", 6))


@register(
    "freshness_lag",
    O.with_(
        CHAIN_AUDIT,
        f"""SELECT table_name, max(finished_at) AS last_success_at,
  CAST(epoch_us(TIMESTAMP '{AS_OF}') // 1000000 - epoch_us(max(finished_at)) // 1000000 AS DOUBLE) / 3600.0 AS lag_hours
FROM audit WHERE status = 'SUCCESS' GROUP BY 1""",
    ),
)
def q_freshness_lag(spark, sf_dir):
    return A.freshness_lag(audit_log(spark, sf_dir), AS_OF)


@register(
    "pass_rate_trend",
    O.with_(
        CHAIN_AUDIT,
        "SELECT ge_suite_name, CAST(finished_at AS DATE) AS day, avg(ge_pass_rate) AS avg_pass_rate FROM audit WHERE ge_suite_name <> '' GROUP BY 1, 2",
    ),
)
def q_pass_rate_trend(spark, sf_dir):
    return A.pass_rate_trend(audit_log(spark, sf_dir))


@register(
    "quarantine_rate",
    O.with_(
        CHAIN_AUDIT,
        """SELECT CAST(date_trunc('month', started_at) AS DATE) AS run_month, CAST(SUM(rows_in) AS BIGINT) AS rows_in,
  CAST(SUM(rows_quarantined) AS BIGINT) AS rows_quarantined,
  CAST(SUM(rows_quarantined) AS DOUBLE) / NULLIF(SUM(rows_in), 0) AS quarantine_rate
FROM audit WHERE task_id = 'ge_bronze' GROUP BY 1""",
    ),
)
def q_quarantine_rate(spark, sf_dir):
    return A.quarantine_rate(audit_log(spark, sf_dir))


@register(
    "status_timeline",
    O.with_(
        CHAIN_AUDIT,
        f"""SELECT day, dag_id, last_status, task_runs, {STATUS_SQL.format(c="last_status")} AS status_code FROM (
  SELECT CAST(finished_at AS DATE) AS day, dag_id, arg_max(status, (finished_at, task_id)) AS last_status,
    COUNT(*) AS task_runs FROM audit GROUP BY 1, 2)""",
    ),
)
def q_status_timeline(spark, sf_dir):
    return A.status_timeline(audit_log(spark, sf_dir))


@register(
    "failed_leaderboard",
    O.with_(
        CHAIN_AUDIT,
        """SELECT dag_id, task_id, COUNT(*) AS unsuccessful_runs, COUNT(*) FILTER (WHERE status = 'FAILED') AS failed_runs,
  COUNT(*) FILTER (WHERE status = 'QUARANTINED') AS quarantined_runs, max(finished_at) AS last_unsuccessful_at
FROM audit WHERE status <> 'SUCCESS' GROUP BY 1, 2""",
    ),
)
def q_failed_leaderboard(spark, sf_dir):
    return A.failed_leaderboard(audit_log(spark, sf_dir))


@register(
    "run_history",
    O.with_(
        CHAIN_AUDIT,
        "SELECT run_id, task_id, status, rows_out, started_at, finished_at FROM audit WHERE table_name = 'gold.fct_trips'",
    ),
)
def q_run_history(spark, sf_dir):
    """Run history of the gold fact (stands in for table snapshot history)."""
    return A.table_history(audit_log(spark, sf_dir), "gold.fct_trips")


# -- profiles -------------------------------------------------------------------

PROFILE_COLS = list(SOURCE_TYPES)
_DEC = {c for c, t in SOURCE_TYPES.items() if t.typeName() == "decimal"}
_INT = {c for c, t in SOURCE_TYPES.items() if t.typeName() == "integer"}


def _profile_sql() -> str:
    parts = []
    for c in PROFILE_COLS:
        mean = (f"CAST({O.avg_dec(c)} AS DOUBLE)" if c in _DEC else f"avg({c})" if c in _INT else "CAST(NULL AS DOUBLE)")
        parts.append(
            f"SELECT pickup_month, '{c}' AS column_name, COUNT(*) AS row_count, COUNT(*) FILTER (WHERE {c} IS NULL) AS null_count, "
            f"CAST(COUNT(*) FILTER (WHERE {c} IS NULL) AS DOUBLE) / NULLIF(COUNT(*), 0) AS null_fraction, "
            f"CAST(min({c}) AS VARCHAR) AS min_value, CAST(max({c}) AS VARCHAR) AS max_value, {mean} AS mean "
            f"FROM bronze_m GROUP BY 1"
        )
    return "\nUNION ALL\n".join(parts)


@register("column_profile", O.with_(O.CHAIN_BRONZE + [BRONZE_M], _profile_sql()))
def q_column_profile(spark, sf_dir):
    """Null density, min/max and mean of every source column, per month, in one aggregation."""
    return profile.column_profile(bronze_m(spark, sf_dir), PROFILE_COLS, ["pickup_month"], approx=False)


@register("column_profile_sketch")
def q_column_profile_sketch(spark, sf_dir):
    """The same profile with HLL distinct counts and quantile sketches (approximate: no oracle)."""
    return profile.column_profile(bronze_m(spark, sf_dir), PROFILE_COLS, ["pickup_month"], approx=True)


@register(
    "value_counts",
    O.with_(O.CHAIN_BRONZE + [BRONZE_M], "SELECT pickup_month, payment_type, COUNT(*) AS count FROM bronze_m GROUP BY 1, 2"),
)
def q_value_counts(spark, sf_dir):
    return profile.value_counts(bronze_m(spark, sf_dir), "payment_type", ["pickup_month"])


@register(
    "all_null_rows",
    O.with_(
        O.CHAIN_BRONZE[:2],
        """SELECT payment_type, COUNT(*) AS rows,
  COUNT(*) FILTER (WHERE congestion_surcharge IS NULL AND airport_fee IS NULL) AS all_null_rows FROM bronze_u GROUP BY 1""",
    ),
)
def q_all_null_rows(spark, sf_dir):
    return profile.all_null_rows(models(spark, sf_dir).bronze_untokenized, ["congestion_surcharge", "airport_fee"], "payment_type")


RUN_METADATA = ["_run_id", "_source_url", "_source_sha256", "_ingested_at", "_schema_version"]


def _fingerprint_sql() -> str:
    from strata.schemas import BRONZE_SCHEMA

    cols = sorted(f.name for f in BRONZE_SCHEMA.fields if f.name not in RUN_METADATA)
    text = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '{profile.FINGERPRINT_NULL}')" for c in cols)
    h = f"CAST('0x' || substr(md5(concat_ws('|', {text})), 1, 15) AS BIGINT)"
    return f"SELECT pickup_month, COUNT(*) AS rows, CAST(SUM({h}) AS DECIMAL(38,0)) AS content_hash FROM bronze_m GROUP BY 1"


@register("partition_fingerprint", O.with_(O.CHAIN_BRONZE + [BRONZE_M], _fingerprint_sql()))
def q_partition_fingerprint(spark, sf_dir):
    """Per month: rows and an order-insensitive content hash without run metadata (md5 form)."""
    return profile.partition_fingerprint(bronze_m(spark, sf_dir), ["pickup_month"], RUN_METADATA, method="md5")


@register("partition_fingerprint_xxhash")
def q_partition_fingerprint_xxhash(spark, sf_dir):
    """The fast xxhash64 form of the fingerprint (no SQL engine reproduces Spark's xxhash64)."""
    return profile.partition_fingerprint(bronze_m(spark, sf_dir), ["pickup_month"], RUN_METADATA)


# -- files ----------------------------------------------------------------------


def _table_name(path_col):
    return F.regexp_extract(path_col, r"([^/]+)\.parquet$", 1)


@register("manifest_build")
def q_manifest_build(spark, sf_dir):
    """sha256, bytes and rows of every test table file, computed on executors."""
    m = landing_manifest(spark, sf_dir)
    return m.select(_table_name(F.col("path")).alias("table_name"), "sha256", "byte_size", "row_count")


def landing_manifest(spark, sf_dir):
    from strata.sources.landing import build_manifest

    return build_manifest(spark, os.path.join(sf_dir, "*.parquet"))


@register(
    "manifest_validate",
    O.with_(
        O.CHAIN_BRONZE[:2],
        """SELECT pickup_month, CASE WHEN kind IN (0, 3) THEN 1 ELSE 0 END::BIGINT AS valid_files, (kind = 1)::BIGINT AS altered_files,
  (kind = 2)::BIGINT AS missing_files, (kind = 3)::BIGINT AS undeclared_files, n AS declared_rows,
  CASE kind WHEN 2 THEN NULL WHEN 3 THEN 2 * n ELSE n END AS found_rows
FROM (SELECT pickup_month, count(*) AS n, (row_number() OVER (ORDER BY pickup_month) - 1) % 4 AS kind
      FROM (SELECT CAST(date_trunc('month', tpep_pickup_datetime) AS DATE) AS pickup_month FROM bronze_u) GROUP BY 1)""",
    ),
)
def q_manifest_validate(spark, sf_dir):
    """Land every month as a file, declare all files, then damage the landing zone and validate it.

    Of every four months one file is altered in place (the same rows, other bytes), one is deleted,
    and one month gets a file that nobody declared.
    """
    from strata.plans.monthly import land_months
    from strata.sources.landing import build_manifest, validate_manifest

    root = scratch_path(spark, f"manifest-{uuid.uuid4().hex}")
    raw = testbed.trips_raw(spark, sf_dir)
    month = F.trunc("tpep_pickup_datetime", "month")
    land_months(raw.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), month), f"{root}/landing", month)
    declared = build_manifest(spark, f"{root}/landing")
    stored = scratch_path(spark, f"manifest-{uuid.uuid4().hex}")
    declared.write.parquet(stored)
    declared = spark.read.schema(declared.schema).parquet(stored)
    _damage(spark, root, sorted(r.path for r in declared.select("path").collect()))

    date = F.make_date(*(F.regexp_extract("path", f"{part}=([0-9]+)", 1).cast("int") for part in ("year", "month")), F.lit(1))
    v = validate_manifest(declared, build_manifest(spark, f"{root}/landing")).withColumn("pickup_month", date)
    of = lambda s: F.count_if(F.col("status") == s).alias(f"{s}_files")
    return v.groupBy("pickup_month").agg(
        *map(of, ("valid", "altered", "missing", "undeclared")),
        F.sum("declared_rows").alias("declared_rows"), F.sum("row_count").alias("found_rows"),
    )


def _damage(spark, root, paths):
    """Alter, delete or double the landed files by their place in the list (one file a month)."""
    jvm = spark._jvm
    fs_path = jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    again = spark.read.schema(testbed.RAW_SCHEMA).parquet(*(p for i, p in enumerate(paths) if i % 4 in (1, 3)))
    again = again.withColumn("name", F.regexp_extract(F.col("_metadata.file_path"), "/(year=[^/]+/month=[^/]+)/", 1))
    again.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "name").write.option("compression", "gzip").partitionBy("name").parquet(f"{root}/other")
    other = {}
    for r in spark.read.parquet(f"{root}/other").select("name", F.col("_metadata.file_path").alias("path")).distinct().collect():
        other[r["name"]] = r["path"]
    for i, p in enumerate(paths):
        at = fs_path(jvm.java.net.URI(p))
        fs = at.getFileSystem(conf)
        if i % 4 in (1, 2):
            fs.delete(at, False)
        if i % 4 in (1, 3):
            name = "/".join(p.split("/")[-3:-1])
            fs.rename(fs_path(jvm.java.net.URI(other[name])), at if i % 4 == 1 else fs_path(at.getParent(), "undeclared.parquet"))


@register("file_telemetry")
def q_file_telemetry(spark, sf_dir):
    """File count and size spread per table from the file listing (contents not read)."""
    fs = files.file_sizes(spark, os.path.join(sf_dir, "*.parquet")).withColumn("table_name", _table_name(F.col("path")))
    return files.file_telemetry(fs, "table_name")


#: Rows that a task of the landing below gets; small tables are dealt to four tasks.
LANDING_ROWS = 2_000_000


@register("compact_partition")
def q_compact_partition(spark, sf_dir):
    """Land the bronze months as many small files, compact the largest month, report files per month."""
    base = scratch_path(spark, f"compact-{uuid.uuid4().hex}")
    # Every landing task has rows of every month; the landed rows are dealt before tokens widen them.
    tasks = max(4, math.ceil(testbed.table(spark, sf_dir, "lineitem").count() / LANDING_ROWS))
    m = models(spark, sf_dir)
    bronze = ingest.with_pickup_month(TripModels(spark, m.raw.repartition(tasks), m.zone_seed, m.p).bronze).drop(*RUN_METADATA)
    bronze.write.partitionBy("pickup_month").parquet(base)
    t = spark.read.parquet(base)
    biggest = t.groupBy("pickup_month").count().orderBy(F.desc("count"), "pickup_month").first()["pickup_month"]
    files.compact_partition(spark, base, "pickup_month", str(biggest), base + "-staging")
    after = spark.read.parquet(base)
    per_file = after.select("pickup_month", F.col("_metadata.file_path").alias("path")).groupBy("pickup_month", "path").count()
    return per_file.groupBy("pickup_month").agg(F.count("*").alias("files"), F.sum("count").alias("rows"))


# -- streaming ------------------------------------------------------------------


@register(
    "stream_ingest_available_now",
    O.with_(O.CHAIN_BRONZE[:2], "SELECT CAST(date_trunc('month', tpep_pickup_datetime) AS DATE) AS pickup_month, COUNT(*) AS rows FROM bronze_u GROUP BY 1"),
)
def q_stream_ingest_available_now(spark, sf_dir):
    """Pick up landed line items as a stream (available-now), join the static order tables per
    micro-batch, load bronze per batch idempotently, then report rows per month."""
    run = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    target, ckpt = run + "/bronze", run + "/checkpoint"
    li_schema = testbed.table(spark, sf_dir, "lineitem").schema

    def transform(stream):
        return testbed.trips_from_lineitem(spark, sf_dir, stream)

    def load(batch, epoch):
        b = ingest.with_pickup_month(ingest.bronze_from_landing(batch, "stream", "testbed://lineitem", "",
                                                                "2024-02-01 02:00:00"))
        (b.withColumn("_batch", F.lit(epoch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_batch").parquet(target))

    ingest_available_now(spark, os.path.join(sf_dir, "lineitem*.parquet"), li_schema, ckpt, load, transform,
                         base_path=sf_dir)
    return spark.read.parquet(target).groupBy("pickup_month").agg(F.count("*").alias("rows"))
