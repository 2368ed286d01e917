"""The monthly run: landing file -> bronze -> gate -> silver -> gold, plus audit.

Every stage boundary is a stored table, so a lost executor or a failed stage re-runs
from the last table, never from the landing file. Writes are dynamic partition
overwrites restricted to the target month, and a table that gets no row of the month has
it cleared: re-running a month (or loading months out of order) gives the same tables. The gate does not branch on the driver: rows of a
passing month flow to silver, rows of a failing month to quarantine, both from one
verdict frame.
"""

from __future__ import annotations

import datetime as dt
import os
import time
import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import dims, facts, ingest, privacy, silver, subjects
from strata.operators.quality import expectations as X
from strata.ops.audit import DAG_ID, AuditRecord, append_audit, audit_frame
from strata.plans.models import RunParams
from strata.session import scratch_path
from strata.sinks.writers import append, clear_partitions, overwrite_partitions, replace
from strata.sizing import bounded_broadcast
from strata.sources.landing import checked_files, landing_path, read_landing

PM = "pickup_month"


@dataclass(frozen=True)
class Tables:
    """Locations of every table under one warehouse root."""

    root: str

    def __getattr__(self, name: str) -> str:  # bronze, pii_lookup, stg_trips, fct_trips, ...
        if name.startswith("__"):
            raise AttributeError(name)
        return os.path.join(self.root, name)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _read(spark: SparkSession, path: str, month: dt.date, like: DataFrame) -> DataFrame:
    """One month of a stored table; an empty frame shaped like ``like`` if nothing was written yet."""
    if not _exists(spark, path):
        return spark.createDataFrame([], like.schema)
    return spark.read.schema(like.schema).parquet(path).filter(F.col(PM) == F.lit(month))


def table_schema(spark: SparkSession, path: str):
    """Schema of a stored table whose files may differ by added columns (additive evolution)."""
    if not _exists(spark, path):
        return None
    try:
        return spark.read.option("mergeSchema", "true").parquet(path).drop(PM).schema
    except AnalysisException as e:  # a folder without files: no month has had a row so far
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def run_month(spark: SparkSession, tables: Tables, landing_root: str, month: dt.date, params: RunParams = RunParams(), **kw) -> dict:
    """:func:`load_month` with its outcome on record.

    The month leaves the table of loaded months before the first write and returns to it after the
    last, so a crash leaves it to be loaded again. A crash also leaves a FAILED audit row.
    """
    month = dt.date(month.year, month.month, 1)
    started = dt.datetime.now(dt.timezone.utc).replace(microsecond=0, tzinfo=None)
    clear_partitions(spark, tables.loaded_months, "month", [month])
    try:
        return load_month(spark, tables, landing_root, month, params, **kw)
    except Exception as e:
        rec = AuditRecord(
            run_id=params.run_id, dag_id=DAG_ID, task_id="run_month", layer="bronze", table_name="bronze.trips",
            started_at=started, finished_at=dt.datetime.now(dt.timezone.utc).replace(microsecond=0, tzinfo=None),
            status="FAILED", source_url=landing_root, ge_pass_rate=0.0, error_message=str(e),
        )
        append_audit(audit_frame(spark, [rec]), tables.pipeline_audit)
        raise


def load_month(
    spark: SparkSession,
    tables: Tables,
    landing_root: str,
    month: dt.date,
    params: RunParams = RunParams(),
    suite: list = X.BRONZE_SUITE,
    zone_seed: DataFrame | None = None,
    quarantine_mode: str = "replace",
    verify_sha: bool = True,
) -> dict:
    """Load one month end to end; returns row counts and the gate outcome.

    ``quarantine_mode``: ``replace`` (default) overwrites the month's quarantine partition, so a
    re-run does not duplicate rows; ``append`` keeps every run's copy, told apart by
    ``_quarantine_run_id``.

    ``verify_sha``: hash the landing file and compare it with its declared manifest; see
    :func:`strata.sources.landing.checked_files`.
    """
    started = dt.datetime.now(dt.timezone.utc).replace(microsecond=0, tzinfo=None)
    t0 = time.time()
    month = dt.date(month.year, month.month, 1)
    raw = read_landing(spark, landing_root, [month])
    # each row carries its file and that file's sha256; a folder that differs from its declared
    # manifest is refused (one row per file, so this side is broadcast after a size check)
    files = checked_files(spark, landing_path(landing_root, month.year, month.month), verify_sha)
    files = files.select(F.col("path").alias("_source_file"), F.coalesce("sha256", F.raise_error(F.lit("no sha256"))).alias("_sha"))
    raw = raw.join(bounded_broadcast(files), "_source_file", "left")
    target = table_schema(spark, tables.bronze)
    bronze_u = ingest.bronze_from_landing(
        raw.drop("year", "month"), params.run_id, F.col("_source_file"), F.col("_sha"), params.ingested_at,
        params.schema_version, target,
    ).drop("_source_file", "_sha")
    routed = ingest.with_pickup_month(ingest.route_out_of_month(bronze_u, month))

    # stage the month once (lineage cut in the shared checkpoint folder)
    stage = scratch_path(spark, f"stage-{uuid.uuid4().hex}")
    routed.write.mode("overwrite").parquet(stage)
    staged = spark.read.parquet(stage)
    keep = staged.filter(F.col("_route") == "in_month").drop("_route")
    # strays are kept per landing month, so another month's strays never replace them
    strays = overwrite_partitions(
        staged.filter(F.col("_route") == "late_or_early").withColumn("_landing_month", F.lit(month)),
        tables.late_or_early, "_landing_month", [month],
    )

    new_lookup = privacy.build_pii_lookup(keep).withColumn(PM, F.lit(month))
    overwrite_partitions(new_lookup, tables.pii_lookup, PM, [month])
    stored_lookup = _read(spark, tables.pii_lookup, month, new_lookup)
    # which months hold a subject is asked of these filters, not of the lookups
    overwrite_partitions(subjects.month_filters(stored_lookup), tables.pii_filters, PM, [month])
    lookup = stored_lookup.drop(PM)
    bronze = privacy.tokenize_bronze(keep, lookup, params.salt, params.salt_version)
    rows_bronze = overwrite_partitions(bronze, tables.bronze, PM, [month])

    # gate on the stored month; the verdict is one row, materialised once
    b = _read(spark, tables.bronze, month, bronze)
    results = X.evaluate_suite(b, suite, [PM], skip_optional=False)
    verdict = X.gate_verdict(results, [PM], "bronze").checkpoint(eager=True)
    passed, failed = X.route(b, verdict, [PM])
    quarantine = failed.select(
        *b.columns,
        F.array_join("failed_expectations", ";").alias("_failure_reason"),
        F.to_json("failed_kwargs").alias("_expectation_kwargs"),
        F.lit(params.run_id).alias("_quarantine_run_id"),
    )
    if quarantine_mode == "append":
        rows_quarantined = append(quarantine, tables.quarantine, [PM])
    else:
        rows_quarantined = overwrite_partitions(quarantine, tables.quarantine, PM, [month])

    stg = silver.stg_trips(passed, params.transformed_at)
    rows_silver = overwrite_partitions(stg, tables.stg_trips, PM, [month])
    s = _read(spark, tables.stg_trips, month, stg)
    fct = facts.fct_trips(s, params.transformed_at)
    rows_fct = overwrite_partitions(fct, tables.fct_trips, PM, [month])
    f = _read(spark, tables.fct_trips, month, fct)
    overwrite_partitions(facts.fct_trips_daily(f, params.transformed_at), tables.fct_trips_daily, PM, [month])
    if zone_seed is not None:
        replace(zone_seed, tables.zone_seed)
    if _exists(spark, tables.zone_seed):  # a run without a seed uses the stored one
        zone_seed = spark.read.parquet(tables.zone_seed)
        zone = dims.dim_zone(silver.stg_zone(zone_seed, params.transformed_at))
        overwrite_partitions(facts.fct_zone_revenue_monthly(f, zone, params.transformed_at),
                             tables.fct_zone_revenue_monthly, PM, [month])
    else:
        clear_partitions(spark, tables.fct_zone_revenue_monthly, PM, [month])
    overwrite_partitions(facts.fct_tokenization_audit(f, params.transformed_at), tables.fct_tokenization_audit, PM, [month])

    # A month without rows has no group to judge: it fails the gate by rule.
    empty = {"success": False, "suite_name": "bronze", "pass_rate": 0.0, "failed_expectations": ["empty_month:table"]}
    v = verdict.first() or empty
    status = "SUCCESS" if v["success"] else "QUARANTINED"
    rec = AuditRecord(
        run_id=params.run_id, dag_id=DAG_ID, task_id="run_month", layer="bronze", table_name="bronze.trips",
        started_at=started, finished_at=started + dt.timedelta(seconds=round(time.time() - t0, 3)), status=status,
        source_url=landing_root, rows_in=rows_bronze + strays, rows_out=rows_fct, rows_quarantined=rows_quarantined,
        ge_suite_name=v["suite_name"], ge_pass_rate=v["pass_rate"], ge_failed_expectations=list(v["failed_expectations"]),
    )
    append_audit(audit_frame(spark, [rec]), tables.pipeline_audit)
    done = spark.createDataFrame([(month, params.run_id, status)], "month date, run_id string, status string")
    overwrite_partitions(done, tables.loaded_months, "month", [month])
    _delete(spark, stage)
    return {"month": month, "bronze": rows_bronze, "strays": strays, "quarantined": rows_quarantined,
            "silver": rows_silver, "fct": rows_fct, "status": status}


def backfill(
    spark: SparkSession,
    tables: Tables,
    landing_root: str,
    start: str,
    end: str,
    params: RunParams = RunParams(),
    force: bool = False,
    **kw,
) -> list[dict]:
    """The same monthly run over an inclusive month range, skipping loaded months unless
    ``force``. Months run one after another, which bounds memory like the monthly job."""
    requested = ingest.month_sequence(spark, start, end)
    if _exists(spark, tables.loaded_months) and not force:
        stored = "run_id string, status string, month date"
        loaded = spark.read.schema(stored).parquet(tables.loaded_months).select("month").distinct()
        todo = ingest.months_to_load(requested, loaded)
    else:
        todo = requested
    months = sorted(r["month"] for r in todo.collect())  # a month list, not data rows
    return [run_month(spark, tables, landing_root, m, params, **kw) for m in months]


def land_months(raw: DataFrame, landing_root: str, month_col: F.Column) -> None:
    """Write a raw trip frame as landing files ``year=Y/month=MM`` cut by ``month_col``."""
    (raw.withColumn("__m", month_col)
        .withColumn("year", F.year("__m")).withColumn("month", F.lpad(F.month("__m").cast("string"), 2, "0"))
        .drop("__m").write.mode("overwrite").partitionBy("year", "month").parquet(landing_root))
