"""The whole run over a range of months at once: landing files to serving tables, every step audited.

The same models as the monthly run, with the month as a group instead of a loop: each table is
written in one job for all months, the gates give one verdict a month, and rows of failing months
flow to quarantine. After the gate the order is silver and its tests, dimensions and the zone
snapshot, gold and serving, gold tests, gold gate. Every step reads stored tables, so a run that
broke off is simply run again: partitions are overwritten, the snapshot adds nothing twice.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import dims, facts, ingest, lattice, privacy, scd2, silver, subjects
from strata.operators.quality import expectations as X
from strata.operators.quality import structural
from strata.ops.steps import Steps, utc_now
from strata.plans.models import RunParams
from strata.plans.monthly import PM, Tables, _delete, _exists, table_schema
from strata.schemas import SOURCE_TYPES
from strata.session import scratch_path
from strata.sinks.writers import overwrite_months, overwrite_partitions, replace
from strata.sizing import bounded_broadcast
from strata.sources.landing import build_manifest, read_landing

#: Keys of a PII lookup whose tokens (some 350 bytes a key) stay under the limit for broadcasts.
LOOKUP_BROADCAST_ROWS = 150_000
SNAPSHOT_COLUMNS = ["borough", "zone_name", "service_zone"]


class TestsFailed(ValueError):
    """Structural tests failed in a run that stops at them."""

    __test__ = False


class RepeatedKeys(ValueError):
    """The zone source names a key twice, so there is no one current version."""


def zone_snapshot(spark: SparkSession, path: str, zones: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    """The stored zone history after a merge of the staged ``zones``; repeated keys are refused."""
    repeated = scd2.duplicate_source_keys(zones, "location_id")
    if not repeated.isEmpty():
        keys = [r["location_id"] for r in repeated.orderBy("location_id").limit(10).collect()]  # for the message
        raise RepeatedKeys(f"location_id {keys} more than once in the zone source")
    history = spark.read.parquet(path) if _exists(spark, path) else None
    merged = scd2.scd2_merge(history, zones, "location_id", SNAPSHOT_COLUMNS, as_of).checkpoint(eager=True)
    replace(merged, path)
    return spark.read.schema(merged.schema).parquet(path)


def _tested(spark: SparkSession, step, path: str, results: list[DataFrame], stop: bool) -> None:
    """Store test results as one table and report them."""
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    replace(out, path)
    rows = spark.read.schema(out.schema).parquet(path).collect()  # one row a declared test
    failed = sorted(f"{r['test']}:{r['model']}.{r['column']}" for r in rows if not r["passed"])
    step.report(
        rows_in=len(rows), rows_out=len(rows) - len(failed), ge_pass_rate=1 - len(failed) / max(1, len(rows)),
        ge_failed_expectations=failed, status="FAILED" if failed else "SUCCESS", error_message=";".join(failed) or None,
    )
    if failed and stop:
        raise TestsFailed("; ".join(failed))


def run_graph(
    spark: SparkSession,
    tables: Tables,
    landing_root: str,
    months: list[dt.date],
    zone_seed: DataFrame,
    params: RunParams = RunParams(),
    bronze_suite: list = X.BRONZE_SUITE,
    gold_suite: list = X.GOLD_SUITE,
    stop_at_failed_tests: bool = False,
    clock=utc_now,
) -> DataFrame:
    """Run all steps over ``months``; the rows that the run left in the step audit table."""
    months = sorted(months)
    at = params.transformed_at
    steps = Steps(spark, tables.step_audit, params.run_id, landing_root, params.schema_version, clock)

    def stored(name: str) -> DataFrame:
        return spark.read.parquet(getattr(tables, name)).where(F.col(PM).isin([F.lit(m) for m in months]))

    with steps.audited("landing_to_bronze", "bronze", "bronze.trips", months) as step:
        raw = read_landing(spark, landing_root, months)
        files = build_manifest(spark, landing_root, count_rows=False).select(F.col("path").alias("_source_file"), F.col("sha256").alias("_sha"))
        raw = raw.join(bounded_broadcast(files), "_source_file", "left")  # a row a file
        landed = F.make_date(F.col("year").cast("int"), F.col("month").cast("int"), F.lit(1))
        bronze_u = ingest.bronze_from_landing(
            lattice.with_rejects(raw.withColumn("_file_month", landed).drop("year", "month"), SOURCE_TYPES), params.run_id, F.col("_source_file"), F.col("_sha"),
            params.ingested_at, params.schema_version, table_schema(spark, tables.bronze),
        )
        routed = ingest.route_by_file_month(ingest.with_pickup_month(bronze_u), F.col("_file_month")).drop("_source_file", "_sha")
        stage = scratch_path(spark, f"graph-{uuid.uuid4().hex}")
        routed.write.parquet(stage)
        staged = spark.read.schema(routed.schema).parquet(stage)
        # Rows with a value that its column cannot hold are kept as they came, and not loaded.
        rejected = staged.where("_reject_reason IS NOT NULL").select(
            "_reject_reason", "_original", "_source_url", "_run_id", F.col("_file_month").alias("_landing_month")
        )
        rejected_rows = overwrite_months(rejected, tables.rejected, months, "_landing_month")
        staged = staged.where("_reject_reason IS NULL").drop("_reject_reason", "_original")
        strays = staged.where("_route = 'late_or_early'").withColumn("_landing_month", F.col("_file_month")).drop("_file_month")
        stray_rows = overwrite_months(strays, tables.late_or_early, months, "_landing_month")
        keep = staged.where("_route = 'in_month'").drop("_route", "_file_month")
        overwrite_months(privacy.build_pii_lookup(keep).withColumn(PM, F.trunc("tpep_pickup_datetime", "month")), tables.pii_lookup, months)
        lookup = stored("pii_lookup")
        overwrite_partitions(subjects.month_filters(lookup), tables.pii_filters, PM, months)
        # A lookup that is small by its stored row count goes to the rows; a large one meets them in a shuffle.
        small = LOOKUP_BROADCAST_ROWS if lookup.count() <= LOOKUP_BROADCAST_ROWS else None
        bronze = privacy.tokenize_bronze(keep, lookup.drop(PM), params.salt, params.salt_version, small)
        rows = overwrite_months(bronze, tables.bronze, months)
        _delete(spark, stage)
        for m in months:
            step.report(m, rows_in=rows[m] + stray_rows[m] + rejected_rows[m], rows_out=rows[m], rows_quarantined=rejected_rows[m])

    with steps.audited("ge_bronze", "bronze", "bronze.trips", months) as step:
        b = stored("bronze")
        verdict = X.gate_verdict(X.evaluate_suite(b, bronze_suite, [PM], skip_optional=False), [PM], "bronze").checkpoint(eager=True)
        passed, failed = X.route(b, verdict, [PM])
        quarantine = failed.select(
            *b.columns, F.array_join("failed_expectations", ";").alias("_failure_reason"),
            F.to_json("failed_kwargs").alias("_expectation_kwargs"), F.lit(params.run_id).alias("_quarantine_run_id"),
        )
        bad = overwrite_months(quarantine, tables.quarantine, months)
        found = {r[PM]: r for r in verdict.collect()}  # a row a month
        good = [m for m in months if m in found and found[m]["success"]]
        for m in months:
            v = found.get(m)
            step.report(
                m, rows_in=rows[m], rows_out=rows[m] - bad[m], rows_quarantined=bad[m], ge_suite_name="bronze",
                ge_pass_rate=v["pass_rate"] if v else 0.0, status="SUCCESS" if m in good else "QUARANTINED",
                ge_failed_expectations=list(v["failed_expectations"]) if v else ["empty_month:table"],
            )

    with steps.audited("silver", "silver", "silver.stg_trips", good) as step:
        silver_rows = overwrite_months(silver.stg_trips(passed, at), tables.stg_trips, months)
        for m in good:
            step.report(m, rows_in=rows[m], rows_out=silver_rows[m])

    with steps.audited("silver_tests", "silver", "silver") as step:
        replace(zone_seed, tables.zone_seed)
        zones = silver.stg_zone(spark.read.parquet(tables.zone_seed), at)
        _tested(spark, step, tables.silver_tests, [
            structural.run_structural_tests(spark, stored("stg_trips"), "stg_trips", structural.STG_TRIPS_TESTS),
            structural.run_structural_tests(spark, zones, "stg_taxi_zone", structural.STG_ZONE_TESTS),
        ], stop_at_failed_tests)

    with steps.audited("dimensions", "gold", "gold.dim_taxi_zone") as step:
        history = zone_snapshot(spark, tables.zone_snapshot, zones, at)
        made = {
            "dim_taxi_zone": dims.dim_zone(history), "dim_vendor": dims.dim_vendor(spark, at),
            "dim_payment_type": dims.dim_payment_type(spark, at), "dim_rate_code": dims.dim_rate_code(spark, at),
        }
        counts = {name: replace(df, getattr(tables, name)) for name, df in made.items()}
        step.report(rows_in=spark.read.parquet(tables.zone_seed).count(), rows_out=counts["dim_taxi_zone"])
    zone, payment = spark.read.parquet(tables.dim_taxi_zone), spark.read.parquet(tables.dim_payment_type)

    with steps.audited("gold", "gold", "gold.fct_trips", good) as step:
        fct_rows = overwrite_months(facts.fct_trips(stored("stg_trips"), at), tables.fct_trips, months)
        overwrite_months(facts.fct_trips_daily(stored("fct_trips"), at), tables.fct_trips_daily, months)
        overwrite_months(facts.fct_zone_revenue_monthly(stored("fct_trips"), zone, at), tables.fct_zone_revenue_monthly, months)
        overwrite_months(facts.fct_tokenization_audit(stored("fct_trips"), at), tables.fct_tokenization_audit, months)
        for m in good:
            step.report(m, rows_in=silver_rows[m], rows_out=fct_rows[m])

    with steps.audited("serving", "gold", "gold.v_trips_summary", good) as step:
        daily = stored("fct_trips_daily")
        served = overwrite_months(facts.v_trips_summary(daily, zone, payment), tables.v_trips_summary, months)
        overwrite_months(facts.v_zone_revenue(stored("fct_zone_revenue_monthly")), tables.v_zone_revenue, months)
        before = {r[PM]: r["n"] for r in daily.groupBy(PM).agg(F.count("*").alias("n")).collect()}
        for m in good:
            step.report(m, rows_in=before.get(m, 0), rows_out=served[m])

    with steps.audited("gold_tests", "gold", "gold") as step:
        related = {n: spark.read.parquet(getattr(tables, n)) for n in ("dim_vendor", "dim_payment_type", "dim_rate_code")}
        run = structural.run_structural_tests
        _tested(spark, step, tables.gold_tests, [
            run(spark, stored("fct_trips"), "fct_trips", structural.FCT_TRIPS_TESTS, related),
            run(spark, stored("fct_trips_daily"), "fct_trips_daily", structural.FCT_DAILY_TESTS),
            run(spark, stored("fct_zone_revenue_monthly"), "fct_zone_revenue_monthly", structural.FCT_ZONE_REVENUE_TESTS),
            run(spark, stored("fct_tokenization_audit"), "fct_tokenization_audit", structural.FCT_TOKEN_AUDIT_TESTS),
            run(spark, history, "dim_taxi_zone_snapshot", structural.ZONE_SNAPSHOT_TESTS),
        ], stop_at_failed_tests)

    with steps.audited("ge_gold", "gold", "gold.fct_trips", good) as step:
        results = X.evaluate_suite(stored("fct_trips"), gold_suite, [PM])
        found = {r[PM]: r for r in X.gate_verdict(results, [PM], "gold").collect()}
        for m in good:
            v = found[m]
            failures = list(v["failed_expectations"])
            step.report(
                m, rows_in=fct_rows[m], rows_out=fct_rows[m], ge_suite_name="gold", ge_pass_rate=v["pass_rate"],
                ge_failed_expectations=failures, status="SUCCESS" if v["success"] else "FAILED", error_message=";".join(failures) or None,
            )

    done = spark.createDataFrame([(m, params.run_id, "SUCCESS" if m in good else "QUARANTINED") for m in months], "month date, run_id string, status string")
    overwrite_partitions(done, tables.loaded_months, "month", months)
    return spark.read.parquet(tables.step_audit).where(F.col("run_id").startswith(params.run_id))
