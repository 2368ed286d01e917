"""Erasing subjects from stored months and rotating salts, resumable and only where it must be.

An erasure asks the month filters which months can hold a subject, takes the subjects out of those
months' lookups, and writes the months' tables anew with tokens of a new salt, so that neither the
person's values nor a token that can be traced to them is left. Months that hold no subject are not
touched: their files stay as they are. A rotation does the same for given months without a change of
the lookup.

Every finished step of every month is a row of the ledger, written after the step. A run that was
killed is started again with the same request id: it takes the months that the ledger planned and
goes on after the last finished step. Steps can be repeated: each writes one partition from stored
tables, and the filter, which names the month, is written last.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators import facts, privacy, silver, subjects
from strata.plans.monthly import PM, Tables, _delete, _exists
from strata.session import scratch_path
from strata.sinks.writers import append, overwrite_partitions

LEDGER = "request_id string, month date, step string, rows long"
#: Steps of a month in order; ``plan`` names the months of a request before any is touched.
STEPS = ("lookup", "bronze", "quarantine", "silver", "fact", "token_audit", "filter")


def _month(spark: SparkSession, path: str, month: dt.date) -> DataFrame | None:
    """One stored month with the table's columns; None where there is no such partition."""
    if not _exists(spark, f"{path}/{PM}={month.isoformat()}"):
        return None
    table = spark.read.option("mergeSchema", "true").parquet(path)
    return table.where(F.col(PM) == F.lit(month))


def _rewrite(spark: SparkSession, path: str, month: dt.date, change: Callable[[DataFrame], DataFrame]) -> int:
    """Replace a stored month by ``change`` of it, through a stage: a table is not read while it is written."""
    now = _month(spark, path, month)
    if now is None:
        return 0
    stage = scratch_path(spark, f"erase-{uuid.uuid4().hex}")
    changed = change(now)
    changed.write.parquet(stage)
    rows = overwrite_partitions(spark.read.schema(changed.schema).parquet(stage), path, PM, [month])
    _delete(spark, stage)
    return rows


def ledger(spark: SparkSession, tables: Tables, request_id: str) -> DataFrame:
    path = tables.erasure_ledger
    if not _exists(spark, path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(path).where(F.col("request_id") == request_id)


def _record(spark: SparkSession, tables: Tables, rows: list[tuple]) -> None:
    append(spark.createDataFrame(rows, LEDGER), tables.erasure_ledger, ["request_id"])


def write_filters(spark: SparkSession, tables: Tables, months: list[dt.date] | None = None) -> int:
    """Filters of the stored lookup's months, or of all of them."""
    lookup = spark.read.parquet(tables.pii_lookup)
    if months:
        lookup = lookup.where(F.col(PM).isin([F.lit(m) for m in months]))
    return overwrite_partitions(subjects.month_filters(lookup), tables.pii_filters, PM, months)


def _run(
    spark: SparkSession, tables: Tables, request_id: str, plan: Callable[[], list[dt.date]], gone: DataFrame | None,
    salt: str, salt_version: int, transformed_at: str, after_step: Callable[[dt.date, str], None],
) -> list[dt.date]:
    done = {(r["month"], r["step"]) for r in ledger(spark, tables, request_id).collect()}  # months times steps
    months = sorted(m for m, s in done if s == "plan")
    if not any(s in ("plan", "planned") for _, s in done):
        months = sorted(plan())
        _record(spark, tables, [(request_id, m, "plan", 0) for m in months] + [(request_id, None, "planned", len(months))])

    def tokens(rows: DataFrame, month: dt.date) -> DataFrame:
        lookup = spark.read.parquet(tables.pii_lookup).where(F.col(PM) == F.lit(month)).drop(PM)
        return privacy.tokenize_bronze(rows, lookup, salt, salt_version).select(*rows.columns)

    for month in months:
        def bronze(_: DataFrame, month=month) -> DataFrame:
            return _month(spark, tables.bronze, month)

        def stored(path: str, month=month) -> DataFrame:
            return _month(spark, path, month)

        change = {
            "lookup": (tables.pii_lookup, lambda d: d if gone is None else privacy.erase_subjects(d, gone).select(*d.columns)),
            "bronze": (tables.bronze, lambda d, m=month: tokens(d, m)),
            "quarantine": (tables.quarantine, lambda d, m=month: tokens(d, m)),
            "silver": (tables.stg_trips, lambda d, m=month: silver.stg_trips(bronze(d, m), transformed_at).select(*d.columns)),
            "fact": (tables.fct_trips, lambda d, m=month: facts.fct_trips(stored(tables.stg_trips, m), transformed_at).select(*d.columns)),
            "token_audit": (
                tables.fct_tokenization_audit,
                lambda d, m=month: facts.fct_tokenization_audit(stored(tables.fct_trips, m), transformed_at).select(*d.columns),
            ),
        }
        for step in STEPS:
            if (month, step) in done:
                continue
            if step == "filter":
                rows = write_filters(spark, tables, [month])
            else:
                rows = _rewrite(spark, change[step][0], month, change[step][1])
            _record(spark, tables, [(request_id, month, step, rows)])
            after_step(month, step)
    return months


def erase(
    spark: SparkSession, tables: Tables, request_id: str, gone: DataFrame, salt: str, salt_version: int,
    transformed_at: str, after_step: Callable[[dt.date, str], None] = lambda month, step: None,
) -> list[dt.date]:
    """Erase the subjects ``gone`` (passenger_id) from the stored months; the months that held one.

    ``after_step`` is called after each step is on record. A request with the id of an earlier one
    resumes it; it must name the same subjects.
    """

    def plan() -> list[dt.date]:
        named = [r[PM] for r in subjects.months_of(spark.read.parquet(tables.pii_filters), gone).select(PM).collect()]
        # A filter may name a month without reason; the lookups of the named months alone are asked.
        lookup = spark.read.parquet(tables.pii_lookup).where(F.col(PM).isin([F.lit(m) for m in named])) if named else None
        return [] if lookup is None else [r[PM] for r in lookup.join(gone.select("passenger_id").distinct(), "passenger_id", "left_semi").select(PM).distinct().collect()]

    return _run(spark, tables, request_id, plan, gone, salt, salt_version, transformed_at, after_step)


def rotate(
    spark: SparkSession, tables: Tables, request_id: str, salt: str, salt_version: int, transformed_at: str,
    months: list[dt.date] | None = None, after_step: Callable[[dt.date, str], None] = lambda month, step: None,
) -> list[dt.date]:
    """Write ``months``, or all stored ones, with tokens of a new salt; earlier tokens resolve no more."""

    def plan() -> list[dt.date]:
        return months or [r[PM] for r in spark.read.parquet(tables.pii_lookup).select(PM).distinct().collect()]

    return _run(spark, tables, request_id, plan, None, salt, salt_version, transformed_at, after_step)
