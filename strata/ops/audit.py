"""Pipeline audit log and the run metrics read from it, all as Spark tables."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.schemas import AUDIT_SCHEMA, STATUS_CODES

DAG_ID = "monthly_trip_load"


@dataclass
class AuditRecord:
    """One task run. Defaults: zero counts, pass rate 1.0, no failures, scheduled."""

    run_id: str
    dag_id: str
    task_id: str
    layer: str
    table_name: str
    started_at: dt.datetime
    finished_at: dt.datetime
    status: str
    source_url: str = ""
    source_sha256: str = ""
    schema_version: int = 1
    rows_in: int = 0
    rows_out: int = 0
    rows_quarantined: int = 0
    ge_suite_name: str = ""
    ge_pass_rate: float = 1.0
    ge_failed_expectations: list[str] = field(default_factory=list)
    error_message: str | None = None
    triggered_by: str = "scheduled"

    @property
    def duration_sec(self) -> float:
        return (self.finished_at - self.started_at).total_seconds()

    def as_tuple(self) -> tuple:
        if self.status not in STATUS_CODES:
            raise ValueError(f"unknown status {self.status}")
        err = self.error_message[:500] if self.error_message else None
        return (
            self.run_id, self.dag_id, self.task_id, self.layer, self.table_name, self.source_url,
            self.source_sha256, self.schema_version, self.rows_in, self.rows_out, self.rows_quarantined,
            self.ge_suite_name, float(self.ge_pass_rate), list(self.ge_failed_expectations), self.started_at,
            self.finished_at, self.duration_sec, self.status, err, self.triggered_by,
        )


def audit_frame(spark: SparkSession, records: list[AuditRecord]) -> DataFrame:
    """Typed rows (no SQL string building, so quotes in any field are harmless)."""
    return spark.createDataFrame([r.as_tuple() for r in records], AUDIT_SCHEMA)


def append_audit(df: DataFrame, path: str) -> None:
    """Append to the audit table, partitioned by the run day."""
    df.withColumn("run_date", F.to_date("started_at")).write.mode("append").partitionBy("run_date").parquet(path)


def status_code(col: Column) -> Column:
    expr = None
    for k, v in STATUS_CODES.items():
        expr = F.when(col == k, F.lit(v)) if expr is None else expr.when(col == k, F.lit(v))
    return expr


def recent_runs(audit: DataFrame, n: int = 20) -> DataFrame:
    """Newest runs first (a top-n report)."""
    return audit.orderBy(F.col("finished_at").desc(), "run_id", "task_id").limit(n).select(
        "run_id", "dag_id", "task_id", "status", "started_at", "finished_at", "duration_sec", "rows_out"
    )


def latest_metrics(audit: DataFrame) -> DataFrame:
    """Latest values per (dag, task, layer), as a metrics gateway would expose them."""
    last = F.max_by(
        F.struct("duration_sec", "rows_out", "rows_quarantined", "ge_pass_rate", "status", "finished_at", "run_id"),
        F.struct("finished_at", "run_id"),
    )
    g = audit.groupBy("dag_id", "task_id", "layer").agg(last.alias("l"))
    return g.select(
        "dag_id", "task_id", "layer",
        F.col("l.duration_sec").alias("duration_sec"),
        F.col("l.rows_out").alias("rows_written"),
        F.col("l.rows_quarantined").alias("rows_quarantined"),
        F.col("l.ge_pass_rate").alias("pass_rate"),
        status_code(F.col("l.status")).alias("status_code"),
        F.col("l.finished_at").alias("last_finished_ts"),
    )


def last_runs(audit: DataFrame, n: int = 12) -> DataFrame:
    """The last ``n`` runs per (dag, task), newest first (group limit before the shuffle)."""
    w = Window.partitionBy("dag_id", "task_id").orderBy(F.col("started_at").desc(), F.col("run_id").desc())
    return audit.withColumn("run_rank", F.row_number().over(w)).filter(F.col("run_rank") <= n).select(
        "dag_id", "task_id", "run_rank", "run_id", "started_at", "duration_sec"
    )


def rows_band(audit: DataFrame, history: int = 14, sigmas: float = 2.0) -> DataFrame:
    """Rows written per run with a mean +/- sigmas band over the previous ``history`` runs."""
    w = Window.partitionBy("dag_id", "task_id").orderBy("started_at", "run_id").rowsBetween(-history, -1)
    v = F.col("rows_out").cast("double")
    mean, sd = F.avg(v).over(w), F.stddev_samp(v).over(w)
    out = audit.select(
        "dag_id", "task_id", "run_id", "started_at", "rows_out",
        (mean - F.lit(sigmas) * sd).alias("band_low"), (mean + F.lit(sigmas) * sd).alias("band_high"),
    )
    return out.withColumn("outside_band", (v < F.col("band_low")) | (v > F.col("band_high")))


def freshness_lag(audit: DataFrame, as_of: dt.datetime | str) -> DataFrame:
    """Per table: last successful finish and the lag to ``as_of`` in hours."""
    s = as_of.strftime("%Y-%m-%d %H:%M:%S") if isinstance(as_of, dt.datetime) else as_of
    now = F.to_timestamp(F.lit(s))
    last = audit.filter(F.col("status") == "SUCCESS").groupBy("table_name").agg(F.max("finished_at").alias("last_success_at"))
    return last.withColumn(
        "lag_hours", (F.unix_seconds(now) - F.unix_seconds(F.col("last_success_at"))).cast("double") / F.lit(3600.0)
    )


def pass_rate_trend(audit: DataFrame, since: dt.datetime | str | None = None) -> DataFrame:
    """Mean gate pass rate per suite and day."""
    a = audit.filter(F.col("ge_suite_name") != "")
    if since is not None:
        a = a.filter(F.col("finished_at") >= F.to_timestamp(F.lit(str(since))))
    return a.groupBy("ge_suite_name", F.to_date("finished_at").alias("day")).agg(F.avg("ge_pass_rate").alias("avg_pass_rate"))


def quarantine_rate(audit: DataFrame) -> DataFrame:
    """Per run month: rows in, rows quarantined, and their ratio (gate tasks only)."""
    a = audit.filter(F.col("task_id") == "ge_bronze")
    g = a.groupBy(F.date_trunc("month", "started_at").cast("date").alias("run_month")).agg(
        F.sum("rows_in").alias("rows_in"), F.sum("rows_quarantined").alias("rows_quarantined")
    )
    return g.withColumn("quarantine_rate", F.col("rows_quarantined") / F.nullif(F.col("rows_in"), F.lit(0)))


def status_timeline(audit: DataFrame) -> DataFrame:
    """Per day and DAG: status of the last task run that day, and its code."""
    g = audit.groupBy(F.to_date("finished_at").alias("day"), "dag_id").agg(
        F.max_by(F.col("status"), F.struct("finished_at", "task_id")).alias("last_status"),
        F.count("*").alias("task_runs"),
    )
    return g.withColumn("status_code", status_code(F.col("last_status")))


def failed_leaderboard(audit: DataFrame, since: dt.datetime | str | None = None) -> DataFrame:
    """Tasks by number of non-successful runs (FAILED and QUARANTINED counted apart)."""
    a = audit.filter(F.col("status") != "SUCCESS")
    if since is not None:
        a = a.filter(F.col("finished_at") >= F.to_timestamp(F.lit(str(since))))
    return a.groupBy("dag_id", "task_id").agg(
        F.count("*").alias("unsuccessful_runs"),
        F.count_if(F.col("status") == "FAILED").alias("failed_runs"),
        F.count_if(F.col("status") == "QUARANTINED").alias("quarantined_runs"),
        F.max("finished_at").alias("last_unsuccessful_at"),
    )


def table_history(audit: DataFrame, table_name: str) -> DataFrame:
    """Run history of one table, newest first."""
    return audit.filter(F.col("table_name") == table_name).select(
        "run_id", "task_id", "status", "rows_out", "started_at", "finished_at"
    )
