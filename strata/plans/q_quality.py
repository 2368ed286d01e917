"""Registered queries: quality gate, quarantine, structural tests, drift, reconciliation."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import dims, ingest
from strata.operators.quality import drift, reconcile, structural
from strata.operators.quality import expectations as X
from strata.operators.quality.quarantine import quarantine_month, quarantine_rows
from strata.plans import oracle as O
from strata.plans import q_ingest
from strata.plans.registry import models, register
from strata.sources import testbed

RUN_ID = "run-0001"
MONTHS = "CAST(date_trunc('month', tpep_pickup_datetime) AS DATE)"
BRONZE_DECIMALS = {"fare_amount", "trip_distance", "total_amount", "tip_amount"}
GOLD_DECIMALS = {"tip_pct", "total_amount", "fare_amount", "duration_min"}

BRONZE_M = f"bronze_m AS (SELECT *, {MONTHS} AS pickup_month FROM bronze)"
BRONZE_RESULTS = f"bronze_results AS ({O.suite_sql(X.TESTBED_BRONZE_SUITE, 'bronze_m', 'pickup_month', BRONZE_DECIMALS)})"
BRONZE_VERDICT = f"bronze_verdict AS ({O.verdict_sql('bronze_results', 'pickup_month', 'testbed_bronze')})"
GOLD_RESULTS = f"gold_results AS ({O.suite_sql(X.TESTBED_GOLD_SUITE, 'fct', 'pickup_month', GOLD_DECIMALS)})"
GOLD_VERDICT = f"gold_verdict AS ({O.verdict_sql('gold_results', 'pickup_month', 'testbed_gold')})"
CHAIN_GATE = O.CHAIN_BRONZE + [BRONZE_M, BRONZE_RESULTS, BRONZE_VERDICT]


def bronze_m(spark, sf_dir):
    return ingest.with_pickup_month(models(spark, sf_dir).bronze)


def bronze_results(spark, sf_dir):
    return X.evaluate_suite(bronze_m(spark, sf_dir), X.TESTBED_BRONZE_SUITE, ["pickup_month"])


def bronze_verdict(spark, sf_dir):
    return X.gate_verdict(bronze_results(spark, sf_dir), ["pickup_month"], "testbed_bronze")


def gold_verdict(spark, sf_dir):
    r = X.evaluate_suite(models(spark, sf_dir).fct_trips, X.TESTBED_GOLD_SUITE, ["pickup_month"])
    return X.gate_verdict(r, ["pickup_month"], "testbed_gold")


@register("ge_bronze_suite", O.with_(CHAIN_GATE[:-1], "SELECT * FROM bronze_results"))
def q_ge_bronze_suite(spark, sf_dir):
    """The bronze suite per month, all expectations from one aggregation."""
    return bronze_results(spark, sf_dir)


@register("ge_gold_suite", O.with_(O.CHAIN_FCT + [GOLD_RESULTS], "SELECT * FROM gold_results"))
def q_ge_gold_suite(spark, sf_dir):
    return X.evaluate_suite(models(spark, sf_dir).fct_trips, X.TESTBED_GOLD_SUITE, ["pickup_month"])


@register(
    "ge_reference_suite",
    O.with_(
        O.CHAIN_BRONZE + [BRONZE_M, f"r AS ({O.suite_sql(X.BRONZE_SUITE, 'bronze_m', 'pickup_month', BRONZE_DECIMALS)})"],
        "SELECT * FROM r",
    ),
)
def q_ge_reference_suite(spark, sf_dir):
    """The published bronze suite, unchanged bounds (the trip-shaped test data fails most of it)."""
    return X.evaluate_suite(bronze_m(spark, sf_dir), X.BRONZE_SUITE, ["pickup_month"])


@register("gate_verdict", O.with_(CHAIN_GATE, "SELECT * FROM bronze_verdict"))
def q_gate_verdict(spark, sf_dir):
    return bronze_verdict(spark, sf_dir)


_Q_COLS = "VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, fare_amount, pickup_month"


@register(
    "quarantine_month",
    O.with_(
        CHAIN_GATE,
        f"""SELECT {_Q_COLS}, array_to_string(v.failed_expectations, ';') AS _failure_reason,
  to_json(v.failed_kwargs)::VARCHAR AS _expectation_kwargs, '{RUN_ID}' AS _quarantine_run_id
FROM bronze_m b JOIN bronze_verdict v USING (pickup_month) WHERE NOT v.success""",
    ),
)
def q_quarantine_month(spark, sf_dir):
    """All rows of months whose bronze gate failed, with the reasons."""
    b = bronze_m(spark, sf_dir).select(*[c.strip() for c in _Q_COLS.split(",")])
    return quarantine_month(b, bronze_verdict(spark, sf_dir), RUN_ID, ["pickup_month"])


def _row_rules_sql() -> str:
    parts = []
    for e in X.TESTBED_BRONZE_SUITE:
        k = e.kwargs
        if e.type == X.PAIR_GT:
            a, b = k["column_A"], k["column_B"]
            cond = f"{a} IS NOT NULL AND {b} IS NOT NULL AND {a} <= {b}"
        elif e.type == X.BETWEEN:
            cond = f"{e.column} IS NOT NULL AND NOT {O._between_sql(e.column, k.get('min_value'), k.get('max_value'))}"
        elif e.type == X.LENGTH_EQ:
            cond = f"{e.column} IS NOT NULL AND length({e.column}) <> {k['value']}"
        elif e.type == X.IN_SET:
            cond = f"{e.column} IS NOT NULL AND {e.column} NOT IN ({', '.join(map(str, k['value_set']))})"
        else:
            continue
        parts.append(
            f"SELECT {_Q_COLS}, '{e.type}:{e.column}' AS _failure_reason, {O._lit(e.kwargs_json())} AS _expectation_kwargs, "
            f"'{RUN_ID}' AS _quarantine_run_id FROM bronze_m WHERE {cond}"
        )
    return "\nUNION ALL\n".join(parts)


@register("quarantine_rows", O.with_(O.CHAIN_BRONZE + [BRONZE_M], _row_rules_sql()))
def q_quarantine_rows(spark, sf_dir):
    """One row per (trip, element rule it breaks)."""
    b = bronze_m(spark, sf_dir)
    q = quarantine_rows(b, X.TESTBED_BRONZE_SUITE, RUN_ID)
    return q.select(*[c.strip() for c in _Q_COLS.split(",")], "_failure_reason", "_expectation_kwargs", "_quarantine_run_id")


# -- structural tests ---------------------------------------------------------------

_DIM_SQL = {"dim_vendor": "dim_vendor", "dim_payment_type": "dim_payment_type", "dim_rate_code": "dim_rate_code"}
_TOK_AUDIT_SQL = f"""tok_audit AS (
  SELECT {O.sk("pickup_month", "_salt_version")} AS audit_id, pickup_month, _salt_version AS salt_version
  FROM fct WHERE _salt_version IS NOT NULL GROUP BY pickup_month, _salt_version)"""


def _structural_oracle() -> str:
    parts = (
        O.structural_sql("stg_trips", "stg", structural.STG_TRIPS_TESTS)
        + O.structural_sql("stg_taxi_zone", "stg_zone", structural.STG_ZONE_TESTS)
        + O.structural_sql("fct_trips", "fct", structural.FCT_TRIPS_TESTS, _DIM_SQL)
        + O.structural_sql("fct_trips_daily", "daily", structural.FCT_DAILY_TESTS)
        + O.structural_sql("fct_zone_revenue_monthly", "zone_rev", structural.FCT_ZONE_REVENUE_TESTS)
        + O.structural_sql("fct_tokenization_audit", "tok_audit", structural.FCT_TOKEN_AUDIT_TESTS)
    )
    body = "SELECT *, failures = 0 AS passed FROM (\n" + "\nUNION ALL\n".join(parts) + "\n)"
    return O.with_(O.CHAIN_GOLD + [O.VENDOR, O.RATE, _TOK_AUDIT_SQL], body)


@register("structural_tests", _structural_oracle())
def q_structural_tests(spark, sf_dir):
    """The declared tests of the silver and gold models, as one result table."""
    m = models(spark, sf_dir)
    d = {"dim_vendor": m.dim_vendor, "dim_payment_type": m.dim_payment_type, "dim_rate_code": m.dim_rate_code}
    parts = [
        structural.run_structural_tests(spark, m.stg_trips, "stg_trips", structural.STG_TRIPS_TESTS),
        structural.run_structural_tests(spark, m.stg_zone, "stg_taxi_zone", structural.STG_ZONE_TESTS),
        structural.run_structural_tests(spark, m.fct_trips, "fct_trips", structural.FCT_TRIPS_TESTS, d),
        structural.run_structural_tests(spark, m.fct_trips_daily, "fct_trips_daily", structural.FCT_DAILY_TESTS),
        structural.run_structural_tests(spark, m.fct_zone_revenue_monthly, "fct_zone_revenue_monthly",
                                        structural.FCT_ZONE_REVENUE_TESTS),
        structural.run_structural_tests(spark, m.fct_tokenization_audit, "fct_tokenization_audit",
                                        structural.FCT_TOKEN_AUDIT_TESTS),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _dims_oracle() -> str:
    parts = (
        O.structural_sql("dim_payment_type", "dim_payment_type", structural.DIM_PAYMENT_TYPE_TESTS)
        + O.structural_sql("dim_rate_code", "dim_rate_code", structural.DIM_RATE_CODE_TESTS)
        + O.structural_sql("dim_vendor", "dim_vendor", structural.DIM_VENDOR_TESTS)
        + O.structural_sql("dim_taxi_zone", "zone_now", structural.DIM_ZONE_TESTS)
        + O.structural_sql("dim_date", "days", structural.DIM_DATE_TESTS)
        + O.structural_sql("dim_taxi_zone_snapshot", "h3", [*structural.ZONE_SNAPSHOT_TESTS, structural.ZONE_SNAPSHOT_ORDER])
    )
    zone_now = """zone_now AS (
  SELECT location_id, md5(CAST(location_id AS VARCHAR)) AS zone_sk, zone_name, borough FROM h3 WHERE valid_to IS NULL)"""
    days = """days AS (
  SELECT d AS date_day, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, year(d) AS year,
    dayofweek(d) IN (0, 6) AS is_weekend
  FROM spine)"""
    body = "SELECT *, failures = 0 AS passed FROM (\n" + "\nUNION ALL\n".join(parts) + "\n)"
    ctes = O.CHAIN_GOLD + [O.VENDOR, O.RATE] + q_ingest._scd_sql_ctes() + [q_ingest.DATE_SPINE_SQL, zone_now, days]
    return O.with_(ctes, body)


@register("structural_tests_dims", _dims_oracle())
def q_structural_tests_dims(spark, sf_dir):
    """The declared tests of the dimensions and the zone snapshot, and the order of its intervals."""
    m = models(spark, sf_dir)
    history = q_ingest.zone_history(spark, sf_dir)
    days = dims.with_date_attributes(dims.date_spine_for(m.fct_trips, "pickup_at"))
    suites = [
        (m.dim_payment_type, "dim_payment_type", structural.DIM_PAYMENT_TYPE_TESTS),
        (m.dim_rate_code, "dim_rate_code", structural.DIM_RATE_CODE_TESTS),
        (m.dim_vendor, "dim_vendor", structural.DIM_VENDOR_TESTS),
        (dims.dim_zone(history), "dim_taxi_zone", structural.DIM_ZONE_TESTS),
        (days, "dim_date", structural.DIM_DATE_TESTS),
        (history, "dim_taxi_zone_snapshot", [*structural.ZONE_SNAPSHOT_TESTS, structural.ZONE_SNAPSHOT_ORDER]),
    ]
    out = None
    for frame, name, tests in suites:
        r = structural.run_structural_tests(spark, frame, name, tests)
        out = r if out is None else out.unionByName(r)
    return out


@register(
    "fk_violations",
    O.with_(
        O.CHAIN_FCT + [O.RATE],
        "SELECT trip_id, pickup_at, rate_code_id FROM fct WHERE rate_code_id IS NOT NULL AND rate_code_id NOT IN (SELECT rate_code_id FROM dim_rate_code)",
    ),
)
def q_fk_violations(spark, sf_dir):
    m = models(spark, sf_dir)
    return structural.fk_violations(m.fct_trips, "rate_code_id", m.dim_rate_code, "rate_code_id").select(
        "trip_id", "pickup_at", "rate_code_id"
    )


@register(
    "duplicate_keys",
    O.with_(O.CHAIN_FCT, "SELECT trip_id, COUNT(*) AS occurrences FROM fct WHERE trip_id IS NOT NULL GROUP BY trip_id HAVING COUNT(*) > 1"),
)
def q_duplicate_keys(spark, sf_dir):
    return structural.duplicate_keys(models(spark, sf_dir).fct_trips, ["trip_id"])


@register(
    "duplicate_keys_relanded",
    O.with_(
        O.CHAIN_FCT,
        """SELECT trip_id, count(*) * 2 AS occurrences FROM fct
WHERE pickup_month IN (SELECT min(pickup_month) FROM fct) GROUP BY trip_id""",
    ),
)
def q_duplicate_keys_relanded(spark, sf_dir):
    """Keys found more than once after the first month was landed a second time."""
    f = models(spark, sf_dir).fct_trips.select("trip_id", "pickup_month")
    first = f.agg(F.min("pickup_month").alias("pickup_month"))
    again = f.join(F.broadcast(first), "pickup_month", "left_semi")  # one row
    return structural.duplicate_keys(f.unionByName(again), ["trip_id"])


# -- drift ----------------------------------------------------------------------

_EVENTS_SPLIT = "2024-01-16 00:00:00"


@register(
    "kl_divergence",
    f"""WITH cur AS (SELECT event_type, COUNT(*) AS nc FROM events WHERE ts >= TIMESTAMP '{_EVENTS_SPLIT}' GROUP BY 1),
ref AS (SELECT event_type, COUNT(*) AS nr FROM events WHERE ts < TIMESTAMP '{_EVENTS_SPLIT}' GROUP BY 1),
j AS (SELECT coalesce(cur.event_type, ref.event_type) AS event_type, coalesce(nc, 0) AS nc, coalesce(nr, 0) AS nr
      FROM cur FULL OUTER JOIN ref ON cur.event_type = ref.event_type),
t AS (SELECT sum(nc) AS tc, sum(nr) AS tr, COUNT(*) AS k FROM j),
pq AS (SELECT (nc / tc + 1e-9) / (1.0 + k * 1e-9) AS p, (nr / tr + 1e-9) / (1.0 + k * 1e-9) AS q FROM j, t)
SELECT round(sum(p * ln(p / q)), 10) AS kl_divergence, COUNT(*) AS categories FROM pq""",
)
def q_kl_divergence(spark, sf_dir):
    """Drift of the event-type mix: second half of the month against the first half."""
    ev = testbed.events(spark, sf_dir)
    split = F.to_timestamp(F.lit(_EVENTS_SPLIT))
    r = drift.kl_divergence(ev.filter(F.col("ts") >= split), ev.filter(F.col("ts") < split), "event_type")
    return r.select(F.round("kl_divergence", 10).alias("kl_divergence"), "categories")


@register(
    "unique_proportion",
    """SELECT event_type, COUNT(user_id) AS non_null, COUNT(DISTINCT user_id) AS distinct_values,
  CAST(COUNT(DISTINCT user_id) AS DOUBLE) / NULLIF(COUNT(user_id), 0) AS unique_proportion FROM events GROUP BY 1""",
)
def q_unique_proportion(spark, sf_dir):
    return drift.unique_proportion(testbed.events(spark, sf_dir), "user_id", ["event_type"])


_LO = "CASE WHEN history_periods >= 3 THEN mu - 2.0 * sd ELSE 500.0 END"
_HI = "CASE WHEN history_periods >= 3 THEN mu + 2.0 * sd ELSE 12000000.0 END"


@register(
    "rolling_row_bounds",
    O.with_(
        O.CHAIN_BRONZE[:2]
        + [
            f"s AS (SELECT {MONTHS} AS pickup_month, COUNT(*) AS rows FROM bronze_u GROUP BY 1)",
            """w AS (SELECT pickup_month, rows,
  COUNT(rows) OVER h AS history_periods, avg(rows) OVER h AS mu, stddev_samp(rows) OVER h AS sd
  FROM s WINDOW h AS (ORDER BY pickup_month ROWS BETWEEN 14 PRECEDING AND 1 PRECEDING))""",
        ],
        f"""SELECT pickup_month, rows, history_periods, round({_LO}, 6) AS lower_bound, round({_HI}, 6) AS upper_bound,
  rows >= {_LO} AND rows <= {_HI} AS in_bounds
FROM w""",
    ),
)
def q_rolling_row_bounds(spark, sf_dir):
    """Monthly row counts against mean +/- 2 sigma of the previous 14 months."""
    b = ingest.with_pickup_month(models(spark, sf_dir).bronze_untokenized)
    series = b.groupBy("pickup_month").agg(F.count("*").alias("rows"))
    r = drift.rolling_bounds(series, "pickup_month", "rows", history=14, sigmas=2.0, min_history=3,
                             bootstrap=(500.0, 12000000.0))
    return r.select("pickup_month", "rows", "history_periods", F.round("lower_bound", 6).alias("lower_bound"),
                    F.round("upper_bound", 6).alias("upper_bound"), "in_bounds")


# -- reconciliation -----------------------------------------------------------------


@register(
    "reconcile_daily",
    O.with_(
        O.CHAIN_GOLD,
        """d AS (SELECT pickup_month, COUNT(*) AS detail_rows FROM fct GROUP BY 1),
s AS (SELECT pickup_month, CAST(SUM(trip_count) AS BIGINT) AS summary_rows FROM daily GROUP BY 1)
SELECT coalesce(d.pickup_month, s.pickup_month) AS pickup_month, coalesce(detail_rows, 0) AS detail_rows,
  coalesce(summary_rows, 0) AS summary_rows, abs(coalesce(detail_rows, 0) - coalesce(summary_rows, 0)) AS abs_diff,
  abs(coalesce(detail_rows, 0) - coalesce(summary_rows, 0)) <= coalesce(detail_rows, 0) * 0.0 AS within_tolerance
FROM d FULL OUTER JOIN s ON d.pickup_month = s.pickup_month""",
    ),
)
def q_reconcile_daily(spark, sf_dir):
    m = models(spark, sf_dir)
    return reconcile.reconcile_counts(m.fct_trips, m.fct_trips_daily, "pickup_month", "trip_count", 0.0)


@register(
    "missing_dates",
    O.with_(
        O.CHAIN_FCT,
        """spine AS (SELECT CAST(unnest(generate_series(min(CAST(pickup_at AS DATE)), max(CAST(pickup_at AS DATE)), INTERVAL 1 DAY)) AS DATE) AS date_day FROM fct)
SELECT date_day FROM spine WHERE date_day NOT IN (SELECT DISTINCT CAST(pickup_at AS DATE) FROM fct)""",
    ),
)
def q_missing_dates(spark, sf_dir):
    fct = models(spark, sf_dir).fct_trips
    cal = dims.date_spine_for(fct, "pickup_at")
    return reconcile.missing_dates(cal, fct.withColumn("pickup_date", F.col("pickup_at").cast("date")))


@register(
    "zone_coverage",
    O.with_(
        O.CHAIN_FCT + [O.ZONE],
        """pz AS (SELECT pickup_month, pu_location_id,
    COUNT(*) FILTER (WHERE tip_pct < 0.0 OR tip_pct > 50.0) AS tip_out,
    COUNT(*) FILTER (WHERE total_amount <= 0) AS non_positive
  FROM fct GROUP BY 1, 2),
act AS (SELECT COUNT(DISTINCT location_id) AS active_zones FROM dim_zone)
SELECT pickup_month, active_zones,
  COUNT(*) FILTER (WHERE pu_location_id IN (SELECT location_id FROM dim_zone)) AS zones_with_trips,
  active_zones - COUNT(*) FILTER (WHERE pu_location_id IN (SELECT location_id FROM dim_zone)) AS zones_without_trips,
  CAST(SUM(tip_out) AS BIGINT) AS tip_pct_out_of_range, CAST(SUM(non_positive) AS BIGINT) AS non_positive_revenue
FROM pz, act GROUP BY pickup_month, active_zones""",
    ),
)
def q_zone_coverage(spark, sf_dir):
    m = models(spark, sf_dir)
    return reconcile.zone_coverage(m.fct_trips, m.dim_zone)


@register(
    "gate_route",
    O.with_(
        CHAIN_GATE,
        """SELECT b.pickup_month, CASE WHEN coalesce(v.success, false) THEN 'silver' ELSE 'quarantine' END AS route,
  COUNT(*) AS rows
FROM bronze_m b LEFT JOIN bronze_verdict v ON b.pickup_month = v.pickup_month GROUP BY 1, 2""",
    ),
)
def q_gate_route(spark, sf_dir):
    """Rows per month sent to silver or to quarantine by the verdict join (no driver branch)."""
    b = bronze_m(spark, sf_dir).select("pickup_month", "VendorID")
    passed, failed = X.route(b, bronze_verdict(spark, sf_dir), ["pickup_month"])
    both = passed.withColumn("route", F.lit("silver")).unionByName(
        failed.select("pickup_month", "VendorID").withColumn("route", F.lit("quarantine")))
    return both.groupBy("pickup_month", "route").agg(F.count("*").alias("rows"))
