"""Registered queries: ingest, privacy, dimensions, SCD2, consumer analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.operators import analytics, dims, ingest, privacy, scd2, silver
from strata.plans import oracle as O
from strata.plans.models import RunParams
from strata.plans.registry import models, register
from strata.schemas import SOURCE_TYPES, TOKEN_COLUMNS
from strata.sources import landing, testbed

SRC_COLS = ", ".join(SOURCE_TYPES)

# -- ingest ---------------------------------------------------------------------


@register("cast_source_schema", O.with_(O.CHAIN_BRONZE[:2], f"SELECT {SRC_COLS} FROM bronze_u"))
def q_cast_source_schema(spark, sf_dir):
    return ingest.cast_source_schema(testbed.trips_raw(spark, sf_dir))


_ALIGN_COLS = ", ".join(
    c if c not in ("congestion_surcharge", "airport_fee") else f"CAST(NULL AS DECIMAL(10,2)) AS {c}" for c in SOURCE_TYPES
)


@register("align_schema_fill", O.with_(O.CHAIN_BRONZE[:2], f"SELECT {_ALIGN_COLS}, store_and_fwd_flag AS Store_Flag_Copy FROM bronze_u"))
def q_align_schema_fill(spark, sf_dir):
    """An old-layout month (no optional columns, one unknown column) aligned to the bronze layout."""
    raw = testbed.trips_raw(spark, sf_dir).drop("congestion_surcharge", "airport_fee")
    raw = raw.withColumn("Store_Flag_Copy", F.col("store_and_fwd_flag"))
    target = ingest.cast_source_schema(testbed.trips_raw(spark, sf_dir)).schema
    aligned, _added = ingest.align_schema(ingest.cast_source_schema(raw), target)
    return aligned


@register("ingest_metadata", O.with_(O.CHAIN_BRONZE[:2], "SELECT * FROM bronze_u"))
def q_ingest_metadata(spark, sf_dir):
    return models(spark, sf_dir).bronze_untokenized


@register(
    "month_slice",
    O.with_(
        O.CHAIN_BRONZE[:2],
        f"""SELECT *, CAST(date_trunc('month', tpep_pickup_datetime) AS DATE) AS pickup_month FROM bronze_u
WHERE CAST(date_trunc('month', tpep_pickup_datetime) AS DATE) =
  (SELECT max(CAST(date_trunc('month', tpep_pickup_datetime) AS DATE)) FROM bronze_u)""",
    ),
)
def q_month_slice(spark, sf_dir):
    """Rows of the latest landed month (semi join with the month frame, no driver round trip)."""
    b = ingest.with_pickup_month(models(spark, sf_dir).bronze_untokenized)
    latest = b.agg(F.max("pickup_month").alias("pickup_month"))
    return landing.month_slice(b, latest)


@register(
    "cross_year_evolution",
    O.with_(
        O.CHAIN_BRONZE[:2],
        f"""SELECT CAST(year(tpep_pickup_datetime) AS INTEGER) AS year, CAST(month(tpep_pickup_datetime) AS INTEGER) AS month,
  COUNT(*) AS trips, {O.avg_dec("congestion_surcharge")} AS avg_congestion_surcharge,
  {O.avg_dec("airport_fee")} AS avg_airport_fee
FROM bronze_u GROUP BY 1, 2""",
    ),
)
def q_cross_year_evolution(spark, sf_dir):
    return analytics.cross_year_evolution(models(spark, sf_dir).bronze_untokenized)


_MONTHS = "CAST(date_trunc('month', tpep_pickup_datetime) AS DATE)"


@register(
    "month_sequence",
    O.with_(
        O.CHAIN_BRONZE[:2],
        f"""SELECT CAST(m AS DATE) AS month FROM (
  SELECT unnest(generate_series(min({_MONTHS}), max({_MONTHS}), INTERVAL 1 MONTH)) AS m FROM bronze_u)""",
    ),
)
def q_month_sequence(spark, sf_dir):
    return ingest.month_range(ingest.with_pickup_month(models(spark, sf_dir).bronze_untokenized))


@register(
    "months_to_load",
    O.with_(
        O.CHAIN_BRONZE[:2],
        f"""SELECT CAST(m AS DATE) AS month FROM (
  SELECT unnest(generate_series(min({_MONTHS}), max({_MONTHS}) + INTERVAL 3 MONTH, INTERVAL 1 MONTH)) AS m FROM bronze_u)
WHERE CAST(m AS DATE) NOT IN (SELECT DISTINCT {_MONTHS} FROM bronze_u)""",
    ),
)
def q_months_to_load(spark, sf_dir):
    """Months requested (data range plus 3 months ahead) that are not loaded yet."""
    b = ingest.with_pickup_month(models(spark, sf_dir).bronze_untokenized)
    requested = ingest.month_range(b, extra_months=3)
    loaded = b.select(F.col("pickup_month").alias("month"))
    return ingest.months_to_load(requested, loaded)


@register(
    "out_of_month_split",
    O.with_(
        O.CHAIN_BRONZE[:2],
        f"""SELECT CAST(date_trunc('month', tpep_dropoff_datetime) AS DATE) AS _file_month,
  CASE WHEN {_MONTHS} = CAST(date_trunc('month', tpep_dropoff_datetime) AS DATE) THEN 'in_month' ELSE 'late_or_early' END AS _route,
  COUNT(*) AS rows
FROM bronze_u GROUP BY 1, 2""",
    ),
)
def q_out_of_month_split(spark, sf_dir):
    """Rows landed in files cut by drop-off month, routed against their pickup month."""
    b = models(spark, sf_dir).bronze_untokenized
    routed = ingest.route_by_file_month(b, F.date_trunc("month", "tpep_dropoff_datetime").cast("date"))
    return routed.groupBy("_file_month", "_route").agg(F.count("*").alias("rows"))


# -- privacy --------------------------------------------------------------------


@register("pii_lookup", O.with_(O.CHAIN_BRONZE[:3], "SELECT * FROM lookup"))
def q_pii_lookup(spark, sf_dir):
    return models(spark, sf_dir).pii_lookup


_TOK = ", ".join(TOKEN_COLUMNS)


@register(
    "pii_tokens",
    O.with_(O.CHAIN_BRONZE, f"SELECT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, fare_amount, {_TOK}, _salt_version FROM bronze"),
)
def q_pii_tokens(spark, sf_dir):
    return models(spark, sf_dir).bronze.select(
        "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "fare_amount", *TOKEN_COLUMNS, "_salt_version"
    )


@register(
    "token_coverage",
    O.with_(
        O.CHAIN_BRONZE,
        f"""SELECT {_MONTHS} AS pickup_month, COUNT(*) AS total_rows, COUNT(passenger_email_token) AS tokenized_rows,
  CAST(COUNT(passenger_email_token) AS DOUBLE) / NULLIF(COUNT(*), 0) AS coverage,
  avg(length(passenger_email_token)) AS avg_token_length
FROM bronze GROUP BY 1""",
    ),
)
def q_token_coverage(spark, sf_dir):
    b = ingest.with_pickup_month(models(spark, sf_dir).bronze)
    return privacy.token_coverage(b, group_by=["pickup_month"])


ROTATED = RunParams(salt="strata-salt-v2", salt_version=2)


@register(
    "salt_rotation",
    O.with_(
        O.CHAIN_BRONZE[:3] + [O.tokens_cte("tokens2", ROTATED.salt), O.bronze_cte("bronze2", "tokens2", ROTATED.salt_version)],
        f"SELECT VendorID, tpep_pickup_datetime, fare_amount, {_TOK}, _salt_version FROM bronze2",
    ),
)
def q_salt_rotation(spark, sf_dir):
    m = models(spark, sf_dir)
    rotated = privacy.rotate_salt(m.bronze, m.pii_lookup, ROTATED.salt, ROTATED.salt_version)
    return rotated.select("VendorID", "tpep_pickup_datetime", "fare_amount", *TOKEN_COLUMNS, "_salt_version")


@register(
    "erase_subjects",
    O.with_(
        O.CHAIN_BRONZE
        + [
            """erasure AS (
  SELECT DISTINCT l.passenger_id FROM lookup l JOIN bronze_u b
    ON l.VendorID = b.VendorID AND l.tpep_pickup_datetime = b.tpep_pickup_datetime
  WHERE b.payment_type = 4)""",
            "lookup2 AS (SELECT * FROM lookup WHERE passenger_id NOT IN (SELECT passenger_id FROM erasure))",
            O.tokens_cte("tokens2", ROTATED.salt, "lookup2"),
            O.bronze_cte("bronze2", "tokens2", ROTATED.salt_version),
        ],
        f"""SELECT {_MONTHS} AS pickup_month, COUNT(*) AS total_rows, COUNT(passenger_email_token) AS tokenized_rows,
  CAST(COUNT(passenger_email_token) AS DOUBLE) / NULLIF(COUNT(*), 0) AS coverage,
  avg(length(passenger_email_token)) AS avg_token_length
FROM bronze2 GROUP BY 1""",
    ),
)
def q_erase_subjects(spark, sf_dir):
    """Erase passengers of disputed trips: drop their lookup rows, rotate the salt, report coverage."""
    m = models(spark, sf_dir)
    disputed = m.bronze_untokenized.filter(F.col("payment_type") == 4).select("VendorID", "tpep_pickup_datetime")
    subjects = m.pii_lookup.join(disputed, ["VendorID", "tpep_pickup_datetime"], "left_semi").select("passenger_id")
    kept = privacy.erase_subjects(m.pii_lookup, subjects)
    rotated = privacy.rotate_salt(m.bronze_untokenized, kept, ROTATED.salt, ROTATED.salt_version)
    return privacy.token_coverage(ingest.with_pickup_month(rotated), group_by=["pickup_month"])


# -- dimensions -----------------------------------------------------------------

DATE_SPINE_SQL = """spine AS (
  SELECT CAST(unnest(generate_series(min(CAST(pickup_at AS DATE)), max(CAST(pickup_at AS DATE)), INTERVAL 1 DAY)) AS DATE) AS d
  FROM fct)"""

@register(
    "dim_date",
    O.with_(
        O.CHAIN_FCT
        + [DATE_SPINE_SQL],
        """SELECT d AS date_day, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, CAST(year(d) AS INTEGER) AS year,
  CAST(quarter(d) AS INTEGER) AS quarter, CAST(month(d) AS INTEGER) AS month,
  CAST(weekofyear(d) AS INTEGER) AS week_of_year, CAST(day(d) AS INTEGER) AS day_of_month,
  CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name, monthname(d) AS month_name,
  CAST(date_trunc('month', d) AS DATE) AS month_start, CAST(date_trunc('quarter', d) AS DATE) AS quarter_start,
  CAST(date_trunc('year', d) AS DATE) AS year_start, dayofweek(d) IN (0, 6) AS is_weekend
FROM spine""",
    ),
)
def q_dim_date(spark, sf_dir):
    """Calendar dimension over the span of the trip dates."""
    return dims.with_date_attributes(dims.date_spine_for(models(spark, sf_dir).fct_trips, "pickup_at"))


# -- SCD2 -----------------------------------------------------------------------

SCD_TIMES = ("1995-01-01 00:00:00", "1998-01-01 00:00:00", "2000-01-01 00:00:00", "2001-01-01 00:00:00")
CHECK = ["borough", "zone_name", "service_zone"]


def zone_versions(spark, sf_dir):
    """Three versions of the zone source derived from the staged seed:
    v2 drops AFRICA, renames ASIA zones, moves EUROPE to service zone 'EU' and blanks
    AMERICA zone names; v3 restores v1 (deleted zones return, NULL -> value)."""
    v1 = models(spark, sf_dir).stg_zone.select("location_id", *CHECK)
    b = F.col("borough")
    v2 = v1.filter(b != "AFRICA").select(
        "location_id", "borough",
        F.when(b == "ASIA", F.concat("zone_name", F.lit(" (renamed)")))
        .when(b == "AMERICA", F.lit(None).cast("string")).otherwise(F.col("zone_name")).alias("zone_name"),
        F.when(b == "EUROPE", F.lit("EU")).otherwise(F.col("service_zone")).alias("service_zone"),
    )
    return v1, v2, v1


def zone_history(spark, sf_dir):
    """Four snapshot runs (first load, changes, restore, unchanged re-run). Each run's
    output is materialised to the checkpoint folder, as the snapshot job stores it."""
    from strata.plans.registry import built

    return built(spark, ("zone_history", sf_dir), lambda: _zone_history(spark, sf_dir))


def _zone_history(spark, sf_dir):
    from strata.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(spark)
    v1, v2, v3 = zone_versions(spark, sf_dir)
    h = scd2.scd2_merge(None, v1, "location_id", CHECK, SCD_TIMES[0]).checkpoint(eager=True)
    h = scd2.scd2_merge(h, v2, "location_id", CHECK, SCD_TIMES[1]).checkpoint(eager=True)
    h = scd2.scd2_merge(h, v3, "location_id", CHECK, SCD_TIMES[2]).checkpoint(eager=True)
    return scd2.scd2_merge(h, v3, "location_id", CHECK, SCD_TIMES[3])


def _scd_sql_ctes() -> list[str]:
    v = [
        "v1 AS (SELECT location_id, borough, zone_name, service_zone FROM stg_zone)",
        """v2 AS (SELECT location_id, borough,
  CASE WHEN borough = 'ASIA' THEN zone_name || ' (renamed)' WHEN borough = 'AMERICA' THEN NULL ELSE zone_name END AS zone_name,
  CASE WHEN borough = 'EUROPE' THEN 'EU' ELSE service_zone END AS service_zone
FROM v1 WHERE borough <> 'AFRICA')""",
    ]

    def ins(src, t):
        sid = f"md5(coalesce(CAST(location_id AS VARCHAR), '') || '|' || coalesce(CAST({O.ts(t)} AS VARCHAR), ''))"
        return (f"SELECT location_id, borough, zone_name, service_zone, {sid} AS scd_id, "
                f"{O.ts(t)} AS updated_at, {O.ts(t)} AS valid_from, CAST(NULL AS TIMESTAMP) AS valid_to FROM {src}")

    same = " AND ".join(f"c.{x} IS NOT DISTINCT FROM s.{x}" for x in CHECK)
    ctes = v + [f"h0 AS ({ins('v1', SCD_TIMES[0])})"]
    for i, (src, t) in enumerate([("v2", SCD_TIMES[1]), ("v1", SCD_TIMES[2]), ("v1", SCD_TIMES[3])], start=1):
        p = f"h{i - 1}"
        ctes.append(f"""h{i} AS (
  SELECT * FROM {p} WHERE valid_to IS NOT NULL
  UNION ALL
  SELECT c.* FROM {p} c JOIN {src} s ON c.location_id = s.location_id WHERE c.valid_to IS NULL AND {same}
  UNION ALL
  SELECT c.location_id, c.borough, c.zone_name, c.service_zone, c.scd_id, c.updated_at, c.valid_from, {O.ts(t)}
  FROM {p} c LEFT JOIN {src} s ON c.location_id = s.location_id
  WHERE c.valid_to IS NULL AND (s.location_id IS NULL OR NOT ({same}))
  UNION ALL
  {ins(f"(SELECT s.* FROM {src} s LEFT JOIN (SELECT * FROM {p} WHERE valid_to IS NULL) c ON c.location_id = s.location_id WHERE c.location_id IS NULL OR NOT ({same}))", t)}
)""")
    return ctes


@register("scd2_merge", O.with_([O.ZONE] + _scd_sql_ctes(), "SELECT * FROM h3"))
def q_scd2_merge(spark, sf_dir):
    return zone_history(spark, sf_dir)


@register(
    "scd2_point_in_time",
    O.with_(
        O.CHAIN_FCT + [O.ZONE] + _scd_sql_ctes(),
        """SELECT f.pu_location_id, h.valid_from AS dim_valid_from, h.zone_name AS dim_zone_name,
  h.service_zone AS dim_service_zone, COUNT(*) AS trips
FROM fct f LEFT JOIN h3 h ON f.pu_location_id = h.location_id AND f.pickup_at >= h.valid_from
  AND (h.valid_to IS NULL OR f.pickup_at < h.valid_to)
GROUP BY 1, 2, 3, 4""",
    ),
)
def q_scd2_point_in_time(spark, sf_dir):
    """Trips joined to the zone version valid at pickup, counted per version."""
    j = scd2.point_in_time(models(spark, sf_dir).fct_trips, zone_history(spark, sf_dir), "pu_location_id",
                           "location_id", "pickup_at", ["zone_name", "service_zone"])
    return j.groupBy("pu_location_id", F.col("valid_from").alias("dim_valid_from"), "dim_zone_name", "dim_service_zone").agg(
        F.count("*").alias("trips")
    )


@register(
    "scd2_current_check",
    O.with_([O.ZONE] + _scd_sql_ctes(),
            "SELECT location_id, COUNT(*) AS current_rows FROM h3 WHERE valid_to IS NULL GROUP BY 1 HAVING COUNT(*) <> 1"),
)
def q_scd2_current_check(spark, sf_dir):
    return scd2.current_row_violations(zone_history(spark, sf_dir), "location_id")


# -- consumer analytics ---------------------------------------------------------


@register(
    "top_zones",
    O.with_(
        O.CHAIN_GOLD,
        """SELECT pickup_month, rank, pu_location_id, zone_name, borough, trip_count, total_revenue FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY pickup_month ORDER BY total_revenue DESC, pu_location_id) AS INTEGER) AS rank
  FROM zone_rev) WHERE rank <= 10""",
    ),
)
def q_top_zones(spark, sf_dir):
    return analytics.top_zones(models(spark, sf_dir).fct_zone_revenue_monthly, 10)


@register(
    "daily_trend",
    O.with_(
        O.CHAIN_GOLD,
        f"""SELECT pickup_date, CAST(SUM(trip_count) AS BIGINT) AS trips, {O.dsum("total_revenue", 30)} AS revenue,
  {O.avg_dec("avg_tip_pct", 6, 14)} AS avg_tip_pct FROM daily GROUP BY 1""",
    ),
)
def q_daily_trend(spark, sf_dir):
    return analytics.daily_trend(models(spark, sf_dir).fct_trips_daily)


@register(
    "daily_trend_weighted",
    O.with_(
        O.CHAIN_FCT,
        f"""SELECT CAST(pickup_at AS DATE) AS pickup_date, COUNT(*) AS trips, {O.dsum("total_amount")} AS revenue,
  {O.avg_dec("tip_pct")} AS avg_tip_pct FROM fct GROUP BY 1""",
    ),
)
def q_daily_trend_weighted(spark, sf_dir):
    return analytics.daily_trend_weighted(models(spark, sf_dir).fct_trips)


@register(
    "grain_check",
    O.with_(O.CHAIN_FCT, "SELECT COUNT(*) AS rows, COUNT(DISTINCT trip_id) AS distinct_keys, COUNT(*) = COUNT(DISTINCT trip_id) AS grain_ok FROM fct"),
)
def q_grain_check(spark, sf_dir):
    return analytics.grain_check(models(spark, sf_dir).fct_trips)


@register(
    "silver_flags",
    O.with_(
        O.CHAIN_FCT[:-1],
        """SELECT vendor_id, pickup_at, dropoff_at, pu_location_id, fare_amount, passenger_count,
  coalesce(fare_amount < 0, false) AS is_dispute, coalesce(passenger_count = 0, false) AS passenger_count_missing,
  CAST(date_diff('second', pickup_at, dropoff_at) AS BIGINT) AS trip_duration_sec
FROM stg""",
    ),
)
def q_silver_flags(spark, sf_dir):
    f = silver.silver_flags(models(spark, sf_dir).stg_trips)
    return f.select("vendor_id", "pickup_at", "dropoff_at", "pu_location_id", "fare_amount", "passenger_count",
                    "is_dispute", "passenger_count_missing", "trip_duration_sec")


_DEDUPE_KEYS = ["vendor_id", "pickup_at", "dropoff_at", "pu_location_id", "do_location_id", "fare_amount",
                "total_amount", "trip_distance", "passenger_count"]
_DEDUPE_COLS = _DEDUPE_KEYS + ["_ingested_at", "rate_code_id", "payment_type", "tip_amount", "mta_tax",
                               "congestion_surcharge", "airport_fee", "store_and_fwd_flag", "passenger_email_token"]


def _dedupe_sql() -> str:
    rest = [c for c in _DEDUPE_COLS if c not in _DEDUPE_KEYS and c != "_ingested_at"]
    order = ", ".join(["_ingested_at DESC NULLS LAST"] + [f"{c} DESC NULLS LAST" for c in rest])
    part = ", ".join(_DEDUPE_KEYS)
    cols = ", ".join(_DEDUPE_COLS)
    return (f"SELECT {cols} FROM (SELECT {cols}, row_number() OVER (PARTITION BY {part} ORDER BY {order}) AS rn "
            f"FROM stg) WHERE rn = 1")


@register("dedupe_latest", O.with_(O.CHAIN_FCT[:-1], _dedupe_sql()))
def q_dedupe_latest(spark, sf_dir):
    """One row per trip grain, latest ingestion first; duplicate trips collapse."""
    s = models(spark, sf_dir).stg_trips.select(*_DEDUPE_COLS)
    return silver.dedupe_latest(s, _DEDUPE_KEYS, "_ingested_at")


@register(
    "dim_zone_from_snapshot",
    O.with_(
        [O.ZONE] + _scd_sql_ctes(),
        """SELECT location_id, zone_name, borough, service_zone, valid_from AS effective_from,
  md5(CAST(location_id AS VARCHAR)) AS zone_sk FROM h3 WHERE valid_to IS NULL""",
    ),
)
def q_dim_zone_from_snapshot(spark, sf_dir):
    """The zone dimension built from the current rows of the SCD2 snapshot."""
    return dims.dim_zone(zone_history(spark, sf_dir))


@register(
    "top_zones_latest_month",
    O.with_(
        O.CHAIN_GOLD,
        """SELECT pu_location_id, zone_name, borough, trip_count, total_revenue FROM zone_rev
WHERE pickup_month = (SELECT max(pickup_month) FROM zone_rev)
ORDER BY total_revenue DESC, pu_location_id LIMIT 10""",
    ),
)
def q_top_zones_latest_month(spark, sf_dir):
    """Top 10 pickup zones by revenue in the latest month (a top-k report)."""
    zr = models(spark, sf_dir).fct_zone_revenue_monthly
    latest = zr.agg(F.max("pickup_month").alias("pickup_month"))
    return analytics.top_zones_in_month(zr, latest, 10)


SAMPLE_COLS = ["tpep_pickup_datetime", "VendorID", "tpep_dropoff_datetime", "PULocationID", "fare_amount", "total_amount"]


@register(
    "bronze_sample",
    O.with_(
        O.CHAIN_BRONZE[:2],
        f"SELECT {', '.join(SAMPLE_COLS)} FROM bronze_u ORDER BY {', '.join(c + ' NULLS FIRST' for c in SAMPLE_COLS)} LIMIT 5",
    ),
)
def q_bronze_sample(spark, sf_dir):
    """Verification sample of bronze: the first 5 rows in a total order (the limit is the feature)."""
    _count, sample = analytics.bronze_sample(models(spark, sf_dir).bronze_untokenized, SAMPLE_COLS, 5)
    return sample
