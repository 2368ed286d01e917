"""Gold facts and serving tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.keys import surrogate_key
from strata.functions.trips import duration_min, tip_pct
from strata.operators.silver import month_filter
from strata.sizing import bounded_broadcast

TRIP_KEY_COLUMNS = (
    "vendor_id", "pickup_at", "dropoff_at", "pu_location_id", "do_location_id",
    "fare_amount", "total_amount", "trip_distance", "passenger_count",
)


def _ts(value: dt.datetime | str):
    s = value.strftime("%Y-%m-%d %H:%M:%S") if isinstance(value, dt.datetime) else value
    return F.to_timestamp(F.lit(s))


def fct_trips(stg: DataFrame, transformed_at, months: list[dt.date] | None = None) -> DataFrame:
    """One row per staged trip: surrogate key, duration, tip %, tokens, provenance.

    No de-duplication and no row filter: identical trips share a trip_id, which the
    unique test reports.
    """
    t = month_filter(stg, months)
    return t.select(
        surrogate_key(*TRIP_KEY_COLUMNS).alias("trip_id"),
        "vendor_id",
        "pickup_at",
        "dropoff_at",
        "pickup_month",
        duration_min(F.col("pickup_at"), F.col("dropoff_at")).alias("duration_min"),
        "passenger_count",
        "trip_distance",
        "rate_code_id",
        "pu_location_id",
        "do_location_id",
        "payment_type",
        "fare_amount",
        "extra",
        "mta_tax",
        "tip_amount",
        "tolls_amount",
        "improvement_surcharge",
        "congestion_surcharge",
        "airport_fee",
        "total_amount",
        tip_pct(F.col("tip_amount"), F.col("fare_amount")).alias("tip_pct"),
        "passenger_email_token",
        "passenger_phone_token",
        "payment_card_last4_token",
        "passenger_id_token",
        "_salt_version",
        "_ingested_at",
        "_source_url",
        _ts(transformed_at).alias("_transformed_at"),
    )


def fct_trips_daily(fct: DataFrame, transformed_at, months: list[dt.date] | None = None) -> DataFrame:
    """Per (pickup_date, pickup_month, pu_location_id, payment_type): counts, sums, means."""
    t = month_filter(fct, months).withColumn("pickup_date", F.col("pickup_at").cast("date"))
    keys = ["pickup_date", "pickup_month", "pu_location_id", "payment_type"]
    agg = t.groupBy(*keys).agg(
        F.count("*").alias("trip_count"),
        F.sum("passenger_count").alias("total_passengers"),
        F.sum("trip_distance").alias("total_distance_mi"),
        F.sum("fare_amount").alias("total_fare"),
        F.sum("tip_amount").alias("total_tip"),
        F.sum("total_amount").alias("total_revenue"),
        F.avg("tip_pct").alias("avg_tip_pct"),
        F.avg("duration_min").alias("avg_duration_min"),
    )
    return agg.select(
        surrogate_key("pickup_date", "pu_location_id", "payment_type").alias("daily_id"),
        "pickup_date",
        F.date_trunc("month", F.col("pickup_date")).cast("date").alias("pickup_month"),
        "pu_location_id",
        "payment_type",
        "trip_count",
        "total_passengers",
        "total_distance_mi",
        "total_fare",
        "total_tip",
        "total_revenue",
        "avg_tip_pct",
        "avg_duration_min",
        _ts(transformed_at).alias("_transformed_at"),
    )


def fct_zone_revenue_monthly(fct: DataFrame, zone_dim: DataFrame, transformed_at, months: list[dt.date] | None = None) -> DataFrame:
    """Monthly revenue per pickup zone.

    Aggregates by (month, location) first and joins the zone attributes afterwards:
    location_id is unique in the dimension, so the result equals join-then-group,
    but only one row per (month, zone) crosses the join instead of every trip.
    """
    t = month_filter(fct, months)
    agg = t.groupBy("pickup_month", "pu_location_id").agg(
        F.count("*").alias("trip_count"),
        F.sum("total_amount").alias("total_revenue"),
        F.avg("total_amount").alias("avg_revenue_per_trip"),
        F.sum("trip_distance").alias("total_distance_mi"),
        F.avg("trip_distance").alias("avg_distance_mi"),
        F.sum("tip_amount").alias("total_tips"),
        F.avg("tip_pct").alias("avg_tip_pct"),
    )
    z = bounded_broadcast(zone_dim.select("location_id", "borough", "zone_name", "service_zone"))
    j = agg.join(z, agg.pu_location_id == z.location_id, "left")
    return j.select(
        surrogate_key("pickup_month", "pu_location_id").alias("zone_month_id"),
        "pickup_month",
        "pu_location_id",
        "borough",
        "zone_name",
        "service_zone",
        "trip_count",
        "total_revenue",
        "avg_revenue_per_trip",
        "total_distance_mi",
        "avg_distance_mi",
        "total_tips",
        "avg_tip_pct",
        _ts(transformed_at).alias("_transformed_at"),
    )


def fct_tokenization_audit(fct: DataFrame, transformed_at, months: list[dt.date] | None = None) -> DataFrame:
    """Per (pickup_month, salt_version): trips, tokenised trips, coverage, distinct passengers."""
    t = month_filter(fct, months).filter(F.col("_salt_version").isNotNull())
    agg = t.groupBy("pickup_month", "_salt_version").agg(
        F.count("*").alias("total_trips"),
        F.count("passenger_email_token").alias("tokenized_count"),
        (F.count("passenger_email_token").cast("double") / F.nullif(F.count("*"), F.lit(0))).alias("token_coverage_rate"),
        F.countDistinct("passenger_id_token").alias("distinct_passengers"),
    )
    return agg.select(
        surrogate_key("pickup_month", "_salt_version").alias("audit_id"),
        "pickup_month",
        F.col("_salt_version").alias("salt_version"),
        "total_trips",
        "tokenized_count",
        "token_coverage_rate",
        "distinct_passengers",
        _ts(transformed_at).alias("_transformed_at"),
    )


def v_trips_summary(daily: DataFrame, zone_dim: DataFrame, payment_dim: DataFrame) -> DataFrame:
    """Daily facts with zone and payment labels (two broadcast LEFT joins to small dims)."""
    z = bounded_broadcast(zone_dim.select("location_id", "borough", "zone_name", "service_zone"))
    p = bounded_broadcast(payment_dim.select("payment_type_id", "payment_type_desc"))
    j = daily.join(z, daily.pu_location_id == z.location_id, "left").join(
        p, daily.payment_type == p.payment_type_id, "left"
    )
    return j.select(
        "pickup_date", "pickup_month", "borough", "zone_name", "service_zone", "payment_type_desc",
        "trip_count", "total_passengers", "total_distance_mi", "total_fare", "total_tip",
        "total_revenue", "avg_tip_pct", "avg_duration_min",
    )


def v_zone_revenue(zone_rev: DataFrame) -> DataFrame:
    return zone_rev.select(
        "pickup_month", "pu_location_id", "borough", "zone_name", "service_zone", "trip_count",
        "total_revenue", "avg_revenue_per_trip", "total_distance_mi", "avg_distance_mi",
        "total_tips", "avg_tip_pct",
    )
