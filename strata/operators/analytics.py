"""Consumer queries over the gold and bronze tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def top_zones(zone_rev: DataFrame, k: int = 10, per: str = "pickup_month") -> DataFrame:
    """Top ``k`` pickup zones by revenue in each month (ties broken by location id).

    ``row_number() <= k`` is planned with a per-partition group limit before the
    shuffle, so each month sends at most ``k`` rows per task.
    """
    w = Window.partitionBy(per).orderBy(F.col("total_revenue").desc(), F.col("pu_location_id"))
    return (
        zone_rev.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
        .select(per, "rank", "pu_location_id", "zone_name", "borough", "trip_count", "total_revenue")
    )


def top_zones_in_month(zone_rev: DataFrame, month, k: int = 10) -> DataFrame:
    """The single-month form: month filter, then take-ordered (a top-k report).

    ``month`` is a date, or a one-column frame of months (semi join, size-checked).
    """
    from strata.sources.landing import month_slice

    rows = month_slice(zone_rev, month if isinstance(month, DataFrame) else [month])
    return (
        rows.orderBy(F.col("total_revenue").desc(), F.col("pu_location_id"))
        .limit(k)
        .select("pu_location_id", "zone_name", "borough", "trip_count", "total_revenue")
    )


def daily_trend(daily: DataFrame) -> DataFrame:
    """Per day over all zones and payment types; the tip mean is the plain mean of daily means."""
    return daily.groupBy("pickup_date").agg(
        F.sum("trip_count").alias("trips"),
        F.sum("total_revenue").alias("revenue"),
        F.avg("avg_tip_pct").alias("avg_tip_pct"),
    )


def daily_trend_weighted(fct: DataFrame) -> DataFrame:
    """Per day, the tip mean weighted by trips (computed from the trip grain)."""
    return fct.groupBy(F.col("pickup_at").cast("date").alias("pickup_date")).agg(
        F.count("*").alias("trips"),
        F.sum("total_amount").alias("revenue"),
        F.avg("tip_pct").alias("avg_tip_pct"),
    )


def grain_check(fct: DataFrame, key: str = "trip_id") -> DataFrame:
    """Rows vs distinct keys in one pass."""
    return fct.agg(
        F.count("*").alias("rows"),
        F.count_distinct(key).alias("distinct_keys"),
    ).withColumn("grain_ok", F.col("rows") == F.col("distinct_keys"))


def cross_year_evolution(bronze: DataFrame) -> DataFrame:
    """Per year and month: trips and the NULL-ignoring means of the two evolved columns."""
    ts = F.col("tpep_pickup_datetime")
    return bronze.groupBy(F.year(ts).alias("year"), F.month(ts).alias("month")).agg(
        F.count("*").alias("trips"),
        F.avg("congestion_surcharge").alias("avg_congestion_surcharge"),
        F.avg("airport_fee").alias("avg_airport_fee"),
    )


def bronze_sample(bronze: DataFrame, columns: list[str], n: int = 5) -> tuple[DataFrame, DataFrame]:
    """Verification read of a bronze table: (row count as a one-row frame, first ``n`` rows of
    some columns ordered by pickup time). The limit is the feature: a sample to eyeball."""
    count = bronze.agg(F.count("*").alias("rows"))
    sample = bronze.select(*columns).orderBy(*columns).limit(n)  # total order: same rows every run
    return count, sample
