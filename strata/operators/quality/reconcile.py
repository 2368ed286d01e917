"""Reconciliation checks between layers: counts, date completeness, zone coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.sizing import bounded_broadcast


def reconcile_counts(
    detail: DataFrame,
    summary: DataFrame,
    key: str = "pickup_month",
    summary_count: str = "trip_count",
    tolerance: float = 0.0,
) -> DataFrame:
    """Per key: rows in the detail table vs the summed counts of the aggregate table.

    Both sides are reduced to one row per key before the full outer join.
    """
    d = detail.groupBy(key).agg(F.count("*").alias("detail_rows"))
    s = summary.groupBy(key).agg(F.sum(summary_count).cast("long").alias("summary_rows"))
    j = d.join(s, key, "full_outer").select(
        key, F.coalesce("detail_rows", F.lit(0)).alias("detail_rows"), F.coalesce("summary_rows", F.lit(0)).alias("summary_rows")
    )
    diff = F.abs(F.col("detail_rows") - F.col("summary_rows"))
    return j.withColumn("abs_diff", diff).withColumn(
        "within_tolerance", diff <= F.col("detail_rows") * F.lit(tolerance)
    )


def missing_dates(calendar: DataFrame, facts: DataFrame, date_col: str = "pickup_date", cal_col: str = "date_day") -> DataFrame:
    """Calendar dates with no fact row (anti join against the distinct fact dates)."""
    present = facts.select(F.col(date_col).alias(cal_col)).distinct()
    return calendar.join(present, cal_col, "left_anti")


def zone_coverage(
    facts: DataFrame,
    zone_dim: DataFrame,
    month_col: str = "pickup_month",
    tip_range: tuple[float, float] = (0.0, 50.0),
) -> DataFrame:
    """Per month: active zones, zones with trips, zones without trips, and two sanity counts.

    Trips are first reduced to (month, zone); the zone dimension is broadcast after a
    size check; the dimension size is a scalar subquery.
    """
    zones = bounded_broadcast(zone_dim.select(F.col("location_id").alias("pu_location_id")).distinct())
    per_zone = facts.groupBy(month_col, "pu_location_id").agg(
        F.count_if((F.col("tip_pct") < tip_range[0]) | (F.col("tip_pct") > tip_range[1])).alias("tip_out"),
        F.count_if(F.col("total_amount") <= 0).alias("non_positive"),
    )
    covered = per_zone.join(zones, "pu_location_id", "left_semi")
    monthly = per_zone.groupBy(month_col).agg(
        F.sum("tip_out").alias("tip_pct_out_of_range"), F.sum("non_positive").alias("non_positive_revenue")
    )
    cov = covered.groupBy(month_col).agg(F.count("*").alias("zones_with_trips"))
    out = monthly.join(cov, month_col, "left").withColumn("active_zones", zones.agg(F.count("*")).scalar())
    zwt = F.coalesce(F.col("zones_with_trips"), F.lit(0))
    return out.select(
        month_col,
        "active_zones",
        zwt.alias("zones_with_trips"),
        (F.col("active_zones") - zwt).alias("zones_without_trips"),
        F.col("tip_pct_out_of_range").cast("long").alias("tip_pct_out_of_range"),
        F.col("non_positive_revenue").cast("long").alias("non_positive_revenue"),
    )
