"""Drift and history-based checks: KL divergence, unique proportion, rolling bounds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Additive smoothing for zero-probability categories; both sides are renormalised after it.
KL_EPSILON = 1e-9


def category_distribution(df: DataFrame, column: str, group_by: list[str] | None = None) -> DataFrame:
    """Counts and shares per category (per group). Partial aggregation makes hot categories cheap."""
    g = group_by or []
    counts = df.groupBy(*g, column).agg(F.count("*").alias("n"))
    if not g:
        out = counts.withColumn("__total", counts.agg(F.sum("n")).scalar())
    else:
        out = counts.join(counts.groupBy(*g).agg(F.sum("n").alias("__total")), g)
    return out.withColumn("share", F.col("n") / F.col("__total")).drop("__total")


def kl_divergence(current: DataFrame, reference: DataFrame, column: str, epsilon: float = KL_EPSILON) -> DataFrame:
    """KL(current || reference) of a categorical column, one row.

    Both sides are reduced to one row per category before the full outer join, so the
    join and the final sum touch only as many rows as there are categories. The totals
    are scalar subqueries (computed once, used as values; no single-task window).
    """
    cur = current.groupBy(column).agg(F.count("*").alias("nc"))
    ref = reference.groupBy(column).agg(F.count("*").alias("nr"))
    j = cur.join(ref, column, "full_outer").select(
        column, F.coalesce("nc", F.lit(0)).alias("nc"), F.coalesce("nr", F.lit(0)).alias("nr")
    )
    tc, tr, k = (j.agg(a).scalar() for a in (F.sum("nc"), F.sum("nr"), F.count("*")))
    norm = F.lit(1.0) + k * F.lit(epsilon)
    p = (F.coalesce(F.col("nc") / F.nullif(tc, F.lit(0)), F.lit(0.0)) + F.lit(epsilon)) / norm
    q = (F.coalesce(F.col("nr") / F.nullif(tr, F.lit(0)), F.lit(0.0)) + F.lit(epsilon)) / norm
    terms = j.select(column, (p * F.log(p / q)).alias("term"))
    return terms.agg(
        F.sum("term").alias("kl_divergence"),
        F.count("*").alias("categories"),
    )


def unique_proportion(df: DataFrame, column: str, group_by: list[str] | None = None) -> DataFrame:
    """Distinct non-NULL values over non-NULL values (per group)."""
    c = F.col(column)
    return df.groupBy(*(group_by or [])).agg(
        F.count(c).alias("non_null"),
        F.count_distinct(c).alias("distinct_values"),
        (F.count_distinct(c) / F.nullif(F.count(c), F.lit(0))).alias("unique_proportion"),
    )


def rolling_bounds(
    series: DataFrame,
    order_col: str,
    value_col: str,
    partition_by: list[str] | None = None,
    history: int = 14,
    sigmas: float = 2.0,
    min_history: int = 3,
    bootstrap: tuple[float, float] = (500000.0, 12000000.0),
) -> DataFrame:
    """Bounds from the mean +/- ``sigmas`` stddev of the previous ``history`` periods.

    Until ``min_history`` earlier periods exist the fixed ``bootstrap`` bounds apply.
    ``series`` is already one row per period (e.g. monthly counts), so the window
    sorts only periods, never raw rows.
    """
    pb = partition_by or []
    w = (Window.partitionBy(*pb) if pb else Window.partitionBy(F.lit(0))).orderBy(order_col).rowsBetween(-history, -1)
    v = F.col(value_col).cast("double")
    hist_n = F.count(v).over(w)
    mean = F.avg(v).over(w)
    sd = F.stddev_samp(v).over(w)
    enough = hist_n >= F.lit(min_history)
    lower = F.when(enough, mean - F.lit(sigmas) * sd).otherwise(F.lit(bootstrap[0]))
    upper = F.when(enough, mean + F.lit(sigmas) * sd).otherwise(F.lit(bootstrap[1]))
    out = series.select(*pb, order_col, value_col, hist_n.alias("history_periods"), lower.alias("lower_bound"),
                        upper.alias("upper_bound"))
    return out.withColumn("in_bounds", (v >= F.col("lower_bound")) & (v <= F.col("upper_bound")))
