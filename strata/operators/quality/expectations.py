"""Distributional expectations evaluated in a single aggregation pass.

A suite is a list of :class:`Expectation`. :func:`evaluate_suite` compiles the whole
suite to one ``groupBy(...).agg(...)`` (optionally per group, e.g. per month) and
returns one result row per (group, expectation):

    expectation_id, expectation_type, column, kwargs, element_count, missing_count,
    unexpected_count, unexpected_percent, observed_value, success

Conventions: element checks ignore NULLs (except the not-null check) and succeed when
``unexpected / non_null <= 1 - mostly``; an empty denominator passes. Aggregate checks
compare one observed value with an inclusive range; a NULL observation fails.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.sizing import bounded_broadcast

ROW_COUNT = "expect_table_row_count_to_be_between"
MEAN = "expect_column_mean_to_be_between"
QUANTILE = "expect_column_quantile_values_to_be_between"
BETWEEN = "expect_column_values_to_be_between"
PAIR_GT = "expect_column_pair_values_A_to_be_greater_than_B"
LENGTH_EQ = "expect_column_value_lengths_to_equal"
IN_SET = "expect_column_values_to_be_in_set"
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE_PROPORTION = "expect_column_proportion_of_unique_values_to_be_between"


@dataclass(frozen=True)
class Expectation:
    type: str
    kwargs: dict = field(default_factory=dict)

    @property
    def optional(self) -> bool:
        """Whether the check may be skipped on a table without its column: the two token checks."""
        return (self.column or "").endswith("_token")

    @property
    def column(self) -> str | None:
        return self.kwargs.get("column") or self.kwargs.get("column_A")

    def columns(self) -> list[str]:
        return [c for c in (self.kwargs.get("column"), self.kwargs.get("column_A"), self.kwargs.get("column_B")) if c]

    def kwargs_json(self) -> str:
        return json.dumps(self.kwargs, sort_keys=True)


def E(type_: str, **kwargs) -> Expectation:
    return Expectation(type_, kwargs)


# The bronze trip suite as published (bounds, quantiles, mostly).
BRONZE_SUITE = [
    E(ROW_COUNT, min_value=500000, max_value=12000000),
    E(MEAN, column="fare_amount", min_value=10, max_value=30),
    E(MEAN, column="trip_distance", min_value=1, max_value=8),
    E(QUANTILE, column="trip_distance", quantile_ranges={"quantiles": [0.99], "value_ranges": [[15, 30]]}),
    E(QUANTILE, column="fare_amount", quantile_ranges={"quantiles": [0.99], "value_ranges": [[50, 150]]}),
    E(BETWEEN, column="passenger_count", min_value=0, max_value=9, mostly=0.99),
    E(PAIR_GT, column_A="tpep_dropoff_datetime", column_B="tpep_pickup_datetime", or_equal=False, mostly=0.9999),
    E(BETWEEN, column="PULocationID", min_value=1, max_value=265),
    E(BETWEEN, column="DOLocationID", min_value=1, max_value=265),
    E(LENGTH_EQ, column="passenger_email_token", value=64, mostly=0.999),
    E(LENGTH_EQ, column="passenger_id_token", value=64, mostly=0.999),
    E(IN_SET, column="payment_type", value_set=[0, 1, 2, 3, 4]),
]

# The gold trip-fact suite as published.
GOLD_SUITE = [
    E(ROW_COUNT, min_value=500000, max_value=12000000),
    E(NOT_NULL, column="trip_id"),
    E(NOT_NULL, column="pickup_at"),
    E(NOT_NULL, column="pu_location_id"),
    E(BETWEEN, column="pu_location_id", min_value=1, max_value=265, mostly=0.999),
    E(BETWEEN, column="do_location_id", min_value=1, max_value=265, mostly=0.999),
    E(MEAN, column="tip_pct", min_value=5, max_value=30),
    E(BETWEEN, column="tip_pct", min_value=0, max_value=200, mostly=0.999),
    E(BETWEEN, column="duration_min", min_value=0, max_value=600, mostly=0.999),
    E(MEAN, column="total_amount", min_value=10, max_value=50),
    E(NOT_NULL, column="_ingested_at"),
    E(NOT_NULL, column="_transformed_at"),
]

# The same checks with bounds fitted to the trip-shaped test view (its money is
# order prices and its months hold hundreds of rows, so the published bounds fail).
TESTBED_BRONZE_SUITE = [
    E(ROW_COUNT, min_value=500, max_value=12000000),
    E(MEAN, column="fare_amount", min_value=45000, max_value=60000),
    E(MEAN, column="trip_distance", min_value=20, max_value=30),
    E(QUANTILE, column="trip_distance", quantile_ranges={"quantiles": [0.99], "value_ranges": [[45, 50.5]]}),
    E(QUANTILE, column="fare_amount", quantile_ranges={"quantiles": [0.99], "value_ranges": [[90000, 110000]]}),
    E(BETWEEN, column="passenger_count", min_value=0, max_value=9, mostly=0.99),
    E(PAIR_GT, column_A="tpep_dropoff_datetime", column_B="tpep_pickup_datetime", or_equal=False, mostly=0.9),
    E(BETWEEN, column="PULocationID", min_value=1, max_value=265),
    E(BETWEEN, column="DOLocationID", min_value=1, max_value=265),
    E(LENGTH_EQ, column="passenger_email_token", value=64, mostly=0.999),
    E(LENGTH_EQ, column="passenger_id_token", value=64, mostly=0.999),
    E(IN_SET, column="payment_type", value_set=[0, 1, 2, 3, 4]),
]

TESTBED_GOLD_SUITE = [
    E(ROW_COUNT, min_value=500, max_value=12000000),
    E(NOT_NULL, column="trip_id"),
    E(NOT_NULL, column="pickup_at"),
    E(NOT_NULL, column="pu_location_id"),
    E(BETWEEN, column="pu_location_id", min_value=1, max_value=265, mostly=0.999),
    E(BETWEEN, column="do_location_id", min_value=1, max_value=265, mostly=0.999),
    E(MEAN, column="tip_pct", min_value=3, max_value=7),
    E(BETWEEN, column="tip_pct", min_value=0, max_value=200, mostly=0.999),
    E(BETWEEN, column="duration_min", min_value=0, max_value=600, mostly=0.999),
    E(MEAN, column="total_amount", min_value=45000, max_value=70000),
    E(UNIQUE_PROPORTION, column="trip_id", min_value=0.5, max_value=1.0),
    E(NOT_NULL, column="_ingested_at"),
    E(NOT_NULL, column="_transformed_at"),
]


def _between(c: Column, lo, hi) -> Column:
    cond = None
    if lo is not None:
        cond = c >= F.lit(lo)
    if hi is not None:
        cond = (c <= F.lit(hi)) if cond is None else cond & (c <= F.lit(hi))
    return cond if cond is not None else F.lit(True)


def _range_ok(obs: Column, lo, hi) -> Column:
    return F.coalesce(obs.isNotNull() & _between(obs, lo, hi), F.lit(False))


def row_check(e: Expectation) -> tuple[Column, Column]:
    """(row has nothing to check, row breaks the rule) of an element expectation."""
    k = e.kwargs
    if e.type == PAIR_GT:
        a, b = F.col(k["column_A"]), F.col(k["column_B"])
        return a.isNull() | b.isNull(), (a < b) if k.get("or_equal") else (a <= b)
    c = F.col(e.column)
    if e.type == NOT_NULL:
        return F.lit(False), c.isNull()
    if e.type == BETWEEN:
        return c.isNull(), ~_between(c, k.get("min_value"), k.get("max_value"))
    if e.type == LENGTH_EQ:
        return c.isNull(), F.length(c) != F.lit(k["value"])
    if e.type == IN_SET:
        return c.isNull(), ~c.isin(list(k["value_set"]))
    raise ValueError(f"unsupported expectation {e.type}")


def enough_good(e: Expectation, denom: Column, unexpected: Column) -> Column:
    """Whether the share of good rows reaches ``mostly``, in exact decimals; no rows to check pass."""
    good = (denom - unexpected).cast("decimal(19,0)")
    return (denom == 0) | (good >= F.lit(Decimal(str(e.kwargs.get("mostly", 1)))) * denom.cast("decimal(19,0)"))


def _compile(e: Expectation, i: int, accuracy: int) -> tuple[list[Column], Column]:
    """Aggregate expressions for one expectation, and the result struct built from them."""
    p = f"e{i}_"
    k = e.kwargs
    aggs: list[Column] = [F.count(F.lit(1)).alias(p + "n")]
    null_long = F.lit(None).cast("long")
    missing = unexpected = null_long
    observed = F.lit(None).cast("double")
    success = None
    if e.type == ROW_COUNT:
        observed = F.col(p + "n").cast("double")
        success = _range_ok(F.col(p + "n"), k.get("min_value"), k.get("max_value"))
    elif e.type == MEAN:
        aggs.append(F.avg(F.col(e.column)).cast("double").alias(p + "obs"))
        observed = F.col(p + "obs")
        success = _range_ok(observed, k.get("min_value"), k.get("max_value"))
    elif e.type == QUANTILE:
        qs = k["quantile_ranges"]["quantiles"]
        ranges = k["quantile_ranges"]["value_ranges"]
        for j, q in enumerate(qs):
            aggs.append(F.percentile_approx(F.col(e.column), q, accuracy).cast("double").alias(f"{p}q{j}"))
        observed = F.col(f"{p}q0")
        conds = [_range_ok(F.col(f"{p}q{j}"), lo, hi) for j, (lo, hi) in enumerate(ranges)]
        success = conds[0]
        for c in conds[1:]:
            success = success & c
    elif e.type == UNIQUE_PROPORTION:
        c = F.col(e.column)
        aggs += [F.count(c).alias(p + "nn"), F.count_distinct(c).alias(p + "nd")]
        observed = F.col(p + "nd").cast("double") / F.nullif(F.col(p + "nn"), F.lit(0))
        success = _range_ok(observed, k.get("min_value"), k.get("max_value"))
        missing = F.col(p + "n") - F.col(p + "nn")
    else:
        is_missing, bad = row_check(e)
        if e.type == NOT_NULL:
            aggs += [F.lit(0).cast("long").alias(p + "m"), F.count_if(bad).alias(p + "u")]
            denom = F.col(p + "n")
        else:
            aggs += [F.count_if(is_missing).alias(p + "m"), F.count_if(~is_missing & bad).alias(p + "u")]
            denom = F.col(p + "n") - F.col(p + "m")
        missing, unexpected = F.col(p + "m"), F.col(p + "u")
        observed = unexpected.cast("double") / F.nullif(denom, F.lit(0))
        success = enough_good(e, denom, unexpected)
    unexpected_pct = (
        unexpected.cast("double") / F.nullif(F.col(p + "n") - F.coalesce(missing, F.lit(0)), F.lit(0)) * F.lit(100.0)
    )
    result = F.struct(
        F.lit(i).alias("expectation_id"),
        F.lit(e.type).alias("expectation_type"),
        F.lit(e.column).cast("string").alias("column"),
        F.lit(e.kwargs_json()).alias("kwargs"),
        F.col(p + "n").alias("element_count"),
        missing.cast("long").alias("missing_count"),
        unexpected.cast("long").alias("unexpected_count"),
        unexpected_pct.alias("unexpected_percent"),
        observed.cast("double").alias("observed_value"),
        success.alias("success"),
    )
    return aggs, result


def applicable(df: DataFrame, suite: list[Expectation], skip_optional: bool = True) -> list[Expectation]:
    """Expectations to run on ``df``: all, but for optional ones (the token checks) whose columns it lacks."""
    have = set(df.columns)
    return [e for e in suite if not (skip_optional and e.optional) or all(c in have for c in e.columns())]


def _absent(e: Expectation, i: int) -> tuple[list[Column], Column]:
    """The failing result of an expectation whose columns are not there."""
    n = F.col(f"e{i}_n")
    none = F.lit(None).cast("long")
    return [F.count(F.lit(1)).alias(f"e{i}_n")], F.struct(
        F.lit(i).alias("expectation_id"), F.lit(e.type).alias("expectation_type"),
        F.lit(e.column).cast("string").alias("column"), F.lit(e.kwargs_json()).alias("kwargs"),
        n.alias("element_count"), none.alias("missing_count"), none.alias("unexpected_count"),
        F.lit(None).cast("double").alias("unexpected_percent"), F.lit(None).cast("double").alias("observed_value"),
        F.lit(False).alias("success"),
    )


def evaluate_suite(
    df: DataFrame,
    suite: list[Expectation],
    group_by: list[str] | None = None,
    accuracy: int = 10000,
    skip_optional: bool = True,
) -> DataFrame:
    """All expectations of ``suite`` over ``df`` (per group) from one aggregation.

    Quantiles use ``percentile_approx`` (bounded-memory sketch, mergeable map-side),
    so a group holding a third of all rows still aggregates in constant memory. An absent
    column fails its check; only optional checks are skipped, and none with ``skip_optional``
    off (a table that must have its tokens).
    """
    group_by = group_by or []
    aggs: list[Column] = []
    results: list[Column] = []
    have = set(df.columns)
    for i, e in enumerate(applicable(df, suite, skip_optional)):
        a, r = _compile(e, i, accuracy) if have.issuperset(e.columns()) else _absent(e, i)
        aggs.extend(a)  # repeated count(1) terms are merged by the planner
        results.append(r)
    stats = df.groupBy(*group_by).agg(*aggs)
    return stats.select(*group_by, F.explode(F.array(*results)).alias("r")).select(*group_by, "r.*")


def gate_verdict(results: DataFrame, group_by: list[str] | None = None, suite_name: str = "suite") -> DataFrame:
    """Per group: expectations run, passed, pass rate, sorted list of failures, verdict."""
    group_by = group_by or []
    failed_name = F.when(
        ~F.col("success"),
        F.concat(F.col("expectation_type"), F.lit(":"), F.coalesce(F.col("column"), F.lit("table"))),
    )
    return results.groupBy(*group_by).agg(
        F.lit(suite_name).alias("suite_name"),
        F.count("*").alias("evaluated"),
        F.count_if(F.col("success")).alias("passed"),
        (F.count_if(F.col("success")).cast("double") / F.count("*")).alias("pass_rate"),
        F.array_sort(F.collect_list(failed_name)).alias("failed_expectations"),
        F.array_sort(F.collect_list(F.when(~F.col("success"), F.col("kwargs")))).alias("failed_kwargs"),
        F.bool_and(F.col("success")).alias("success"),
    )


def route(df: DataFrame, verdict: DataFrame, group_by: list[str]) -> tuple[DataFrame, DataFrame]:
    """Split rows into (passing groups, quarantined groups) as data flow, no driver branch.

    The verdict has one row per group (e.g. per month), so it is broadcast after a
    size check; rows of groups without a verdict are quarantined.
    """
    v = bounded_broadcast(
        verdict.select(*group_by, F.col("success").alias("__gate_ok"), "failed_expectations", "failed_kwargs"),
        materialize=True,
    )
    j = df.join(v, group_by, "left")
    ok = F.coalesce(F.col("__gate_ok"), F.lit(False))
    passed = j.filter(ok).drop("__gate_ok", "failed_expectations", "failed_kwargs")
    failed = j.filter(~ok).drop("__gate_ok")
    return passed, failed
