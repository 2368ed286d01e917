"""Mergeable profile and gate state: one stored row per month and column, or month and expectation.

A month is read once, when it is loaded. What its rows leave behind is additive: counts, least and
greatest values, exact decimal sums, a KLL sketch for quantiles and an HLL sketch for distinct
values. The profile or the gate of any range of months is an aggregation of those stored rows, which
are as many as months and columns; the months themselves are not read again, and a month that is
loaded anew replaces its own rows only.

Quantiles of merged sketches are within RANK_ERROR of the asked rank: with KLL_K items a sketch's
error is 0.0044 at 99 % confidence, merged or not, and the declared bound is more than twice that.
Distinct counts have a relative standard error of 1.6 %; DISTINCT_ERROR is over three of those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.operators.quality import expectations as X
from strata.ops.profile import NUMERIC

KLL_K, HLL_K = 1024, 12
RANK_ERROR, DISTINCT_ERROR = 0.01, 0.05
QUANTILES = (0.5, 0.95, 0.99)
_SUM = "decimal(38,6)"


def _quantiles(c: Column) -> Column:
    return F.kll_sketch_agg_double(c.cast("double"), KLL_K)


def _distinct(c: Column) -> Column:
    return F.hll_sketch_agg(c.cast("string"), HLL_K)


def profile_state(df: DataFrame, columns: list[str], group_by: list[str]) -> DataFrame:
    """(group, column_name, rows, nulls, least, greatest, total, quantiles, distinct), one aggregation.

    least and greatest are strings of the values; of numbers they are also kept as doubles, which
    is what ranges are merged by. total, quantiles and the doubles are null for other columns.
    """
    numeric = {f.name: isinstance(f.dataType, NUMERIC) for f in df.schema.fields}
    aggs, rows = [F.count(F.lit(1)).alias("n")], []
    for i, name in enumerate(columns):
        c = F.col(name)
        aggs += [F.count(c).alias(f"v{i}"), F.min(c).alias(f"lo{i}"), F.max(c).alias(f"hi{i}"), _distinct(c).alias(f"d{i}")]
        if numeric[name]:
            aggs += [F.sum(c.cast("decimal(28,6)")).cast(_SUM).alias(f"s{i}"), _quantiles(c).alias(f"q{i}")]
        number = lambda x, i=i, name=name: (F.col(f"{x}{i}").cast("double") if numeric[name] else F.lit(None).cast("double"))
        rows.append(F.struct(
            F.lit(name).alias("column_name"),
            F.col("n").alias("rows"),
            (F.col("n") - F.col(f"v{i}")).alias("nulls"),
            F.col(f"lo{i}").cast("string").alias("least"),
            F.col(f"hi{i}").cast("string").alias("greatest"),
            number("lo").alias("least_number"),
            number("hi").alias("greatest_number"),
            (F.col(f"s{i}") if numeric[name] else F.lit(None).cast(_SUM)).alias("total"),
            (F.col(f"q{i}") if numeric[name] else F.lit(None).cast("binary")).alias("quantiles"),
            F.col(f"d{i}").alias("distinct_values"),
        ))
    return df.groupBy(*group_by).agg(*aggs).select(*group_by, F.inline(F.array(*rows)))


def merge_profile(state: DataFrame, group_by: list[str]) -> DataFrame:
    """Profile rows of any grouping of stored ``profile_state`` rows; reads nothing else."""
    number = F.col("least_number").isNotNull()
    merged = state.groupBy(*group_by, "column_name").agg(
        F.sum("rows").alias("rows"),
        F.sum("nulls").alias("nulls"),
        # Numbers by value, with the string that the value was stored as; other columns by string.
        F.coalesce(F.min_by(F.when(number, F.col("least")), "least_number"), F.min("least")).alias("min_value"),
        F.coalesce(F.max_by(F.when(number, F.col("greatest")), "greatest_number"), F.max("greatest")).alias("max_value"),
        F.sum("total").cast(_SUM).alias("total"),
        F.kll_merge_agg_double("quantiles", KLL_K).alias("q"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct_values")).alias("approx_distinct"),
    )
    values = F.col("rows") - F.col("nulls")
    # An empty sketch has no quantiles; a column without values gets none.
    at = lambda p: F.when((values > 0) & F.col("total").isNotNull(), F.kll_sketch_get_quantile_double("q", F.lit(p)))
    return merged.select(
        *group_by, "column_name", "rows", "nulls", "min_value", "max_value", "total",
        (F.col("total") / F.nullif(values, F.lit(0))).cast("double").alias("mean"), "approx_distinct",
        *(at(p).alias(f"p{round(100 * p)}") for p in QUANTILES),
    )


def suite_state(df: DataFrame, suite: list[X.Expectation], group_by: list[str]) -> DataFrame:
    """(group, expectation_id, rows, missing, unexpected, total, quantiles, distinct) of a suite, one aggregation.

    Expectations whose columns are absent have null in ``missing`` and so fail when merged.
    """
    aggs, rows = [F.count(F.lit(1)).alias("n")], []
    have = set(df.columns)
    for i, e in enumerate(suite):
        cell: dict[str, Column] = {}
        if not have.issuperset(e.columns()):
            pass
        elif e.type == X.ROW_COUNT:
            cell["missing"] = F.lit(0)
        elif e.type in (X.MEAN, X.QUANTILE, X.UNIQUE_PROPORTION):
            c = F.col(e.column)
            aggs.append((F.count(F.lit(1)) - F.count(c)).alias(f"m{i}"))
            cell["missing"] = F.col(f"m{i}")
            kind, of = {
                X.MEAN: ("total", F.sum(c.cast("decimal(28,6)")).cast(_SUM)), X.QUANTILE: ("quantiles", _quantiles(c)),
            }.get(e.type, ("distinct_values", _distinct(c)))
            aggs.append(of.alias(f"x{i}"))
            cell[kind] = F.col(f"x{i}")
        else:
            missing, bad = X.row_check(e)
            aggs += [F.count_if(missing).alias(f"m{i}"), F.count_if(~missing & bad).alias(f"u{i}")]
            cell |= {"missing": F.col(f"m{i}"), "unexpected": F.col(f"u{i}")}
        types = {"missing": "long", "unexpected": "long", "total": _SUM, "quantiles": "binary", "distinct_values": "binary"}
        rows.append(F.struct(
            F.lit(i).alias("expectation_id"), F.col("n").alias("rows"),
            *(cell.get(c, F.lit(None)).cast(t).alias(c) for c, t in types.items()),
        ))
    return df.groupBy(*group_by).agg(*aggs).select(*group_by, F.inline(F.array(*rows)))


def merge_suite(state: DataFrame, suite: list[X.Expectation], group_by: list[str]) -> DataFrame:
    """Results of ``suite`` for any grouping of stored ``suite_state`` rows; reads nothing else."""
    merged = state.groupBy(*group_by, "expectation_id").agg(
        F.sum("rows").alias("element_count"),
        F.when(F.count("missing") == F.count(F.lit(1)), F.sum("missing")).alias("missing_count"),
        F.sum("unexpected").alias("unexpected_count"),
        F.sum("total").cast(_SUM).alias("total"),
        F.kll_merge_agg_double("quantiles", KLL_K).alias("q"),
        F.hll_union_agg("distinct_values").alias("d"),
    )
    values = F.col("element_count") - F.col("missing_count")
    observed, success = F.lit(None).cast("double"), F.lit(False)
    for i, e in enumerate(suite):
        k = e.kwargs
        if e.type == X.ROW_COUNT:
            seen = F.col("element_count").cast("double")
            ok = X._range_ok(F.col("element_count"), k.get("min_value"), k.get("max_value"))
        elif e.type == X.MEAN:
            seen = (F.col("total") / F.nullif(values, F.lit(0))).cast("double")
            ok = X._range_ok(seen, k.get("min_value"), k.get("max_value"))
        elif e.type == X.QUANTILE:
            asked, ranges = k["quantile_ranges"]["quantiles"], k["quantile_ranges"]["value_ranges"]
            found = [F.when(values > 0, F.kll_sketch_get_quantile_double("q", F.lit(float(p)))) for p in asked]
            seen, ok = found[0], F.lit(True)
            for q, (lo, hi) in zip(found, ranges, strict=True):
                ok = ok & X._range_ok(q, lo, hi)
        elif e.type == X.UNIQUE_PROPORTION:
            seen = F.least(F.hll_sketch_estimate("d") / F.nullif(values, F.lit(0)), F.lit(1.0))
            ok = X._range_ok(seen, k.get("min_value"), k.get("max_value"))
        else:
            seen = F.col("unexpected_count").cast("double") / F.nullif(values, F.lit(0))
            ok = X.enough_good(e, values, F.col("unexpected_count"))
        here = (F.col("expectation_id") == i) & F.col("missing_count").isNotNull()
        observed, success = F.when(here, seen).otherwise(observed), F.when(here, ok).otherwise(success)
    names = F.array(*(F.lit(e.type) for e in suite))
    columns = F.array(*(F.lit(e.column).cast("string") for e in suite))
    return merged.select(
        *group_by, "expectation_id", F.get(names, F.col("expectation_id")).alias("expectation_type"),
        F.get(columns, F.col("expectation_id")).alias("column"), "element_count", "missing_count", "unexpected_count",
        observed.alias("observed_value"), success.alias("success"),
    )


def rank_of(df: DataFrame, estimates: DataFrame, column: str, group_by: list[str]) -> DataFrame:
    """(group, rows, below, upto): exact ranks in ``df`` of one estimate per group, to judge a sketch by."""
    j = df.join(F.broadcast(estimates), group_by)  # one row a group
    c = F.col(column).cast("double")
    return j.groupBy(*group_by).agg(
        F.count(c).alias("values"), F.count_if(c < F.col("estimate")).alias("below"), F.count_if(c <= F.col("estimate")).alias("upto")
    )
