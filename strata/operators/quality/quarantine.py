"""Quarantine: whole failing months, or only failing rows with the rule they broke."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.operators.quality.expectations import (
    BETWEEN,
    IN_SET,
    LENGTH_EQ,
    NOT_NULL,
    PAIR_GT,
    Expectation,
    _between,
    applicable,
)
from strata.sizing import bounded_broadcast


def quarantine_month(
    df: DataFrame,
    verdict: DataFrame,
    run_id: str,
    group_by: list[str],
) -> DataFrame:
    """Every row of the groups (months) whose gate failed, with reason, kwargs and run id.

    ``verdict`` comes from :func:`gate_verdict`; it has one row per group, so it is
    broadcast after a size check.
    """
    failed = verdict.filter(~F.col("success")).select(
        *group_by,
        F.array_join(F.col("failed_expectations"), ";").alias("_failure_reason"),
        F.to_json(F.col("failed_kwargs")).alias("_expectation_kwargs"),
    )
    out = df.join(bounded_broadcast(failed, materialize=True), group_by, "inner")
    return out.withColumn("_quarantine_run_id", F.lit(run_id))


def _row_rule(e: Expectation):
    """Violation condition on one row for element-level expectations (None otherwise)."""
    k = e.kwargs
    if e.type == PAIR_GT:
        a, b = F.col(k["column_A"]), F.col(k["column_B"])
        bad = (a < b) if k.get("or_equal") else (a <= b)
        return a.isNotNull() & b.isNotNull() & bad
    if e.type not in (NOT_NULL, BETWEEN, LENGTH_EQ, IN_SET):
        return None
    c = F.col(e.column)
    if e.type == NOT_NULL:
        return c.isNull()
    if e.type == BETWEEN:
        return c.isNotNull() & ~_between(c, k.get("min_value"), k.get("max_value"))
    if e.type == LENGTH_EQ:
        return c.isNotNull() & (F.length(c) != F.lit(k["value"]))
    if e.type == IN_SET:
        return c.isNotNull() & ~c.isin(list(k["value_set"]))
    return None


def quarantine_rows(df: DataFrame, suite: list[Expectation], run_id: str) -> DataFrame:
    """One row per (input row, element rule it breaks), with the rule name and kwargs.

    Rows that break nothing are dropped by a filter on the array size before the
    explode, so the work is a single narrow pass.
    """
    rules = []
    for e in applicable(df, suite):
        cond = _row_rule(e)
        if cond is None:
            continue
        name = f"{e.type}:{e.column}"
        rules.append(F.when(cond, F.struct(F.lit(name).alias("n"), F.lit(e.kwargs_json()).alias("k"))))
    hits = F.filter(F.array(*rules), lambda x: x.isNotNull())
    cols = [c for c in df.columns]
    return (
        df.withColumn("__hits", hits)
        .filter(F.size("__hits") > 0)
        .select(*cols, F.explode("__hits").alias("__h"))
        .select(
            *cols,
            F.col("__h.n").alias("_failure_reason"),
            F.col("__h.k").alias("_expectation_kwargs"),
            F.lit(run_id).alias("_quarantine_run_id"),
        )
    )
