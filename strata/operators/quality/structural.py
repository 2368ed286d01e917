"""Structural tests (not_null, unique, accepted_values, relationships, accepted_range,
expression_is_true) as Spark aggregations returning result tables."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators.quality.expectations import _between
from strata.sizing import bounded_broadcast, fits

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("test", T.StringType()),
        T.StructField("column", T.StringType()),
        T.StructField("failures", T.LongType()),
        T.StructField("passed", T.BooleanType()),
    ]
)


@dataclass(frozen=True)
class Test:
    kind: str  # not_null | unique | accepted_values | relationships | accepted_range | expression_is_true
    column: str
    args: dict = field(default_factory=dict)


def not_null(c):
    return Test("not_null", c)


def unique(c):
    return Test("unique", c)


def accepted_values(c, values):
    return Test("accepted_values", c, {"values": list(values)})


def accepted_range(c, lo=None, hi=None):
    return Test("accepted_range", c, {"min_value": lo, "max_value": hi})


def relationships(c, to: str, field_: str):
    return Test("relationships", c, {"to": to, "field": field_})


def expression_is_true(name: str, expr: str):
    return Test("expression_is_true", name, {"expression": expr})


# Declared tests of the silver and gold models (column, test, arguments).
STG_TRIPS_TESTS = [
    not_null("vendor_id"), accepted_values("vendor_id", [1, 2]),
    not_null("pickup_at"), not_null("dropoff_at"), not_null("pickup_month"),
    not_null("pu_location_id"), accepted_range("pu_location_id", 1, 265),
    not_null("do_location_id"), accepted_range("do_location_id", 1, 265),
    accepted_values("payment_type", [0, 1, 2, 3, 4]),
    not_null("congestion_surcharge"), not_null("airport_fee"),
    not_null("_ingested_at"), not_null("_transformed_at"),
]
STG_ZONE_TESTS = [
    not_null("location_id"), unique("location_id"),
    not_null("borough"),
    accepted_values("borough", ["Manhattan", "Brooklyn", "Queens", "Bronx", "Staten Island", "EWR"]),
    not_null("zone_name"), not_null("service_zone"),
]
FCT_TRIPS_TESTS = [
    not_null("trip_id"), unique("trip_id"),
    not_null("vendor_id"), relationships("vendor_id", "dim_vendor", "vendor_id"),
    relationships("payment_type", "dim_payment_type", "payment_type_id"),
    relationships("rate_code_id", "dim_rate_code", "rate_code_id"),
    not_null("pu_location_id"), not_null("do_location_id"),
    not_null("_ingested_at"), not_null("_transformed_at"),
]
FCT_DAILY_TESTS = [not_null("daily_id"), unique("daily_id"), not_null("pickup_date"), not_null("trip_count")]
FCT_ZONE_REVENUE_TESTS = [
    not_null("zone_month_id"), unique("zone_month_id"), not_null("pickup_month"),
    not_null("pu_location_id"), not_null("trip_count"),
]
FCT_TOKEN_AUDIT_TESTS = [not_null("audit_id"), unique("audit_id"), not_null("salt_version")]
DIM_PAYMENT_TYPE_TESTS = [not_null("payment_type_id"), unique("payment_type_id"), not_null("payment_type_desc")]
DIM_RATE_CODE_TESTS = [not_null("rate_code_id"), unique("rate_code_id"), not_null("rate_code_desc")]
DIM_VENDOR_TESTS = [not_null("vendor_id"), unique("vendor_id"), not_null("vendor_name")]
DIM_ZONE_TESTS = [
    not_null("location_id"), unique("location_id"), not_null("zone_sk"), unique("zone_sk"),
    not_null("zone_name"), not_null("borough"),
]
DIM_DATE_TESTS = [
    not_null("date_day"), unique("date_day"), not_null("date_key"), unique("date_key"),
    not_null("year"), not_null("is_weekend"),
]
ZONE_SNAPSHOT_TESTS = [not_null("location_id"), not_null("scd_id"), unique("scd_id"), not_null("valid_from")]

# Not declared, but what every version interval must satisfy.
ZONE_SNAPSHOT_ORDER = expression_is_true("valid_to", "valid_to IS NULL OR valid_to > valid_from")


def _row_conditions(df: DataFrame, tests: list[Test], dims: dict[str, DataFrame] | None,
                    broadcast_rows: int) -> tuple[DataFrame, list[tuple[Test, object]], list[Test]]:
    """Per-row failure conditions for not_null / accepted_* / expression / relationship tests.

    Each relationship's dimension keys are attached by a broadcast LEFT join (after a
    size check), so an orphan is a row with a key and no match. Relationships to
    dimensions too large to broadcast are returned for the anti-join path.
    """
    conds, deferred = [], []
    base = df
    for i, t in enumerate(tests):
        if t.kind == "relationships":
            d = dims[t.args["to"]].select(F.col(t.args["field"]).alias(f"__fk{i}")).distinct()
            if not fits(d, broadcast_rows):
                deferred.append(t)
                continue
            base = base.join(F.broadcast(d), F.col(t.column) == F.col(f"__fk{i}"), "left")
    for i, t in enumerate(tests):
        c = F.col(t.column) if t.kind != "expression_is_true" else None
        if t.kind == "not_null":
            bad = c.isNull()
        elif t.kind == "accepted_values":
            bad = c.isNotNull() & ~c.isin(t.args["values"])
        elif t.kind == "accepted_range":
            bad = c.isNotNull() & ~_between(c, t.args.get("min_value"), t.args.get("max_value"))
        elif t.kind == "expression_is_true":
            bad = ~F.coalesce(F.expr(t.args["expression"]), F.lit(False))
        elif t.kind == "relationships" and t not in deferred:
            bad = c.isNotNull() & F.col(f"__fk{i}").isNull()
        else:
            continue
        conds.append((t, bad))
    return base, conds, deferred


def _result(model: str, t: Test, failures) -> object:
    return F.struct(F.lit(model).alias("model"), F.lit(t.kind).alias("test"), F.lit(t.column).alias("column"),
                    failures.cast("long").alias("failures"))


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys (non-NULL) that occur more than once, with their counts.

    The count is a map-side-combined aggregate, so a key with a third of all rows
    costs one partial count per task, not a third of the rows in one task.
    """
    cond = None
    for k in keys:
        cond = F.col(k).isNotNull() if cond is None else cond & F.col(k).isNotNull()
    return df.filter(cond).groupBy(*keys).agg(F.count("*").alias("occurrences")).filter(F.col("occurrences") > 1)


def fk_violations(df: DataFrame, column: str, dim: DataFrame, field_: str) -> DataFrame:
    """Rows whose non-NULL foreign key has no match in the dimension (anti join; the
    dimension keys are broadcast after a size check, else the join shuffles)."""
    d = bounded_broadcast(dim.select(F.col(field_).alias("__k")).distinct())
    return df.filter(F.col(column).isNotNull()).join(d, F.col(column) == F.col("__k"), "left_anti")


def run_structural_tests(
    spark: SparkSession,
    df: DataFrame,
    model: str,
    tests: list[Test],
    dims: dict[str, DataFrame] | None = None,
    broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """Result table (model, test, column, failures, passed) for a model's tests, in one pass.

    Without a unique test all row-level and relationship checks are one global
    aggregation. With one, rows are first aggregated per key (map-side combined, so a
    hot key is one partial row per task) carrying the per-key failure counts; a second,
    tiny aggregation then yields both the duplicate-key count and the row-check totals.
    Further unique tests and relationships to dimensions too large to broadcast add
    their own grouped pass.
    """
    base, conds, deferred = _row_conditions(df, tests, dims, broadcast_rows)
    uniques = [t for t in tests if t.kind == "unique"]
    parts = []
    if uniques:
        key = uniques[0].column
        per_key = base.groupBy(key).agg(
            F.count(F.lit(1)).alias("__n"), *[F.count_if(bad).alias(f"__b{j}") for j, (_, bad) in enumerate(conds)]
        )
        results = [_result(model, uniques[0], F.count_if(F.col(key).isNotNull() & (F.col("__n") > 1)))]
        results += [_result(model, t, F.coalesce(F.sum(f"__b{j}"), F.lit(0))) for j, (t, _) in enumerate(conds)]
        parts.append(per_key.agg(F.array(*results).alias("r")))
        extra_uniques = uniques[1:]
    else:
        if conds:
            parts.append(base.agg(F.array(*[_result(model, t, F.count_if(bad)) for t, bad in conds]).alias("r")))
        extra_uniques = []
    for t in extra_uniques:
        dup = duplicate_keys(df, [t.column]).agg(F.array(_result(model, t, F.count("*"))).alias("r"))
        parts.append(dup)
    for t in deferred:
        orphans = fk_violations(df, t.column, dims[t.args["to"]], t.args["field"])
        parts.append(orphans.agg(F.array(_result(model, t, F.count("*"))).alias("r")))
    if not parts:
        return spark.createDataFrame([], RESULT_SCHEMA)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.explode("r").alias("r")).select("r.*").withColumn("passed", F.col("failures") == 0)
