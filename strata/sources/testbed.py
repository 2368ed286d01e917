"""Trip-shaped views over the shared test tables.

There are no taxi files in the test data, so the landed trip file is derived from
lineitem x orders x customer x supplier, and the zone seed from nation x region.
Every column is a native expression, so the derived frame scales with the tables.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.schemas import AUDIT_SCHEMA, RAW_FIELDS, RAW_SCHEMA  # noqa: F401
from strata.sizing import bounded_broadcast

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Declared schemas of the tables the trip view reads: a read with a schema skips the
# footer-inference job that a bare ``read.parquet`` starts.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = os.path.join(sf_dir, f"{name}.parquet")
    if name in SCHEMAS:
        return spark.read.schema(SCHEMAS[name]).parquet(path)
    return spark.read.parquet(path)


def trips_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed-file schema (19 columns) built from the order tables."""
    return trips_from_lineitem(spark, sf_dir, table(spark, sf_dir, "lineitem"))


def trips_from_lineitem(spark: SparkSession, sf_dir: str, lineitem: DataFrame) -> DataFrame:
    """Trip rows for a (possibly streaming) line-item frame, joined to the static tables."""
    li = lineitem.select(
        "l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_shipdate",
    )
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    # Customers meet the orders, not the line items, so a shuffle by customer moves an order once
    # and no line item; suppliers are broadcast after a size check. Line items and orders are both
    # fact-sized: a sort-merge join on the order key (the plan they get at any scale) is the one
    # shuffle of the line items, and spreads the work after it even when a file is one row group.
    o = o.join(c, o.o_custkey == c.c_custkey).select("o_orderkey", "o_orderdate", "o_orderpriority", "c_nationkey")
    j = li.join(o.hint("merge"), li.l_orderkey == o.o_orderkey).join(bounded_broadcast(s), F.col("l_suppkey") == s.s_suppkey)
    pickup = F.col("o_orderdate").cast("timestamp")
    # Money is kept in whole cents, like real fares: products are computed in exact
    # decimal arithmetic and rounded half-up to cents before landing as DOUBLE.
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    tip_c = F.round(price * F.col("l_discount").cast("decimal(4,2)"), 2)
    tax_c = F.round(price * F.col("l_tax").cast("decimal(4,2)"), 2)
    fare = price.cast("double")
    tip = tip_c.cast("double")
    tax = tax_c.cast("double")
    total = (price + tip_c + tax_c).cast("double")
    cols = {
        "VendorID": (F.col("l_linenumber") % 2 + 1).cast("long"),
        "tpep_pickup_datetime": pickup,
        "tpep_dropoff_datetime": F.col("l_shipdate").cast("timestamp"),
        "passenger_count": F.col("l_linenumber").cast("double"),
        "trip_distance": F.col("l_quantity"),
        "RatecodeID": F.col("l_linenumber").cast("double"),
        "store_and_fwd_flag": F.col("l_returnflag"),
        "PULocationID": (F.col("s_nationkey") + 1).cast("long"),
        "DOLocationID": (F.col("c_nationkey") + 1).cast("long"),
        "payment_type": (F.substring("o_orderpriority", 1, 1).cast("long") - 1),
        "fare_amount": fare,
        "extra": F.lit(0.0),
        "mta_tax": tax,
        "tip_amount": tip,
        "tolls_amount": F.lit(0.0),
        "improvement_surcharge": F.lit(0.0),
        "total_amount": total,
        "congestion_surcharge": F.when(F.year(pickup) >= 1997, F.lit(2.5)).cast("double"),
        "airport_fee": F.when(F.year(pickup) >= 1999, F.lit(1.25)).cast("double"),
    }
    return j.select(*[cols[n].cast(t).alias(n) for n, t in RAW_FIELDS])


def zone_seed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone seed (LocationID, Borough, Zone, service_zone) from nation x region."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return n.join(r, n.n_regionkey == r.r_regionkey, "left").select(
        (F.col("n_nationkey") + 1).cast("int").alias("LocationID"),
        F.col("r_name").alias("Borough"),
        F.col("n_name").alias("Zone"),
        F.col("r_name").alias("service_zone"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def simulated_audit(
    month_counts: DataFrame,
    bronze_verdict: DataFrame,
    gold_verdict: DataFrame,
    dag_id: str = "monthly_trip_load",
) -> DataFrame:
    """Made-up audit rows of one monthly run per month, with times that follow from row counts.

    The test tables hold no run history; the metrics over a long one are tested on this. Rows of real
    runs come from :mod:`strata.ops.steps`.

    ``month_counts``: (pickup_month, rows) of the landed data; ``*_verdict``: per-month
    :func:`gate_verdict` frames. Each run starts two hours into the month after the data
    month; task durations grow with the rows. Three tasks per run:
    bronze load (SUCCESS), bronze gate (SUCCESS or QUARANTINED, rows quarantined when it
    fails) and gold gate (SUCCESS or FAILED, only when the bronze gate passed).
    """
    m = month_counts.alias("m")
    b = bronze_verdict.select("pickup_month", F.col("pass_rate").alias("b_rate"),
                              F.col("failed_expectations").alias("b_failed"), F.col("success").alias("b_ok"),
                              F.col("suite_name").alias("b_suite"))
    g = gold_verdict.select("pickup_month", F.col("pass_rate").alias("g_rate"),
                            F.col("failed_expectations").alias("g_failed"), F.col("success").alias("g_ok"),
                            F.col("suite_name").alias("g_suite"))
    j = m.join(b, "pickup_month", "left").join(g, "pickup_month", "left")
    start = F.to_timestamp(F.add_months(F.col("pickup_month"), 1)) + F.expr("INTERVAL 2 HOURS")
    run_id = F.concat(F.lit("run-"), F.date_format("pickup_month", "yyyyMM"))
    # durations in microseconds: load 30 s + 10 ms per row, gates 10 s + 1 ms per row
    d_load = F.lit(30_000_000) + F.col("rows") * F.lit(10_000)
    d_gate = F.lit(10_000_000) + F.col("rows") * F.lit(1_000)
    t1 = F.timestamp_micros(F.unix_micros(start) + d_load)
    t2 = F.timestamp_micros(F.unix_micros(t1) + d_gate)
    t3 = F.timestamp_micros(F.unix_micros(t2) + d_gate)
    b_ok = F.coalesce(F.col("b_ok"), F.lit(False))
    g_ok = F.coalesce(F.col("g_ok"), F.lit(False))
    empty = F.array().cast("array<string>")

    def row(task, layer, table, rows_in, rows_out, quarantined, suite, rate, failed, s, f, status, err):
        return F.struct(
            run_id.alias("run_id"), F.lit(dag_id).alias("dag_id"), F.lit(task).alias("task_id"),
            F.lit(layer).alias("layer"), F.lit(table).alias("table_name"), F.lit("testbed://lineitem").alias("source_url"),
            F.lit("").alias("source_sha256"), F.lit(1).alias("schema_version"),
            rows_in.cast("long").alias("rows_in"), rows_out.cast("long").alias("rows_out"),
            quarantined.cast("long").alias("rows_quarantined"), suite.cast("string").alias("ge_suite_name"),
            rate.cast("double").alias("ge_pass_rate"), failed.alias("ge_failed_expectations"),
            s.alias("started_at"), f.alias("finished_at"),
            ((F.unix_micros(f) - F.unix_micros(s)).cast("double") / F.lit(1e6)).alias("duration_sec"),
            status.alias("status"), err.cast("string").alias("error_message"), F.lit("scheduled").alias("triggered_by"),
        )

    n = F.col("rows")
    zero = F.lit(0)
    rows = [
        row("landing_to_bronze", "bronze", "bronze.trips", n, n, zero, F.lit(""), F.lit(1.0), empty,
            start, t1, F.lit("SUCCESS"), F.lit(None)),
        row("ge_bronze", "bronze", "bronze.trips", n, F.when(b_ok, n).otherwise(zero),
            F.when(b_ok, zero).otherwise(n), F.col("b_suite"), F.col("b_rate"), F.coalesce(F.col("b_failed"), empty),
            t1, t2, F.when(b_ok, "SUCCESS").otherwise("QUARANTINED"), F.lit(None)),
        F.when(b_ok, row("ge_gold", "gold", "gold.fct_trips", n, n, zero, F.col("g_suite"), F.col("g_rate"),
                         F.coalesce(F.col("g_failed"), empty), t2, t3,
                         F.when(g_ok, "SUCCESS").otherwise("FAILED"),
                         F.when(~g_ok, F.substring(F.array_join(F.col("g_failed"), ";"), 1, 500)))),
    ]
    out = j.select(F.explode(F.filter(F.array(*rows), lambda x: x.isNotNull())).alias("r")).select("r.*")
    return out.toDF(*AUDIT_SCHEMA.fieldNames())
