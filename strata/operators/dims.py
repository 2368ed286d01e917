"""Gold dimensions: date spine, code tables, current zone dimension."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Vendor, payment type and rate code labels of the code tables.
VENDORS = [
    (1, "Creative Mobile Technologies LLC"),
    (2, "VeriFone Inc."),
]
PAYMENT_TYPES = [
    (0, "Voided trip"),
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
]
RATE_CODES = [
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
    (99, "Unknown"),
]

DATE_SPINE_START = dt.date(2018, 1, 1)
DATE_SPINE_END = dt.date(2026, 12, 31)


def _ts(value: dt.datetime | str):
    s = value.strftime("%Y-%m-%d %H:%M:%S") if isinstance(value, dt.datetime) else value
    return F.to_timestamp(F.lit(s))


def _code_table(spark: SparkSession, rows, id_col: str, desc_col: str, transformed_at) -> DataFrame:
    schema = T.StructType([T.StructField(id_col, T.IntegerType(), False), T.StructField(desc_col, T.StringType(), False)])
    return spark.createDataFrame(rows, schema).withColumn("_transformed_at", _ts(transformed_at))


def dim_vendor(spark: SparkSession, transformed_at) -> DataFrame:
    return _code_table(spark, VENDORS, "vendor_id", "vendor_name", transformed_at)


def dim_payment_type(spark: SparkSession, transformed_at) -> DataFrame:
    return _code_table(spark, PAYMENT_TYPES, "payment_type_id", "payment_type_desc", transformed_at)


def dim_rate_code(spark: SparkSession, transformed_at) -> DataFrame:
    return _code_table(spark, RATE_CODES, "rate_code_id", "rate_code_desc", transformed_at)


def date_spine(spark: SparkSession, start: dt.date | str, end: dt.date | str) -> DataFrame:
    """One row per day, inclusive; the array is built per row of a 1-row relation."""
    return spark.range(1).select(
        F.explode(F.sequence(F.to_date(F.lit(str(start))), F.to_date(F.lit(str(end))), F.expr("interval 1 day"))).alias("date_day")
    )


def dim_date(spark: SparkSession, start: dt.date | str = DATE_SPINE_START, end: dt.date | str = DATE_SPINE_END) -> DataFrame:
    return with_date_attributes(date_spine(spark, start, end), "date_day")


def with_date_attributes(df: DataFrame, col: str = "date_day") -> DataFrame:
    d = F.col(col)
    return df.select(
        d.alias("date_day"),
        F.date_format(d, "yyyyMMdd").cast("int").alias("date_key"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.weekofyear(d).alias("week_of_year"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofweek(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.date_trunc("month", d).cast("date").alias("month_start"),
        F.date_trunc("quarter", d).cast("date").alias("quarter_start"),
        F.date_trunc("year", d).cast("date").alias("year_start"),
        F.dayofweek(d).isin(1, 7).alias("is_weekend"),
    )


def dim_zone(zones: DataFrame, effective_col: str = "_transformed_at") -> DataFrame:
    """Current zone dimension with ``zone_sk = md5(location_id)``.

    ``zones`` is either the staged seed or the SCD2 snapshot; for the snapshot only
    rows with ``valid_to IS NULL`` (the current version) are used and ``valid_from``
    becomes ``effective_from``.
    """
    if "valid_to" in zones.columns:
        zones = zones.filter(F.col("valid_to").isNull())
        effective_col = "valid_from"
    return zones.select(
        "location_id",
        "zone_name",
        "borough",
        "service_zone",
        F.col(effective_col).alias("effective_from"),
        F.md5(F.col("location_id").cast("string")).alias("zone_sk"),
    )


def date_spine_for(df: DataFrame, col: str) -> DataFrame:
    """Calendar covering the dates of ``df[col]`` (first to last), one row per day."""
    b = df.agg(F.min(F.col(col).cast("date")).alias("lo"), F.max(F.col(col).cast("date")).alias("hi"))
    return b.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("date_day"))
