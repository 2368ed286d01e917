"""Silver staging models and row-level silver helpers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.trips import month_of
from strata.schemas import MONEY, TOKEN_COLUMNS


def _ts(value: dt.datetime | str):
    s = value.strftime("%Y-%m-%d %H:%M:%S") if isinstance(value, dt.datetime) else value
    return F.to_timestamp(F.lit(s))


def month_filter(df: DataFrame, months: list[dt.date] | None, col: str = "pickup_month") -> DataFrame:
    """Restrict to some months by equality / IN on the partition column (prunes files)."""
    if not months:
        return df
    return df.filter(F.col(col).isin([F.lit(m) for m in months]))


def stg_trips(bronze: DataFrame, transformed_at: dt.datetime | str, months: list[dt.date] | None = None) -> DataFrame:
    """Snake-case trip staging; surcharges absent in old months become 0.

    ``months`` selects an incremental run; rows are filtered on a range of the raw
    pickup column so the predicate reaches the scan.
    """
    src = bronze
    if months:
        conds = None
        for m in months:
            start = dt.datetime(m.year, m.month, 1)
            nxt = dt.datetime(m.year + (m.month == 12), m.month % 12 + 1, 1)
            c = (F.col("tpep_pickup_datetime") >= F.lit(start)) & (F.col("tpep_pickup_datetime") < F.lit(nxt))
            conds = c if conds is None else conds | c
        src = src.filter(conds)
    zero = F.lit(0).cast(MONEY)
    has = set(src.columns)

    def opt(c, dtype="string"):
        return F.col(c) if c in has else F.lit(None).cast(dtype)

    return src.select(
        F.col("VendorID").alias("vendor_id"),
        F.col("tpep_pickup_datetime").alias("pickup_at"),
        F.col("tpep_dropoff_datetime").alias("dropoff_at"),
        month_of(F.col("tpep_pickup_datetime")).alias("pickup_month"),
        "passenger_count",
        "trip_distance",
        F.col("RatecodeID").alias("rate_code_id"),
        "store_and_fwd_flag",
        F.col("PULocationID").alias("pu_location_id"),
        F.col("DOLocationID").alias("do_location_id"),
        "payment_type",
        "fare_amount",
        "extra",
        "mta_tax",
        "tip_amount",
        "tolls_amount",
        "improvement_surcharge",
        "total_amount",
        F.coalesce(opt("congestion_surcharge", MONEY), zero).alias("congestion_surcharge"),
        F.coalesce(opt("airport_fee", MONEY), zero).alias("airport_fee"),
        *[opt(c).alias(c) for c in TOKEN_COLUMNS],
        opt("_salt_version", "int").alias("_salt_version"),
        opt("_ingested_at", "timestamp").alias("_ingested_at"),
        opt("_source_url").alias("_source_url"),
        opt("_source_sha256").alias("_source_sha256"),
        opt("_schema_version", "int").alias("_schema_version"),
        _ts(transformed_at).alias("_transformed_at"),
    )


def stg_zone(seed: DataFrame, transformed_at: dt.datetime | str) -> DataFrame:
    """Zone staging: cast id, snake-case names."""
    return seed.select(
        F.col("LocationID").cast("int").alias("location_id"),
        F.col("Borough").alias("borough"),
        F.col("Zone").alias("zone_name"),
        "service_zone",
        _ts(transformed_at).alias("_transformed_at"),
    )


def silver_flags(stg: DataFrame) -> DataFrame:
    """Row flags: negative fare is a dispute, zero passengers means the count is missing."""
    return stg.withColumns(
        {
            "is_dispute": F.coalesce(F.col("fare_amount") < 0, F.lit(False)),
            "passenger_count_missing": F.coalesce(F.col("passenger_count") == 0, F.lit(False)),
            "trip_duration_sec": F.unix_timestamp("dropoff_at") - F.unix_timestamp("pickup_at"),
        }
    )


def dedupe_latest(df: DataFrame, keys: list[str], order_col: str = "_ingested_at") -> DataFrame:
    """Keep one row per key: the latest by ``order_col``, ties broken by the whole row.

    Written as a grouped ``max`` of a struct, not a window: the aggregate combines
    map-side before the shuffle, so a key holding a third of all rows never lands
    in one task as raw rows. Row order of ties is deterministic.
    """
    rest = [c for c in df.columns if c not in keys and c != order_col]
    packed = F.struct(F.col(order_col).alias("__o"), *[F.col(c) for c in rest])
    out = df.groupBy(*keys).agg(F.max(packed).alias("__r"))
    return out.select(*keys, F.col("__r.__o").alias(order_col), *[F.col(f"__r.{c}").alias(c) for c in rest]).select(*df.columns)
