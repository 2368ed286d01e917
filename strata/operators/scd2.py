"""Type-2 slowly changing dimension: merge, point-in-time lookup, current-row check."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.sizing import bounded_broadcast

SCD_COLUMNS = ("scd_id", "updated_at", "valid_from", "valid_to")


def _ts(value: dt.datetime | str) -> Column:
    s = value.strftime("%Y-%m-%d %H:%M:%S") if isinstance(value, dt.datetime) else value
    return F.to_timestamp(F.lit(s))


def scd2_merge(
    history: DataFrame | None,
    source: DataFrame,
    key: str,
    check_cols: list[str],
    as_of: dt.datetime | str,
) -> DataFrame:
    """New snapshot history after comparing the source with the current rows.

    - key only in the source (first load, new key, or a deleted key that returns): insert
    - key in both, some check column differs (NULL-safe): close the current row, insert
    - key only in the current rows (hard delete): close the current row
    - otherwise: unchanged (a re-run with the same source adds nothing)

    ``as_of`` is a parameter, so a re-run is reproducible. Closed rows of the history
    pass through untouched. A key that the source repeats counts once (greatest values);
    :func:`duplicate_source_keys` reports it. Rows are matched with one full outer join on the key.
    """
    now = _ts(as_of)
    # One row a key: of several, the one with the greatest values, so a re-run picks the same.
    src = source.groupBy(key).agg(F.max(F.struct(*check_cols)).alias("__v")).select(key, *[F.col(f"__v.{x}").alias(x) for x in check_cols])
    if history is None:
        return _versions(src, key, check_cols, now)
    closed = history.filter(F.col("valid_to").isNotNull())
    current = history.filter(F.col("valid_to").isNull())
    c = current.select(key, *[F.col(x).alias(f"__c_{x}") for x in check_cols], *SCD_COLUMNS)
    s = src.select(key, *[F.col(x).alias(f"__s_{x}") for x in check_cols], F.lit(True).alias("__in_src"))
    j = c.join(s, key, "full_outer")
    in_cur = F.col("scd_id").isNotNull()
    in_src = F.coalesce(F.col("__in_src"), F.lit(False))
    same = F.lit(True)
    for x in check_cols:
        same = same & F.col(f"__c_{x}").eqNullSafe(F.col(f"__s_{x}"))
    j = j.withColumn("__action", F.when(in_cur & in_src & same, "same")
                     .when(in_cur & in_src, "changed")
                     .when(in_cur, "deleted")
                     .otherwise("new"))
    kept = j.filter(F.col("__action") == "same").select(
        key, *[F.col(f"__c_{x}").alias(x) for x in check_cols], *SCD_COLUMNS
    )
    closing = j.filter(F.col("__action").isin("changed", "deleted")).select(
        key, *[F.col(f"__c_{x}").alias(x) for x in check_cols],
        "scd_id", "updated_at", "valid_from", now.alias("valid_to"),
    )
    inserts = _versions(
        j.filter(F.col("__action").isin("changed", "new")).select(key, *[F.col(f"__s_{x}").alias(x) for x in check_cols]),
        key, check_cols, now,
    )
    cols = [key, *check_cols, *SCD_COLUMNS]
    return closed.select(*cols).unionByName(kept).unionByName(closing).unionByName(inserts)


def duplicate_source_keys(source: DataFrame, key: str) -> DataFrame:
    """(key, rows) of keys that the source has more than once: a failed check of the snapshot."""
    return source.groupBy(key).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def snapshot_id(key: Column, updated_at: Column) -> Column:
    """Snapshot row id: md5 of the '|'-joined string forms, NULL as '' (snapshot convention)."""
    return F.md5(F.concat_ws("|", F.coalesce(key.cast("string"), F.lit("")), F.coalesce(updated_at.cast("string"), F.lit(""))))


def _versions(rows: DataFrame, key: str, check_cols: list[str], now: Column) -> DataFrame:
    return rows.select(
        key, *check_cols,
        snapshot_id(F.col(key), now).alias("scd_id"),
        now.alias("updated_at"),
        now.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
    )


def point_in_time(
    facts: DataFrame,
    history: DataFrame,
    fact_key: str,
    dim_key: str,
    at: str,
    dim_cols: list[str],
    broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """Attach the dimension version valid at ``facts[at]``: valid_from <= t < valid_to (NULL = open).

    Equi join on the key plus a range condition; the history is broadcast after a size
    check, else the join shuffles on the key and filters the range per key.
    """
    h = history.select(
        F.col(dim_key).alias("__dk"), "valid_from", "valid_to", *[F.col(c).alias(f"dim_{c}") for c in dim_cols]
    )
    h = bounded_broadcast(h, broadcast_rows)
    t = F.col(at)
    cond = (F.col(fact_key) == F.col("__dk")) & (t >= F.col("valid_from")) & (F.col("valid_to").isNull() | (t < F.col("valid_to")))
    return facts.join(h, cond, "left").drop("__dk")


def current_row_violations(history: DataFrame, key: str) -> DataFrame:
    """Keys that do not have exactly one current row (0 for fully closed keys is allowed)."""
    cur = history.filter(F.col("valid_to").isNull()).groupBy(key).agg(F.count("*").alias("current_rows"))
    return cur.filter(F.col("current_rows") != 1)
