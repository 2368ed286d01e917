"""Landing -> bronze: typed cast, schema alignment, ingestion stamp, month routing."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.trips import month_of
from strata.schemas import MANDATORY_SOURCE_COLUMNS, SOURCE_TYPES


def _by_lower(columns: list[str]) -> dict[str, str]:
    return {c.lower(): c for c in columns}


def cast_source_schema(df: DataFrame, strict: bool = True) -> DataFrame:
    """Cast the landed columns to bronze types in one projection.

    Source names are matched case-insensitively and renamed to the canonical form.
    Optional columns are cast only when present; columns the layout does not know
    pass through unchanged so that alignment can report them. ``try_cast`` turns
    unparseable / overflowing values into NULL instead of failing the job
    (count them with :func:`cast_failures`).
    """
    present = _by_lower(df.columns)
    missing = [c for c in MANDATORY_SOURCE_COLUMNS if c.lower() not in present]
    if missing and strict:
        raise ValueError(f"landed file lacks mandatory columns: {missing}")
    known = []
    for name, dtype in SOURCE_TYPES.items():
        src = present.get(name.lower())
        if src is None:
            if name in MANDATORY_SOURCE_COLUMNS:
                known.append(F.lit(None).cast(dtype).alias(name))
            continue
        known.append(F.col(f"`{src}`").try_cast(dtype).alias(name))
    known_lower = {n.lower() for n in SOURCE_TYPES}
    extra = [F.col(f"`{c}`") for c in df.columns if c.lower() not in known_lower]
    return df.select(*known, *extra)


def cast_failures(df: DataFrame) -> DataFrame:
    """One row: per source column, how many non-NULL values the bronze cast nulls out."""
    present = _by_lower(df.columns)
    aggs = []
    for name, dtype in SOURCE_TYPES.items():
        src = present.get(name.lower())
        if src is None:
            continue
        c = F.col(f"`{src}`")
        aggs.append(F.count_if(c.isNotNull() & c.try_cast(dtype).isNull()).alias(name))
    return df.agg(*aggs)


def align_schema(df: DataFrame, target: T.StructType | None) -> tuple[DataFrame, list[T.StructField]]:
    """Align ``df`` to a target table schema (additive evolution).

    Returns the aligned frame (target columns first, in target order, missing ones as
    typed NULL, other types cast; then new columns in source order) and the list of new fields the
    target must gain, with their real types. Names compare case-insensitively. With
    no target (the table does not exist yet) the frame is returned unchanged.
    Applying it twice gives the same result as once.
    """
    if target is None:
        return df, []
    present = _by_lower(df.columns)
    target_lower = {f.name.lower() for f in target.fields}
    cols: list[Column] = []
    for f in target.fields:
        src = present.get(f.name.lower())
        if src is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        elif df.schema[src].dataType == f.dataType:
            cols.append(F.col(f"`{src}`").alias(f.name))
        else:  # a drifted type: the stored type wins, values it cannot hold become NULL
            cols.append(F.col(f"`{src}`").try_cast(f.dataType).alias(f.name))
    added = [f for f in df.schema.fields if f.name.lower() not in target_lower]
    cols.extend(F.col(f"`{f.name}`") for f in added)
    return df.select(*cols), added


def evolve_schema(target: T.StructType, added: list[T.StructField]) -> T.StructType:
    """Target schema after adding new fields (nullable, real types)."""
    return T.StructType(list(target.fields) + [T.StructField(f.name, f.dataType, True) for f in added])


def add_ingestion_metadata(
    df: DataFrame,
    run_id: str,
    source_url: str | Column,
    source_sha256: str | Column,
    ingested_at: dt.datetime | str,
    schema_version: int = 1,
) -> DataFrame:
    """Stamp run id, source URL/sha256, ingestion time (second precision) and schema version."""
    def lit_or_col(v):
        return v if isinstance(v, Column) else F.lit(v)

    ts = ingested_at.strftime("%Y-%m-%d %H:%M:%S") if isinstance(ingested_at, dt.datetime) else ingested_at
    return df.withColumns(
        {
            "_run_id": F.lit(run_id).cast("string"),
            "_source_url": lit_or_col(source_url).cast("string"),
            "_source_sha256": lit_or_col(source_sha256).cast("string"),
            "_ingested_at": F.date_trunc("second", F.to_timestamp(F.lit(ts))),
            "_schema_version": F.lit(schema_version).cast("int"),
        }
    )


def with_pickup_month(df: DataFrame, ts_col: str = "tpep_pickup_datetime") -> DataFrame:
    return df.withColumn("pickup_month", month_of(F.col(ts_col)))


def route_out_of_month(df: DataFrame, month: dt.date, ts_col: str = "tpep_pickup_datetime") -> DataFrame:
    """Add ``_route``: 'in_month' for rows whose pickup lies in ``month``, else 'late_or_early'.

    The bounds are literals on the raw column, so a downstream filter on ``_route``
    is a pushed-down range predicate.
    """
    start = dt.datetime(month.year, month.month, 1)
    nxt = dt.datetime(month.year + (month.month == 12), month.month % 12 + 1, 1)
    ts = F.col(ts_col)
    inside = (ts >= F.lit(start)) & (ts < F.lit(nxt))
    return df.withColumn("_route", F.when(inside, "in_month").otherwise("late_or_early"))


def split_out_of_month(df: DataFrame, month: dt.date, ts_col: str = "tpep_pickup_datetime") -> tuple[DataFrame, DataFrame]:
    """(rows of the target month, stray rows) from one plan."""
    routed = route_out_of_month(df, month, ts_col)
    keep = routed.filter(F.col("_route") == "in_month").drop("_route")
    stray = routed.filter(F.col("_route") == "late_or_early")
    return keep, stray


def month_sequence(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Months from ``start`` to ``end`` inclusive ('YYYY-MM'), one row each, as DATE."""
    return spark.range(1).select(
        F.explode(
            F.sequence(
                F.to_date(F.lit(start + "-01")),
                F.to_date(F.lit(end + "-01")),
                F.expr("interval 1 month"),
            )
        ).alias("month")
    )


def months_to_load(requested: DataFrame, loaded: DataFrame, force: bool = False, col: str = "month") -> DataFrame:
    """Requested months minus those already loaded, unless ``force``."""
    if force:
        return requested.select(col).distinct()
    done = loaded.select(F.col(col)).distinct()
    return requested.select(col).distinct().join(done, col, "left_anti")


def bronze_from_landing(
    raw: DataFrame,
    run_id: str,
    source_url: str | Column,
    source_sha256: str | Column,
    ingested_at: dt.datetime | str,
    schema_version: int = 1,
    target: T.StructType | None = None,
) -> DataFrame:
    """cast -> align -> stamp (tokens are added by the privacy step)."""
    casted = cast_source_schema(raw)
    aligned, _ = align_schema(casted, target)
    return add_ingestion_metadata(aligned, run_id, source_url, source_sha256, ingested_at, schema_version)


def month_range(df: DataFrame, col: str = "pickup_month", extra_months: int = 0) -> DataFrame:
    """All months from the first to the last month present in ``df`` (plus ``extra_months``).

    The bounds are one global aggregate (partial per task); the sequence is exploded
    from that single row, so nothing reaches the driver.
    """
    b = df.agg(F.min(col).alias("lo"), F.max(col).alias("hi"))
    return b.select(
        F.explode(F.sequence(F.col("lo"), F.add_months(F.col("hi"), extra_months), F.expr("interval 1 month"))).alias("month")
    )


def route_by_file_month(df: DataFrame, file_month: Column, ts_col: str = "tpep_pickup_datetime") -> DataFrame:
    """Route each row against the month of the file it arrived in (a per-row month)."""
    inside = month_of(F.col(ts_col)) == file_month
    return df.withColumn("_file_month", file_month).withColumn(
        "_route", F.when(inside, "in_month").otherwise("late_or_early")
    )
