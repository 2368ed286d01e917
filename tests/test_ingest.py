"""Landing -> bronze cast, alignment, stamping and month routing."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import ingest
from strata.schemas import RAW_SCHEMA

SAMPLE = (2, dt.datetime(2023, 1, 15, 8, 0), dt.datetime(2023, 1, 15, 8, 20), 1.0, 2.5, 1.0, "N", 100, 200, 1,
          12.5, 0.5, 0.5, 2.0, 0.0, 0.3, 15.8, 2.5, 0.0)


def raw(spark, rows=None):
    return spark.createDataFrame(rows or [SAMPLE], RAW_SCHEMA)


def test_cast_types_and_null_survival(spark):
    row = list(SAMPLE)
    row[3] = None  # passenger_count
    row[5] = None  # RatecodeID
    row[17] = None  # congestion_surcharge
    out = ingest.cast_source_schema(raw(spark, [tuple(row), SAMPLE]))
    assert len(out.columns) == 19
    types = dict(out.dtypes)
    assert types["VendorID"] == "int" and types["fare_amount"] == "decimal(10,2)"
    r = out.orderBy(F.col("passenger_count").asc_nulls_first()).first()
    assert r.passenger_count is None and r.RatecodeID is None and r.congestion_surcharge is None
    assert str(r.fare_amount) == "12.50"


def test_cast_optional_columns_only_when_present(spark):
    df = raw(spark).drop("airport_fee", "congestion_surcharge")
    out = ingest.cast_source_schema(df)
    assert len(out.columns) == 17


def test_cast_is_case_insensitive_and_keeps_unknown_columns(spark):
    df = raw(spark).withColumnRenamed("VendorID", "vendorid").withColumn("new_col", F.lit("x"))
    out = ingest.cast_source_schema(df)
    assert "VendorID" in out.columns and out.columns[-1] == "new_col"


def test_cast_failures_counted_not_raised(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "VendorID string")
    df = df.select(*(["VendorID"] + [F.lit(None).cast(f.dataType).alias(f.name) for f in RAW_SCHEMA.fields[1:]]))
    fails = ingest.cast_failures(df).first()
    assert fails.VendorID == 1


def test_align_fills_missing_with_typed_null_and_reports_new(spark):
    target = T.StructType([T.StructField("VendorID", T.IntegerType()), T.StructField("congestion_surcharge", T.DecimalType(10, 2))])
    df = spark.createDataFrame([(1, 2.5)], "VendorID int, new_double double")
    out, added = ingest.align_schema(df, target)
    assert out.columns == ["VendorID", "congestion_surcharge", "new_double"]
    assert dict(out.dtypes)["congestion_surcharge"] == "decimal(10,2)"
    assert [f.name for f in added] == ["new_double"] and added[0].dataType == T.DoubleType()
    assert out.first().congestion_surcharge is None


def test_align_idempotent_and_noop_without_target(spark):
    target = T.StructType([T.StructField("VendorID", T.IntegerType())])
    df = spark.createDataFrame([(1,)], "vendorid int")
    once, _ = ingest.align_schema(df, target)
    twice, added = ingest.align_schema(once, target)
    assert once.columns == twice.columns == ["VendorID"] and added == []
    same, none = ingest.align_schema(df, None)
    assert same.columns == df.columns and none == []


def test_metadata_stamp_adds_five_columns(spark):
    out = ingest.bronze_from_landing(raw(spark), "run-123", "s3://x/y.parquet", "abc", "2023-01-15 02:00:00.7")
    assert len(out.columns) == 24
    r = out.first()
    assert r._run_id == "run-123" and r._schema_version == 1
    assert r._ingested_at == dt.datetime(2023, 1, 15, 2, 0, 0)


def test_month_routing_and_split(spark):
    rows = [SAMPLE, SAMPLE[:1] + (dt.datetime(2023, 2, 1, 0, 0),) + SAMPLE[2:], SAMPLE[:1] + (dt.datetime(2022, 12, 31, 23, 59),) + SAMPLE[2:]]
    keep, stray = ingest.split_out_of_month(raw(spark, rows), dt.date(2023, 1, 1))
    assert keep.count() == 1 and stray.count() == 2


def test_month_sequence_inclusive_across_year_end(spark):
    m = [r.month for r in ingest.month_sequence(spark, "2022-11", "2023-02").collect()]
    assert m == [dt.date(2022, 11, 1), dt.date(2022, 12, 1), dt.date(2023, 1, 1), dt.date(2023, 2, 1)]


def test_months_to_load_respects_force(spark):
    req = ingest.month_sequence(spark, "2023-01", "2023-03")
    loaded = spark.createDataFrame([(dt.date(2023, 2, 1),)], "month date")
    assert sorted(r.month.month for r in ingest.months_to_load(req, loaded).collect()) == [1, 3]
    assert ingest.months_to_load(req, loaded, force=True).count() == 3
