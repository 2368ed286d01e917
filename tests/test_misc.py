"""Remaining library helpers: calendar, incremental staging, manifest sidecar, telemetry, split writes."""

import datetime as dt
import glob
import json
import os

from pyspark.sql import functions as F

from strata.operators import analytics, dims, silver
from strata.ops.files import table_file_telemetry
from strata.plans.models import TripModels
from strata.sinks.writers import write_split
from strata.sources.landing import read_manifest

SF = "/root/testdata/sf0.001"


def test_default_calendar(spark):
    d = dims.dim_date(spark)
    assert d.count() == 3287
    r = d.filter(F.col("date_day") == dt.date(2023, 1, 1)).first()
    assert (r.date_key, r.day_of_week, r.day_name, r.is_weekend, r.week_of_year) == (20230101, 1, "Sunday", True, 52)
    assert r.quarter_start == dt.date(2023, 1, 1) and r.month_name == "January"


def test_incremental_staging_filters_months(spark):
    m = TripModels.from_testbed(spark, SF)
    jan = dt.date(1996, 1, 1)
    stg = silver.stg_trips(m.bronze, "2024-01-01 00:00:00", [jan])
    months = {r.pickup_month for r in stg.select("pickup_month").distinct().collect()}
    assert months == {jan}
    assert stg.count() == m.stg_trips.filter(F.col("pickup_month") == jan).count()


def test_top_zones_for_a_literal_month(spark):
    zr = TripModels.from_testbed(spark, SF).fct_zone_revenue_monthly
    jan = dt.date(1996, 1, 1)
    top = analytics.top_zones_in_month(zr, jan, 3).collect()
    want = zr.filter(F.col("pickup_month") == jan).orderBy(F.desc("total_revenue"), "pu_location_id").limit(3).collect()
    assert [r.pu_location_id for r in top] == [r.pu_location_id for r in want]


def test_manifest_sidecar_is_read_with_schema(spark, tmp_dir):
    path = os.path.join(tmp_dir, "_manifest.json")
    rec = {"url": "https://x/y.parquet", "sha256": "ab" * 32, "byte_size": 10, "row_count": 3,
           "ingested_at": "2023-01-15T02:00:00+00:00"}
    with open(path, "w") as f:
        json.dump(rec, f, indent=2)
    r = read_manifest(spark, path).first()
    assert r.asDict() == rec


def test_partition_file_telemetry(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    spark.range(3000).select((F.col("id") % 2).alias("p"), "id").repartition(3).write.partitionBy("p").parquet(path)
    tel = {r.p: r for r in table_file_telemetry(spark.read.parquet(path), "p").collect()}
    for p in (0, 1):
        sizes = [os.path.getsize(f) for f in glob.glob(os.path.join(path, f"p={p}", "*.parquet"))]
        assert (tel[p].files, tel[p].total_bytes, tel[p].max_bytes) == (len(sizes), sum(sizes), max(sizes))


def test_split_write_routes_rows(spark, tmp_dir):
    df = spark.createDataFrame([(dt.date(2023, 1, 1), "in_month", 1), (dt.date(2023, 2, 1), "late_or_early", 2)],
                               "pickup_month date, _route string, v int")
    a, b = os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "b")
    write_split(df, "_route", {"in_month": a, "late_or_early": b}, "pickup_month")
    assert [r.v for r in spark.read.parquet(a).collect()] == [1]
    assert [r.v for r in spark.read.parquet(b).collect()] == [2]
