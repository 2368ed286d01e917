"""SCD2 snapshot cases: first load, unchanged re-run, changes, NULL -> value, deletes, returns."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators import scd2

CHECK = ["borough", "zone_name", "service_zone"]
SCHEMA = "location_id int, borough string, zone_name string, service_zone string"


def src(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_scd2_lifecycle(spark):
    v1 = src(spark, [(1, "Q", "A", "Boro"), (2, "M", None, "Yellow"), (3, "B", "C", "Boro")])
    h1 = scd2.scd2_merge(None, v1, "location_id", CHECK, "2020-01-01 00:00:00")
    assert h1.count() == 3 and h1.filter(F.col("valid_to").isNull()).count() == 3
    same = scd2.scd2_merge(h1, v1, "location_id", CHECK, "2020-02-01 00:00:00")
    assert same.count() == 3  # unchanged source adds nothing
    v2 = src(spark, [(1, "Q", "A2", "Boro"), (2, "M", "Mid", "Yellow")])  # rename, NULL->value, 3 deleted
    h2 = scd2.scd2_merge(h1, v2, "location_id", CHECK, "2020-03-01 00:00:00")
    rows = h2.collect()
    assert len(rows) == 5
    closed = {r.location_id for r in rows if r.valid_to is not None}
    assert closed == {1, 2, 3}
    assert scd2.current_row_violations(h2, "location_id").count() == 0
    v3 = src(spark, [(1, "Q", "A2", "Boro"), (2, "M", "Mid", "Yellow"), (3, "B", "C", "Boro")])
    h3 = scd2.scd2_merge(h2, v3, "location_id", CHECK, "2020-04-01 00:00:00")
    cur3 = h3.filter((F.col("location_id") == 3) & F.col("valid_to").isNull()).collect()
    assert len(cur3) == 1 and cur3[0].valid_from == dt.datetime(2020, 4, 1)
    assert h3.select("scd_id").distinct().count() == h3.count()


def test_point_in_time_lookup(spark):
    v1 = src(spark, [(1, "Q", "A", "Boro")])
    h = scd2.scd2_merge(None, v1, "location_id", CHECK, "2020-01-01 00:00:00")
    h = scd2.scd2_merge(h, src(spark, [(1, "Q", "B", "Boro")]), "location_id", CHECK, "2020-06-01 00:00:00")
    facts = spark.createDataFrame([(1, dt.datetime(2020, 3, 1)), (1, dt.datetime(2020, 7, 1)), (1, dt.datetime(2019, 1, 1))],
                                  "loc int, at timestamp")
    out = {r.at.month: r.dim_zone_name for r in scd2.point_in_time(facts, h, "loc", "location_id", "at", ["zone_name"]).collect()}
    assert out == {3: "A", 7: "B", 1: None}
