"""CSV seed load, landing reads and the bronze verification sample."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from strata.operators.analytics import bronze_sample
from strata.plans.monthly import land_months
from strata.sinks.writers import replace
from strata.sources import testbed
from strata.sources.landing import landing_path, read_landing, read_seed_csv

SF = "/root/testdata/sf0.001"


def test_seed_csv_load_and_replace(spark, tmp_dir):
    seed = testbed.zone_seed(spark, SF)
    csv = os.path.join(tmp_dir, "seed")
    seed.coalesce(1).write.option("header", True).csv(csv)
    got = read_seed_csv(spark, csv)
    assert got.count() == 25 and dict(got.dtypes)["LocationID"] == "int"
    n = replace(got, os.path.join(tmp_dir, "zones"))
    assert n == 25 and replace(got, os.path.join(tmp_dir, "zones")) == 25
    assert spark.read.parquet(os.path.join(tmp_dir, "zones")).count() == 25


def test_seed_csv_fails_fast_on_malformed_rows(spark, tmp_dir):
    path = os.path.join(tmp_dir, "bad.csv")
    with open(path, "w") as f:
        f.write("LocationID,Borough,Zone,service_zone\n1,Queens,Jamaica Bay,Boro Zone\nnot_an_int,X,Y,Z\n")
    with pytest.raises(Exception):
        read_seed_csv(spark, path).collect()


def test_landing_paths_and_month_read(spark, tmp_dir):
    assert landing_path("/l", 2023, 1) == "/l/year=2023/month=01"
    raw = testbed.trips_raw(spark, SF).filter(F.year("tpep_pickup_datetime") == 1997)
    root = os.path.join(tmp_dir, "landing")
    land_months(raw, root, F.date_trunc("month", "tpep_pickup_datetime").cast("date"))
    jan = read_landing(spark, root, [dt.date(1997, 1, 1)])
    assert jan.count() == raw.filter(F.month("tpep_pickup_datetime") == 1).count()
    assert jan.select("_source_file").first()[0].endswith(".parquet")


def test_bronze_sample(spark):
    from strata.plans.models import TripModels

    b = TripModels.from_testbed(spark, SF).bronze_untokenized
    count, sample = bronze_sample(b, ["VendorID", "tpep_pickup_datetime", "fare_amount"], 5)
    assert count.first().rows == 6000 and sample.count() == 5
