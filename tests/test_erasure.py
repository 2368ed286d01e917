"""Targeted erasure: gone from every table, other months untouched, resumed after any step."""

import datetime as dt
import hashlib
import os

import pytest
from pyspark.sql import functions as F

from strata.operators import subjects
from strata.plans import erasure
from strata.plans.models import TripModels
from strata.plans.monthly import Tables
from strata.plans.q_history import stored_tables
from strata.sources import testbed
from tests.conftest import SF0001

MONTHS = [dt.date(1995, m, 1) for m in (1, 2, 3, 4)]


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """A function that makes a fresh copy of four stored months."""
    raw = testbed.trips_raw(spark, SF0001).where(F.trunc("tpep_pickup_datetime", "month").isin(MONTHS))
    m = TripModels(spark, raw, testbed.zone_seed(spark, SF0001))
    first = str(tmp_path_factory.mktemp("tables") / "t")
    stored_tables(m, Tables(first))

    def copy(name):
        import shutil

        at = str(tmp_path_factory.mktemp(name) / "t")
        shutil.copytree(first, at)
        return Tables(at)

    return copy


def files(root):
    return {
        os.path.relpath(os.path.join(d, f), root): hashlib.md5(open(os.path.join(d, f), "rb").read()).hexdigest()
        for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")
    }


def asked(spark, tables, months):
    lookup = spark.read.parquet(tables.pii_lookup).where(F.col("pickup_month").isin(months))
    return sorted(r.passenger_id for r in lookup.select("passenger_id").collect())[::5]


def state(spark, tables):
    """What every table holds, without file names."""
    out = {}
    for name in ("pii_lookup", "bronze", "stg_trips", "fct_trips", "fct_tokenization_audit", "pii_filters"):
        df = spark.read.parquet(getattr(tables, name))
        out[name] = sorted(map(str, df.select(*sorted(df.columns)).collect()))
    return out


def test_filters_name_every_month_of_a_subject(spark, loaded):
    tables = loaded("filters")
    filters, lookup = spark.read.parquet(tables.pii_filters), spark.read.parquet(tables.pii_lookup)
    some = asked(spark, tables, MONTHS)
    got = {(r.pickup_month, r.subjects) for r in subjects.months_of(filters, spark.createDataFrame([(s,) for s in [*some, "nobody", None]], "passenger_id string")).collect()}
    exact = lookup.where(F.col("passenger_id").isin(some)).groupBy("pickup_month").count().collect()
    assert {m for m, _ in got} >= {r.pickup_month for r in exact}
    assert all(dict(got)[r.pickup_month] >= r["count"] for r in exact)
    none = subjects.months_of(filters, spark.createDataFrame([(f"stranger {i}",) for i in range(200)], "passenger_id string"))
    assert sum(r.subjects for r in none.collect()) <= 5  # of 800 questions
    assert subjects.months_of(filters.limit(0), spark.createDataFrame([("x",)], "passenger_id string")).count() == 0


def test_erased_subjects_are_gone_and_other_months_untouched(spark, loaded):
    tables = loaded("erase")
    before, gone = files(tables.root), asked(spark, tables, MONTHS[1:2])
    old = {r.passenger_id_token for r in spark.read.parquet(tables.fct_trips).where(F.col("pickup_month") == F.lit(MONTHS[1])).collect()}
    requested = spark.createDataFrame([(g,) for g in gone], "passenger_id string")
    assert erasure.erase(spark, tables, "r1", requested, "salt two", 2, "2024-03-01 00:00:00") == MONTHS[1:2]
    after = files(tables.root)
    touched = f"pickup_month={MONTHS[1]}"
    same = lambda fs: {k: v for k, v in fs.items() if touched not in k and not k.startswith("erasure_ledger")}
    assert same(before) == same(after)
    assert not {k for k in before if touched in k and k in after}
    assert spark.read.parquet(tables.pii_lookup).where(F.col("passenger_id").isin(gone)).count() == 0
    for name in ("bronze", "stg_trips", "fct_trips"):
        month = spark.read.parquet(getattr(tables, name)).where(F.col("pickup_month") == F.lit(MONTHS[1]))
        tokens = {r.passenger_id_token for r in month.collect()}
        assert None in tokens and not tokens & (old - {None})
        assert {r._salt_version for r in month.select("_salt_version").distinct().collect()} == {2}
    left = subjects.months_of(spark.read.parquet(tables.pii_filters), requested).collect()
    assert sum(r.subjects for r in left) <= 1


@pytest.mark.parametrize("stop", [("bronze", 1), ("filter", 0)])
def test_a_killed_run_is_resumed(spark, loaded, stop):
    whole, broken = loaded("whole"), loaded("broken")
    gone = spark.createDataFrame([(g,) for g in asked(spark, whole, [MONTHS[0], MONTHS[2]])], "passenger_id string")
    args = (gone, "salt two", 2, "2024-03-01 00:00:00")
    months = erasure.erase(spark, whole, "r", *args)
    assert months == [MONTHS[0], MONTHS[2]]

    def kill(month, step):
        if (step, months.index(month)) == stop:
            raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        erasure.erase(spark, broken, "r", *args, after_step=kill)
    assert erasure.erase(spark, broken, "r", *args) == months
    assert state(spark, broken) == state(spark, whole)
    steps = [(r.month, r.step) for r in erasure.ledger(spark, broken, "r").collect()]
    assert len(steps) == len(set(steps)) == 1 + len(months) * (1 + len(erasure.STEPS))
    kept = files(broken.root)
    assert erasure.erase(spark, broken, "r", *args) == months and files(broken.root) == kept  # done: nothing is written


def test_rotation_of_all_months(spark, loaded):
    tables = loaded("rotate")
    lookup = sorted(map(str, spark.read.parquet(tables.pii_lookup).collect()))
    old = {r[0] for r in spark.read.parquet(tables.fct_trips).select("passenger_id_token").distinct().collect()}
    assert erasure.rotate(spark, tables, "s", "salt three", 3, "2024-03-01 00:00:00") == MONTHS
    fct = spark.read.parquet(tables.fct_trips)
    assert not old & {r[0] for r in fct.select("passenger_id_token").distinct().collect()}
    assert fct.where("_salt_version <> 3 OR passenger_id_token IS NULL").count() == 0
    assert sorted(map(str, spark.read.parquet(tables.pii_lookup).collect())) == lookup
