"""Scale properties of the physical plans, guarded against regressions."""

import datetime as dt
import os
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from strata.operators import ingest
from strata.plans.models import TripModels
from strata.sources.landing import month_slice

SF = "/root/testdata/sf0.001"
RED = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_flagship_prunes_tokens_and_columns(spark):
    p = plan(E.queries()["fct_zone_revenue_monthly"](spark, SF))
    assert "sha2" not in p and "md5(concat(pid" not in p  # no token or PII work
    li = re.search(r"FileScan parquet \[(l_[^\]]*)\]", p).group(1)
    assert "l_shipdate" not in li and "l_returnflag" not in li
    assert "SortMergeJoin [l_orderkey" in p
    assert re.search(r"HashAggregate\(keys=\[pickup_month.*pu_location_id", p)  # aggregate below the zone join


def test_month_filter_prunes_partitions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "bronze")
    b = ingest.with_pickup_month(TripModels.from_testbed(spark, SF).bronze_untokenized)
    b.write.partitionBy("pickup_month").parquet(path)
    stored = spark.read.parquet(path)
    p = plan(month_slice(stored, [dt.date(1996, 1, 1)]))
    assert re.search(r"PartitionFilters: \[[^\]]*pickup_month", p)
    assert month_slice(stored, [dt.date(1996, 1, 1)]).select("pickup_month").distinct().count() == 1


@pytest.mark.parametrize("name", ["fct_trips", "v_trips_summary", "ge_bronze_suite", "quarantine_rows", "structural_tests",
                                  "kl_divergence", "zone_coverage", "dedupe_latest", "top_zones", "scd2_point_in_time",
                                  "audit_log", "column_profile"])
def test_no_python_or_cartesian_operators(spark, name):
    p = plan(E.queries()[name](spark, SF))
    assert not [r for r in RED if r in p]


def test_grouped_dedupe_combines_before_the_shuffle(spark):
    p = plan(E.queries()["dedupe_latest"](spark, SF))
    assert "Window" not in p
    assert p.count("SortAggregate") >= 2 or p.count("ObjectHashAggregate") >= 2  # partial + final
