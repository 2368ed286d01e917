"""Drift and reconciliation operators against hand computations."""

import datetime as dt
import math

from pyspark.sql import functions as F

from strata.operators.quality import drift, reconcile


def test_kl_divergence_matches_formula_with_smoothing(spark):
    cur = spark.createDataFrame([("a",)] * 3 + [("b",)], "c string")
    ref = spark.createDataFrame([("a",)] * 1 + [("b",)] * 1 + [("z",)] * 2, "c string")
    got = drift.kl_divergence(cur, ref, "c").first()
    eps, k = 1e-9, 3
    pc = {"a": 0.75, "b": 0.25, "z": 0.0}
    pr = {"a": 0.25, "b": 0.25, "z": 0.5}
    want = 0.0
    for c in pc:
        p = (pc[c] + eps) / (1 + k * eps)
        q = (pr[c] + eps) / (1 + k * eps)
        want += p * math.log(p / q)
    assert got.categories == 3 and abs(got.kl_divergence - want) < 1e-12
    same = drift.kl_divergence(cur, cur, "c").first()
    assert abs(same.kl_divergence) < 1e-15


def test_category_distribution_and_unique_proportion(spark):
    df = spark.createDataFrame([("x", 1), ("x", 1), ("x", 2), ("y", None)], "g string, v int")
    shares = {r.v: r.share for r in drift.category_distribution(df, "v").collect()}
    assert shares == {1: 0.5, 2: 0.25, None: 0.25}
    up = {r.g: r.unique_proportion for r in drift.unique_proportion(df, "v", ["g"]).collect()}
    assert up == {"x": 2 / 3, "y": None}


def test_rolling_bounds_bootstrap_then_band(spark):
    vals = [100, 110, 90, 100, 400]
    s = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "period int, rows int")
    out = {r.period: r for r in drift.rolling_bounds(s, "period", "rows", history=14, min_history=3,
                                                      bootstrap=(50.0, 1000.0)).collect()}
    assert (out[0].lower_bound, out[0].upper_bound, out[0].history_periods) == (50.0, 1000.0, 0)
    mu, sd = 100.0, 10.0  # of 100, 110, 90
    assert abs(out[3].lower_bound - (mu - 2 * sd)) < 1e-9 and out[3].in_bounds
    assert not out[4].in_bounds


def test_reconcile_and_missing_dates(spark):
    d1, d2, d3 = dt.date(2023, 1, 1), dt.date(2023, 1, 2), dt.date(2023, 1, 3)
    detail = spark.createDataFrame([(d1,), (d1,), (d3,)], "pickup_month date")
    summary = spark.createDataFrame([(d1, 2), (d3, 2)], "pickup_month date, trip_count int")
    r = {x.pickup_month: x for x in reconcile.reconcile_counts(detail, summary).collect()}
    assert r[d1].within_tolerance and not r[d3].within_tolerance and r[d3].abs_diff == 1
    cal = spark.createDataFrame([(d1,), (d2,), (d3,)], "date_day date")
    facts = spark.createDataFrame([(d1,), (d3,)], "pickup_date date")
    assert [x.date_day for x in reconcile.missing_dates(cal, facts).collect()] == [d2]


def test_zone_coverage(spark):
    m = dt.date(2023, 1, 1)
    facts = spark.createDataFrame([(m, 1, 10.0, 5.0), (m, 1, 80.0, 5.0), (m, 9, 1.0, -1.0)],
                                  "pickup_month date, pu_location_id int, tip_pct double, total_amount double")
    zones = spark.createDataFrame([(1,), (2,), (3,)], "location_id int")
    r = reconcile.zone_coverage(facts, zones).first()
    assert (r.active_zones, r.zones_with_trips, r.zones_without_trips) == (3, 1, 2)
    assert (r.tip_pct_out_of_range, r.non_positive_revenue) == (1, 1)
