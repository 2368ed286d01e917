"""Expectation suites, gate verdict and routing, quarantine, structural tests."""

import json

from strata.operators.quality import expectations as X
from strata.operators.quality import structural as S
from strata.operators.quality.quarantine import quarantine_month, quarantine_rows


def frame(spark):
    rows = [("m1", 1, 10.0, 3, 1), ("m1", 2, 20.0, 5, 2), ("m1", None, 30.0, 1, 3), ("m2", 50, None, 2, 1)]
    return spark.createDataFrame(rows, "m string, a int, b double, hi int, lo int")


def results(spark, suite, group=None):
    r = X.evaluate_suite(frame(spark), suite, group)
    return {(getattr(x, "m", None), x.expectation_id): x for x in r.collect()}


def test_element_checks_ignore_nulls_and_apply_mostly(spark):
    suite = [X.E(X.BETWEEN, column="a", min_value=0, max_value=10, mostly=0.6),
             X.E(X.BETWEEN, column="a", min_value=0, max_value=10)]
    r = results(spark, suite)
    loose, strict = r[(None, 0)], r[(None, 1)]
    assert (loose.element_count, loose.missing_count, loose.unexpected_count) == (4, 1, 1)
    assert abs(loose.observed_value - 1 / 3) < 1e-12 and loose.success
    assert not strict.success


def test_aggregate_checks_and_empty_denominator(spark):
    suite = [X.E(X.ROW_COUNT, min_value=1, max_value=2), X.E(X.MEAN, column="b", min_value=15, max_value=25),
             X.E(X.QUANTILE, column="b", quantile_ranges={"quantiles": [0.5], "value_ranges": [[20, 20]]}),
             X.E(X.BETWEEN, column="a", min_value=0, max_value=1)]
    r = results(spark, suite, ["m"])
    assert not r[("m1", 0)].success and r[("m1", 0)].observed_value == 3.0
    assert r[("m1", 1)].success and r[("m2", 1)].success is False  # NULL mean fails
    assert r[("m1", 2)].observed_value == 20.0
    assert r[("m2", 3)].success is False


def test_pair_and_set_and_length_and_not_null(spark):
    suite = [X.E(X.PAIR_GT, column_A="hi", column_B="lo", or_equal=False),
             X.E(X.IN_SET, column="lo", value_set=[1, 2]),
             X.E(X.NOT_NULL, column="b"),
             X.E(X.LENGTH_EQ, column="m", value=2)]
    r = results(spark, suite)
    assert r[(None, 0)].unexpected_count == 1  # 1 <= 3
    assert r[(None, 1)].unexpected_count == 1
    assert r[(None, 2)].unexpected_count == 1 and r[(None, 2)].missing_count == 0
    assert r[(None, 3)].success


def test_absent_columns_fail_but_for_optional_checks(spark):
    absent = X.E(X.NOT_NULL, column="missing_col")
    optional = X.E(X.NOT_NULL, column="missing_token")  # token checks only
    rows = X.E(X.ROW_COUNT, min_value=0, max_value=9)

    def outcome(*suite, **kw):
        return [r.success for r in X.evaluate_suite(frame(spark), list(suite), **kw).orderBy("expectation_id").collect()]

    assert outcome(absent, rows) == [False, True]
    assert outcome(optional, rows) == [True]
    assert outcome(optional, rows, skip_optional=False) == [False, True]


def test_verdict_route_and_quarantine(spark):
    suite = [X.E(X.ROW_COUNT, min_value=2, max_value=10), X.E(X.NOT_NULL, column="b")]
    df = frame(spark)
    v = X.gate_verdict(X.evaluate_suite(df, suite, ["m"]), ["m"], "s")
    vs = {r.m: r for r in v.collect()}
    assert vs["m1"].success and not vs["m2"].success and vs["m2"].pass_rate == 0.0
    assert vs["m2"].failed_expectations == sorted(vs["m2"].failed_expectations)
    passed, failed = X.route(df, v, ["m"])
    assert passed.count() == 3 and failed.count() == 1
    q = quarantine_month(df, v, "run-9", ["m"]).collect()
    assert len(q) == 1 and q[0]._quarantine_run_id == "run-9" and "not_be_null" in q[0]._failure_reason
    assert len(json.loads(q[0]._expectation_kwargs)) == 2


def test_quarantine_rows_one_row_per_broken_rule(spark):
    suite = [X.E(X.BETWEEN, column="a", min_value=0, max_value=10), X.E(X.PAIR_GT, column_A="hi", column_B="lo")]
    q = quarantine_rows(frame(spark), suite, "r").collect()
    assert sorted(r._failure_reason.split(":")[0] for r in q) == sorted([X.BETWEEN, X.PAIR_GT])


def test_structural_tests(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 9), (None, "z", 2)], "k int, v string, fk int")
    dim = spark.createDataFrame([(1,), (2,)], "id int")
    tests = [S.not_null("k"), S.unique("k"), S.accepted_values("v", ["a", "b"]), S.accepted_range("fk", 1, 5),
             S.relationships("fk", "d", "id"), S.expression_is_true("k_pos", "k > 0")]
    out = {(r.test, r.column): r.failures for r in S.run_structural_tests(spark, df, "t", tests, {"d": dim}).collect()}
    assert out == {("not_null", "k"): 1, ("unique", "k"): 1, ("accepted_values", "v"): 1,
                   ("accepted_range", "fk"): 1, ("relationships", "fk"): 1, ("expression_is_true", "k_pos"): 1}
    assert S.fk_violations(df, "fk", dim, "id").count() == 1
    assert S.duplicate_keys(df, ["k"]).first().occurrences == 2
