"""Merged sketch and suite state against one pass over the rows; keys against stored months."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strata.operators.quality import expectations as X
from strata.operators.quality.history import KeyHistory, key_types
from strata.ops import profile, sketches
from strata.sinks.writers import overwrite_partitions

SCHEMA = "month date, n int, price decimal(10,2), name string, nothing double"
MONTHS = [dt.date(2020, m, 1) for m in range(1, 7)]
SUITE = [
    X.E(X.ROW_COUNT, min_value=100, max_value=10_000),
    X.E(X.MEAN, column="price", min_value=40, max_value=60),
    X.E(X.QUANTILE, column="price", quantile_ranges={"quantiles": [0.5, 0.99], "value_ranges": [[40, 60], [95, 100]]}),
    X.E(X.BETWEEN, column="n", min_value=0, max_value=90, mostly=0.8),
    X.E(X.NOT_NULL, column="name"),
    X.E(X.LENGTH_EQ, column="name", value=2),
    X.E(X.IN_SET, column="name", value_set=["aa", "bb"]),
    X.E(X.UNIQUE_PROPORTION, column="n", min_value=0.01, max_value=0.2),
    X.E(X.MEAN, column="absent", min_value=0, max_value=1),
    X.E(X.MEAN, column="nothing", min_value=0, max_value=1),
]


def rows(seed, months=MONTHS):
    rng = random.Random(seed)
    return [
        (m, rng.choice([None, rng.randrange(100)]), None if rng.random() < 0.1 else round(rng.random() * 100, 2), rng.choice(["aa", "bb", "c", None]), None)
        for m in months for _ in range(rng.randint(200, 400))
    ]


def frame(spark, data):
    return spark.createDataFrame([(m, n, None if p is None else __import__("decimal").Decimal(str(p)), s, z) for m, n, p, s, z in data], SCHEMA)


def halves(df):
    return df.withColumn("half", F.when(F.month("month") <= 3, 1).otherwise(2))


def test_merged_profile_is_the_profile_of_the_rows(spark, tmp_dir):
    df, path = frame(spark, rows(1)), tmp_dir + "/state"
    cols = ["n", "price", "name", "nothing"]
    overwrite_partitions(sketches.profile_state(df, cols, ["month"]), path, "month")
    anew = frame(spark, rows(2, MONTHS[1:2]))  # a month loaded again replaces its rows only
    overwrite_partitions(sketches.profile_state(anew, cols, ["month"]), path, "month", MONTHS[1:2])
    now = df.where(F.col("month") != F.lit(MONTHS[1])).unionByName(anew)
    merged = sketches.merge_profile(halves(spark.read.parquet(path)), ["half"])
    got = {(r.half, r.column_name): r for r in merged.collect()}
    want = profile.column_profile(halves(now), cols, ["half"], approx=False).collect()
    assert len(want) == len(got) == 8
    for w in want:
        g = got[w.half, w.column_name]
        assert (g.rows, g.nulls, g.min_value, g.max_value) == (w.row_count, w.null_count, w.min_value, w.max_value)
        assert (g.mean is None) == (w.mean is None) and (w.mean is None or abs(g.mean - w.mean) < 1e-6)
        if w.column_name in ("n", "price"):
            values = sorted(float(r[0]) for r in halves(now).where((F.col("half") == w.half) & F.col(w.column_name).isNotNull()).select(w.column_name).collect())
            for q in sketches.QUANTILES:
                v = g[f"p{round(100 * q)}"]
                below, upto = sum(x < v for x in values) / len(values), sum(x <= v for x in values) / len(values)
                assert below <= q + sketches.RANK_ERROR and upto >= q - sketches.RANK_ERROR
            assert abs(g.approx_distinct - len(set(values))) <= sketches.DISTINCT_ERROR * len(set(values)) + 1
    assert got[1, "nothing"].p50 is None and got[1, "nothing"].approx_distinct == 0
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation ") == 1 and "price" not in plan  # the stored rows and nothing else


def test_merged_suite_is_the_suite_of_the_rows(spark, tmp_dir):
    df = frame(spark, rows(3))
    state = sketches.suite_state(df, SUITE, ["month"])
    overwrite_partitions(state, tmp_dir + "/suite", "month")
    merged = sketches.merge_suite(halves(spark.read.parquet(tmp_dir + "/suite")), SUITE, ["half"]).collect()
    want = {(r.half, r.expectation_id): r for r in X.evaluate_suite(halves(df), SUITE, ["half"]).collect()}
    assert len(merged) == len(want) == 2 * len(SUITE)
    for g in merged:
        w = want[g.half, g.expectation_id]
        assert (g.expectation_type, g.column, g.element_count, g.unexpected_count, g.success) == (
            w.expectation_type, w.column, w.element_count, w.unexpected_count, w.success,
        )
    assert {g.success for g in merged if g.column in ("absent", "nothing")} == {False}


KEYS = "a string, b int, month date"


@pytest.fixture()
def history(spark, tmp_dir):
    df = spark.createDataFrame([], KEYS)
    h = KeyHistory(spark, "test_keys", tmp_dir + "/keys", key_types(df, ["a", "b"]), buckets=4).open()
    yield h
    h.forget()


def test_keys_of_old_months_are_found(spark, history, tmp_dir):
    old = [("k", 1, MONTHS[0]), ("k", 1, MONTHS[0]), ("k", 1, MONTHS[2]), ("l", 1, MONTHS[1]), (None, 1, MONTHS[1])]
    history.store(spark.createDataFrame(old, KEYS))
    new = [("k", 1, MONTHS[5]), ("k", 2, MONTHS[5]), ("m", 3, MONTHS[5]), ("m", 3, MONTHS[5]), (None, 1, MONTHS[5]), (None, 1, MONTHS[5])]
    new = spark.createDataFrame(new, KEYS)
    want = {("k", 1, 1, 3, 2, MONTHS[0]), ("m", 3, 2, 0, 0, None)}
    assert set(map(tuple, history.repeated(new, MONTHS[5]).collect())) == want
    history.store(new)  # the month itself is no history of its own
    assert set(map(tuple, history.repeated(new, MONTHS[5]).collect())) == want
    history.store(spark.createDataFrame([("z", 1, MONTHS[0])], KEYS))  # loaded anew
    assert set(map(tuple, history.repeated(new, MONTHS[5]).collect())) == {("k", 1, 1, 1, 1, MONTHS[2]), ("m", 3, 2, 0, 0, None)}
    again = KeyHistory(spark, "test_keys_again", tmp_dir + "/keys", history.types, buckets=4).open()  # another session's view
    assert set(map(tuple, again.repeated(new, MONTHS[5]).collect())) == {("k", 1, 1, 1, 1, MONTHS[2]), ("m", 3, 2, 0, 0, None)}
    again.forget()


def test_history_is_not_shuffled(spark, history):
    history.store(spark.createDataFrame([(f"k{i}", i, m) for m in MONTHS[:5] for i in range(300)], KEYS))
    found = history.repeated(spark.createDataFrame([("k1", 1, MONTHS[5])], KEYS), MONTHS[5])
    plan = found._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    join = next(i for i, x in enumerate(lines) if "ShuffledHashJoin" in x)
    scan = next(i for i, x in enumerate(lines) if "FileScan parquet" in x and "test_keys" in x)
    first = lines[join + 1 : scan]  # the history's side comes first
    assert "Bucketed: true" in lines[scan] and not any("Exchange" in x for x in first)
    assert found.first()["months"] == 5


def test_doubles_are_no_keys(spark):
    with pytest.raises(TypeError):
        key_types(spark.createDataFrame([(1.5,)], "x double"), ["x"])
