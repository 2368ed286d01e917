"""Property tests: native expressions against Python definitions on generated inputs."""

import decimal
import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions import surrogate_key, token

SETTINGS = settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
text = st.one_of(st.none(), st.text(max_size=40))


@SETTINGS
@given(values=st.lists(text, min_size=1, max_size=20), salt=st.text(min_size=1, max_size=10))
def test_token_equals_sha256(spark, values, salt):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r.t for r in df.select(token(F.col("v"), salt).alias("t")).collect()]
    want = [None if v is None else hashlib.sha256((v + salt).encode()).hexdigest() for v in values]
    assert got == want


@SETTINGS
@given(rows=st.lists(st.tuples(st.one_of(st.none(), st.integers(-10**6, 10**6)), text), min_size=1, max_size=20))
def test_surrogate_key_equals_md5_of_joined_strings(spark, rows):
    df = spark.createDataFrame(rows, "a long, b string")
    got = [r.k for r in df.select(surrogate_key("a", "b").alias("k")).collect()]
    null = "_dbt_utils_surrogate_key_null_"
    want = [hashlib.md5("-".join(null if x is None else str(x) for x in r).encode()).hexdigest() for r in rows]
    assert got == want


@SETTINGS
@given(values=st.lists(st.floats(min_value=-1e6, max_value=1e6, allow_nan=False), min_size=1, max_size=20))
def test_money_cast_rounds_half_up_on_the_exact_binary_value(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    got = [r.d for r in df.select(F.col("v").try_cast("decimal(10,2)").alias("d")).collect()]
    want = [decimal.Decimal(v).quantize(decimal.Decimal("0.01"), rounding=decimal.ROUND_HALF_UP) for v in values]
    assert got == want
