"""The type lattice's laws, schema merges read back from files, rejected rows in a real run."""

import datetime as dt
import itertools
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.operators import lattice
from strata.operators.lattice import merge_schema, rewritten, widen, with_rejects
from strata.operators.quality import expectations as X
from strata.plans.graph import run_graph
from strata.plans.models import RunParams
from strata.plans.monthly import Tables, land_months
from strata.sources import testbed
from tests.conftest import SF0001

TYPES = [
    T.ByteType(), T.IntegerType(), T.LongType(), T.DecimalType(10, 2), T.DecimalType(38, 10), T.FloatType(), T.DoubleType(),
    T.StringType(), T.DateType(), T.TimestampType(), T.TimestampNTZType(), T.BooleanType(), T.NullType(),
]


def test_laws():
    for a, b in itertools.product(TYPES, TYPES):
        assert widen(a, a) == a and widen(a, b) == widen(b, a)
        assert widen(widen(a, b), b) == widen(a, b)  # absorbing: once widened, both fit
    assert widen(T.IntegerType(), T.LongType()) == T.LongType()
    assert widen(T.LongType(), T.DecimalType(10, 2)) == T.DecimalType(22, 2)
    assert widen(T.DecimalType(38, 0), T.DecimalType(10, 5)) == T.DoubleType()
    assert widen(T.DateType(), T.TimestampType()) == T.TimestampType()
    assert widen(T.BooleanType(), T.IntegerType()) == T.StringType()


def test_merged_schema_reads_files_of_both(spark, tmp_dir):
    old = spark.createDataFrame([(1, 2, "x")], "A int, b int, c string")
    new = spark.createDataFrame([(2**40, 2.5, "y", True)], "a long, B double, c string, d boolean")
    merged = merge_schema(old.schema, new.schema)
    assert merged.simpleString() == "struct<A:bigint,b:double,c:string,d:boolean>" and rewritten(old.schema, merged) == []
    old.write.parquet(tmp_dir + "/t/m=1")
    new.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in merged.fields)).write.parquet(tmp_dir + "/t/m=2")
    rows = spark.read.schema(T.StructType([*merged.fields, T.StructField("m", T.IntegerType())])).parquet(tmp_dir + "/t").orderBy("m").collect()
    assert [tuple(r) for r in rows] == [(1, 2.0, "x", None, 1), (2**40, 2.5, "y", True, 2)]
    text = merge_schema(old.schema, spark.createDataFrame([("x",)], "a string").schema)
    assert rewritten(old.schema, text) == ["A"]


def test_rejects_name_column_and_value(spark):
    df = spark.createDataFrame([("1", "a", 5), ("x", None, 5), (None, "2.5", 2**40), ("3.0", "zz", 7)], "N string, price string, k long")
    types = {"n": T.IntegerType(), "price": T.DecimalType(5, 1), "k": T.IntegerType(), "absent": T.IntegerType()}
    got = [(r._reject_reason, r._original) for r in with_rejects(df, types).collect()]
    assert [g for g, _ in got] == ["price: a", "n: x", f"k: {2**40}", "n: 3.0; price: zz"]
    assert json.loads(got[0][1]) == {"N": "1", "price": "a", "k": 5}
    assert with_rejects(df.select("k"), {"k": T.LongType()}).where("_reject_reason IS NOT NULL").count() == 0
    assert lattice.cast_failures(df.limit(0), types) is not None and with_rejects(df.limit(0), types).count() == 0


@pytest.mark.parametrize("month", [dt.date(1996, 3, 1)])
def test_a_run_counts_and_keeps_rejected_rows(spark, tmp_dir, month):
    raw = testbed.trips_raw(spark, SF0001).where(F.trunc("tpep_pickup_datetime", "month") == F.lit(month))
    odd = raw.withColumn("passenger_count", F.when(F.col("passenger_count") == 1, "one").otherwise(F.col("passenger_count").cast("int").cast("string")))
    land_months(odd, tmp_dir + "/landing", F.lit(month))
    t = Tables(tmp_dir + "/t")
    good = [X.E(X.ROW_COUNT, min_value=1)]
    audit = run_graph(spark, t, tmp_dir + "/landing", [month], testbed.zone_seed(spark, SF0001), RunParams(run_id="r"), good, good)
    load = audit.where("task_id = 'landing_to_bronze'").first()
    bad = raw.where("passenger_count = 1").count()
    assert bad > 0 and load.rows_quarantined == bad and load.rows_in == raw.count() and load.rows_out == raw.count() - bad
    rows = spark.read.parquet(t.rejected).collect()
    assert len(rows) == bad and {r._reject_reason for r in rows} == {"passenger_count: one"}
    assert all(json.loads(r._original)["passenger_count"] == "one" and r._source_url.endswith(".parquet") for r in rows)
