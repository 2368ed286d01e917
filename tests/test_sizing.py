"""Size checks of broadcast sides: by rows and by bytes, without moving rows to one task."""

from pyspark.sql import functions as F

from strata.sizing import bounded_broadcast, fits, measured


def test_bytes_and_rows_bound_a_broadcast_side(spark):
    small = spark.range(10)
    wide = small.select("id", F.repeat(F.lit("x"), 1 << 20).alias("text"), F.array(F.lit(1)).alias("list"))
    rows, size = measured(wide)
    assert rows == 10 and size >= 10 << 20
    assert fits(wide, 100) and not fits(wide, 100, max_bytes=1 << 20) and not fits(wide, 9)
    assert measured(spark.createDataFrame([], "a string, b int")) == (0, 0)
    assert measured(spark.createDataFrame([(None,)], "a string")) == (1, 16)
    hinted = small.join(bounded_broadcast(wide, max_bytes=1 << 20), "id")
    assert "ResolvedHint" not in hinted._jdf.queryExecution().analyzed().toString()
    hinted = small.join(bounded_broadcast(wide), "id")
    assert "ResolvedHint" in hinted._jdf.queryExecution().analyzed().toString()
