"""A key holding a third of all rows: the token join is split by AQE, nothing is dropped."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators import privacy

AQE_SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def test_hot_key_token_join_is_split_and_complete(spark):
    old = {k: spark.conf.get(k, None) for k in AQE_SMALL}
    for k, v in AQE_SMALL.items():
        spark.conf.set(k, v)
    try:
        n = 200000
        hot = dt.datetime(2023, 1, 1)
        ts = F.when(F.col("id") % 3 == 0, F.lit(hot)).otherwise(
            F.timestamp_seconds(F.lit(1672531200) + F.col("id")))
        bronze = spark.range(0, n, 1, 8).select(F.lit(1).alias("VendorID"), ts.alias("tpep_pickup_datetime"),
                                       F.col("id").alias("row_id"))
        lookup = privacy.build_pii_lookup(bronze)
        out = privacy.tokenize_bronze(bronze, lookup, "s", 1)
        agg = out.agg(F.count("*").alias("rows"), F.count("passenger_id_token").alias("tokens"),
                      F.count_if(F.col("tpep_pickup_datetime") == F.lit(hot)).alias("hot_rows"),
                      F.sum("row_id").alias("ids"))
        r = agg.collect()[0]
        assert (r.rows, r.tokens, r.hot_rows, r.ids) == (n, n, (n + 2) // 3, n * (n - 1) // 2)
        plan = agg._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin(skew=true)" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
