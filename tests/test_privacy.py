"""Tokenisation with the PII lookup, salt rotation and erasure."""

import datetime as dt

from pyspark.sql import functions as F

from strata.operators import privacy
from strata.schemas import PII_LOOKUP_SCHEMA, TOKEN_COLUMNS

T0 = dt.datetime(2023, 1, 15, 8, 0)
BRONZE = "VendorID int, tpep_pickup_datetime timestamp, fare_amount decimal(10,2)"


def lookup(spark):
    return spark.createDataFrame([(2, T0, "user@example.com", "555-000-0001", "1234", "pid-abc")], PII_LOOKUP_SCHEMA)


def test_tokens_hex_version_and_unmatched_rows(spark):
    b = spark.createDataFrame([(2, T0, None), (1, T0, None), (None, T0, None)], BRONZE)
    out = privacy.tokenize_bronze(b, lookup(spark), "salt_a", 7)
    rows = {r.VendorID: r for r in out.collect()}
    assert len(rows[2].passenger_email_token) == 64
    assert rows[1].passenger_email_token is None and rows[None].passenger_id_token is None
    assert {r._salt_version for r in rows.values()} == {7}


def test_rerun_does_not_duplicate_columns_and_salt_matters(spark):
    b = spark.createDataFrame([(2, T0, None)], BRONZE)
    once = privacy.tokenize_bronze(b, lookup(spark), "salt_a", 1)
    twice = privacy.tokenize_bronze(once, lookup(spark), "salt_b", 2)
    assert twice.columns.count("passenger_email_token") == 1
    assert once.first().passenger_email_token != twice.first().passenger_email_token
    assert twice.first()._salt_version == 2


def test_lookup_is_one_row_per_key_and_raw_pii_stays_out(spark):
    b = spark.createDataFrame([(2, T0, None), (2, T0, None), (1, T0, None)], BRONZE)
    lk = privacy.build_pii_lookup(b)
    assert lk.count() == 2
    out = privacy.tokenize_bronze(b, lk, "s", 1)
    assert privacy.raw_pii_columns(out) == []
    assert out.count() == 3 and all(c in out.columns for c in TOKEN_COLUMNS)


def test_erasure_then_rotation_nulls_erased_subjects(spark):
    b = spark.createDataFrame([(2, T0, None), (1, T0, None)], BRONZE)
    lk = privacy.build_pii_lookup(b)
    victim = lk.filter(F.col("VendorID") == 1).select("passenger_id")
    kept = privacy.erase_subjects(lk, victim)
    out = privacy.rotate_salt(b, kept, "new", 2).collect()
    tok = {r.VendorID: r.passenger_id_token for r in out}
    assert tok[1] is None and tok[2] is not None


def test_token_coverage(spark):
    b = spark.createDataFrame([(2, T0, None), (1, T0, None)], BRONZE)
    out = privacy.tokenize_bronze(b, lookup(spark), "s", 1)
    r = privacy.token_coverage(out).first()
    assert (r.total_rows, r.tokenized_rows, r.coverage, r.avg_token_length) == (2, 1, 0.5, 64.0)


def test_fresh_lookup_projection_equals_join(spark):
    rows = [(2, T0, None), (2, T0, None), (1, dt.datetime(2023, 2, 1), None), (None, T0, None), (1, None, None)]
    b = spark.createDataFrame(rows, BRONZE)
    joined = privacy.tokenize_bronze(b, privacy.build_pii_lookup(b), "s", 3)
    fresh = privacy.tokenize_with_fresh_lookup(b, "s", 3)
    cols = ["VendorID", "tpep_pickup_datetime", *TOKEN_COLUMNS, "_salt_version"]
    key = lambda r: tuple(map(str, r))
    assert sorted(joined.select(cols).collect(), key=key) == sorted(fresh.select(cols).collect(), key=key)
