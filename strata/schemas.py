"""Table schemas, defined once as StructTypes, and the column groups built on them."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)

# The landed trip file layout (19 columns) in source order.
RAW_FIELDS = [
    ("VendorID", T.LongType()),
    ("tpep_pickup_datetime", T.TimestampType()),
    ("tpep_dropoff_datetime", T.TimestampType()),
    ("passenger_count", T.DoubleType()),
    ("trip_distance", T.DoubleType()),
    ("RatecodeID", T.DoubleType()),
    ("store_and_fwd_flag", T.StringType()),
    ("PULocationID", T.LongType()),
    ("DOLocationID", T.LongType()),
    ("payment_type", T.LongType()),
    ("fare_amount", T.DoubleType()),
    ("extra", T.DoubleType()),
    ("mta_tax", T.DoubleType()),
    ("tip_amount", T.DoubleType()),
    ("tolls_amount", T.DoubleType()),
    ("improvement_surcharge", T.DoubleType()),
    ("total_amount", T.DoubleType()),
    ("congestion_surcharge", T.DoubleType()),
    ("airport_fee", T.DoubleType()),
]
RAW_SCHEMA = T.StructType([T.StructField(n, t, True) for n, t in RAW_FIELDS])

# Bronze types of the source columns. The last two are optional: they are cast only
# when the landed file carries them.
SOURCE_TYPES: dict[str, T.DataType] = {
    "VendorID": T.IntegerType(),
    "tpep_pickup_datetime": T.TimestampType(),
    "tpep_dropoff_datetime": T.TimestampType(),
    "passenger_count": T.IntegerType(),
    "trip_distance": MONEY,
    "RatecodeID": T.IntegerType(),
    "store_and_fwd_flag": T.StringType(),
    "PULocationID": T.IntegerType(),
    "DOLocationID": T.IntegerType(),
    "payment_type": T.IntegerType(),
    "fare_amount": MONEY,
    "extra": MONEY,
    "mta_tax": MONEY,
    "tip_amount": MONEY,
    "tolls_amount": MONEY,
    "improvement_surcharge": MONEY,
    "total_amount": MONEY,
    "congestion_surcharge": MONEY,
    "airport_fee": MONEY,
}
OPTIONAL_SOURCE_COLUMNS = ("congestion_surcharge", "airport_fee")
MANDATORY_SOURCE_COLUMNS = tuple(c for c in SOURCE_TYPES if c not in OPTIONAL_SOURCE_COLUMNS)

PII_COLUMNS = ("passenger_email", "passenger_phone", "payment_card_last4", "passenger_id")
TOKEN_COLUMNS = tuple(f"{c}_token" for c in PII_COLUMNS)
PII_KEYS = ("VendorID", "tpep_pickup_datetime")

METADATA_FIELDS = [
    ("_run_id", T.StringType()),
    ("_source_url", T.StringType()),
    ("_source_sha256", T.StringType()),
    ("_ingested_at", T.TimestampType()),
    ("_schema_version", T.IntegerType()),
]

BRONZE_SCHEMA = T.StructType(
    [T.StructField(n, t, True) for n, t in SOURCE_TYPES.items()]
    + [T.StructField(c, T.StringType(), True) for c in TOKEN_COLUMNS]
    + [T.StructField("_salt_version", T.IntegerType(), True)]
    + [T.StructField(n, t, True) for n, t in METADATA_FIELDS]
)

PII_LOOKUP_SCHEMA = T.StructType(
    [
        T.StructField("VendorID", T.IntegerType(), True),
        T.StructField("tpep_pickup_datetime", T.TimestampType(), True),
    ]
    + [T.StructField(c, T.StringType(), True) for c in PII_COLUMNS]
)

ZONE_SEED_SCHEMA = T.StructType(
    [
        T.StructField("LocationID", T.IntegerType(), True),
        T.StructField("Borough", T.StringType(), True),
        T.StructField("Zone", T.StringType(), True),
        T.StructField("service_zone", T.StringType(), True),
    ]
)

QUARANTINE_EXTRA = [
    ("_failure_reason", T.StringType()),
    ("_expectation_kwargs", T.StringType()),
    ("_quarantine_run_id", T.StringType()),
]
QUARANTINE_SCHEMA = T.StructType(
    list(BRONZE_SCHEMA.fields) + [T.StructField(n, t, True) for n, t in QUARANTINE_EXTRA]
)

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), True),
        T.StructField("dag_id", T.StringType(), True),
        T.StructField("task_id", T.StringType(), True),
        T.StructField("layer", T.StringType(), True),
        T.StructField("table_name", T.StringType(), True),
        T.StructField("source_url", T.StringType(), True),
        T.StructField("source_sha256", T.StringType(), True),
        T.StructField("schema_version", T.IntegerType(), True),
        T.StructField("rows_in", T.LongType(), True),
        T.StructField("rows_out", T.LongType(), True),
        T.StructField("rows_quarantined", T.LongType(), True),
        T.StructField("ge_suite_name", T.StringType(), True),
        T.StructField("ge_pass_rate", T.DoubleType(), True),
        T.StructField("ge_failed_expectations", T.ArrayType(T.StringType()), True),
        T.StructField("started_at", T.TimestampType(), True),
        T.StructField("finished_at", T.TimestampType(), True),
        T.StructField("duration_sec", T.DoubleType(), True),
        T.StructField("status", T.StringType(), True),
        T.StructField("error_message", T.StringType(), True),
        T.StructField("triggered_by", T.StringType(), True),
    ]
)

# Audit status codes as exported to metrics.
STATUS_CODES = {"SUCCESS": 1, "FAILED": 0, "QUARANTINED": -1}

MANIFEST_SCHEMA = T.StructType(
    [
        T.StructField("url", T.StringType(), True),
        T.StructField("sha256", T.StringType(), True),
        T.StructField("byte_size", T.LongType(), True),
        T.StructField("row_count", T.LongType(), True),
        T.StructField("ingested_at", T.StringType(), True),
    ]
)
