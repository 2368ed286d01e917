"""PII lookup, tokenisation, salt rotation, erasure and token coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.privacy import (
    fake_card_last4,
    fake_email,
    fake_passenger_id,
    fake_phone,
    phone_digits,
    phone_of,
    pii_seed,
    token,
)
from strata.schemas import PII_COLUMNS, PII_KEYS, TOKEN_COLUMNS
from strata.sizing import bounded_broadcast



def pii_keys(bronze: DataFrame) -> DataFrame:
    """Distinct (VendorID, pickup) pairs; map-side partial aggregation absorbs hot keys."""
    return bronze.select(*PII_KEYS).distinct()


def build_pii_lookup(bronze: DataFrame) -> DataFrame:
    """Deterministic fabricated PII per distinct (VendorID, pickup) key."""
    keys = pii_keys(bronze)
    seed = pii_seed(F.col("VendorID"), F.col("tpep_pickup_datetime"))
    return keys.select(
        F.col("VendorID").cast("int").alias("VendorID"),
        "tpep_pickup_datetime",
        fake_email(seed).alias("passenger_email"),
        fake_phone(seed).alias("passenger_phone"),
        fake_card_last4(seed).alias("payment_card_last4"),
        fake_passenger_id(seed).alias("passenger_id"),
    )


def tokenize_lookup(lookup: DataFrame, salt: str) -> DataFrame:
    """Replace each raw PII column by its salted token; raw values do not leave this frame."""
    return lookup.select(
        *PII_KEYS,
        *[token(F.col(raw), salt).alias(tok) for raw, tok in zip(PII_COLUMNS, TOKEN_COLUMNS)],
    )


def tokenize_bronze(
    bronze: DataFrame,
    lookup: DataFrame,
    salt: str,
    salt_version: int,
    broadcast_rows: int | None = None,
) -> DataFrame:
    """Attach the 4 token columns by a LEFT join on (VendorID, pickup) and stamp the salt version.

    Stale token columns are dropped first, so re-running never duplicates columns.
    Rows with no lookup entry (or a NULL key) keep NULL tokens but still get the
    version. The lookup is unique per key, so the join never multiplies rows.

    The lookup holds one row per distinct key of the data, so it grows with the data:
    by default the join shuffles both sides on the keys (the lookup is usually already
    hash-partitioned on them by its distinct) and AQE turns it into a broadcast join at
    runtime when the lookup turns out small, or splits hot keys of the bronze side.
    ``broadcast_rows`` forces a size-checked broadcast for a stored, known-small lookup.
    """
    stale = [c for c in (*TOKEN_COLUMNS, "_salt_version") if c in bronze.columns]
    base = bronze.drop(*stale)
    toks = tokenize_lookup(lookup, salt)
    if broadcast_rows is not None:
        toks = bounded_broadcast(toks, broadcast_rows)
    joined = base.join(toks, list(PII_KEYS), "left")
    return joined.withColumn("_salt_version", F.lit(salt_version).cast("int"))


def tokenize_with_fresh_lookup(bronze: DataFrame, salt: str, salt_version: int) -> DataFrame:
    """Tokens for rows whose lookup is built from these same rows, in the same pass.

    A freshly built lookup holds, for every non-NULL key of ``bronze``, PII that is a
    function of the key; joining it back is a self-join whose result is that function
    of each row's own key. This computes it as a projection, with the same values:
    NULL keys get NULL tokens, as an unmatched join row would. Use
    :func:`tokenize_bronze` whenever the lookup is a stored table (edited by erasure or
    shared across runs).
    """
    stale = [c for c in (*TOKEN_COLUMNS, "_salt_version") if c in bronze.columns]
    base = bronze.drop(*stale)
    has_key = F.col("VendorID").isNotNull() & F.col("tpep_pickup_datetime").isNotNull()
    # The seed and the phone's digits are columns of their own: inside the conditional tokens
    # they would be computed anew for every use.
    seeded = base.withColumn("_pii_seed", pii_seed(F.col("VendorID").cast("int"), F.col("tpep_pickup_datetime")))
    seed = F.col("_pii_seed")
    seeded = seeded.withColumn("_phone_digits", phone_digits(seed))
    pii = {
        "passenger_email": fake_email(seed),
        "passenger_phone": phone_of(F.col("_phone_digits")),
        "payment_card_last4": fake_card_last4(seed),
        "passenger_id": fake_passenger_id(seed),
    }
    tokens = {tok: F.when(has_key, token(pii[raw], salt)) for raw, tok in zip(PII_COLUMNS, TOKEN_COLUMNS)}
    out = seeded.withColumns({**tokens, "_salt_version": F.lit(salt_version).cast("int")})
    return out.drop("_pii_seed", "_phone_digits")


def rotate_salt(bronze: DataFrame, lookup: DataFrame, new_salt: str, new_version: int) -> DataFrame:
    """Re-tokenise with a new salt; prior tokens become unresolvable, the lookup is unchanged."""
    return tokenize_bronze(bronze, lookup, new_salt, new_version)


def erase_subjects(lookup: DataFrame, erasure: DataFrame, on: str = "passenger_id") -> DataFrame:
    """Lookup without the rows of the subjects to erase (pair with :func:`rotate_salt`)."""
    return lookup.join(erasure.select(on).distinct(), on, "left_anti")


def raw_pii_columns(df: DataFrame) -> list[str]:
    """Raw PII columns present in a frame that must contain tokens only (should be [])."""
    return [c for c in df.columns if c in PII_COLUMNS]


def token_coverage(df: DataFrame, token_col: str = "passenger_email_token", group_by: list[str] | None = None) -> DataFrame:
    """Tokenised rows, total rows, coverage and mean token length, in one aggregation."""
    tok = F.col(token_col)
    aggs = [
        F.count("*").alias("total_rows"),
        F.count(tok).alias("tokenized_rows"),
        (F.count(tok).cast("double") / F.nullif(F.count("*"), F.lit(0))).alias("coverage"),
        F.avg(F.length(tok)).alias("avg_token_length"),
    ]
    return df.groupBy(*(group_by or [])).agg(*aggs)
