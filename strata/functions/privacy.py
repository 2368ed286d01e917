"""Fabricated-PII and tokenisation expressions.

Every function is a native expression, so tokenising stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pii_seed(vendor: Column, pickup: Column) -> Column:
    """``"<vendor>|<pickup>"`` with NULL rendered as ``None`` (the seed convention)."""
    return F.concat(
        F.coalesce(vendor.cast("string"), F.lit("None")),
        F.lit("|"),
        F.coalesce(pickup.cast("string"), F.lit("None")),
    )


def _digits(hex_col: Column, n: int) -> Column:
    """First ``n`` decimal digits of a lowercase hex string (md5 output), right-padded with
    zeros. Deleting the letters a-f leaves exactly the digits, without a regex per row."""
    return F.rpad(F.substring(F.translate(hex_col, "abcdef", ""), 1, n), n, "0")


def fake_email(seed: Column) -> Column:
    return F.concat(F.lit("user_"), F.substring(F.md5(seed), 1, 8), F.lit("@example.com"))


def phone_digits(seed: Column) -> Column:
    return _digits(F.md5(F.concat(F.lit("phone"), seed)), 10)


def phone_of(d: Column) -> Column:
    """A phone number of its ten digits; ``d`` is used three times."""
    return F.concat_ws("-", F.substring(d, 1, 3), F.substring(d, 4, 3), F.substring(d, 7, 4))


def fake_phone(seed: Column) -> Column:
    return phone_of(phone_digits(seed))


def fake_card_last4(seed: Column) -> Column:
    return _digits(F.md5(F.concat(F.lit("card"), seed)), 4)


def fake_passenger_id(seed: Column) -> Column:
    return F.md5(F.concat(F.lit("pid"), seed))


def token(value: Column, salt: str | Column) -> Column:
    """Salted SHA-256 hex token; NULL stays NULL, '' still gets a token."""
    salt_col = salt if isinstance(salt, Column) else F.lit(salt)
    return F.sha2(F.concat(value, salt_col), 256)
