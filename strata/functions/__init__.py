"""Column -> Column building blocks."""

from strata.functions.keys import row_hash, surrogate_key
from strata.functions.privacy import (
    fake_card_last4,
    fake_email,
    fake_passenger_id,
    fake_phone,
    pii_seed,
    token,
)
from strata.functions.trips import duration_min, duration_sec, month_of, tip_pct

__all__ = [
    "duration_min",
    "duration_sec",
    "fake_card_last4",
    "fake_email",
    "fake_passenger_id",
    "fake_phone",
    "month_of",
    "pii_seed",
    "row_hash",
    "surrogate_key",
    "tip_pct",
    "token",
]
