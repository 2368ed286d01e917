"""Key and hash expressions (Column -> Column, all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: placeholder the published surrogate-key convention substitutes for NULL.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def surrogate_key(*cols: str | Column) -> Column:
    """md5 over the '-'-joined string forms of ``cols``, NULL replaced by a marker."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(SURROGATE_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def row_hash(*cols: str | Column) -> Column:
    """64-bit hash of a row's values (order-sensitive in the columns, not the rows)."""
    return F.xxhash64(*[_col(c) for c in cols])
