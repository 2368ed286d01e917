"""Which months hold a subject: a Bloom filter for each month of the PII lookup, kept as a table.

A filter is as many bits as its month needs (16 or more for each key, a power of two), stored as
rows of 64 bits. Asking for subjects joins their bit positions with those rows, so neither the
lookup nor any month's data is read, and the answer has every month that holds a subject; of months
that hold none, about one in 2,000 for each subject is named as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits for each key, and bit positions that each key sets.
BITS_PER_KEY, POSITIONS = 16, 7
_LEAST_BITS = 1 << 10


def _positions(key: Column, n_bits: Column) -> Column:
    """Bit positions of a key: two hashes, combined POSITIONS times."""
    a, b = F.xxhash64(key, F.lit(1)), F.xxhash64(key, F.lit(2))
    # n_bits is a power of two, so the low bits of a hash are its remainder; 31 bits cannot overflow.
    low, step = a.bitwiseAND(F.lit((1 << 31) - 1)), b.bitwiseAND(F.lit((1 << 31) - 1)).bitwiseOR(F.lit(1).cast("long"))
    return F.transform(F.sequence(F.lit(0), F.lit(POSITIONS - 1)), lambda i: (low + i * step).bitwiseAND(n_bits - 1))


def _cells(rows: DataFrame, key: str, *by: str) -> DataFrame:
    """(by..., n_bits, word, mask): a row for each position of each key."""
    at = rows.select(*by, "n_bits", F.explode(_positions(F.col(key), F.col("n_bits"))).alias("at"))
    mask = F.expr("shiftleft(CAST(1 AS BIGINT), CAST(at & 63 AS INT))")
    return at.select(*by, "n_bits", F.shiftright("at", 6).alias("word"), mask.alias("mask"))


def month_filters(lookup: DataFrame, key: str = "passenger_id", month: str = "pickup_month") -> DataFrame:
    """(n_bits, word, bits, month) for the months of a lookup; null keys set nothing."""
    keys = lookup.select(month, key).where(F.col(key).isNotNull()).distinct()
    sizes = keys.groupBy(month).agg(F.count("*").alias("n"))
    bits = F.greatest(F.lit(_LEAST_BITS).cast("double"), F.pow(F.lit(2.0), F.ceil(F.log2(F.col("n") * BITS_PER_KEY))))
    sized = keys.join(F.broadcast(sizes.select(month, bits.cast("long").alias("n_bits"))), month)  # a row a month
    cells = _cells(sized, key, month).groupBy(month, "n_bits", "word").agg(F.bit_or("mask").alias("bits"))
    return cells.select("n_bits", "word", "bits", month)


def months_of(filters: DataFrame, subjects: DataFrame, key: str = "passenger_id", month: str = "pickup_month") -> DataFrame:
    """(month, subjects): months whose filter has all bits of a subject, and of how many."""
    sizes = [r["n_bits"] for r in filters.select("n_bits").distinct().collect()]  # powers of two: a few dozen
    if not sizes:
        return filters.select(month, F.lit(0).cast("long").alias("subjects")).limit(0)
    asked = subjects.select(F.col(key).alias("subject")).where(F.col("subject").isNotNull()).distinct()
    cells = _cells(asked.withColumn("n_bits", F.explode(F.lit(sizes).cast("array<long>"))), "subject", "subject")
    met = filters.join(cells, ["n_bits", "word"]).where(F.col("bits").bitwiseAND(F.col("mask")) != 0)
    full = met.groupBy(month, "subject").agg(F.count("*").alias("n")).where(F.col("n") == POSITIONS)
    return full.groupBy(month).agg(F.count("*").alias("subjects"))
