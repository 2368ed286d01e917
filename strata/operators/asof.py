"""As-of join of facts with dimension versions, for histories of any size and hot keys.

Facts and versions of a key are put in one order of time and the last version is carried forward.
Time is cut into slices: one small table has the last version of each key and slice, a window over
it gives what each slice starts with, and that carry row opens the slice. A key with a third of all
facts so is as many groups as it has slices, nothing is broadcast, and no group holds more than a
key's rows of one slice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Seconds of a slice: a day.
SLICE = 86_400


def as_of(
    facts: DataFrame, history: DataFrame, fact_key: str, dim_key: str, at: str, dim_cols: list[str], slice_seconds: int = SLICE
) -> DataFrame:
    """``facts`` with valid_from, valid_to and ``dim_`` columns of the version valid at ``facts[at]``.

    The same rows as :func:`strata.operators.scd2.point_in_time` for a history whose versions of a key
    do not overlap: valid_from <= t < valid_to, an open end as NULL. Facts without a key, a time or a
    version keep NULLs; versions without valid_from are never valid.
    """

    def sliced(time: str):
        return F.floor(F.unix_timestamp(F.col(time)) / slice_seconds)

    names = ["valid_from", "valid_to", *dim_cols]
    version = F.struct(*names)
    usable = F.col(fact_key).isNotNull() & F.col(at).isNotNull()
    f = facts.where(usable).select(
        F.col(fact_key).alias("_key"), sliced(at).alias("_slice"), F.col(at).alias("_at"), F.lit(2).alias("_kind"), F.struct(*facts.columns).alias("_row")
    )
    h = history.where(F.col("valid_from").isNotNull() & F.col(dim_key).isNotNull()).select(
        F.col(dim_key).alias("_key"), sliced("valid_from").alias("_slice"), F.col("valid_from").alias("_at"), F.lit(1).alias("_kind"), version.alias("_version")
    )
    # What each slice of a key starts with: the last version of the slices before it.
    ends = h.groupBy("_key", "_slice").agg(F.max(F.struct("_at", "_version")).alias("_last"))
    asked = f.groupBy("_key", "_slice").agg(F.count(F.lit(1)).alias("_facts"))
    before = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = ends.join(asked, ["_key", "_slice"], "full_outer").withColumn("_carry", F.last("_last", ignorenulls=True).over(before))
    carry = carry.where("_facts IS NOT NULL AND _carry IS NOT NULL").select(
        "_key", "_slice", F.col("_carry._at").alias("_at"), F.lit(0).alias("_kind"), F.col("_carry._version").alias("_version")
    )
    events = f.unionByName(h, allowMissingColumns=True).unionByName(carry, allowMissingColumns=True)
    order = Window.partitionBy("_key", "_slice").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = events.withColumn("_version", F.last("_version", ignorenulls=True).over(order)).where("_kind = 2")
    valid = F.col("_version.valid_to").isNull() | (F.col("_at") < F.col("_version.valid_to"))
    out = [c if c.startswith("valid_") else f"dim_{c}" for c in names]
    matched = found.select("_row.*", *(F.when(valid, F.col("_version").getField(c)).alias(n) for c, n in zip(names, out, strict=True)))
    types = {f.name: f.dataType for f in history.schema.fields}
    rest = facts.where(~usable).select(*facts.columns, *(F.lit(None).cast(types[c]).alias(n) for c, n in zip(names, out, strict=True)))
    return matched.unionByName(rest)
