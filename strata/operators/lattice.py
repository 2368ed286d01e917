"""Drifted types: a lattice that says what stored and landed types widen to, and rows that cannot be cast.

int < long < decimal < double < string, date < timestamp < string, boolean < string; decimals widen to
hold the digits of both, and to double beyond 38 of them. Two types with no common one below string
meet there. A table keeps its type where the landed one is below it; else the merged schema is what
later months are read with, and ``rewritten`` names the columns whose stored files have to be
written anew because Parquet readers do not widen them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Integers as decimals: digits of the greatest value.
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_INTEGERS = list(_DIGITS)


def widen(a: T.DataType, b: T.DataType) -> T.DataType:
    """The least type that holds the values of both."""
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    whole = [x for x in (a, b) if type(x) in _DIGITS]
    if len(whole) == 2:
        return max(whole, key=lambda x: _INTEGERS.index(type(x)))
    numbers = (*_INTEGERS, T.DecimalType, T.FloatType, T.DoubleType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        if isinstance(a, (T.FloatType, T.DoubleType)) or isinstance(b, (T.FloatType, T.DoubleType)):
            return T.DoubleType()
        x, y = ((t.precision - t.scale, t.scale) if isinstance(t, T.DecimalType) else (_DIGITS[type(t)], 0) for t in (a, b))
        before, after = max(x[0], y[0]), max(x[1], y[1])
        return T.DecimalType(before + after, after) if before + after <= 38 else T.DoubleType()
    times = (T.DateType, T.TimestampNTZType, T.TimestampType)
    if isinstance(a, times) and isinstance(b, times):
        return max((a, b), key=lambda x: times.index(type(x)))
    return T.StringType()


def merge_schema(stored: T.StructType, landed: T.StructType) -> T.StructType:
    """Stored columns in their order, widened by the landed ones of the same name (in any case), then new ones."""
    by_name = {f.name.lower(): f for f in landed.fields}
    have = {f.name.lower() for f in stored.fields}
    fields = [T.StructField(f.name, widen(f.dataType, by_name[f.name.lower()].dataType) if f.name.lower() in by_name else f.dataType, True) for f in stored.fields]
    return T.StructType(fields + [T.StructField(f.name, f.dataType, True) for f in landed.fields if f.name.lower() not in have])


def rewritten(stored: T.StructType, merged: T.StructType) -> list[str]:
    """Columns of stored files that a read with the merged schema cannot widen."""
    to = {f.name: f.dataType for f in merged.fields}

    def readable(a: T.DataType, b: T.DataType) -> bool:
        if a == b or type(a) in _DIGITS and (type(b) in _DIGITS or isinstance(b, T.DoubleType) and not isinstance(a, T.LongType)):
            return True
        if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
            return b.scale >= a.scale and b.precision - b.scale >= a.precision - a.scale
        return isinstance(a, T.FloatType) and isinstance(b, T.DoubleType)

    return [f.name for f in stored.fields if not readable(f.dataType, to[f.name])]


def cast_failures(df: DataFrame, types: dict[str, T.DataType]) -> Column:
    """Array of "column: value" for the values of a row that are not null but cannot be cast to their type."""
    present = {c.lower(): c for c in df.columns}
    found = []
    for name, kind in types.items():
        if name.lower() not in present:
            continue
        c = F.col(f"`{present[name.lower()]}`")
        if df.schema[present[name.lower()]].dataType != kind:
            found.append(F.when(c.isNotNull() & c.try_cast(kind).isNull(), F.concat(F.lit(f"{name}: "), c.cast("string"))))
    none = F.array().cast("array<string>")
    return F.filter(F.array(*found), lambda x: x.isNotNull()) if found else none


def with_rejects(df: DataFrame, types: dict[str, T.DataType]) -> DataFrame:
    """``df`` with _reject_reason and _original (the row as JSON), both NULL where every value can be cast."""
    bad = cast_failures(df, types)
    columns = [c for c in df.columns if c.lower() in {n.lower() for n in types}]
    some = F.size("_bad") > 0
    out = df.withColumn("_bad", bad)
    return out.withColumns({
        "_reject_reason": F.when(some, F.array_join("_bad", "; ")),
        "_original": F.when(some, F.to_json(F.struct(*(F.col(f"`{c}`") for c in columns)))),
    }).drop("_bad")
