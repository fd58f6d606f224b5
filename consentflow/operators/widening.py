"""Type changes of a known column: the narrowest type that holds both.

Integers widen among each other, to decimals with room for their digits, and to
doubles; decimals to decimals with room for both, beyond 38 digits to doubles;
floats to doubles; dates to timestamps. Anything else (text against a number) is
an error that names the column: there is no type that keeps both.

Files written before a change keep their type. Spark's Parquet reader widens
most of these while it reads (``reads_as``); where it does not, the table is
rewritten once, and by then holds the wider type.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


def wider(a: T.DataType, b: T.DataType) -> T.DataType | None:
    """The narrowest type that holds both, or None."""
    if a == b:
        return a
    if type(a) in DIGITS and type(b) in DIGITS:
        return max(a, b, key=lambda t: DIGITS[type(t)])
    both = {type(a), type(b)}
    if both == {T.DateType, T.TimestampNTZType} or both == {T.DateType, T.TimestampType}:
        return a if isinstance(b, T.DateType) else b
    numbers = (*DIGITS, T.DecimalType, T.FloatType, T.DoubleType)
    if not both <= set(numbers):
        return None
    if both & {T.FloatType, T.DoubleType}:
        return T.DoubleType()
    whole, scale = (max(f(t) for t in (a, b)) for f in (
        lambda t: DIGITS.get(type(t)) or t.precision - t.scale, lambda t: getattr(t, "scale", 0)))
    return T.DecimalType(whole + scale, scale) if whole + scale <= 38 else T.DoubleType()


def reads_as(stored: T.DataType, wanted: T.DataType) -> bool:
    """Whether the Parquet reader gives a stored column as the wanted type."""
    if stored == wanted:
        return True
    if type(stored) in DIGITS:
        if type(wanted) in DIGITS:
            return DIGITS[type(stored)] < DIGITS[type(wanted)]
        if isinstance(wanted, T.DecimalType):
            return wanted.precision - wanted.scale >= DIGITS[type(stored)]
        return isinstance(wanted, T.DoubleType) and not isinstance(stored, T.LongType)
    if isinstance(stored, T.DecimalType) and isinstance(wanted, T.DecimalType):
        return wanted.scale >= stored.scale and wanted.precision - wanted.scale >= stored.precision - stored.scale
    return isinstance(stored, T.FloatType) and isinstance(wanted, T.DoubleType)


def merged_schema(known: T.StructType, batch: T.StructType) -> T.StructType:
    """``known`` with the batch's new columns, known ones as wide as needed."""
    new = {f.name: f.dataType for f in batch.fields}
    fields = []
    for f in known.fields:
        t = wider(f.dataType, new.get(f.name, f.dataType))
        if t is None:
            raise TypeError(f"column {f.name!r} cannot change from {f.dataType.simpleString()} to {new[f.name].simpleString()}")
        fields.append(T.StructField(f.name, t, True))
    names = {f.name for f in known.fields}
    return T.StructType(fields + [T.StructField(f.name, f.dataType, True) for f in batch.fields if f.name not in names])


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with the schema's types for the columns it has."""
    types = {f.name: f.dataType for f in schema.fields}
    return df.select(*[F.col(f.name).cast(types[f.name]).alias(f.name) if types.get(f.name, f.dataType) != f.dataType else F.col(f.name)
                       for f in df.schema.fields])
