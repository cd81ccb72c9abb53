"""Which column types may be stored in which: only where no value can change.

Spark's own insert casts (2.9 into an int column is stored as 2). Loads here
refuse such rows and widen the others: an int fits a bigint, a float a double,
a decimal one with as many digits on either side of the point.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    NullType,
    ShortType,
    StructField,
    StructType,
    TimestampNTZType,
)

from vetline.functions.checks import col_ref

#: Decimal digits that hold every value of an integral type.
_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}
#: Integral types whose every value a floating type holds exactly.
_EXACT = {FloatType: (ByteType, ShortType), DoubleType: (ByteType, ShortType, IntegerType, FloatType)}


def fits(have: DataType, want: DataType) -> bool:
    """Whether every value of type ``have`` can be stored as ``want`` unchanged."""
    if have == want or isinstance(have, NullType):
        return True
    if isinstance(have, ArrayType) and isinstance(want, ArrayType):
        return fits(have.elementType, want.elementType)
    if isinstance(have, MapType) and isinstance(want, MapType):
        return fits(have.keyType, want.keyType) and fits(have.valueType, want.valueType)
    if isinstance(have, StructType) and isinstance(want, StructType):
        return have.fieldNames() == want.fieldNames() and all(fits(a.dataType, b.dataType) for a, b in zip(have, want))
    if isinstance(want, DecimalType):
        whole = want.precision - want.scale
        if isinstance(have, DecimalType):
            return want.scale >= have.scale and whole >= have.precision - have.scale
        return whole >= _DIGITS.get(type(have), 99)
    if type(have) in _DIGITS and type(want) in _DIGITS:
        return _DIGITS[type(have)] <= _DIGITS[type(want)]
    if type(want) in _EXACT:
        return isinstance(have, _EXACT[type(want)])
    return isinstance(have, DateType) and isinstance(want, TimestampNTZType)


def misfits(pairs: Sequence[tuple[StructField, StructField]]) -> list[str]:
    """Names, with both types, of the columns (have, want) that do not fit."""
    return [f"'{want.name}' ({have.dataType.simpleString()} into {want.dataType.simpleString()})"
            for have, want in pairs if not fits(have.dataType, want.dataType)]


def widened(df: DataFrame, wanted: StructType, target: str) -> DataFrame:
    """``df`` with the columns that ``wanted`` has too in its types; ``ValueError`` naming all that do not fit."""
    kinds = {f.name: f for f in wanted.fields}
    faults = misfits([(f, kinds[f.name]) for f in df.schema.fields if f.name in kinds])
    if faults:
        raise ValueError(f"Rows for {target} have other types than it: {', '.join(faults)}")
    return df.select(*[col_ref(f.name).cast(kinds[f.name].dataType).alias(f.name) if f.name in kinds and kinds[f.name].dataType != f.dataType
                       else col_ref(f.name) for f in df.schema.fields])
