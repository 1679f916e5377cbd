"""The smallest type that holds the values of several types, and the conversion to it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Digits that the whole-number types need.
INTEGERS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
TIMES = (T.DateType, T.TimestampNTZType, T.TimestampType)
TEXTS = (T.StringType, T.CharType, T.VarcharType)
MOST_DIGITS = 38


def superset(types: Sequence[T.DataType]) -> T.DataType:
    """The type that can hold all values of ``types``; their order has no effect on it (but on the order of a struct's fields).

    Whole numbers take the widest of them, with decimals a decimal of enough digits on both sides, with floats or doubles
    a double (float beside bytes and shorts alone). A date beside timestamps becomes a timestamp. Unlike simple
    types, and decimals beyond 38 digits, become text. Lists, maps and structs are widened inside; a struct has the
    fields of all. They have no common type with anything else, nor have binary values.
    """
    found = [t for t in types if not isinstance(t, T.NullType)]
    if not found:
        return T.StringType() if not types else T.NullType()
    if all(isinstance(t, T.ArrayType) for t in found):
        return T.ArrayType(superset([t.elementType for t in found]))
    if all(isinstance(t, T.MapType) for t in found):
        return T.MapType(superset([t.keyType for t in found]), superset([t.valueType for t in found]))
    if all(isinstance(t, T.StructType) for t in found):
        fields: dict[str, list[T.StructField]] = {}
        for t in found:
            for f in t:
                fields.setdefault(f.name.lower(), []).append(f)
        return T.StructType([T.StructField(fs[0].name, superset([f.dataType for f in fs])) for fs in fields.values()])
    if all(t == found[0] for t in found):
        return found[0]
    simple = (*INTEGERS, T.DecimalType, T.FloatType, T.DoubleType, T.BooleanType, *TIMES, *TEXTS)
    odd = [t.simpleString() for t in found if not isinstance(t, simple)]
    if odd:
        raise ValueError(f"no common type for {' and '.join(sorted({t.simpleString() for t in found}))}")
    if all(isinstance(t, (*INTEGERS, T.DecimalType, T.FloatType, T.DoubleType)) for t in found):
        return _number(found)
    if all(isinstance(t, TIMES) for t in found):
        return max(found, key=lambda t: TIMES.index(type(t)))
    return T.StringType()


def _number(types: Sequence[T.DataType]) -> T.DataType:
    whole = [t for t in types if type(t) in INTEGERS]
    decimals = [t for t in types if isinstance(t, T.DecimalType)]
    if any(isinstance(t, T.DoubleType) for t in types):
        return T.DoubleType()
    if any(isinstance(t, T.FloatType) for t in types):
        fits = not decimals and all(isinstance(t, (T.ByteType, T.ShortType)) for t in whole)
        return T.FloatType() if fits else T.DoubleType()
    if not decimals:
        return max(whole, key=lambda t: INTEGERS[type(t)])
    scale = max(t.scale for t in decimals)
    digits = max([t.precision - t.scale for t in decimals] + [INTEGERS[type(t)] for t in whole])
    return T.DecimalType(digits + scale, scale) if digits + scale <= MOST_DIGITS else T.StringType()


def widened(value: Column, given: T.DataType, wanted: T.DataType) -> Column:
    """A column of type ``given`` as one of the type :func:`superset` makes of it. NULL stays NULL at every level."""
    if given == wanted:
        return value
    if isinstance(given, T.NullType):
        return F.lit(None).cast(wanted)
    if isinstance(given, T.ArrayType) and isinstance(wanted, T.ArrayType):
        return F.transform(value, lambda x: widened(x, given.elementType, wanted.elementType))
    if isinstance(given, T.MapType) and isinstance(wanted, T.MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.struct(
                widened(e["key"], given.keyType, wanted.keyType).alias("key"),
                widened(e["value"], given.valueType, wanted.valueType).alias("value"),
            ),
        )
        return F.map_from_entries(entries)
    if isinstance(given, T.StructType) and isinstance(wanted, T.StructType):
        own = {f.name.lower(): f for f in given}
        fields = [
            (widened(value[own[f.name.lower()].name], own[f.name.lower()].dataType, f.dataType) if f.name.lower() in own else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in wanted
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value.cast(wanted)
