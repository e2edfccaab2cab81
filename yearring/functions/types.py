"""How an archive's types grow with its source, without losing a digit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGERS = (T.ByteType(), T.ShortType(), T.IntegerType(), T.LongType())
_DIGITS = {T.ByteType(): 3, T.ShortType(): 5, T.IntegerType(): 10, T.LongType(): 19}


class TypeConflict(ValueError):
    """Neither type holds all values of the other."""


def merged(known: T.DataType, incoming: T.DataType, name: str) -> T.DataType:
    """The type that holds every value of both; structs grow by name, without regard to case."""
    if known == incoming or isinstance(incoming, T.NullType):
        return known
    if isinstance(known, T.NullType):
        return incoming
    pair = {known, incoming}
    if known in _INTEGERS and incoming in _INTEGERS:
        return max(known, incoming, key=_INTEGERS.index)
    if pair == {T.FloatType(), T.DoubleType()}:
        return T.DoubleType()
    if pair == {T.DateType(), T.TimestampNTZType()}:
        return T.TimestampNTZType()
    if all(isinstance(t, T.DecimalType) or t in _INTEGERS for t in pair):
        whole = max(t.precision - t.scale if isinstance(t, T.DecimalType) else _DIGITS[t] for t in pair)
        scale = max(t.scale if isinstance(t, T.DecimalType) else 0 for t in pair)
        if whole + scale <= 38:
            return T.DecimalType(whole + scale, scale)
    # Doubles hold every integer of 32 bits, but not of 64.
    if T.DoubleType() in pair and pair & set(_INTEGERS[:3]):
        return T.DoubleType()
    if isinstance(known, T.StructType) and isinstance(incoming, T.StructType):
        return evolve_schema(known, incoming, f"{name}.")
    if isinstance(known, T.ArrayType) and isinstance(incoming, T.ArrayType):
        return T.ArrayType(merged(known.elementType, incoming.elementType, f"{name}[]"))
    if isinstance(known, T.MapType) and isinstance(incoming, T.MapType):
        key, value = (merged(getattr(known, k), getattr(incoming, k), f"{name}{{}}") for k in ("keyType", "valueType"))
        return T.MapType(key, value)
    raise TypeConflict(f"column {name}: {incoming.simpleString()} does not fit {known.simpleString()}")


def evolve_schema(known: T.StructType, incoming: T.StructType, prefix: str = "") -> T.StructType:
    """Archive schema after a load: new columns go to the end, none is dropped, types only grow."""
    arriving = {f.name.lower(): f for f in incoming.fields}
    fields = []
    for f in known.fields:
        new = arriving.pop(f.name.lower(), None)
        fields.append(T.StructField(f.name, merged(f.dataType, new.dataType, prefix + f.name) if new else f.dataType))
    return T.StructType(fields + [T.StructField(f.name, f.dataType) for f in arriving.values()])


def fitted(col: Column, have: T.DataType, want: T.DataType) -> Column:
    """``col`` in a type that :func:`merged` found: structs by name, NULL for fields they lack."""
    if have == want:
        return col
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        own = {f.name.lower(): f for f in have.fields}
        fields = [
            (fitted(col[own[f.name.lower()].name], own[f.name.lower()].dataType, f.dataType) if f.name.lower() in own else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in want.fields
        ]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(col, lambda x: fitted(x, have.elementType, want.elementType))
    if isinstance(want, T.MapType) and isinstance(have, T.MapType):
        keyed = F.transform_keys(col, lambda k, _: fitted(k, have.keyType, want.keyType))
        return F.transform_values(keyed, lambda _, v: fitted(v, have.valueType, want.valueType))
    return col.cast(want)


def conform(df: DataFrame, struct: T.StructType) -> DataFrame:
    """By name, without regard to case: the archive's types, NULL for columns the source lost."""
    own = {f.name.lower(): f for f in df.schema.fields}

    def column(f: T.StructField) -> Column:
        mine = own.get(f.name.lower())
        found = fitted(F.col(f"`{mine.name}`"), mine.dataType, f.dataType) if mine else F.lit(None).cast(f.dataType)
        return found.alias(f.name)

    return df.select(*[column(f) for f in struct.fields if f.name != "_archive_id"])
