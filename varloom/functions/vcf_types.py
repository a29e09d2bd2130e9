"""What the variant text format can hold, and values made to fit it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from varloom.functions.nulls import cap_int32

_NUMBERS = (T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def is_number(t: T.DataType) -> bool:
    return isinstance(t, _NUMBERS)


def fits_info(t: T.DataType) -> bool:
    """Whether an INFO field can hold the type as it is."""
    return is_number(t) or isinstance(t, (T.StringType, T.BooleanType)) or (isinstance(t, T.ArrayType) and fits_info(t.elementType))


def piped(values: Column) -> Column:
    """|a|b|c, the old allele-specific form."""
    return F.concat(F.lit("|"), F.array_join(values.cast("array<string>"), "|"))


def fit_info(df: DataFrame, info: str = "info", pipe: tuple[str, ...] = ()) -> DataFrame:
    """The info struct with longs cut to 32 bits, strand tables as text (SB a flat list, AS_SB_TABLE a,b|c,d), and the
    named fields delimited by pipes."""
    fields = []
    for f in df.schema[info].dataType.fields:
        x, t = F.col(f"{info}.`{f.name}`"), f.dataType
        if f.name == "AS_SB_TABLE":
            x = F.array_join(F.transform(x, lambda y: F.array_join(y.cast("array<string>"), ",")), "|")
        elif f.name == "SB" and isinstance(t, T.ArrayType) and isinstance(t.elementType, T.ArrayType):
            x = F.flatten(x)
        elif f.name in pipe:
            x = piped(x)
        elif isinstance(t, T.LongType):
            x = cap_int32(x)
        elif isinstance(t, T.ArrayType) and isinstance(t.elementType, T.LongType):
            x = F.transform(x, cap_int32)
        fields.append(x.alias(f.name))
    return df.withColumn(info, F.struct(*fields))
