"""Null handling, safe ratios and reproducible randomness as plain Spark expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH_BITS = 52
HASH_RANGE = float(1 << HASH_BITS)


def is_missing(df: DataFrame, name: str) -> Column:
    """NULL, or NaN where the type can hold one."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def known(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into NULL, so that aggregates skip it."""
    column = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(column), column)
    return column


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, 0.0 where the denominator is zero or unknown."""
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(0.0))


def hash52(seed: int | str, *keys: Column) -> Column:
    """52-bit integer from ``md5(seed|key|...)``; the same on any engine with md5."""
    text = F.concat_ws("|", F.lit(str(seed)), *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")


def uniform(seed: int | str, *keys: Column) -> Column:
    """Reproducible uniform number in [0, 1) for a row key."""
    return hash52(seed, *keys) / F.lit(HASH_RANGE)


def present(df: DataFrame, names: list[str]) -> list[str]:
    """The requested names the frame has, in request order."""
    have = set(df.columns)
    return [n for n in names if n in have]


NUMERIC_TYPES = (T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def numeric_columns(df: DataFrame, exclude: list[str] = ()) -> list[str]:
    """32/64-bit integer and float columns; booleans and narrow integers do not count."""
    skip = set(exclude)
    return [
        f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC_TYPES) and f.name not in skip
    ]


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def codes(*pairs: tuple[Column, str]) -> Column:
    """Array of the codes whose condition holds, in the order given."""
    return F.array_compact(F.array(*[F.when(cond, F.lit(code)) for cond, code in pairs]))
