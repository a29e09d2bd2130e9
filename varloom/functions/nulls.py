"""Missing-value rules that differ from SQL's: a missing condition gives a missing result."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strict_if(test: Column, then, other) -> Column:
    """then or other; NULL where the test is NULL (SQL's CASE would take the other branch)."""
    return F.when(test, then).when(~test, other)


def strict_case(branches: list[tuple[Column, object]], default) -> Column:
    """The first branch whose test holds; NULL as soon as a test before it is NULL."""
    out = F.lit(default) if not isinstance(default, Column) else default
    for test, value in reversed(branches):
        out = strict_if(test, value, out)
    return out


def or_missing(test: Column, value) -> Column:
    return F.when(test, value)


def fdiv(a: Column, b: Column) -> Column:
    """IEEE division of doubles: x/0 is an infinity or NaN; SQL's ANSI mode would fail."""
    a, b = a.cast("double"), b.cast("double")
    zero = F.when(a > 0, F.lit(float("inf"))).when(a < 0, F.lit(float("-inf"))).when(a.isNotNull(), F.lit(float("nan")))
    return F.when(b == 0, zero).otherwise(F.try_divide(a, b))


def at_least(x: Column, bound: float) -> Column:
    """x >= bound with NaN as false; Spark orders NaN above all numbers."""
    return F.when(F.isnan(x), F.lit(False)).otherwise(x >= bound)


def cap_int32(x: Column) -> Column:
    """Cast to int with values above its range cut to the greatest; below it the cast fails, as in the file format's writer."""
    return F.least(F.lit(2147483647).cast("long"), x.cast("long")).cast("int")


def sorted_set(x: Column) -> Column:
    """A set: distinct elements in order."""
    return F.array_sort(F.array_distinct(x))


def let(value: Column, f) -> Column:
    """f(value) with the value computed once: a lambda's variable stands for it, so that expressions stay small."""
    return F.get(F.transform(F.array(value), f), F.lit(0))
