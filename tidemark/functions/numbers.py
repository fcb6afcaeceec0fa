"""Numeric expressions with the same result on every run and partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_number(column: Column | str) -> Column:
    """Text or number to double; blank, unparseable, NaN and infinite become null."""
    text = F.trim(_col(column).cast("string"))
    # A trailing type letter is Java syntax ("1.5d"), not a number in a data file.
    java_literal = text.rlike("^[0-9.eE+-]+[fFdD]$")
    number = F.when(~java_literal, text).try_cast("double")
    return F.when(F.abs(number) < float("inf"), number)


def round_half_up(value: Column | str, digits: int) -> Column:
    """Round through a decimal, so binary noise cannot decide a tie."""
    return F.round(_col(value).cast("decimal(30,10)"), digits).cast("double")


def exact_sum(value: Column | str, scale: int = 6) -> Column:
    """Sum doubles as decimals: the order of addition cannot change the total."""
    return F.sum(_col(value).cast(f"decimal(28,{scale})")).cast("double")


def exact_avg(value: Column | str, scale: int = 6) -> Column:
    """Mean over the non-null values, from an exact sum."""
    return F.try_divide(exact_sum(value, scale), F.count(_col(value)).cast("double"))


def share(condition: Column) -> Column:
    """Fraction of all rows for which the condition is true (null counts as false)."""
    return F.try_divide(F.count_if(condition).cast("double"), F.count(F.lit(1)).cast("double"))


def flag(condition: Column) -> Column:
    """Condition as 0/1, null counting as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def clip(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def ratio_to(value: Column, top: Column) -> Column:
    """value / top clamped to [0, 1]; 0 when top is 0."""
    return clip(F.coalesce(F.try_divide(value, top), F.lit(0.0)), 0.0, 1.0)


def _col(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
