"""Casts from dirty text. Bad text gives NULL and never fails the job."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def int_or_null(c: Column) -> Column:
    return c.try_cast("int")


def long_or_null(c: Column) -> Column:
    return c.try_cast("bigint")


def double_or_null(c: Column) -> Column:
    return c.try_cast("double")


def whole_part(c: Column) -> Column:
    """``"4.5"`` becomes 4 and ``"-4.5"`` -4: cut toward zero; NULL where no INT holds it."""
    number = c.try_cast("double")
    whole = F.when(number < 0, F.ceil(number)).otherwise(F.floor(number))
    return F.when(F.abs(number) < F.lit(2.0**31), whole.try_cast("int"))


def flag_or_null(c: Column) -> Column:
    """Numeric code made of digits only; a sign, a point or any letter gives NULL."""
    return F.when(c.rlike(r"\A[0-9]+\z"), c.try_cast("int"))
