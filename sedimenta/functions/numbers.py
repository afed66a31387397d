"""Rounding that gives the same digits on every engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, digits: int) -> Column:
    """Round by decimal digits, once, so that a binary tie such as 1.005 rounds up; values beyond 38 digits as doubles."""
    exact = F.round(value.try_cast("decimal(38,18)"), digits).cast("double")
    return F.coalesce(exact, F.round(value, digits))


def ratio_to_limit(value: Column, limit: Column) -> Column:
    """How many times the limit the value is, with two decimals."""
    return round_half_up(value / limit, 2)
