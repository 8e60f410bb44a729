"""Aggregate expressions shared by the statistics tables."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def row_count() -> Column:
    return F.count(F.lit(1))


def rate_pct(hit: Column, digits: int = 2) -> Column:
    """Percentage of a group's rows for which ``hit`` is true."""
    return F.round(F.count_if(hit) / row_count() * 100, digits)


def mean_rounded(value: Column | str) -> Column:
    """Mean rounded to a whole number (still a double)."""
    return F.round(F.avg(value), 0)
