"""Rows to columns, columns to rows, shares of a total."""

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_metrics(
    df: DataFrame,
    key: str,
    by: str,
    values: Sequence[str],
    metrics: Mapping[str, str],
) -> DataFrame:
    """``<value>_<name>`` columns, one row per ``key``.

    ``metrics`` maps an output name to a column of ``df``. ``(key, by)`` must be
    unique, as it is after grouping by both. The value list is explicit, so no
    job runs to find it, and one aggregation replaces a filter and a join per
    value.
    """
    cells = [
        F.max(F.when(F.col(by) == value, F.col(column))).alias(f"{value}_{name}")
        for value in values
        for name, column in metrics.items()
    ]
    return df.filter(F.col(by).isin(*values)).groupBy(key).agg(*cells)


def long_form(
    df: DataFrame,
    ids: Sequence[str],
    columns: Sequence[str],
    name: str,
    value: str,
) -> DataFrame:
    """One row per id and column, rows with a missing part left out."""
    return df.unpivot(list(ids), list(columns), name, value).na.drop("any")


def share_of_total(df: DataFrame, value: str, share: str) -> DataFrame:
    """Add each row's part of the column total.

    The total is a scalar subquery: rows stay where they are, where a window
    without partitions would bring all of them to one task.
    """
    total = df.agg(F.sum(value).cast("double")).scalar()
    return df.withColumn(share, F.try_divide(F.col(value).cast("double"), total))
