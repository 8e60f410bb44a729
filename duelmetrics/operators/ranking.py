"""Ordered picks: top rows, best row, first appearances."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def descending(column: str) -> Column:
    return F.col(column).desc_nulls_last()


def ordered(df: DataFrame, down: Sequence[str] = (), up: Sequence[str] = ()) -> DataFrame:
    """Sort by ``down`` from the greatest, then by ``up`` from the smallest."""
    return df.orderBy(*[descending(c) for c in down], *[F.col(c).asc_nulls_first() for c in up])


def top_rows(df: DataFrame, n: int, down: Sequence[str], up: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows of that order; each task keeps only ``n`` rows."""
    return ordered(df, down, up).limit(n)


def argmax_row(df: DataFrame, metric: str, down: Sequence[str], up: Sequence[str]) -> DataFrame:
    """The row with the greatest ``metric``; rows without it do not compete."""
    return top_rows(df.filter(F.col(metric).isNotNull()), 1, [metric, *down], up)


def rank_struct(down: Sequence[str], up: Sequence[str]) -> Column:
    """A struct that sorts like ``ordered``: NULL last in ``down``, first in ``up``.

    ``down`` columns must be numeric.
    """
    keys = []
    for i, c in enumerate(down):
        keys += [F.col(c).isNull().alias(f"_none{i}"), F.negate(F.col(c)).alias(f"_down{i}")]
    return F.struct(*keys, *[F.col(c).alias(f"_up{i}") for i, c in enumerate(up)])


def argmax_value(value: str, metric: str, down: Sequence[str], up: Sequence[str]) -> Column:
    """Aggregate form of ``argmax_row``, so several fit into one pass.

    ``down`` columns must be numeric. NULL when no row has the metric.
    """
    rank = rank_struct([metric, *down], up)
    return F.min_by(value, F.when(F.col(metric).isNotNull(), rank))


def _first_seen(df: DataFrame, column: str, down: Sequence[str], up: Sequence[str]) -> DataFrame:
    """Each value of ``column`` with the rank of its first row; NULL is a value too.

    Rows are grouped before they are ordered, so only one row per value takes
    part in a sort.
    """
    return df.groupBy(column).agg(F.min(rank_struct(down, up)).alias("_seen"))


def options_in_order(
    df: DataFrame, column: str, down: Sequence[str] = (), up: Sequence[str] = ()
) -> DataFrame:
    """The different values of ``column`` as they appear in the given row order.

    ``position`` counts from 1; it is numbered over one row per value.
    """
    seen = _first_seen(df, column, down, up)
    position = F.row_number().over(Window.orderBy("_seen", column)).cast("bigint")
    return seen.select(column, position.alias("position")).orderBy("position")


def first_appearances(
    df: DataFrame, column: str, n: int, down: Sequence[str] = (), up: Sequence[str] = ()
) -> DataFrame:
    """The first ``n`` different values of ``column`` in the given row order."""
    return _first_seen(df, column, down, up).orderBy("_seen", column).limit(n).select(column)
