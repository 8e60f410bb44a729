"""Period roll-ups of a time series and the change between periods."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def period_close(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    order: Sequence[str] | Column,
    closing: str,
    measures: Mapping[str, Column],
) -> DataFrame:
    """One row per ``keys`` with the last value and further aggregates.

    The last value is taken by ``max_by`` over ``order`` in the same grouping as
    the other measures. Each map task reduces its rows to one per group before
    the shuffle, so the shuffle grows with groups times tasks and not with the
    rows of a hot group, as a window over the rows would. Several ``order``
    columns make the aggregation sort its rows; one number, as ``packed_order``
    gives it, keeps it a hash aggregation.
    """
    by = order if isinstance(order, Column) else F.struct(*order)
    last = F.max_by(value, by).alias(closing)
    return df.groupBy(*keys).agg(last, *[m.alias(n) for n, m in measures.items()])


TIE_BITS = 20


def packed_order(seconds: Column, tie: Column) -> Column:
    """One whole number that sorts by epoch seconds, then by a small number.

    ``tie`` counts from 0 to 2**20 - 1, NULL as 0; another value would lose the
    order, so it ends the job (order by a struct of both then). With the value
    itself as ``tie`` the order leaves nothing open: rows that agree in it have
    the same value.
    """
    beyond = F.raise_error(F.concat(F.lit("a tie outside 0 to 2**20 - 1: "), tie.cast("string")))
    fits = F.when(tie.isNull(), 0).when(tie.between(0, (1 << TIE_BITS) - 1), tie).otherwise(beyond.cast("bigint"))
    return F.shiftleft(seconds.cast("bigint"), TIE_BITS) + fits.cast("bigint")


def change_vs_previous(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: str,
    change: str,
) -> DataFrame:
    """Add the difference to the previous period of the same ``keys``.

    Meant for rolled-up tables: a group then holds one row per period, which
    bounds it by the length of the calendar.
    """
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy(order))
    return df.withColumn(change, F.col(value) - before)


def repeat_for_ties(df: DataFrame, count: str, value: str, change: str) -> DataFrame:
    """Changes as a per-row ``lag`` followed by ``distinct`` would give them.

    When the difference is taken per row and not per period, the first row of a
    period is compared with the previous period and every further row with its
    own period. After ``distinct`` a period of several rows keeps both results.
    They follow from the rolled-up row, so the rows themselves are not needed.
    """
    first = F.col(change)
    further = F.col(value) - F.col(value)
    changes = F.when(
        F.col(count) > 1, F.array_distinct(F.array(first, further))
    ).otherwise(F.array(first))
    return df.withColumn(change, F.explode(changes))
