"""One sort key over several columns, so that files narrow each of them down."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bits of each column's rank; 2**BITS ranks.
BITS = 6


def as_number(df: DataFrame, name: str) -> Column:
    """A number that grows with the value; of a text its first seven bytes, which is all that ranks need."""
    kind, value = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.StringType):
        head = F.rpad(F.hex(F.substring(value.cast("binary"), 1, 7)), 14, "0")
        return F.conv(head, 16, 10).cast("bigint").cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(value).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_diff("MICROSECOND", epoch, value).cast("double")
    return value.cast("double")


def interleaved(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """The bits of the columns' ranks in turn, highest first (a Z-order).

    Ranks are places among the column's quantiles, found by one aggregation, so
    they split the rows evenly whatever the values are; a frequent value keeps one
    rank. NULL comes first. The quantiles are approximate, and only place rows.
    """
    if bits * len(columns) > 62:
        raise ValueError("the ranks of so many columns do not fit in a long")
    parts = [k / (1 << bits) for k in range(1, 1 << bits)]
    cuts = df.agg(
        *[F.percentile_approx(as_number(df, c), F.array(*map(F.lit, parts)), 10_000).alias(f"c{j}") for j, c in enumerate(columns)]
    ).first()
    key = F.lit(0).cast("bigint")
    for j, name in enumerate(columns):
        borders = sorted(set(cuts[j] or []))
        value = as_number(df, name)
        rank = F.lit(0)
        if borders:
            rank = F.when(value.isNull(), 0).otherwise(
                F.size(F.filter(F.array(*map(F.lit, borders)), lambda b: b <= value))
            )
        for i in range(bits):
            bit = F.shiftright(rank, i).cast("bigint").bitwiseAND(F.lit(1).cast("bigint"))
            key = key + F.shiftleft(bit, i * len(columns) + len(columns) - 1 - j)
    return key


def spread_evenly(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> DataFrame:
    """The rows in ranges of the interleaved key, each in its order.

    A range partitioning samples the key to cut ranges of equal size; equal keys
    share a range, and there are ``2 ** (bits * columns)`` keys at most, so raise
    ``bits`` where ranges come out uneven.
    """
    key = "_interleaved"
    keyed = df.withColumn(key, interleaved(df, columns, bits))
    return keyed.repartitionByRange(key).sortWithinPartitions(key).drop(key)
