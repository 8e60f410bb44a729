"""Expected but missing periods per entity."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BITS = 63


def coverage_gaps(
    entities: DataFrame | None,
    landed: DataFrame,
    key: str,
    period: str,
    expected: Sequence,
) -> DataFrame:
    """(key, period) for every expected period without a landed row.

    Periods are numbered and the landed ones of a key are or-ed into bit masks
    of fixed width, so entities and landed rows meet in one hash aggregation
    with map-side partial results. With ``entities`` None the landed rows name
    them, and are scanned once. Neither the product of entities and periods
    nor a join is built, and a key's state does not grow with its rows.
    """
    periods = list(dict.fromkeys(expected))
    number = F.array_position(F.array(*[F.lit(p) for p in periods]), F.col(period)) - 1
    number = F.when(number >= 0, number.cast("int"))
    if entities is None:
        rows = landed.select(key, F.lit(True).alias("_entity"), number.alias("_number"))
    else:
        known = entities.select(
            key, F.lit(True).alias("_entity"), F.lit(None).cast("int").alias("_number")
        )
        seen = landed.filter(F.col(period).isin(*periods)).select(
            key, F.lit(False).alias("_entity"), number.alias("_number")
        )
        rows = known.unionAll(seen)
    one = F.lit(1).cast("bigint")
    starts = range(0, len(periods), _BITS)
    masks = [
        F.bit_or(
            F.when(
                F.col("_number").between(start, start + _BITS - 1),
                F.call_function("shiftleft", one, F.col("_number") - start),
            )
        ).alias(f"_mask{start}")
        for start in starts
    ]
    per_key = rows.groupBy(key).agg(F.bool_or("_entity").alias("_known"), *masks)
    flags = [
        F.when(
            F.coalesce(F.col(f"_mask{i - i % _BITS}"), F.lit(0)).bitwiseAND(1 << i % _BITS) == 0,
            F.lit(p),
        )
        for i, p in enumerate(periods)
    ]
    missing = F.explode(F.array_compact(F.array(*flags)))
    return per_key.filter("_known").select(key, missing.alias(period))
