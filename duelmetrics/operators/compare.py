"""Two entities side by side."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelmetrics.functions.text import leader_arrow, signed_delta, whole_number
from duelmetrics.operators.ranking import rank_struct


def compare_entities(
    df: DataFrame,
    key: str,
    first: str,
    second: str,
    metrics: Sequence[tuple[str, str, str]],
    down: Sequence[str] = (),
) -> DataFrame:
    """One row per metric that both entities have.

    ``metrics`` lists (label, column, unit). The two rows are picked by one
    aggregation over the rows of the two keys (the filter reaches the scan), and
    the metrics are unfolded from that single row; no join takes place. If a key
    has several rows the first in ``down`` order is used.
    """
    columns = [column for _, column, _ in metrics]
    cells = F.struct(*[F.col(c).cast("double").alias(c) for c in columns])
    rank = rank_struct(down, columns)
    pair = df.filter(F.col(key).isin(first, second)).agg(
        F.min_by(cells, F.when(F.col(key) == first, rank)).alias("a"),
        F.min_by(cells, F.when(F.col(key) == second, rank)).alias("b"),
    )
    unfolded = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(label).alias("metric"),
                    F.lit(unit).alias("unit"),
                    F.col(f"a.{column}").alias("value_1"),
                    F.col(f"b.{column}").alias("value_2"),
                )
                for label, column, unit in metrics
            ]
        )
    )
    one, two, unit = F.col("value_1"), F.col("value_2"), F.col("unit")
    return (
        pair.select(unfolded)
        .filter(one.isNotNull() & two.isNotNull())
        .select(
            "metric",
            "value_1",
            "value_2",
            (one - two).alias("delta"),
            leader_arrow(one, two).alias("winner"),
            whole_number(one, unit).alias("text_1"),
            whole_number(two, unit).alias("text_2"),
            signed_delta(one - two, unit).alias("delta_1"),
            signed_delta(two - one, unit).alias("delta_2"),
        )
    )
