"""Two-sided records seen from one side."""

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def perspective(
    df: DataFrame,
    me: str,
    first: str,
    fields: Mapping[str, tuple[str, str]],
    side: str,
    labels: tuple[str, str],
) -> DataFrame:
    """Add ``side`` and, per field, the value of the side that ``me`` is on.

    ``fields`` maps an output column to (column when ``me`` is the first side,
    column otherwise). Names are compared without case. Whatever does not equal
    the first side counts as the second, a missing name included.
    """
    flagged = df.withColumn("_first", F.lower(first) == F.lower(me))
    on_first = F.col("_first")
    added = {side: F.when(on_first, labels[0]).otherwise(labels[1])}
    for name, (mine, other) in fields.items():
        added[name] = F.when(on_first, F.col(mine)).otherwise(F.col(other))
    return flagged.withColumns(added).drop("_first")
