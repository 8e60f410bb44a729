"""Freshness, volume, profile and change of tables."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from duelmetrics import fixed_values as fixed
from duelmetrics.functions.clock import utc_day, utc_from_iso
from duelmetrics.functions.measures import row_count
from duelmetrics.quality.checks import row_count_above, run_suite


def freshness(
    df: DataFrame,
    loaded_at: str,
    as_of: str,
    warn_hours: int = fixed.FRESHNESS_WARN_HOURS,
    error_hours: int = fixed.FRESHNESS_ERROR_HOURS,
) -> DataFrame:
    """Age of the newest row at ``as_of`` and what follows from it.

    ``loaded_at`` holds ISO text; without an offset it is UTC. An age equal to a limit is still within
    it. A table without a readable load time is an error.
    """
    seconds = F.timestamp_diff("SECOND", F.col("loaded_until"), utc_from_iso(F.lit(as_of)))
    age = F.col("age_seconds")
    status = (
        F.when(age.isNull() | (age > error_hours * 3600), "error")
        .when(age > warn_hours * 3600, "warn")
        .otherwise("pass")
    )
    return (
        df.agg(F.max(utc_from_iso(F.col(loaded_at))).alias("loaded_until"))
        .withColumn("age_seconds", seconds)
        .withColumn("status", status)
    )


def volume_check(
    df: DataFrame, suite: str, more_than: int = fixed.MIN_RAW_GAMES
) -> DataFrame:
    """One check row: the table has more rows than ``more_than``."""
    return run_suite(df, suite, [row_count_above(more_than)])


def table_profile(df: DataFrame, entity: str, at: str) -> DataFrame:
    """Rows, different entities, first and last instant."""
    return df.agg(
        row_count().alias("total_games"),
        F.count_distinct(entity).alias("unique_players"),
        F.min(at).alias("earliest_game"),
        F.max(at).alias("latest_game"),
    )


def daily_volume(df: DataFrame, keys: Sequence[str], at: str) -> DataFrame:
    """Rows per key and day; a gap is one row, its first day, with no rows.

    ``days`` is the number of days a row stands for: 1, or the length of a gap.
    There are at most two rows per counted day, however long a gap is.
    """
    counts = (
        df.groupBy(*keys, utc_day(F.col(at)).alias("day"))
        .agg(row_count().alias("n_rows"))
        .filter(F.col("day").isNotNull())
    )
    following = F.lead("day").over(Window.partitionBy(*keys).orderBy("day"))
    gap = F.datediff("_following", "day") - 1
    own = F.struct(F.col("day"), F.col("n_rows"), F.lit(1).alias("days"))
    empty = F.struct(
        F.date_add("day", 1).alias("day"),
        F.lit(0).cast("bigint").alias("n_rows"),
        gap.alias("days"),
    )
    both = F.when(gap > 0, F.array(own, empty)).otherwise(F.array(own))
    return counts.withColumn("_following", following).select(*keys, F.inline(both))


def volume_anomaly(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    trailing: int = 7,
    deviations: float = 3.0,
) -> DataFrame:
    """Days whose volume is far from the mean of the ``trailing`` days before.

    Days without rows count as zero; of a gap the first day is judged. A day is
    judged once that many days are there; with a constant history any change is
    an anomaly. The exact mean and deviation decide, rounded ones are shown. The
    window runs over the daily counts and sums them and their squares, so days
    without rows need no row.
    """
    number = F.datediff("day", F.lit("1970-01-01").cast("date"))
    own = Window.partitionBy(*keys)
    before = own.orderBy("_number").rangeBetween(-trailing, -1)
    total = F.coalesce(F.sum("n_rows").over(before), F.lit(0))
    squares = F.coalesce(F.sum(F.col("n_rows") * F.col("n_rows")).over(before), F.lit(0))
    summed = daily_volume(df, keys, at).withColumn("_number", number).withColumns(
        {
            "_sum": total,
            "_squares": squares,
            "_age": F.col("_number") - F.min("_number").over(own),
        }
    )
    # whole numbers until the last division and root, so nothing cancels
    mean = F.col("_sum") / trailing
    spread = F.col("_squares") * trailing - F.col("_sum") * F.col("_sum")
    deviation = F.sqrt(spread / (trailing * (trailing - 1)))
    far = F.abs(F.col("n_rows") - mean) > deviations * deviation
    known = F.col("_age") >= trailing
    return summed.select(
        *keys,
        "day",
        "n_rows",
        "days",
        F.when(known, F.round(mean, 4)).alias("trailing_mean"),
        F.when(known, F.round(deviation, 4)).alias("trailing_stddev"),
        (known & far).alias("is_anomaly"),
    )


def seasonal_anomaly(
    df: DataFrame,
    keys: Sequence[str],
    at: str,
    weeks: int = 4,
    deviations: float = 4.0,
) -> DataFrame:
    """Days whose volume is far from what the same weekday had in the ``weeks`` before.

    Usual is the median of those weeks, far is more than ``deviations`` times the
    median deviation from it (scaled to a standard deviation), or the square root
    of the median where that is larger, as counts vary by chance. Medians don't
    follow a single spike, and a weekly pattern is usual. Days without rows count
    as zero; of a gap the first day is judged, once ``weeks`` weeks are there. The
    window runs over daily counts and holds at most ``weeks`` of them a row.
    """
    number = F.datediff("day", F.lit("1970-01-01").cast("date"))
    own = Window.partitionBy(*keys)
    before = Window.partitionBy(*keys, F.col("_number") % 7).orderBy("_number").rangeBetween(-7 * weeks, -1)
    seen = daily_volume(df, keys, at).withColumn("_number", number).withColumns(
        {"_seen": F.collect_list("n_rows").over(before), "_age": F.col("_number") - F.min("_number").over(own)}
    )
    missing = F.array_repeat(F.lit(0).cast("bigint"), F.lit(weeks) - F.size("_seen"))
    middle, parity = (weeks - 1) // 2, 1 - weeks % 2

    def median(values: Column) -> Column:
        ordered = F.array_sort(values)
        return (ordered[middle] + ordered[middle + parity]) / 2

    judged = (
        seen.withColumn("_all", F.concat("_seen", missing))
        .withColumn("usual", median(F.col("_all")))
        .withColumn("_off", median(F.transform("_all", lambda n: F.abs(n - F.col("usual")))))
        .withColumn("scale", F.greatest(F.col("_off") * 1.4826, F.sqrt("usual")))
    )
    far = F.abs(F.col("n_rows") - F.col("usual")) > F.col("scale") * deviations
    known = F.col("_age") >= 7 * weeks
    return judged.select(
        *keys,
        "day",
        "n_rows",
        "days",
        F.when(known, F.col("usual")).alias("usual"),
        F.when(known, F.round("scale", 4)).alias("scale"),
        (known & far).alias("is_anomaly"),
    )


def _column_profile(df: DataFrame, label: str) -> DataFrame:
    """(column_name, type, null share, distinct count) from one aggregation."""
    fields = df.schema.fields
    row = df.agg(
        row_count().alias("_rows"),
        *[F.count(F.col(f.name)).alias(f"_set{i}") for i, f in enumerate(fields)],
        *[F.approx_count_distinct(f.name).alias(f"_values{i}") for i, f in enumerate(fields)],
    )
    per_column = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias(f"type_{label}"),
                F.coalesce(
                    F.round(F.try_divide(F.col("_rows") - F.col(f"_set{i}"), F.col("_rows")), 4),
                    F.lit(0.0),
                ).alias(f"null_share_{label}"),
                F.col(f"_values{i}").alias(f"values_{label}"),
            )
            for i, f in enumerate(fields)
        ]
    )
    return row.select(F.inline(per_column))


def schema_change(
    before: DataFrame,
    after: DataFrame,
    null_drift: float = 0.1,
    values_ratio: float = 2.0,
) -> DataFrame:
    """Columns that were added, removed, retyped or whose content drifted.

    Content has drifted when the share of NULLs moved by more than
    ``null_drift`` or the number of different values changed by more than the
    factor ``values_ratio``. That number is approximate (relative standard
    deviation 5 %), so it decides but is not part of the result.
    """
    old, new = _column_profile(before, "before"), _column_profile(after, "after")
    low = F.least("values_before", "values_after")
    high = F.greatest("values_before", "values_after")
    drifted = (
        F.abs(F.col("null_share_after") - F.col("null_share_before")) > null_drift
    ) | (high > low * values_ratio)
    change = (
        F.when(F.col("type_before").isNull(), "added")
        .when(F.col("type_after").isNull(), "removed")
        .when(F.col("type_before") != F.col("type_after"), "retyped")
        .when(drifted, "drifted")
    )
    return (
        old.join(new, "column_name", "full")
        .withColumn("change", change)
        .filter(F.col("change").isNotNull())
        .select(
            "column_name",
            "change",
            "type_before",
            "type_after",
            "null_share_before",
            "null_share_after",
        )
    )
