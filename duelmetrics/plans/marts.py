"""The three tables that dashboards read."""

from functools import reduce
from operator import add

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelmetrics import fixed_values as fixed
from duelmetrics.functions.clock import epoch_from_utc, utc_day
from duelmetrics.functions.measures import mean_rounded, rate_pct, row_count
from duelmetrics.operators.progression import (
    change_vs_previous,
    packed_order,
    period_close,
    repeat_for_ties,
)
from duelmetrics.operators.reshape import pivot_metrics
from duelmetrics.plans.staging import with_opening_tags


def player_stats(players: DataFrame, performance: DataFrame) -> DataFrame:
    """One row per player with the results per format side by side.

    Totals add up the pivoted formats only; games of other formats do not count.
    """
    formats = fixed.PIVOT_CLASSES
    metrics = {
        "total_games": "total_games",
        "wins": "total_wins",
        "win_rate_pct": "win_rate_pct",
        "avg_rating": "avg_rating",
    }
    pivoted = pivot_metrics(performance, "username", "time_class", formats, metrics)

    def total(metric: str):
        return reduce(add, [F.coalesce(f"{f}_{metric}", F.lit(0)) for f in formats])

    return players.join(pivoted, "username", "left").select(
        "username",
        "full_name",
        "title",
        "country_code",
        "followers",
        "is_streamer",
        "rapid_rating",
        "blitz_rating",
        "bullet_rating",
        "peak_rating",
        *[f"{f}_{m}" for f in formats for m in metrics],
        total("total_games").alias("total_games_all"),
        total("wins").alias("total_wins_all"),
    )


def opening_analysis(
    games: DataFrame, min_games: int = fixed.MIN_OPENING_GAMES
) -> DataFrame:
    """Results per player, format, colour and opening with enough games.

    ``games`` carries either the opening tags or the game text. Missing tags are
    labelled before grouping, so a label stands for exactly one group.
    """
    tagged = games if "opening_slug" in games.columns else with_opening_tags(games)
    result = F.col("player_result")
    won = result == fixed.WIN
    unknown = F.lit(fixed.UNKNOWN_OPENING)
    stats = (
        tagged.withColumns(
            {c: F.coalesce(c, unknown) for c in ("opening_slug", "eco_code")}
        )
        .groupBy("username", "time_class", "player_color", "opening_slug", "eco_code")
        .agg(
            row_count().alias("total_games"),
            F.count_if(won).alias("wins"),
            F.count_if(result == fixed.LOSS).alias("losses"),
            F.count_if(result == fixed.DRAW).alias("draws"),
            rate_pct(won).alias("win_rate_pct"),
            mean_rounded("player_rating").alias("avg_rating"),
        )
    )
    return stats.filter(F.col("total_games") >= min_games)


def rating_progression(games: DataFrame, grain: str = "day") -> DataFrame:
    """Daily rating series per player and format.

    ``grain="day"``: one row per day. ``grain="as_written"``: a day of several
    games also keeps the row whose change is taken within the day, as a change
    computed per game and made distinct afterwards gives it. Of several games
    that end in a day's last second the one with the greatest rating closes it.
    """
    if grain not in ("day", "as_written"):
        raise ValueError(f"unknown grain: {grain}")
    series = ["username", "time_class"]
    rating = F.col("player_rating")
    daily = period_close(
        games.withColumn("game_date", utc_day(F.col("ended_at"))),
        keys=[*series, "game_date"],
        value="player_rating",
        order=packed_order(epoch_from_utc(F.col("ended_at")), rating),
        closing="closing_rating",
        measures={
            "daily_max_rating": F.max(rating),
            "daily_min_rating": F.min(rating),
            "daily_games": row_count(),
            "daily_wins": F.count_if(F.col("player_result") == fixed.WIN),
        },
    )
    changed = change_vs_previous(
        daily, series, "game_date", "closing_rating", "rating_change"
    )
    if grain == "as_written":
        return repeat_for_ties(changed, "daily_games", "closing_rating", "rating_change")
    return changed
