"""Result frames of a dashboard, each read from a written table.

Filters stand directly on the table, so they reach its Parquet scan.
"""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelmetrics import fixed_values as fixed
from duelmetrics.functions.measures import row_count
from duelmetrics.functions.text import format_label, grouped_number, one_decimal
from duelmetrics.operators.compare import compare_entities
from duelmetrics.operators.ranking import (
    argmax_row,
    argmax_value,
    first_appearances,
    options_in_order,
    ordered,
    top_rows,
)
from duelmetrics.operators.reshape import long_form, share_of_total

# Row orders of the three tables as the dashboard shows them.
MOST_GAMES_FIRST = {"down": ["total_games_all"], "up": ["username"]}
BY_DAY = {"up": ["username", "time_class", "game_date"]}
MOST_PLAYED_FIRST = {
    "down": ["total_games"],
    "up": ["username", "time_class", "player_color", "opening_slug", "eco_code"],
}


def players_in_order(stats: DataFrame) -> DataFrame:
    return ordered(stats, **MOST_GAMES_FIRST)


def progression_in_order(progression: DataFrame) -> DataFrame:
    return ordered(progression, **BY_DAY)


def openings_in_order(openings: DataFrame) -> DataFrame:
    return ordered(openings, **MOST_PLAYED_FIRST)


def kpi_row(stats: DataFrame) -> DataFrame:
    """Totals and record holders, all from one pass over the table."""
    best = ("blitz_win_rate_pct", ["total_games_all"], ["username"])
    highest = ("peak_rating", ["total_games_all"], ["username"])
    return stats.agg(
        F.sum("total_games_all").alias("total_games"),
        row_count().alias("players_tracked"),
        F.max("blitz_win_rate_pct").alias("best_blitz_win_rate"),
        argmax_value("username", *best).alias("best_blitz_player"),
        F.max("peak_rating").alias("highest_peak_rating"),
        argmax_value("username", *highest).alias("highest_peak_player"),
    )


def kpi_labels(stats: DataFrame) -> DataFrame:
    """The numbers of ``kpi_row`` as they are shown."""
    row = kpi_row(stats)
    return row.select(
        grouped_number(F.col("total_games")).alias("total_games"),
        grouped_number(F.col("players_tracked")).alias("players_tracked"),
        one_decimal(F.col("best_blitz_win_rate"), "%").alias("best_blitz_win_rate"),
        grouped_number(F.col("highest_peak_rating")).alias("highest_peak_rating"),
    )


def best_blitz_player(stats: DataFrame) -> DataFrame:
    return argmax_row(stats, "blitz_win_rate_pct", **MOST_GAMES_FIRST)


def player_table(stats: DataFrame) -> DataFrame:
    headings = fixed.PLAYER_TABLE_HEADINGS
    return players_in_order(stats).select(
        *[F.col(c).alias(heading) for c, heading in headings.items()]
    )


def games_share(stats: DataFrame) -> DataFrame:
    return share_of_total(stats.select("username", "total_games_all"), "total_games_all", "share")


def win_rate_by_format(stats: DataFrame) -> DataFrame:
    columns = [f"{f}_win_rate_pct" for f in ("blitz", "rapid", "bullet")]
    rows = long_form(stats, ["username"], columns, "format", "win_rate")
    return rows.withColumn("format", format_label(F.col("format"), "_win_rate_pct"))


def _series(
    progression: DataFrame, players: Sequence[str], time_class: str, value: str
) -> DataFrame:
    chosen = F.col("username").isin(*players) & (F.col("time_class") == time_class)
    return progression_in_order(progression.filter(chosen)).select(
        "username", "game_date", value
    )


def rating_series(progression: DataFrame, players: Sequence[str], time_class: str) -> DataFrame:
    return _series(progression, players, time_class, "closing_rating")


def rating_change_series(
    progression: DataFrame, players: Sequence[str], time_class: str
) -> DataFrame:
    return _series(progression, players, time_class, "rating_change")


def top_openings(
    openings: DataFrame,
    player: str,
    time_class: str,
    color: str,
    n: int = fixed.TOP_OPENINGS,
) -> DataFrame:
    chosen = (
        (F.col("username") == player)
        & (F.col("time_class") == time_class)
        & (F.col("player_color") == color)
    )
    return top_rows(openings.filter(chosen), n, **MOST_PLAYED_FIRST).select(
        "opening_slug", "win_rate_pct", "total_games"
    )


def compare_players(stats: DataFrame, first: str, second: str) -> DataFrame:
    return compare_entities(
        stats, "username", first, second, fixed.COMPARISON_METRICS, ["total_games_all"]
    )


def progression_options(progression: DataFrame, column: str) -> DataFrame:
    """Choices of the rating page in table order, numbered by ``position``."""
    return options_in_order(progression, column, **BY_DAY)


def opening_options(openings: DataFrame, column: str) -> DataFrame:
    """Choices of the openings page in table order."""
    return options_in_order(openings, column, **MOST_PLAYED_FIRST)


def player_options(stats: DataFrame) -> DataFrame:
    """Choices of the comparison: players, most games first."""
    return options_in_order(stats, "username", **MOST_GAMES_FIRST)


def default_players(progression: DataFrame, n: int = 3) -> DataFrame:
    """The players selected at first: the first ones in table order."""
    return first_appearances(progression, "username", n, **BY_DAY)


def default_format(progression: DataFrame) -> DataFrame:
    return first_appearances(progression, "time_class", 1, **BY_DAY)


def default_opening_choice(openings: DataFrame, column: str) -> DataFrame:
    return first_appearances(openings, column, 1, **MOST_PLAYED_FIRST)


def default_pair(stats: DataFrame) -> DataFrame:
    """The two players compared at first: those with the most games."""
    return top_rows(stats, 2, **MOST_GAMES_FIRST).select("username")
