"""Results per player and format."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duelmetrics.fixed_values import DRAW, LOSS, WIN
from duelmetrics.functions.measures import mean_rounded, rate_pct, row_count


def player_performance(games: DataFrame) -> DataFrame:
    """One row per (username, time_class), by one hash aggregation."""
    result, color = F.col("player_result"), F.col("player_color")
    won = result == WIN
    return games.groupBy("username", "time_class").agg(
        row_count().alias("total_games"),
        F.count_if(won).alias("total_wins"),
        F.count_if(result == LOSS).alias("total_losses"),
        F.count_if(result == DRAW).alias("total_draws"),
        rate_pct(won).alias("win_rate_pct"),
        F.count_if(color == "white").alias("games_as_white"),
        F.count_if(color == "black").alias("games_as_black"),
        F.count_if((color == "white") & won).alias("wins_as_white"),
        F.count_if((color == "black") & won).alias("wins_as_black"),
        mean_rounded("player_rating").alias("avg_rating"),
        F.max("player_rating").alias("max_rating"),
        F.min("player_rating").alias("min_rating"),
        mean_rounded("opponent_rating").alias("avg_opponent_rating"),
        F.min("ended_at").alias("first_game_at"),
        F.max("ended_at").alias("last_game_at"),
    )
