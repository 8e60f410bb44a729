from datetime import date

import pytest
from helpers import raw_games, raw_players, rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from duelmetrics.operators.progression import change_vs_previous, period_close, repeat_for_ties
from duelmetrics.plans import marts
from duelmetrics.plans.performance import player_performance
from duelmetrics.plans.staging import game_facts, stage_games, stage_players

DAY = 86400
NEW_YEAR = 1735689600


def games_on(*day_ratings):
    """One game per rating, a minute apart, on consecutive days."""
    return [
        {
            "game_url": f"g{day}-{i}",
            "end_time": NEW_YEAR + day * DAY + i * 60,
            "white_rating": rating,
        }
        for day, ratings in enumerate(day_ratings)
        for i, rating in enumerate(ratings)
    ]


def test_performance_counts_and_rates(spark):
    raw = raw_games(
        spark,
        {"game_url": "1"},
        {"game_url": "2", "white_result": "draw", "white_rating": 1501},
        {
            "game_url": "3",
            "white_username": "bob",
            "black_username": "ann",
            "black_result": "win",
            "black_rating": 1502,
        },
    )
    (row,) = player_performance(stage_games(raw)).collect()
    assert (row.total_games, row.total_wins, row.total_losses, row.total_draws) == (3, 2, 0, 1)
    assert row.win_rate_pct == 66.67
    assert (row.games_as_white, row.games_as_black) == (2, 1)
    assert (row.wins_as_white, row.wins_as_black) == (1, 1)
    assert (row.avg_rating, row.max_rating, row.min_rating) == (1501.0, 1502, 1500)
    assert row.avg_opponent_rating == 1433.0


def test_progression_grains(spark):
    staged = stage_games(raw_games(spark, *games_on([9, 10], [14, 15], [12], [11, 12])))
    by_day = marts.rating_progression(staged)
    assert rows(by_day, "game_date", "closing_rating", "rating_change") == [
        (date(2025, 1, 1), 10, None),
        (date(2025, 1, 2), 15, 5),
        (date(2025, 1, 3), 12, -3),
        (date(2025, 1, 4), 12, 0),
    ]
    assert rows(by_day, "daily_max_rating", "daily_min_rating", "daily_games", "daily_wins") == [
        (10, 9, 2, 2),
        (12, 11, 2, 2),
        (12, 12, 1, 1),
        (15, 14, 2, 2),
    ]
    as_written = marts.rating_progression(staged, grain="as_written")
    changes = [r[1] for r in rows(as_written, "game_date", "rating_change")]
    assert changes == [None, 0, 0, 5, -3, 0]
    with pytest.raises(ValueError):
        marts.rating_progression(staged, grain="week")


def literal_progression(games):
    """Windows over every game, then distinct: what the roll-up must equal."""
    day = Window.partitionBy("username", "time_class", "game_date")
    closing = day.orderBy("ended_at", "player_rating").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    per_game = games.withColumn("game_date", F.to_date("ended_at")).select(
        "username",
        "time_class",
        "game_date",
        F.last("player_rating").over(closing).alias("closing_rating"),
        F.max("player_rating").over(day).alias("daily_max_rating"),
        F.min("player_rating").over(day).alias("daily_min_rating"),
        F.count(F.lit(1)).over(day).alias("daily_games"),
        F.count_if(F.col("player_result") == "win").over(day).alias("daily_wins"),
    )
    series = Window.partitionBy("username", "time_class").orderBy("game_date")
    change = F.col("closing_rating") - F.lag("closing_rating").over(series)
    return per_game.withColumn("rating_change", change).distinct()


def test_roll_up_equals_windows_over_games(spark):
    changes = [
        {
            "game_url": f"g{i}",
            "username": "ann" if i % 5 else "cid",
            "white_username": "ann" if i % 5 else "cid",
            "time_class": ["blitz", "rapid"][i % 2],
            "end_time": NEW_YEAR + (i * i * 7919) % (20 * DAY) // 600 * 600,
            "white_rating": None if i % 17 == 0 else 1500 + (i * 37) % 90,
        }
        for i in range(300)
    ]
    games = stage_games(raw_games(spark, *changes))
    got = marts.rating_progression(games, grain="as_written")
    want = literal_progression(games)
    assert rows(got, *sorted(want.columns)) == rows(want, *sorted(want.columns))


def test_operators_work_on_any_columns(spark):
    df = spark.createDataFrame(
        [("a", 1, 1, 5.0), ("a", 1, 2, 7.0), ("a", 2, 1, 4.0)], "k string, d int, t int, v double"
    )
    daily = period_close(df, ["k", "d"], "v", ["t"], "last", {"n": F.count(F.lit(1))})
    changed = change_vs_previous(daily, ["k"], "d", "last", "change")
    assert rows(changed) == [("a", 1, 7.0, 2, None), ("a", 2, 4.0, 1, -3.0)]
    repeated = repeat_for_ties(changed, "n", "last", "change")
    assert rows(repeated, "d", "change") == [(1, None), (1, 0.0), (2, -3.0)]


PGN_BOTH = '[ECO "B10"]\n[ECOUrl "https://www.chess.com/openings/Caro-Kann"]\n1. e4 c6'
PGN_ECO = '[ECO "C20"]\n1. e4 e5'


def openings_of(spark, *texts, min_games=1):
    raw = raw_games(spark, *[{"game_url": str(i), "pgn": t} for i, t in enumerate(texts)])
    return marts.opening_analysis(stage_games(raw), min_games)


def test_opening_tags(spark):
    found = openings_of(spark, PGN_BOTH, PGN_ECO, "1. d4", None)
    assert rows(found, "opening_slug", "eco_code", "total_games") == [
        ("Caro-Kann", "B10", 1),
        ("unknown", "C20", 1),
        ("unknown", "unknown", 2),
    ]


def test_missing_and_literal_unknown_form_one_group(spark):
    literal = '[ECO "unknown"] [ECOUrl "https://www.chess.com/openings/unknown"]'
    found = openings_of(spark, "1. d4", "1. c4", literal, min_games=3)
    assert rows(found, "opening_slug", "eco_code", "total_games") == [("unknown", "unknown", 3)]


def test_openings_need_enough_games(spark):
    found = openings_of(spark, *[PGN_BOTH] * 3, *[PGN_ECO] * 2, min_games=3)
    assert rows(found, "opening_slug", "total_games", "wins", "win_rate_pct") == [
        ("Caro-Kann", 3, 3, 100.0)
    ]


def test_openings_from_facts_equal_those_from_text(spark):
    raw = raw_games(
        spark, *[{"game_url": str(i), "pgn": [PGN_BOTH, PGN_ECO, None][i % 3]} for i in range(12)]
    )
    columns = ["opening_slug", "eco_code", "total_games", "wins", "avg_rating"]
    assert rows(marts.opening_analysis(game_facts(raw)), *columns) == rows(
        marts.opening_analysis(stage_games(raw)), *columns
    )


def three_joins(players, performance):
    """One filter and one left join per format."""
    joined = players
    for f in ("rapid", "blitz", "bullet"):
        part = performance.filter(F.col("time_class") == f).select(
            "username",
            F.col("total_games").alias(f"{f}_total_games"),
            F.col("total_wins").alias(f"{f}_wins"),
            F.col("win_rate_pct").alias(f"{f}_win_rate_pct"),
            F.col("avg_rating").alias(f"{f}_avg_rating"),
        )
        joined = joined.join(part, "username", "left")
    zero = F.lit(0)
    return joined.withColumns(
        {
            f"{name}": sum(
                (F.coalesce(f"{f}_{m}", zero) for f in ("blitz", "bullet")),
                F.coalesce(f"rapid_{m}", zero),
            )
            for name, m in (("total_games_all", "total_games"), ("total_wins_all", "wins"))
        }
    )


def test_player_stats_equal_three_joins(spark):
    formats = ["Rapid", "blitz", "BULLET", "daily"]
    games = [
        {
            "game_url": str(i),
            "username": "ABC"[i % 3],
            "white_username": "ABC"[i % 3],
            "time_class": formats[i % (i % 3 + 2)],
        }
        for i in range(40)
    ]
    names = ["A", "B", "C", "Idle"]
    players = stage_players(raw_players(spark, *[{"username": n} for n in names]))
    performance = player_performance(stage_games(raw_games(spark, *games)))
    got = marts.player_stats(players, performance)
    assert got.count() == 4
    assert rows(got, *got.columns) == rows(three_joins(players, performance), *got.columns)


def test_daily_games_do_not_count_in_totals(spark):
    performance = player_performance(stage_games(raw_games(spark, {"time_class": "daily"})))
    got = marts.player_stats(stage_players(raw_players(spark, {})), performance)
    columns = ["rapid_total_games", "blitz_wins", "total_games_all", "total_wins_all"]
    assert rows(got, *columns) == [(None, None, 0, 0)]
