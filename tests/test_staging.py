from datetime import date, datetime

from helpers import plan_of, raw_games, raw_players, rows
from pyspark.sql import functions as F

from duelmetrics.plans.marts import rating_progression
from duelmetrics.plans.performance import player_performance
from duelmetrics.plans.staging import game_facts, stage_games, stage_players


def test_later_load_of_a_game_wins(spark):
    raw = raw_games(
        spark,
        {"white_rating": 1500, "ingested_at": "2025-01-02T00:00:00"},
        {"white_rating": 1510, "ingested_at": "2025-01-02T00:00:00.000001"},
    )
    assert rows(stage_games(raw), "game_url", "player_rating") == [("g1", 1510)]


def test_tie_on_load_time_is_broken_by_name(spark):
    raw = raw_games(spark, {"username": "bob"}, {"username": "ann"})
    for order in (raw, raw.orderBy("username"), raw.orderBy(F.desc("username"))):
        assert rows(stage_games(order), "username") == [("ann",)]


def test_game_of_two_tracked_players(spark):
    raw = raw_games(spark, {"username": "ann"}, {"username": "bob"})
    assert stage_games(raw).count() == 1
    both = stage_games(raw, key=("game_url", "username"))
    assert rows(both, "username", "player_color", "player_result") == [
        ("ann", "white", "win"),
        ("bob", "black", "loss"),
    ]


def test_perspective_ignores_case(spark):
    raw = raw_games(
        spark,
        {"game_url": "w", "username": "Hikaru", "white_username": "HIKARU"},
        {"game_url": "b", "username": "Hikaru", "black_username": "HIKARU"},
    )
    columns = ["game_url", "player_color", "player_rating", "opponent_rating", "opponent_username"]
    assert rows(stage_games(raw), *columns) == [
        ("b", "black", 1400, 1500, "ann"),
        ("w", "white", 1500, 1400, "bob"),
    ]
    assert rows(stage_games(raw), "game_url", "white_username", "black_username") == [
        ("b", "ann", "hikaru"),
        ("w", "hikaru", "bob"),
    ]


def test_missing_white_name_counts_as_black(spark):
    raw = raw_games(spark, {"white_username": None})
    assert rows(stage_games(raw), "player_color", "opponent_username") == [("black", None)]


def test_result_codes_pass_through_unless_mapped(spark):
    raw = raw_games(
        spark,
        {"game_url": "a", "white_result": "Resigned"},
        {"game_url": "b", "white_result": "win"},
        {"game_url": "c", "white_result": None},
    )
    assert rows(stage_games(raw), "game_url", "player_result") == [
        ("a", "resigned"),
        ("b", "win"),
        ("c", None),
    ]
    counted = ["total_games", "total_wins", "total_losses", "total_draws"]
    assert rows(player_performance(stage_games(raw)), *counted) == [(3, 1, 0, 0)]
    mapped = stage_games(raw, result_map={"resigned": "loss"})
    assert rows(player_performance(mapped), *counted) == [(3, 1, 1, 0)]


def test_day_is_the_utc_day_in_any_zone(spark, zone):
    staged = stage_games(raw_games(spark, {"end_time": 1735689600}))
    assert rows(staged, "ended_at") == [(datetime(2025, 1, 1),)]
    assert rows(rating_progression(staged), "game_date") == [(date(2025, 1, 1),)]


def test_one_hot_game_url_is_limited_before_the_shuffle(spark):
    raw = raw_games(spark, {"username": "x"}).drop("game_url", "ingested_at")
    many = (
        spark.range(0, 20000, 1, 8)
        .crossJoin(raw)
        .select(
            "*",
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias(
                "game_url"
            ),
            F.format_string("2025-01-02T00:00:00.%06d", "id").alias("ingested_at"),
        )
    )
    staged = stage_games(many)
    assert staged.count() == 20000 - 6667 + 1
    latest = staged.filter("game_url = 'hot'").collect()
    assert [r.ingested_at for r in latest] == ["2025-01-02T00:00:00.019998"]
    assert plan_of(staged).count("WindowGroupLimit") == 2


def test_game_text_is_not_read_where_it_is_not_needed(spark, tmp_path):
    path = str(tmp_path / "raw")
    raw_games(spark, {}).write.parquet(path)
    raw = spark.read.parquet(path)
    assert "pgn" not in plan_of(player_performance(stage_games(raw)))
    assert "pgn" not in plan_of(rating_progression(stage_games(raw)))
    facts = plan_of(game_facts(raw))
    exchange = next(line for line in facts.splitlines() if "WindowGroupLimit" in line)
    assert "pgn" not in exchange
    assert "pgn" not in game_facts(raw).columns


def test_players_are_deduplicated_by_the_name_as_landed(spark):
    raw = raw_players(
        spark,
        {"username": "Ann", "followers": 1, "ingested_at": "2025-01-01T00:00:00"},
        {"username": "Ann", "followers": 2, "ingested_at": "2025-01-02T00:00:00"},
        {"username": "ann", "followers": 3, "ingested_at": "2025-01-01T00:00:00"},
    )
    assert rows(stage_players(raw), "username", "followers") == [("ann", 2), ("ann", 3)]


def test_peak_rating_is_the_best_current_rating(spark):
    none = {"rapid_rating": None, "blitz_rating": None, "bullet_rating": None}
    raw = raw_players(
        spark, {"username": "a"}, {"username": "b", **none}, {"username": "c", "title": None}
    )
    assert rows(stage_players(raw), "username", "title", "country_code", "peak_rating") == [
        ("a", "GM", "NO", 1600),
        ("b", "GM", "NO", 0),
        ("c", None, "NO", 1600),
    ]


def test_copies_that_differ_in_the_text_alone_have_one_survivor(spark):
    games = [{"pgn": f"1. e{k}"} for k in range(6)]
    seen = set()
    for order in (games, games[::-1], games[3:] + games[:3]):
        raw = raw_games(spark, *order).repartition(3)
        seen |= {r.pgn for r in stage_games(raw, text_ties=True).collect()}
    assert len(seen) == 1
