from datetime import date

import pytest
from helpers import plan_of, rows

from duelmetrics.plans import frames

COLUMNS = (
    "username string, title string, country_code string, peak_rating bigint, "
    "blitz_rating bigint, rapid_rating bigint, total_games_all bigint, "
    "blitz_win_rate_pct double, rapid_win_rate_pct double, bullet_win_rate_pct double"
)


@pytest.fixture
def stats(spark):
    return spark.createDataFrame(
        [
            ("ann", "GM", "NO", 2800, 2700, 2800, 10, 50.0, 60.5, None),
            ("bob", None, "US", 2800, 2750, None, 30, 50.0, None, 40.0),
            ("cid", "IM", "FR", 2500, None, 2500, 0, None, 70.0, None),
        ],
        COLUMNS,
    )


def test_kpi_row(stats):
    assert rows(frames.kpi_row(stats)) == [(40, 3, 50.0, "bob", 2800, "bob")]
    assert rows(frames.best_blitz_player(stats), "username") == [("bob",)]


def test_kpi_labels(stats):
    many = stats.withColumn("total_games_all", stats.total_games_all * 1000)
    assert rows(frames.kpi_labels(many)) == [("40,000", "3", "50.0%", "2,800")]


def test_kpi_row_of_players_without_blitz(stats):
    (row,) = frames.kpi_row(stats.filter("username = 'cid'")).collect()
    assert (row.best_blitz_win_rate, row.best_blitz_player) == (None, None)
    assert row.highest_peak_player == "cid"


def test_player_table(stats):
    table = frames.player_table(stats)
    assert table.columns == [
        "Player",
        "Title",
        "Country",
        "Peak Rating",
        "Blitz",
        "Rapid",
        "Total Games",
        "Blitz WR%",
        "Rapid WR%",
    ]
    assert [r.Player for r in table.collect()] == ["bob", "ann", "cid"]


def test_shares_and_win_rates(stats):
    assert rows(frames.games_share(stats), "username", "share") == [
        ("ann", 0.25),
        ("bob", 0.75),
        ("cid", 0.0),
    ]
    assert rows(frames.win_rate_by_format(stats)) == [
        ("ann", "Blitz", 50.0),
        ("ann", "Rapid", 60.5),
        ("bob", "Blitz", 50.0),
        ("bob", "Bullet", 40.0),
        ("cid", "Rapid", 70.0),
    ]


def test_comparison(stats):
    found = {r.metric: r for r in frames.compare_players(stats, "ann", "bob").collect()}
    assert set(found) == {"Peak Rating", "Blitz Rating", "Total Games", "Blitz Win Rate"}
    blitz, peak = found["Blitz Rating"], found["Peak Rating"]
    assert (blitz.value_1, blitz.value_2, blitz.delta, blitz.winner) == (2700, 2750, -50, "→")
    assert (blitz.delta_1, blitz.delta_2, blitz.text_1) == ("-50.0", "+50.0", "2700")
    assert (peak.winner, peak.delta_1) == ("=", None)
    assert found["Blitz Win Rate"].text_1 == "50%"
    assert frames.compare_players(stats, "ann", "nobody").count() == 0


def test_defaults(stats, spark):
    assert [r.username for r in frames.default_pair(stats).collect()] == ["bob", "ann"]
    progression = spark.createDataFrame(
        [
            ("d", "blitz", date(2025, 1, 1), 5, None),
            ("a", "rapid", date(2025, 1, 2), 6, 1),
            ("a", "rapid", date(2025, 1, 1), 5, None),
            ("c", "blitz", date(2025, 1, 1), 5, None),
            ("b", "blitz", date(2025, 1, 1), 5, None),
        ],
        "username string, time_class string, game_date date, closing_rating int, rating_change int",
    )
    names = [r.username for r in frames.default_players(progression).collect()]
    assert names == ["a", "b", "c"]
    assert rows(frames.default_format(progression)) == [("rapid",)]
    shown = frames.progression_options(progression, "time_class").collect()
    assert [tuple(r) for r in shown] == [("rapid", 1), ("blitz", 2)]
    assert [r.username for r in frames.player_options(stats).collect()][:2] == ["bob", "ann"]
    series = frames.rating_series(progression, ["a", "d"], "rapid").collect()
    assert [r.closing_rating for r in series] == [5, 6]
    changes = frames.rating_change_series(progression, ["a"], "rapid").collect()
    assert [r.rating_change for r in changes] == [None, 1]


def test_slice_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "openings")
    spark.createDataFrame(
        [("a", "blitz", "white", f"s{i}", "A00", i, 50.0) for i in range(20)],
        "username string, time_class string, player_color string, opening_slug string, "
        "eco_code string, total_games int, win_rate_pct double",
    ).write.parquet(path)
    top = frames.top_openings(spark.read.parquet(path), "a", "blitz", "white")
    assert [r.total_games for r in top.collect()] == list(range(19, 4, -1))
    plan = plan_of(top)
    for column in ("username", "time_class", "player_color"):
        assert f"EqualTo({column}" in plan
