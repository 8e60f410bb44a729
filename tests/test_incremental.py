"""Upserts by key, incremental loads and marts finished from states."""

import json
import os

import pytest
from helpers import plan_of, raw_games, rows
from pyspark.sql import functions as F

from duelmetrics import jobs
from duelmetrics.plans import incremental, pipeline
from duelmetrics.plans.staging import game_facts, stage_games
from duelmetrics.quality.checks import DataCheckFailed
from duelmetrics.schemas import RAW_GAMES
from duelmetrics.sources import parts, tables

JANUARY = 1735689600
DAY = 86400
TIES = [c for c in RAW_GAMES.names if c not in ("game_url", "ingested_at")]
MARTS = ["int_player_performance", "mart_player_stats", "mart_opening_analysis", "mart_elo_progression"]


def land(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as out:
        out.writelines((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in lines)


def game(k, player="Ann", **changes):
    pgn = f'[ECO "B1{k % 2}"] [ECOUrl "https://www.chess.com/openings/Opening-{k % 2}"]'
    side = {"username": player, "rating": 1500 + k % 17, "result": ("win", "loss", "draw")[k % 3]}
    return {
        "url": f"g{k}", "time_class": ("blitz", "rapid")[k % 2], "time_control": "180", "rated": True, "pgn": pgn,
        "white": side, "black": {"username": "Zed", "rating": 1400, "result": "loss"},
        "end_time": JANUARY + k * DAY // 2, **changes,
    }


def archive(landed, player, month, name, games):
    land(f"{landed}/archives/username={player}/year=2025/month={month}", name, {"games": games})


def first_day(landed):
    archive(landed, "Ann", "01", "a", [game(k) for k in range(40)])
    archive(landed, "Bob", "01", "a", [game(100 + k, "Bob") for k in range(20)] + [game(100, "Bob")])
    for player in ("Ann", "Bob"):
        land(f"{landed}/profiles/username={player}", "a", {"player_id": 1, "title": "x", "country": "https://x/no"})
        land(f"{landed}/stats/username={player}", "a", {"chess_blitz": {"last": {"rating": 1700, "rd": 30}}})


def second_day(landed):
    late = [game(40 + k, end_time=JANUARY + k * DAY) for k in range(10)]  # days that have games already
    moved = [game(k, end_time=JANUARY + (60 + k) * DAY, white={"username": "Ann", "rating": 2000, "result": "draw"}) for k in (3, 4)]
    archive(landed, "Ann", "02", "b", late + moved + [game(200 + k) for k in range(5)])
    land(f"{landed}/stats/username=Bob", "b", {"chess_blitz": {"last": {"rating": 1650, "rd": 30}}})


def whole_run(spark, landed, root, *loads):
    """The marts of one full run over rows that all loads together have, each with its own load time."""
    games, players = [], []
    for k, (folder, at) in enumerate(loads):
        pipeline.run_ingestion(spark, folder, f"{root}-{k}", at, more_than=0)
        games.append(pipeline.table(spark, f"{root}-{k}", "raw_games"))
        players.append(pipeline.table(spark, f"{root}-{k}", "raw_players"))
    for name, both in (("raw_games", games), ("raw_players", players)):
        rows = both[0]
        for more in both[1:]:
            rows = rows.unionByName(more)
        tables.replace_table(rows, pipeline.table_path(root, name))
    pipeline.run_repair(spark, root)
    pipeline.run_models(spark, root)


def same_marts(spark, one, other, names=MARTS):
    for name in names:
        a, b = pipeline.table(spark, one, name), pipeline.table(spark, other, name)
        assert sorted(a.columns) == sorted(b.columns), name
        assert rows(a, *a.columns) == rows(b, *a.columns), name


def test_two_loads_equal_one_full_run(spark, tmp_path):
    landed, root = f"{tmp_path}/landed", f"{tmp_path}/root"
    first_day(landed)
    one = incremental.run_update(spark, landed, root, "2025-02-01T00:00:00", buckets=4)
    assert one.files == {"archives": 2, "profiles": 2, "stats": 2} and one.lines["archives"] == 2
    second_day(landed)
    two = incremental.load_new(spark, landed, root, "2025-02-02T00:00:00", buckets=4)
    assert two.files == {"archives": 1, "profiles": 0, "stats": 1} and two.lines["archives"] == 1  # the second day's files only
    assert incremental.refresh_marts(spark, root) == ["2025-01", "2025-03", "2025-04"]
    drift = incremental.drift_since(spark, root, "2025-02-01T00:00:00", "2025-02-02T00:00:00")
    assert {"end_time", "pgn"} <= {r["column_name"] for r in drift.collect()}

    days = f"{tmp_path}/first", f"{tmp_path}/second"
    first_day(days[0])
    first_day(days[1])
    second_day(days[1])
    full = f"{tmp_path}/full"
    whole_run(spark, landed, full, (days[0], "2025-02-01T00:00:00"))
    new_games = f"{tmp_path}/new"
    second_day(new_games)
    pipeline.run_ingestion(spark, new_games, f"{tmp_path}/r2", "2025-02-02T00:00:00", more_than=0)
    both = pipeline.table(spark, full, "raw_games").unionByName(pipeline.table(spark, f"{tmp_path}/r2", "raw_games"))
    tables.replace_table(both, pipeline.table_path(full, "raw_games"))
    pipeline.run_repair(spark, full)
    tables.replace_table(pipeline.table(spark, root, "raw_players"), pipeline.table_path(full, "raw_players"))
    pipeline.run_models(spark, full)
    same_marts(spark, root, full)
    assert rows(pipeline.table(spark, root, "raw_players"), "username", "blitz_rating") == [("Ann", 1700), ("Bob", 1650)]

    before = tables.current_version(spark, pipeline.table_path(root, "raw_games"))
    none = incremental.run_update(spark, landed, root, "2025-02-03T00:00:00", buckets=4)
    assert set(none.files.values()) == {0} and set(none.lines.values()) == {0}
    assert tables.current_version(spark, pipeline.table_path(root, "raw_games")) == before
    same_marts(spark, root, full)
    # the tables in parts serve the plain models too
    tables.replace_table(pipeline.table(spark, root, "raw_players"), pipeline.table_path(f"{tmp_path}/copy", "raw_players"))
    tables.replace_table(pipeline.table(spark, root, "raw_games"), pipeline.table_path(f"{tmp_path}/copy", "raw_games"))
    pipeline.run_models(spark, f"{tmp_path}/copy", grain="as_written")
    incremental.refresh_marts(spark, root, grain="as_written")
    same_marts(spark, root, f"{tmp_path}/copy")


@pytest.mark.parametrize("lost", ["refresh_facts", "refresh_states", "append_parts"])
def test_a_job_lost_between_tables_is_made_up_for(spark, tmp_path, monkeypatch, lost):
    landed, root, whole = f"{tmp_path}/landed", f"{tmp_path}/root", f"{tmp_path}/whole"
    first_day(landed)
    for target in (root, whole):
        incremental.run_update(spark, landed, target, "2025-02-01T00:00:00", buckets=4)
    second_day(landed)
    incremental.run_update(spark, landed, whole, "2025-02-02T00:00:00", buckets=4)

    def killed(*_, **__):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch, pytest.raises(KeyboardInterrupt):
        patch.setattr(incremental, lost, killed)
        incremental.run_update(spark, landed, root, "2025-02-02T00:00:00", buckets=4)
    archive(landed, "Bob", "03", "c", [game(300 + k, "Bob") for k in range(3)])
    for target in (root, whole):
        incremental.run_update(spark, landed, target, "2025-02-03T00:00:00", buckets=4)
    same_marts(spark, root, whole)


def test_only_selected_folders_are_read(spark, tmp_path):
    landed, root = f"{tmp_path}/landed", f"{tmp_path}/root"
    first_day(landed)
    land(f"{landed}/archives/username=Bob/year=2024/month=05", "broken", '{"games": [{"url')
    chosen = {"players": ["Ann"], "months": ["2025-01"]}
    done = pipeline.run_ingestion(spark, landed, root, "2025-02-01T00:00:00", more_than=10, **chosen)
    assert (done.lines["archives"], done.rejected["archives"]) == (1, 0)
    assert rows(pipeline.table(spark, root, "raw_games").groupBy("username").count()) == [("Ann", 40)]
    with pytest.raises(DataCheckFailed, match="1 of 3 archives"):
        pipeline.run_ingestion(spark, landed, root, "2025-02-01T00:00:00", more_than=10)

    fresh = f"{tmp_path}/fresh"
    part = incremental.load_new(spark, landed, fresh, "2025-02-01T00:00:00", **chosen)
    assert part.files == {"archives": 1, "profiles": 1, "stats": 1}
    with pytest.raises(DataCheckFailed, match="1 of 2 archives"):
        incremental.load_new(spark, landed, fresh, "2025-02-02T00:00:00")
    rest = incremental.load_new(spark, landed, fresh, "2025-02-02T00:00:00", allow_rejects=True)
    assert rest.files == {"archives": 2, "profiles": 1, "stats": 1} and rest.rejected["archives"] == 1
    assert rows(pipeline.table(spark, fresh, "rejects"), "source", "line") == [("archives", '{"games": [{"url')]
    assert pipeline.table(spark, fresh, "raw_games").count() == 60


def test_players_stay_when_their_sources_are_unreadable(spark, tmp_path):
    landed, root = f"{tmp_path}/landed", f"{tmp_path}/root"
    first_day(landed)
    pipeline.run_ingestion(spark, landed, root, "2025-02-01T00:00:00", more_than=10)
    other = f"{tmp_path}/other"
    archive(other, "Ann", "02", "a", [game(k) for k in range(30)])
    land(f"{other}/profiles/username=Ann", "a", {"player_id": 1})
    land(f"{other}/stats/username=Ann", "a", "{broken")
    done = pipeline.run_ingestion(spark, other, root, "2025-02-02T00:00:00", more_than=10, allow_rejects=True)
    assert not done.players_loaded and pipeline.table(spark, root, "raw_games").count() == 30
    assert pipeline.table(spark, root, "raw_players").count() == 2


def games(spark, *changes):
    return raw_games(spark, *[{"game_url": f"g{k}", "ingested_at": at, **more} for k, at, more in changes])


def put(df, path, **options):
    return parts.upsert(df, path, ["game_url"], ["ingested_at"], TIES, **options)


def test_an_upsert_touches_only_the_buckets_of_its_keys(spark, tmp_path):
    path = f"{tmp_path}/t"
    one = put(games(spark, *[(k, "1", {}) for k in range(200)]), path, buckets=16)
    two = put(games(spark, (3, "2", {"white_rating": 9}), (3, "1", {}), (900, "2", {}), (4, "0", {"white_rating": 8})), path, buckets=16)
    shared = set(one.folders) & set(two.folders)
    assert len({parts.part_of(f) for f in one.folders}) == 16 and len(shared) >= 13
    now = tables.read_table(spark, path, RAW_GAMES)
    assert now.count() == 201 and now.select("game_url").distinct().count() == 201
    assert rows(now.filter("game_url in ('g3', 'g4')"), "game_url", "white_rating") == [("g3", 9), ("g4", 1500)]
    came, went = parts.changes(spark, path, two, RAW_GAMES)
    assert rows(came, "game_url") == [("g3",), ("g900",)] and rows(went, "game_url", "white_rating") == [("g3", 1500)]
    assert put(games(spark, (1, "1", {})).filter("false"), path, buckets=16) is None
    for k in range(4):  # what is no longer named goes
        put(games(spark, (k, "3", {})), path, buckets=16)
    assert tables.read_table(spark, path, RAW_GAMES).count() == 201
    tables.remove_leftovers(spark, path, hours=0)
    assert tables.read_table(spark, path, RAW_GAMES).count() == 201


def test_keyed_rows_are_staged_without_a_shuffle(spark, tmp_path):
    path = f"{tmp_path}/t"
    put(games(spark, *[(k % 30, str(k // 30), {"white_rating": k}) for k in range(90)], (None, "1", {"game_url": None})), path, buckets=4)
    keyed = tables.read_table(spark, path, RAW_GAMES)
    for build in (stage_games, game_facts):
        plan = plan_of(build(keyed, unique=True))
        assert "Exchange" not in plan and "Window" not in plan
        a, b = build(keyed, unique=True), build(keyed)
        assert rows(a) == rows(b) and a.count() == 31


def test_a_hot_key_costs_one_row_a_task(spark, tmp_path):
    path = f"{tmp_path}/t"
    hot = spark.range(0, 30_000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 500)).alias("game_url"),
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in RAW_GAMES if f.name not in ("game_url", "ingested_at")],
        F.col("id").cast("string").alias("ingested_at"),
    )
    put(hot, path, buckets=4)
    now = tables.read_table(spark, path, RAW_GAMES)
    newest = hot.groupBy("game_url").agg(F.max("ingested_at").alias("ingested_at"))
    assert rows(now, "game_url", "ingested_at") == rows(newest)


def test_two_upserts_at_once(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    put(games(spark, (1, "1", {})), path)
    change = parts.change_parts

    def late(*arguments, **options):
        monkeypatch.setattr(parts, "change_parts", change)
        put(games(spark, (2, "1", {})), path)
        return change(*arguments, **options)

    monkeypatch.setattr(parts, "change_parts", late)
    with pytest.raises(tables.LostRace):
        put(games(spark, (3, "1", {})), path)
    assert rows(tables.read_table(spark, path, RAW_GAMES), "game_url") == [("g1",), ("g2",)]


def test_the_update_command(spark, tmp_path, capsys):
    landed, root = f"{tmp_path}/landed", f"{tmp_path}/root"
    first_day(landed)
    arguments = ["update", "--landed", landed, "--root", root, "--players", "Ann", "--ingested-at"]
    jobs.main([*arguments, "2025-02-01T00:00:00"], spark)
    jobs.main([*arguments, "2025-02-02T00:00:00"], spark)
    out = capsys.readouterr().out
    assert "archives: 1 new files, 1 lines, 0 rejected" in out and "archives: 0 new files" in out
    assert rows(pipeline.table(spark, root, "int_player_performance"), "username", "total_games") == [("ann", 20), ("ann", 20)]


def test_nothing_landed(spark, tmp_path):
    root = f"{tmp_path}/root"
    done = incremental.run_update(spark, f"{tmp_path}/none", root, "2025-02-01T00:00:00")
    assert set(done.files.values()) == {0}
    for name in MARTS:
        assert pipeline.table(spark, root, name).count() == 0
