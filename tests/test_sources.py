import json
import os
import threading
from concurrent.futures import ThreadPoolExecutor

import pytest
from helpers import GAME, plan_of, raw_games, rows
from pyspark.sql import functions as F

from duelmetrics import jobs
from duelmetrics.operators.interleave import spread_evenly
from duelmetrics.plans import pipeline
from duelmetrics.quality.checks import DataCheckFailed
from duelmetrics.schemas import ARCHIVE, RAW_GAMES
from duelmetrics.sources import payloads, tables
from duelmetrics.sources.raw_tables import one_load, read_raw_games
from duelmetrics.sources.scratch import scratch_dir


def land(folder, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/part.json", "w") as out:
        out.writelines((x if isinstance(x, str) else json.dumps(x)) + "\n" for x in lines)


def payload_game(url, **changes):
    side = {"username": "Ann", "rating": 1500, "result": "win"}
    return {
        "url": url,
        "time_class": "blitz",
        "time_control": "180",
        "rated": True,
        "pgn": "1. e4",
        "white": side,
        "black": {"username": "Bob", "rating": 1400, "result": "loss"},
        "end_time": 1735689600,
        "extra": {"ignored": 1},
        **changes,
    }


def test_archives(spark, tmp_path):
    root = f"{tmp_path}/archives"
    without_black = payload_game("g2")
    del without_black["black"]
    land(f"{root}/username=007/year=2025/month=01", {"games": [payload_game("g1"), without_black]})
    land(f"{root}/username=bob/year=2025/month=02", {"games": []}, {}, "{broken", {"games": None})
    flat = payloads.flatten_archives(payloads.read_archives(spark, root), "2025-02-01T00:00:00")
    assert flat.schema.names == RAW_GAMES.names
    assert rows(flat, "game_url", "username", "white_rating", "black_rating", "ingested_at") == [
        ("g1", "007", 1500, 1400, "2025-02-01T00:00:00"),
        ("g2", "007", 1500, None, "2025-02-01T00:00:00"),
    ]
    rejected = payloads.rejected_lines(spark, root, ARCHIVE)
    assert [r.line for r in rejected.collect()] == ["{broken"]


def test_several_folders_are_one_load(spark, tmp_path):
    roots = [f"{tmp_path}/{name}" for name in ("first", "second")]
    for root in roots:
        for month in ("01", "02", "03"):
            land(f"{root}/username=x/year=2025/month={month}", {"games": [payload_game("g")]})
    folders = [f"{roots[0]}/username=x/year=2025/month={m}" for m in ("01", "02")]
    part = payloads.read_archives(spark, folders, root=roots[0])
    assert rows(part, "username", "year", "month") == [("x", "2025", "01"), ("x", "2025", "02")]
    assert one_load(part, payloads.read_archives(spark, roots[1])).count() == 5


def test_one_bad_value_costs_neither_the_game_nor_the_archive(spark, tmp_path):
    bad = payload_game("g2", white={"username": "Ann", "rating": "none", "result": "win"})
    late = payload_game("g3", end_time="soon")
    folder = f"{tmp_path}/a/username=x/year=2025/month=01"
    land(folder, {"games": [payload_game("g1"), bad, late, payload_game("g4")]})
    archives = payloads.read_archives(spark, f"{tmp_path}/a")
    flat = payloads.flatten_archives(archives, "now")
    assert rows(flat, "game_url", "white_rating", "end_time") == [
        ("g1", 1500, 1735689600),
        ("g2", None, 1735689600),
        ("g3", 1500, None),
        ("g4", 1500, 1735689600),
    ]
    assert payloads.rejected_lines(spark, f"{tmp_path}/a", ARCHIVE).count() == 1


def test_empty_and_broken_profiles_are_left_out(spark, tmp_path):
    land(f"{tmp_path}/p/username=a", {})
    land(f"{tmp_path}/p/username=b", '{"player_id": ')
    land(f"{tmp_path}/p/username=c", {"name": "C"})
    land(f"{tmp_path}/s/username=c", '{"chess_blitz": ', {"chess_blitz": {"last": {"rating": 9}}})
    flat = payloads.flatten_players(
        payloads.read_profiles(spark, f"{tmp_path}/p"),
        payloads.read_stats(spark, f"{tmp_path}/s"),
        "now",
    )
    assert rows(flat, "username", "name", "blitz_rating") == [("c", "C", 9)]


def test_players(spark, tmp_path):
    profiles, stats = f"{tmp_path}/profiles", f"{tmp_path}/stats"
    land(
        f"{profiles}/username=ann",
        {"player_id": 1, "country": "https://x/country/NO", "is_streamer": True},
    )
    land(f"{profiles}/username=bob", {"player_id": 2})
    rated = {"chess_blitz": {"last": {"rating": 2000, "rd": 40}}, "chess_rapid": {}}
    land(f"{stats}/username=ann", rated, rated)
    land(f"{stats}/username=nobody", rated)
    flat = payloads.flatten_players(
        payloads.read_profiles(spark, profiles), payloads.read_stats(spark, stats), "now"
    )
    columns = ["username", "country", "is_streamer", "rapid_rating", "blitz_rating", "blitz_games"]
    assert rows(flat, *columns) == [
        ("ann", "NO", True, None, 2000, 40),
        ("bob", "", False, None, None, None),
    ]


def test_raw_json_has_the_declared_types(spark, tmp_path):
    land(f"{tmp_path}/raw", GAME, {"game_url": "only"}, "{broken")
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        read_raw_games(spark, f"{tmp_path}/raw").collect()
    df = read_raw_games(spark, f"{tmp_path}/raw", tolerant=True)
    assert payloads.count_lines(spark, f"{tmp_path}/raw", RAW_GAMES) == (3, 1)
    assert df.schema == RAW_GAMES
    assert rows(df, "game_url", "end_time") == [("g1", 1735689600), ("only", None)]
    assert one_load(df, df).count() == 4


def test_ensure_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.ensure_table(spark, path, RAW_GAMES)
    assert tables.read_table(spark, path).schema == RAW_GAMES
    tables.replace_table(raw_games(spark, {}), path)
    tables.ensure_table(spark, path, RAW_GAMES)
    assert tables.read_table(spark, path).count() == 1


def test_replace_keeps_the_table_on_empty_or_failed_input(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert tables.replace_table(spark.range(3), path, keep_if_empty=True)
    assert not tables.replace_table(spark.range(0), path, keep_if_empty=True)
    with pytest.raises(Exception, match="broken input"):
        tables.replace_table(
            spark.range(3).select(F.raise_error(F.lit("broken input")).cast("bigint").alias("id")),
            path,
        )
    assert tables.read_table(spark, path).count() == 3
    tables.replace_table(spark.range(0), path)
    assert tables.read_table(spark, path).count() == 0


def test_a_table_can_be_replaced_by_a_query_over_itself(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.replace_table(spark.range(10), path)
    tables.replace_table(tables.read_table(spark, path).filter("id < 4"), path)
    assert tables.read_table(spark, path).count() == 4
    assert os.listdir(tmp_path) == ["t"]


def versions(path):
    return sorted(f for f in os.listdir(path) if f.startswith("version-"))


def test_a_reader_outlives_a_replacement(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.replace_table(spark.range(3), path)
    before = tables.read_table(spark, path)
    tables.replace_table(spark.range(5), path)
    assert (before.count(), tables.read_table(spark, path).count()) == (3, 5)
    tables.replace_table(spark.range(7), path)
    assert len(versions(path)) == tables.KEPT_VERSIONS
    assert tables.read_table(spark, path).count() == 7


def test_a_replacement_that_broke_off_leaves_the_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.replace_table(spark.range(3), path)
    spark.range(9).write.parquet(f"{path}/version-lost")
    assert tables.read_table(spark, path).count() == 3
    assert tables.remove_leftovers(spark, path) == 0
    assert tables.remove_leftovers(spark, path, hours=0) == 1
    assert len(versions(path)) == 1 and tables.read_table(spark, path).count() == 3


def test_a_check_that_fails_leaves_the_table(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.replace_table(spark.range(3), path)

    def refuse(written):
        assert written.count() == 4
        raise DataCheckFailed("no")

    with pytest.raises(DataCheckFailed):
        tables.replace_table(spark.range(4), path, check=refuse)
    assert tables.read_table(spark, path).count() == 3 and len(versions(path)) == 1


def test_of_two_replacements_at_once_the_later_fails(spark, tmp_path):
    path = f"{tmp_path}/t"
    tables.replace_table(spark.range(3), path)
    with pytest.raises(tables.LostRace):
        tables.replace_table(
            spark.range(4), path, check=lambda _: tables.replace_table(spark.range(5), path)
        )
    assert tables.read_table(spark, path).count() == 5 and len(versions(path)) == 2


class Killed(BaseException):
    """Ends a writer where a lost driver would, without its clean-up."""


@pytest.mark.parametrize("step", ["before the entry", "inside the entry", "before it is in place", "after it is in place"])
def test_a_killed_writer_leaves_a_whole_table(spark, tmp_path, monkeypatch, step):
    path = f"{tmp_path}/t"
    tables.replace_table(spark.range(3), path)
    spark.range(4).write.parquet(f"{path}/version-killed")
    version = tables.Version(2, ["version-killed"])

    def killed(*_):
        raise Killed

    with monkeypatch.context() as patch:
        if step == "inside the entry":  # as a writer without this protocol, or a store that shows files early, leaves it
            with open(f"{path}/_log/000000000002", "wb") as out:
                out.write(b"\nversion-kil")
        elif step == "before it is in place":
            patch.setattr(tables, "_put_local", killed)
        elif step == "after it is in place":
            patch.setattr(tables, "_tidy", killed)
        if step in ("before it is in place", "after it is in place"):
            with pytest.raises(Killed):
                tables.commit(spark, path, version.folders, tables.current_version(spark, path))
    counted = 4 if step == "after it is in place" else 3
    assert tables.read_table(spark, path).count() == counted
    assert tables.table_exists(spark, path)
    for n in (5, 6, 7):  # the table goes on, and its clean-up with it
        tables.replace_table(spark.range(n), path)
        assert tables.read_table(spark, path).count() == n
    tables.remove_leftovers(spark, path, hours=0)
    assert len(versions(path)) == tables.KEPT_VERSIONS
    assert sorted(f for f in os.listdir(f"{path}/_log") if not f.endswith(".crc")) == [
        f"{n:012d}" for n in [v.number for v in (tables.current_version(spark, path),) for v in (v._replace(number=v.number - 1), v)]
    ]
    assert tables.read_table(spark, path).count() == 7


@pytest.mark.parametrize("put", ["_put_local", "_put_renamed"])
def test_of_many_writers_one_wins(spark, tmp_path, monkeypatch, put):
    path = f"{tmp_path}/t"
    tables.replace_table(spark.range(3), path)
    since = tables.current_version(spark, path)
    gate, real = threading.Barrier(4), getattr(tables, put)

    def together(*arguments):
        gate.wait(30)
        if put == "_put_renamed":  # the rename of a local file system looks first and then renames
            with lock:
                return real(*arguments)
        return real(*arguments)

    lock = threading.Lock()
    monkeypatch.setattr(tables, "_put_local", together)

    def write(n):
        spark.range(n).write.parquet(f"{path}/version-{n}")
        try:
            return tables.commit(spark, path, [f"version-{n}"], since) and n
        except tables.LostRace:
            return None

    with ThreadPoolExecutor(4) as pool:
        won = [n for n in pool.map(write, (4, 5, 6, 7)) if n]
    assert len(won) == 1 and tables.read_table(spark, path).count() == won[0]
    with pytest.raises(tables.LostRace):
        tables.replace_table(spark.range(9), path, since=since)
    assert tables.read_table(spark, path).count() == won[0]


def test_entries_of_earlier_releases_are_read(spark, tmp_path):
    path = f"{tmp_path}/t"
    spark.range(3).write.parquet(f"{path}/version-old")
    os.makedirs(f"{path}/_log")
    with open(f"{path}/_log/000000000001", "wb") as out:
        out.write(b"\x00\x0bversion-old")
    open(f"{path}/_log/000000000002", "wb").close()  # and one that was never filled
    assert tables.read_table(spark, path).count() == 3
    for n in (4, 5):
        tables.replace_table(spark.range(n), path)
    assert tables.read_table(spark, path).count() == 5 and not os.path.exists(f"{path}/version-old")


def test_a_repair_does_not_undo_a_load(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/t"
    tables.replace_table(spark.range(3), path)
    read = tables.read_table

    def loaded_meanwhile(*arguments):
        rows = read(*arguments)
        tables.replace_table(spark.range(8), path)
        return rows

    monkeypatch.setattr(tables, "read_table", loaded_meanwhile)
    with pytest.raises(tables.LostRace):
        tables.repair_table(spark, path, ["id"], ["id"])
    assert read(spark, path).count() == 8


def test_the_catalog_follows_location_and_schema(spark, tmp_path):
    spark.sql(f"create database tables_test location '{tmp_path}/db'")
    try:
        for df, path in (
            (spark.range(3), "a"),
            (spark.range(5), "b"),
            (spark.range(6).withColumn("x", F.lit("x")), "b"),
        ):
            tables.replace_table(df, f"{tmp_path}/{path}")
            for _ in range(2):
                tables.register_table(spark, "tables_test.t", f"{tmp_path}/{path}")
            assert spark.table("tables_test.t").count() == df.count()
            assert spark.table("tables_test.t").columns == df.columns
    finally:
        spark.sql("drop database tables_test cascade")


def test_newest_payload_wins_though_ratings_fall(spark, tmp_path):
    for day, rating in ((1, 2900), (2, 2800)):
        for kind, line in (
            ("profiles", {"title": f"T{day}"}),
            ("stats", {"chess_blitz": {"last": {"rating": rating}}}),
        ):
            folder = f"{tmp_path}/{kind}/username=ann"
            os.makedirs(folder, exist_ok=True)
            with open(f"{folder}/day{3 - day}.json", "w") as out:
                out.write(json.dumps(line))
            os.utime(f"{folder}/day{3 - day}.json", (day * 86400, day * 86400))
    flat = payloads.flatten_players(
        payloads.read_profiles(spark, f"{tmp_path}/profiles"),
        payloads.read_stats(spark, f"{tmp_path}/stats"),
        "now",
    )
    assert rows(flat, "username", "title", "blitz_rating") == [("ann", "T2", 2800)]


def test_a_copied_landing_zone_keeps_its_order(spark, tmp_path):
    for day, written in (("2025-01-02", 100), ("2025-01-01", 900)):  # copied in another order than landed
        for kind, line in (("profiles", {"title": day}), ("stats", {"chess_blitz": {"last": {"rating": int(day[-2:])}}})):
            folder = f"{tmp_path}/{kind}/username=ann/landed={day}"
            land(folder, line)
            os.utime(f"{folder}/part.json", (written, written))
    flat = payloads.flatten_players(
        payloads.read_profiles(spark, f"{tmp_path}/profiles"), payloads.read_stats(spark, f"{tmp_path}/stats"), "now"
    )
    assert rows(flat, "username", "title", "blitz_rating") == [("ann", "2025-01-02", 2)]


def row_groups_read(folder, column, low, high):
    """Row groups whose statistics leave them in for a range of the column, and all of them."""
    import pyarrow.parquet as pq

    kept = total = 0
    for name in os.listdir(folder):
        if name.endswith(".parquet"):
            meta = pq.read_metadata(f"{folder}/{name}")
            at = meta.schema.names.index(column)
            for k in range(meta.num_row_groups):
                found = meta.row_group(k).column(at).statistics
                kept += found.min <= high and found.max >= low
                total += 1
    return kept, total


def test_interleaved_files_narrow_down_each_column(spark, tmp_path):
    df = spark.range(40_000).select(
        F.concat(F.lit("p"), (F.col("id") * 7919 % 100 + 100).cast("string")).alias("player"),
        (F.col("id") * 104_729 % 86_400).alias("at"),
        F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("f"), F.col("id") % 9)).alias("format"),
        F.lit(None).cast("date").alias("never"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        spread_evenly(df, ["player", "at", "never"]).write.parquet(f"{tmp_path}/z")
        tables.clustered(df, ["player", "at"]).write.parquet(f"{tmp_path}/sorted")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert spark.read.parquet(f"{tmp_path}/z").count() == 40_000
    for column, low, high in (("at", 43_200, 45_000), ("player", "p150", "p152")):
        kept, total = row_groups_read(f"{tmp_path}/z", column, low, high)
        assert total >= 48 and kept <= 0.3 * total, (column, kept, total)
    kept, total = row_groups_read(f"{tmp_path}/sorted", "at", 43_200, 45_000)
    assert kept > 0.9 * total  # sorted by player first, time alone rules nothing out
    assert spread_evenly(df.filter("false"), ["player", "at"]).count() == 0
    assert spread_evenly(df, ["format"]).count() == 40_000


def test_repair(spark, tmp_path):
    path = f"{tmp_path}/t"
    twice = raw_games(
        spark,
        {"white_rating": 1},
        {"white_rating": 2, "ingested_at": "2025-01-03T00:00:00"},
        {"game_url": "other"},
        {"game_url": "other"},
    )
    tables.replace_table(twice, path)
    tables.repair_table(spark, path, ["game_url"], ["ingested_at"], ["username"])
    assert rows(tables.read_table(spark, path), "game_url", "white_rating") == [
        ("g1", 2),
        ("other", 1500),
    ]


def test_clustering_splits_a_hot_key_and_sorts_files(spark, tmp_path):
    path = f"{tmp_path}/t"
    df = spark.range(0, 300000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise((F.col("id") % 50).cast("string")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("text"),
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        tables.replace_table(df, path, ["k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert "REBALANCE_PARTITIONS_BY_COL" in plan_of(tables.clustered(df, ["k"]))
    stored = tables.read_table(spark, path).select("k", F.input_file_name().alias("file"))
    hot = stored.filter("k = 'hot'").select("file").distinct().count()
    assert stored.count() == 300000 and hot > 1
    chosen = plan_of(tables.read_table(spark, path).filter("k = 'hot'"))
    assert "EqualTo(k,hot)" in chosen


def test_files_can_be_sorted_without_a_shuffle(spark, tmp_path):
    df = spark.range(0, 1000, 1, 4).select((F.col("id") * 7 % 10).alias("k"), "id")
    assert "Exchange" not in plan_of(tables.clustered(df, ["k"], gather=False))
    path = f"{tmp_path}/t"
    tables.replace_table(df, path, ["k"], gather=False)
    (version,) = versions(path)
    folder = f"{path}/{version}"
    files = [f"{folder}/{f}" for f in os.listdir(folder) if f.endswith(".parquet")]
    assert len(files) == 4
    for file in files:
        keys = [r.k for r in spark.read.parquet(file).collect()]
        assert keys == sorted(keys)


def test_scratch_dir_follows_the_session(spark):
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    assert first.startswith(shared.rstrip("/"))


@pytest.fixture
def landed(tmp_path):
    folder = f"{tmp_path}/landed"
    pgn = '[ECO "B10"] [ECOUrl "https://www.chess.com/openings/Caro-Kann"]'
    games = [payload_game(f"g{i}", end_time=1735689600 + i * 7200, pgn=pgn) for i in range(30)]
    land(f"{folder}/archives/username=Ann/year=2025/month=01", {"games": games})
    land(f"{folder}/profiles/username=Ann", {"player_id": 1, "country": "https://x/NO"})
    land(f"{folder}/stats/username=Ann", {"chess_blitz": {"last": {"rating": 1700, "rd": 30}}})
    return folder


def test_pipeline(spark, tmp_path, landed):
    root = f"{tmp_path}/root"
    pipeline.run_ingestion(spark, landed, root, "2025-02-01T00:00:00", more_than=29)
    fresh = pipeline.run_transformation(
        spark, root, "2025-02-02T06:00:00", players=["ann"], fail_on_error=True
    )
    assert rows(fresh, "table_name", "status") == [("raw_games", "warn"), ("raw_players", "warn")]
    stats = pipeline.table(spark, root, "mart_player_stats")
    assert rows(stats, "username", "peak_rating", "blitz_total_games", "total_wins_all") == [
        ("ann", 1700, 30, 30)
    ]
    openings = pipeline.table(spark, root, "mart_opening_analysis")
    assert rows(openings, "opening_slug", "eco_code", "total_games") == [("Caro-Kann", "B10", 30)]
    assert pipeline.table(spark, root, "mart_elo_progression").count() == 3
    summary = pipeline.run_expectations(spark, root)
    assert rows(summary) == [("mart_player_stats", 4, 1, False), ("stg_games", 4, 1, False)]
    with pytest.raises(DataCheckFailed):
        pipeline.run_expectations(spark, root, fail_on_error=True)
    with pytest.raises(DataCheckFailed, match="accepted_values"):
        pipeline.run_checks(spark, root, players=["bob"], fail_on_error=True)

    spark.sql(f"create database games_test location '{tmp_path}/db'")
    try:
        for _ in range(2):
            pipeline.register_tables(spark, root, "games_test")
        assert spark.table("games_test.mart_elo_progression").count() == 3
        assert spark.table("games_test.raw_games").schema == RAW_GAMES
    finally:
        spark.sql("drop database games_test cascade")
    pipeline.register_views(spark, root)
    counted = spark.sql(
        "select s.username, count(*) n, max(m.total_games_all) t from stg_games s "
        "join mart_player_stats m using (username) group by 1"
    )
    assert rows(counted) == [("ann", 30, 30)]


def test_empty_load_keeps_raw_tables_and_low_volume_raises(spark, tmp_path, landed):
    root = f"{tmp_path}/root"
    with pytest.raises(DataCheckFailed, match="row_count_above"):
        pipeline.run_ingestion(spark, landed, root, "2025-02-01T00:00:00")
    assert pipeline.table(spark, root, "raw_games").count() == 0
    pipeline.run_ingestion(spark, landed, root, "2025-02-01T00:00:00", more_than=29)
    empty = f"{tmp_path}/empty"
    land(f"{empty}/archives/username=Ann/year=2025/month=02", {"games": []})
    with pytest.raises(DataCheckFailed, match="row_count_above"):
        pipeline.run_ingestion(spark, empty, root, "2025-03-01T00:00:00", more_than=29)
    loaded = pipeline.table(spark, root, "raw_games").select("ingested_at").distinct()
    assert rows(loaded) == [("2025-02-01T00:00:00",)]
    assert pipeline.table(spark, root, "raw_players").count() == 1


def test_jobs(spark, tmp_path, landed):
    root = f"{tmp_path}/root"
    at = "2025-02-01T00:00:00"
    jobs.main(
        ["ingest", "--landed", landed, "--root", root, "--ingested-at", at, "--more-than", "29"],
        spark,
    )
    jobs.main(["transform", "--root", root, "--as-of", at, "--players", "ann"], spark)
    jobs.main(["validate", "--root", root], spark)
    late = ["transform", "--root", root, "--as-of", "2025-02-04T00:00:00", "--players", "ann"]
    with pytest.raises(DataCheckFailed, match="stale"):
        jobs.main(late, spark)
    with pytest.raises(DataCheckFailed):
        jobs.main(["validate", "--root", root, "--fail"], spark)


def test_rejected_lines_end_a_load_unless_allowed(spark, tmp_path, landed):
    root = f"{tmp_path}/root"
    folder = f"{landed}/archives/username=Bob/year=2025/month=01"
    land(folder, '{"games": [{"url": "g')
    with pytest.raises(DataCheckFailed, match="1 of 2 archives"):
        pipeline.run_ingestion(spark, landed, root, "2025-02-01T00:00:00", more_than=29)
    assert pipeline.table(spark, root, "raw_games").count() == 0
    listed = pipeline.table(spark, root, "rejects")
    assert rows(listed, "source", "line") == [("archives", '{"games": [{"url": "g')]
    done = pipeline.run_ingestion(
        spark, landed, root, "2025-02-01T00:00:00", more_than=29, allow_rejects=True
    )
    assert (done.lines["archives"], done.rejected["archives"]) == (2, 1)
    assert pipeline.table(spark, root, "raw_games").count() == 30
    pretty = f"{tmp_path}/pretty"
    land(f"{pretty}/archives/username=Ann/year=2025/month=01", "{", '"games":', "[]", "}")
    with pytest.raises(DataCheckFailed, match="4 of 4 archives"):
        pipeline.run_ingestion(spark, pretty, root, "later", more_than=0, allow_rejects=True)
    assert pipeline.table(spark, root, "raw_games").count() == 30
    land(folder, {"games": []})
    pipeline.run_ingestion(spark, landed, root, "2025-02-01T00:00:00", more_than=29)
    assert pipeline.table(spark, root, "rejects").count() == 0


def test_players_and_months_are_selected_and_missing_ones_reported(spark, tmp_path, landed):
    for month in ("02", "03"):
        folder = f"{landed}/archives/username=Bob/year=2025/month={month}"
        land(folder, {"games": [payload_game(f"b{month}")]})
    done = pipeline.run_ingestion(
        spark,
        landed,
        f"{tmp_path}/root",
        "2025-02-01T00:00:00",
        more_than=0,
        players=["Ann", "Bob"],
        months=["2025-01", "2025-02"],
    )
    games = pipeline.table(spark, f"{tmp_path}/root", "raw_games")
    assert rows(games.filter("username = 'Bob'"), "game_url") == [("b02",)]
    assert rows(done.missing) == [("Ann", "2025-02"), ("Bob", "2025-01")]


def test_model_options(spark, tmp_path, landed):
    root = f"{tmp_path}/root"
    lost = payload_game("lost", white={"username": "Ann", "rating": 1500, "result": "lose"})
    folder = f"{landed}/archives/username=Ann/year=2025/month=02"
    land(folder, {"games": [lost]})
    at = "2025-02-01T00:00:00"
    jobs.main(
        ["ingest", "--landed", landed, "--root", root, "--ingested-at", at, "--more-than", "29",
         "--gather", "--players", "Ann"],
        spark,
    )
    jobs.main(
        ["transform", "--root", root, "--as-of", at, "--players", "ann", "--with-text",
         "--result-map", "lose=loss", "--key", "game_url,username", "--grain", "as_written"],
        spark,
    )
    performance = pipeline.table(spark, root, "int_player_performance")
    assert rows(performance, "total_wins", "total_losses") == [(30, 1)]
    assert "pgn" in pipeline.table(spark, root, "stg_games").columns
    jobs.main(["repair", "--root", root], spark)
    assert pipeline.table(spark, root, "raw_games").count() == 31
    results = pipeline.expectation_results(spark, root)
    assert results.count() == 10
    spark.sql(f"create database options_test location '{tmp_path}/db'")
    try:
        pipeline.register_tables(spark, root, "options_test")
        assert spark.table("options_test.stg_games").count() == 31
    finally:
        spark.sql("drop database options_test cascade")
