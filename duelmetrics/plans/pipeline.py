"""Jobs over one table root: ``raw/``, ``staging/`` and ``marts/``."""

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from duelmetrics import fixed_values as fixed
from duelmetrics.operators.coverage import coverage_gaps
from duelmetrics.plans import marts
from duelmetrics.plans.performance import player_performance
from duelmetrics.plans.staging import game_facts, stage_games, stage_players
from duelmetrics.quality.checks import (
    DataCheckFailed,
    raise_on_failure,
    run_suite,
    settled,
    summarize,
)
from duelmetrics.quality.declared import expectations, schema_tests
from duelmetrics.quality.monitors import freshness, volume_check
from duelmetrics.schemas import ARCHIVE, PROFILE, RAW_GAMES, RAW_PLAYERS, STATS
from duelmetrics.sources import payloads
from duelmetrics.sources.raw_tables import one_load
from duelmetrics.sources.tables import (
    ensure_table,
    path_exists,
    read_table,
    register_table,
    repair_table,
    replace_table,
    table_exists,
)

RAW_TABLES = {"raw_games": RAW_GAMES, "raw_players": RAW_PLAYERS}
LANDING = {"archives": ARCHIVE, "profiles": PROFILE, "stats": STATS}
REJECTS = StructType([StructField(c, StringType()) for c in ("source", "path", "line")])
GAME_CLUSTERING = ["username", "time_class"]
STAGING = ["game_facts", "stg_players", "int_player_performance"]
MARTS = ["mart_player_stats", "mart_opening_analysis", "mart_elo_progression"]


def table_path(root: str, name: str) -> str:
    zone = "raw" if name in (*RAW_TABLES, "rejects", "loaded_files", "load_profiles") else "marts" if name in MARTS else "staging"
    return f"{root}/{zone}/{name}"


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_table(spark, table_path(root, name), RAW_TABLES.get(name))


@dataclass(frozen=True)
class Ingested:
    """What a load read and wrote.

    ``lines`` and ``rejected`` count landed lines by source. ``missing`` has the
    (username, period) that were expected and have not landed.
    """

    lines: dict[str, int]
    rejected: dict[str, int]
    players_loaded: bool
    missing: DataFrame


def _landed(spark: SparkSession, landed: str, source: str, read: Callable) -> DataFrame:
    """What landed of ``source``; a folder that was never written holds no rows."""
    path = f"{landed}/{source}"
    if path_exists(spark, path):
        return read(spark, path)
    return spark.createDataFrame([], LANDING[source])


def missing_archives(
    spark: SparkSession, landed: str, players: Sequence[str], months: Sequence[str]
) -> DataFrame:
    """(username, period) without a landed archive; periods are like 2025-01.

    What has landed is seen from the folders' names, no archive is read.
    """
    expected = spark.createDataFrame([(p,) for p in players], "username string")
    path = f"{landed}/archives"
    if path_exists(spark, path):
        found = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", "*")
            .option("recursiveFileLookup", "true")
            .load(path)
            .select(F.regexp_extract_all("path", F.lit(r"/(?:username|year|month)=([^/]+)")).alias("p"))
            .filter(F.size("p") == 3)
            .select(F.col("p")[0].alias("username"), F.concat_ws("-", F.col("p")[1], F.col("p")[2]).alias("period"))
        )
    else:
        found = spark.createDataFrame([], "username string, period string")
    return coverage_gaps(expected, found, "username", "period", months)


def run_ingestion(
    spark: SparkSession,
    landed: str,
    root: str,
    ingested_at: str,
    more_than: int = fixed.MIN_RAW_GAMES,
    gather: bool = False,
    players: Sequence[str] | None = None,
    months: Sequence[str] | None = None,
    allow_rejects: bool = False,
) -> Ingested:
    """Landed payloads to raw tables, with an account of what was not readable.

    ``players`` and ``months`` (like 2025-01) select folders of the landing zone.
    Neither the account nor the load reads others. Lines that cannot be read in
    full are written to ``raw/rejects``. They end the load before it writes a
    table, unless ``allow_rejects`` is set and some archive is readable: then it
    goes on with the rest, and players of whose profiles or stats nothing is
    readable stay as they were. Games are checked for volume before they
    replace the table, so the check judges this load, and a load of too few
    games, or of none, leaves the games as they were. A landing zone without
    profiles keeps the players.

    A landed file holds the games of one player, so sorting each written file
    clusters the games without moving their text between tasks; ``gather`` also
    shuffles them so that a player's games share files.
    """
    for name, schema in RAW_TABLES.items():
        ensure_table(spark, table_path(root, name), schema)
    lines, rejected = account_for(spark, landed, root, players, months)
    raise_on_rejects(lines, rejected, root, allow_rejects)

    def read(source: str, reader: Callable) -> DataFrame:
        rows = _landed(spark, landed, source, reader)
        return rows.filter(payloads.selected(players, months, rows.columns))

    roster = payloads.flatten_players(
        read("profiles", payloads.read_profiles), read("stats", payloads.read_stats), ingested_at
    )
    games = payloads.flatten_archives(read("archives", payloads.read_archives), ingested_at)
    unreadable = {s for s, n in rejected.items() if n and n == lines[s]}
    players_loaded = not unreadable & {"profiles", "stats"} and replace_table(
        roster, table_path(root, "raw_players"), keep_if_empty=True
    )
    replace_table(
        games,
        table_path(root, "raw_games"),
        GAME_CLUSTERING,
        gather=gather,
        check=lambda loaded: raise_on_failure(volume_check(loaded, "raw_games", more_than)),
    )
    if players is not None and months is not None:
        missing = missing_archives(spark, landed, players, months)
    else:
        missing = spark.createDataFrame([], "username string, period string")
    return Ingested(lines, rejected, players_loaded, missing)


def raise_on_rejects(lines: dict, rejected: dict, root: str, allow_rejects: bool) -> None:
    broken = {s: n for s, n in rejected.items() if n}
    if broken and (not allow_rejects or broken.get("archives") == lines["archives"]):
        counts = ", ".join(f"{n} of {lines[s]} {s}" for s, n in broken.items())
        raise DataCheckFailed(f"not readable: {counts} lines; see {table_path(root, 'rejects')}")


def account_for(
    spark: SparkSession,
    landed: str,
    root: str,
    players: Sequence[str] | None = None,
    months: Sequence[str] | None = None,
) -> tuple[dict, dict]:
    """Landed and rejected lines by source; the rejected ones are in ``raw/rejects``.

    The selected folders are read once for the counts; only a source with
    rejected lines is read again to list them. The table always tells of the
    last load.
    """
    keep = {
        s: payloads.selected(players, months, schema.names) if (players, months) != (None, None) else None
        for s, schema in LANDING.items()
    }
    lines, rejected = {}, {}
    for source, schema in LANDING.items():
        path = f"{landed}/{source}"
        there = path_exists(spark, path)
        lines[source], rejected[source] = (
            payloads.count_lines(spark, path, schema, keep[source]) if there else (0, 0)
        )
    found = [
        payloads.rejected_lines(spark, f"{landed}/{s}", LANDING[s], keep[s]).select(
            F.lit(s).alias("source"), "path", "line"
        )
        for s, n in rejected.items()
        if n
    ]
    write_rejects(spark, root, found)
    return lines, rejected


def write_rejects(spark: SparkSession, root: str, found: Sequence[DataFrame]) -> None:
    """``raw/rejects`` tells of the last load; a root that never had rejects has no such table."""
    rejects = table_path(root, "rejects")
    if found or table_exists(spark, rejects):
        replace_table(one_load(spark.createDataFrame([], REJECTS), *found), rejects)


def run_repair(spark: SparkSession, root: str) -> None:
    """Keep the latest row per game and per player of the raw tables."""
    ties = [c for c in RAW_GAMES.names if c not in ("game_url", "ingested_at")]
    repair_table(
        spark, table_path(root, "raw_games"), ["game_url"], ["ingested_at"], ties, GAME_CLUSTERING
    )
    ties = [c for c in RAW_PLAYERS.names if c not in ("username", "ingested_at")]
    repair_table(spark, table_path(root, "raw_players"), ["username"], ["ingested_at"], ties)


def write_all(root: str, built: dict[str, tuple[DataFrame, Sequence[str]]]) -> None:
    """Write tables that do not depend on each other at the same time.

    One job alone rarely fills a cluster up to its last task.
    """

    def write(name: str) -> None:
        df, order = built[name]
        replace_table(df, table_path(root, name), order, gather=False)

    with ThreadPoolExecutor(len(built)) as pool:
        for done in [pool.submit(write, name) for name in built]:
            done.result()


def run_models(
    spark: SparkSession,
    root: str,
    grain: str = "day",
    key: Sequence[str] = ("game_url",),
    result_map: Mapping[str, str] | None = None,
    with_text: bool = False,
) -> None:
    """Raw tables to marts, in the order of their dependencies.

    ``key`` and ``result_map`` are those of ``stage_games``, ``grain`` that of
    the progression. ``with_text`` also writes ``stg_games``, the staged games
    with their text, for sessions that read tables.

    The de-duplication shuffles every game, so its result is written once, in
    place of the view that every mart would compute anew. The game text stays
    behind: the written table carries the tags taken from it.
    """
    raw_games, raw_players = (table(spark, root, n) for n in RAW_TABLES)
    how = {"key": key, "result_map": result_map}
    staged = {
        "game_facts": (game_facts(raw_games, **how), []),
        "stg_players": (stage_players(raw_players), []),
    }
    if with_text:
        staged["stg_games"] = (stage_games(raw_games, **how, text_ties=True), [])
    write_all(root, staged)
    games, players = table(spark, root, "game_facts"), table(spark, root, "stg_players")
    series = ["username", "time_class"]
    write_all(
        root,
        {
            "int_player_performance": (player_performance(games), series),
            "mart_opening_analysis": (marts.opening_analysis(games), series),
            "mart_elo_progression": (
                marts.rating_progression(games, grain),
                [*series, "game_date"],
            ),
        },
    )
    performance = table(spark, root, "int_player_performance")
    write_all(
        root, {"mart_player_stats": (marts.player_stats(players, performance), ["username"])}
    )


def register_views(spark: SparkSession, root: str, **options) -> None:
    """Temporary views for SQL users; the staging views compute from raw.

    ``options`` are those of ``stage_games``.
    """
    raw_games, raw_players = (table(spark, root, n) for n in RAW_TABLES)
    games = stage_games(raw_games, **options)
    views = {
        "raw_games": raw_games,
        "raw_players": raw_players,
        "stg_games": stage_games(raw_games, **options, text_ties=True),
        "stg_players": stage_players(raw_players),
        "int_player_performance": player_performance(games),
        **{name: table(spark, root, name) for name in MARTS},
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def register_tables(spark: SparkSession, root: str, database: str = "default") -> None:
    """External catalog tables over the current versions, for other sessions.

    Call it again after a load. ``stg_games`` is there if the models were run
    ``with_text``, ``rejects`` if a load left any.
    """
    optional = [n for n in ("stg_games", "rejects") if table_exists(spark, table_path(root, n))]
    for name in [*RAW_TABLES, *STAGING, *MARTS, *optional]:
        register_table(spark, f"{database}.{name}", table_path(root, name))


def _checked(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The written table that holds the checked columns."""
    return table(spark, root, "game_facts" if name == "stg_games" else name)


def _suites(spark: SparkSession, root: str, declared: dict) -> DataFrame:
    return one_load(
        *[run_suite(_checked(spark, root, name), name, checks) for name, checks in declared.items()]
    )


def run_checks(
    spark: SparkSession,
    root: str,
    players: Sequence[str] = fixed.TRACKED_PLAYERS,
    fail_on_error: bool = False,
) -> DataFrame:
    """One row per declared schema test of every table."""
    results = settled(_suites(spark, root, schema_tests(players)))
    if fail_on_error:
        raise_on_failure(results)
    return results


def run_freshness(spark: SparkSession, root: str, as_of: str) -> DataFrame:
    """One row per raw table."""
    return one_load(
        *[
            freshness(table(spark, root, name), "ingested_at", as_of).select(
                F.lit(name).alias("table_name"), "*"
            )
            for name in RAW_TABLES
        ]
    )


def run_transformation(
    spark: SparkSession,
    root: str,
    as_of: str,
    players: Sequence[str] = fixed.TRACKED_PLAYERS,
    fail_on_error: bool = True,
    **options,
) -> DataFrame:
    """Models, then their tests, then source freshness (which is returned).

    ``options`` are those of ``run_models``.
    """
    run_models(spark, root, **options)
    run_checks(spark, root, players, fail_on_error)
    return run_freshness(spark, root, as_of)


def expectation_results(
    spark: SparkSession, root: str, fail_on_error: bool = False
) -> DataFrame:
    """One row per expectation of every suite."""
    results = settled(_suites(spark, root, expectations()))
    if fail_on_error:
        raise_on_failure(results)
    return results


def run_expectations(spark: SparkSession, root: str, fail_on_error: bool = False) -> DataFrame:
    """Passed and failed expectations per suite."""
    return summarize(expectation_results(spark, root, fail_on_error))
