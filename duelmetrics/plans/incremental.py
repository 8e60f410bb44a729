"""Incremental loads and marts: what is new is read, what it touches is rewritten.

A load parses the landed files that no load before it has parsed, puts their
games and players into raw tables kept by key, and notes the files. The marts
are finished from states: the counts, sums, extremes and closing pair of each
player, format and day, and the counts of each opening and month. A load
recomputes the states of the months its games fall into, from those months'
facts; sums over states take the place of sums over games.

A job may be lost between any two tables. Each is committed as a whole, in the
order raw tables, ledger, facts, states, marts. Files that were loaded but not
noted are loaded again, which changes nothing; each table notes the version it
was made from, and where that is not the one before the current, it is rebuilt.
"""

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from duelmetrics import fixed_values as fixed
from duelmetrics.functions.clock import epoch_from_utc, utc_day, utc_from_epoch
from duelmetrics.functions.measures import row_count
from duelmetrics.operators.progression import change_vs_previous, packed_order, period_close, repeat_for_ties
from duelmetrics.plans import marts
from duelmetrics.plans.pipeline import (
    GAME_CLUSTERING,
    LANDING,
    RAW_TABLES,
    raise_on_rejects,
    table,
    table_path,
    write_all,
    write_rejects,
)
from duelmetrics.plans.staging import game_facts, stage_players
from duelmetrics.quality.history import profile_drift, record_profile
from duelmetrics.schemas import RAW_GAMES, RAW_PLAYERS
from duelmetrics.sources import parts, payloads
from duelmetrics.sources.parts import PART, append_parts, change_parts, read_parts, write_parts
from duelmetrics.sources.scratch import scratch_dir
from duelmetrics.sources.tables import Version, current_version, path_exists, replace_table

LEDGER, PROFILES = "loaded_files", "load_profiles"
LEDGER_SCHEMA = "source string, path string, length bigint, modified timestamp, loaded_at string"
SERIES = ["username", "time_class"]
OPENING = ["username", "time_class", "player_color", "opening_slug", "eco_code"]
DAY_STATES, OPENING_STATES = "day_states", "opening_states"


@dataclass(frozen=True)
class Loaded:
    """What an incremental load read: new files, lines and rejected lines by source."""

    files: dict[str, int]
    lines: dict[str, int]
    rejected: dict[str, int]


def ledger(spark: SparkSession, root: str) -> DataFrame:
    """The files that loads have parsed."""
    empty = spark.createDataFrame([], LEDGER_SCHEMA)
    return read_parts(spark, table_path(root, LEDGER), empty.schema)


def _new_files(
    spark: SparkSession, landed: str, root: str, source: str, keep: Column
) -> DataFrame:
    """Selected files that were not parsed before as they are now: another length or time makes a file new."""
    seen = ledger(spark, root).filter(F.col("source") == source)
    files = payloads.landed_files(spark, f"{landed}/{source}").filter(keep)
    return files.join(seen, ["path", "length", "modified"], "left_anti")


def _paths(files: DataFrame) -> list[str]:
    """Their names, which Spark's file index on the driver holds anyway."""
    return sorted(r["path"] for r in files.select("path").collect())


def load_new(
    spark: SparkSession,
    landed: str,
    root: str,
    ingested_at: str,
    players: Sequence[str] | None = None,
    months: Sequence[str] | None = None,
    allow_rejects: bool = False,
    buckets: int = parts.BUCKETS,
) -> Loaded:
    """Put what has landed since the last load into the raw tables, the latest row per game and player.

    ``players`` and ``months`` select folders; other files stay new. Files are
    found by their folder's listing, and each is parsed once. Lines that cannot be
    read in full are listed in ``raw/rejects`` and end the load, unless
    ``allow_rejects`` is set and some archive is readable. Of a player with a new
    profile or new stats all profiles and stats are read again, so the newest of
    both meet. A profile of the games that came is kept under ``ingested_at``, for
    ``drift_since``.
    """

    def parse(source: str) -> tuple[list, DataFrame, int, int]:
        keep = payloads.selected(players, months, LANDING[source].names)
        there = path_exists(spark, f"{landed}/{source}")
        new = _new_files(spark, landed, root, source, keep).collect() if there else []
        path = scratch_dir(spark, source)
        files = [r["path"] for r in new]
        payloads.parsed_files(spark, files, LANDING[source], f"{landed}/{source}").write.parquet(path)
        rows = spark.read.parquet(path)
        counted = rows.agg(row_count(), F.count_if("rejected")).first()
        noted = [(source, r["path"], r["length"], r["modified"], ingested_at) for r in new]
        return noted, rows, counted[0], counted[1]

    with ThreadPoolExecutor(len(LANDING)) as pool:  # sources are independent and mostly small
        parsed = dict(zip(LANDING, pool.map(parse, LANDING)))
    found = {s: p[0] for s, p in parsed.items()}
    staged = {s: p[1] for s, p in parsed.items()}
    lines = {s: p[2] for s, p in parsed.items()}
    rejected = {s: p[3] for s, p in parsed.items()}
    listed = [
        df.filter("rejected").select(F.lit(s).alias("source"), "path", "line")
        for s, df in staged.items()
        if rejected[s]
    ]
    write_rejects(spark, root, listed)
    raise_on_rejects(lines, rejected, root, allow_rejects)

    games = payloads.flatten_archives(staged["archives"].select("username", "games"), ingested_at)
    ties = [c for c in RAW_GAMES.names if c not in ("game_url", "ingested_at")]
    loaded = parts.upsert(
        games, table_path(root, "raw_games"), ["game_url"], ["ingested_at"], ties, buckets, GAME_CLUSTERING
    )
    if loaded:
        came, _ = parts.changes(spark, table_path(root, "raw_games"), loaded, RAW_GAMES)
        record_profile(came.drop("ingested_at"), table_path(root, PROFILES), ingested_at)
    if found["profiles"] or found["stats"]:
        _load_players(spark, landed, root, ingested_at, staged, buckets)
    noted = [row for rows in found.values() for row in rows]
    if noted:
        new = spark.createDataFrame(noted, LEDGER_SCHEMA)
        append_parts(new.withColumn(PART, F.col("source")), table_path(root, LEDGER))
    return Loaded({s: len(f) for s, f in found.items()}, lines, rejected)


def drift_since(spark: SparkSession, root: str, before: str, after: str, **limits: float) -> DataFrame:
    """What changed in the games from the load of one time to that of another, by their kept profiles."""
    return profile_drift(spark, table_path(root, PROFILES), before, after, **limits)


def _load_players(
    spark: SparkSession, landed: str, root: str, ingested_at: str, staged: dict[str, DataFrame], buckets: int
) -> None:
    sources = ("profiles", "stats")
    touched = staged[sources[0]].select("username").union(staged[sources[1]].select("username")).distinct()
    read = {}
    for source in sources:
        there = path_exists(spark, f"{landed}/{source}")
        files = payloads.landed_files(spark, f"{landed}/{source}").join(touched, "username", "left_semi") if there else None
        read[source] = payloads.parsed_files(
            spark, _paths(files) if there else [], LANDING[source], f"{landed}/{source}"
        )
    roster = payloads.flatten_players(payloads.with_content(read["profiles"]), read["stats"], ingested_at)
    ties = [c for c in RAW_PLAYERS.names if c not in ("username", "ingested_at")]
    parts.upsert(roster, table_path(root, "raw_players"), ["username"], ["ingested_at"], ties, buckets)


def _month(ended_at: Column) -> Column:
    return F.coalesce(F.substring(ended_at.cast("string"), 1, 7), F.lit("none"))


def _facts(raw: DataFrame, result_map: Mapping[str, str] | None) -> DataFrame:
    facts = game_facts(raw, unique=True, result_map=result_map)
    return facts.withColumn(PART, _month(F.col("ended_at")))


def _facts_schema(spark: SparkSession) -> StructType:
    return _facts(spark.createDataFrame([], RAW_GAMES), None).drop(PART).schema


def refresh_facts(
    spark: SparkSession, root: str, result_map: Mapping[str, str] | None = None
) -> tuple[Version | None, list[str] | None]:
    """Bring the facts up to the raw games; their version, and the months that changed (None: all).

    The table is kept by month. Games that came with the load are added to their
    months; only months that lost a row to a newer one are written anew.
    """
    raw_path, path = table_path(root, "raw_games"), table_path(root, "game_facts")
    raw, since = current_version(spark, raw_path), current_version(spark, path)
    if raw is None:
        return since, []
    if since and since.note == str(raw.number):
        return since, []
    if since is None or since.note != str(raw.number - 1):
        folders = write_parts(_facts(read_parts(spark, raw_path, RAW_GAMES), result_map), path)
        gone = [parts.part_of(f) for f in since.folders] if since else []
        return change_parts(spark, path, since, gone, folders, str(raw.number)), None
    came, went = parts.changes(spark, raw_path, raw, RAW_GAMES)
    added = write_parts(_facts(came, result_map), path)
    lost = went.select("game_url", _month(utc_from_epoch(F.col("end_time"))).alias(PART))
    hit = parts.distinct_parts(lost)
    if hit:
        old = read_parts(spark, path, _facts_schema(spark), hit).withColumn(PART, _month(F.col("ended_at")))
        keys = lost.select(F.col("game_url").alias("_lost"))
        stayed = old.join(keys, F.col("game_url").eqNullSafe(F.col("_lost")), "left_anti")
        added = [*write_parts(stayed, path), *added]
    version = change_parts(spark, path, since, hit, added, str(raw.number))
    return version, sorted({*hit, *map(parts.part_of, added)})


def day_states(facts: DataFrame) -> DataFrame:
    """Of each player, format and day: what performance and progression are finished from."""
    result, color, rating = F.col("player_result"), F.col("player_color"), F.col("player_rating")
    won = result == fixed.WIN
    return period_close(
        facts.withColumn("game_date", utc_day(F.col("ended_at"))),
        keys=[PART, *SERIES, "game_date"],
        value="player_rating",
        order=packed_order(epoch_from_utc(F.col("ended_at")), rating),
        closing="closing_rating",
        measures={
            "games": row_count(),
            "wins": F.count_if(won),
            "losses": F.count_if(result == fixed.LOSS),
            "draws": F.count_if(result == fixed.DRAW),
            "white_games": F.count_if(color == "white"),
            "black_games": F.count_if(color == "black"),
            "white_wins": F.count_if((color == "white") & won),
            "black_wins": F.count_if((color == "black") & won),
            "rating_sum": F.sum(rating),
            "rating_count": F.count(rating),
            "rating_max": F.max(rating),
            "rating_min": F.min(rating),
            "opponent_sum": F.sum("opponent_rating"),
            "opponent_count": F.count("opponent_rating"),
            "first_game_at": F.min("ended_at"),
            "last_game_at": F.max("ended_at"),
        },
    )


def opening_states(facts: DataFrame) -> DataFrame:
    """Of each player, format, colour, opening and month: what the opening analysis is finished from."""
    result, rating = F.col("player_result"), F.col("player_rating")
    unknown = F.lit(fixed.UNKNOWN_OPENING)
    labelled = facts.withColumns({c: F.coalesce(c, unknown) for c in ("opening_slug", "eco_code")})
    return labelled.groupBy(PART, *OPENING).agg(
        row_count().alias("games"),
        F.count_if(result == fixed.WIN).alias("wins"),
        F.count_if(result == fixed.LOSS).alias("losses"),
        F.count_if(result == fixed.DRAW).alias("draws"),
        F.sum(rating).alias("rating_sum"),
        F.count(rating).alias("rating_count"),
    )


STATES = {DAY_STATES: day_states, OPENING_STATES: opening_states}


def _states_schema(spark: SparkSession, name: str) -> StructType:
    return STATES[name](_facts(spark.createDataFrame([], RAW_GAMES), None)).drop(PART).schema


def refresh_states(
    spark: SparkSession, root: str, facts: Version, before: Version | None, months: list[str] | None
) -> None:
    """Recompute the states of the months that changed, from those months' facts alone."""
    source = table_path(root, "game_facts")
    for name, build in STATES.items():
        path = table_path(root, name)
        since = current_version(spark, path)
        if since and since.note == str(facts.number):
            continue
        known = since and before and since.note == str(before.number)
        chosen = months if known else None
        rows = read_parts(spark, source, _facts_schema(spark), chosen).withColumn(PART, _month(F.col("ended_at")))
        gone = [parts.part_of(f) for f in since.folders] if since and chosen is None else chosen or []
        change_parts(spark, path, since, gone, write_parts(build(rows), path), str(facts.number))


def _ratio(total: str, count: str) -> Column:
    return F.round(F.try_divide(F.sum(total), F.sum(count)), 0)


def _rate(wins: str, games: str) -> Column:
    return F.round(F.sum(wins) / F.sum(games) * 100, 2)


def performance_of(days: DataFrame) -> DataFrame:
    """``player_performance`` from the states of days."""
    sums = {
        "total_games": "games", "total_wins": "wins", "total_losses": "losses", "total_draws": "draws",
    }
    sided = {
        "games_as_white": "white_games", "games_as_black": "black_games",
        "wins_as_white": "white_wins", "wins_as_black": "black_wins",
    }
    return days.groupBy(*SERIES).agg(
        *[F.sum(c).alias(n) for n, c in sums.items()],
        _rate("wins", "games").alias("win_rate_pct"),
        *[F.sum(c).alias(n) for n, c in sided.items()],
        _ratio("rating_sum", "rating_count").alias("avg_rating"),
        F.max("rating_max").alias("max_rating"),
        F.min("rating_min").alias("min_rating"),
        _ratio("opponent_sum", "opponent_count").alias("avg_opponent_rating"),
        F.min("first_game_at").alias("first_game_at"),
        F.max("last_game_at").alias("last_game_at"),
    )


def openings_of(states: DataFrame, min_games: int = fixed.MIN_OPENING_GAMES) -> DataFrame:
    """``opening_analysis`` from the states of months."""
    return (
        states.groupBy(*OPENING)
        .agg(
            F.sum("games").alias("total_games"),
            *[F.sum(c).alias(c) for c in ("wins", "losses", "draws")],
            _rate("wins", "games").alias("win_rate_pct"),
            _ratio("rating_sum", "rating_count").alias("avg_rating"),
        )
        .filter(F.col("total_games") >= min_games)
    )


def progression_of(days: DataFrame, grain: str = "day") -> DataFrame:
    """``rating_progression`` from the states of days."""
    if grain not in ("day", "as_written"):
        raise ValueError(f"unknown grain: {grain}")
    daily = days.select(
        *SERIES,
        "game_date",
        "closing_rating",
        F.col("rating_max").alias("daily_max_rating"),
        F.col("rating_min").alias("daily_min_rating"),
        F.col("games").alias("daily_games"),
        F.col("wins").alias("daily_wins"),
    )
    changed = change_vs_previous(daily, SERIES, "game_date", "closing_rating", "rating_change")
    if grain == "as_written":
        return repeat_for_ties(changed, "daily_games", "closing_rating", "rating_change")
    return changed


def refresh_marts(
    spark: SparkSession,
    root: str,
    grain: str = "day",
    result_map: Mapping[str, str] | None = None,
) -> list[str] | None:
    """Bring facts, states and marts up to the raw tables; the months that were recomputed (None: all).

    ``result_map`` must stay the same from load to load. The players' table is
    small and written anew.
    """
    before = current_version(spark, table_path(root, "game_facts"))
    facts, months = refresh_facts(spark, root, result_map)
    if facts is not None:
        refresh_states(spark, root, facts, before, months)
    states = {n: read_parts(spark, table_path(root, n), _states_schema(spark, n)) for n in STATES}
    if current_version(spark, table_path(root, "raw_players")):
        players = table(spark, root, "raw_players")
    else:
        players = spark.createDataFrame([], RAW_TABLES["raw_players"])
    written = {
        "stg_players": (stage_players(players), []),
        "int_player_performance": (performance_of(states[DAY_STATES]), SERIES),
        "mart_opening_analysis": (openings_of(states[OPENING_STATES]), SERIES),
        "mart_elo_progression": (progression_of(states[DAY_STATES], grain), [*SERIES, "game_date"]),
    }
    write_all(root, written)
    stats = marts.player_stats(table(spark, root, "stg_players"), table(spark, root, "int_player_performance"))
    replace_table(stats, table_path(root, "mart_player_stats"), ["username"], gather=False)
    return months


def run_update(
    spark: SparkSession,
    landed: str,
    root: str,
    ingested_at: str,
    grain: str = "day",
    result_map: Mapping[str, str] | None = None,
    **selection,
) -> Loaded:
    """``load_new`` and then ``refresh_marts``; ``selection`` are further arguments of the load."""
    done = load_new(spark, landed, root, ingested_at, **selection)
    refresh_marts(spark, root, grain, result_map)
    return done
