"""Registered queries: name -> function of (spark, sf_dir)."""

from collections.abc import Callable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelmetrics.functions.clock import (
    epoch_from_utc,
    iso_from_utc,
    utc_day,
    utc_from_epoch,
    utc_from_iso,
)
from duelmetrics.functions.measures import mean_rounded, rate_pct, row_count
from duelmetrics.functions.text import (
    last_segment,
    one_decimal,
    signed_delta,
    tag_value,
    whole_number,
)
from duelmetrics.operators.coverage import coverage_gaps
from duelmetrics.operators.interleave import spread_evenly
from duelmetrics.operators.latest import latest_per_key
from duelmetrics.operators.perspective import perspective
from duelmetrics.operators.progression import (
    change_vs_previous,
    period_close,
    repeat_for_ties,
)
from duelmetrics.operators.ranking import (
    argmax_row,
    argmax_value,
    first_appearances,
    top_rows,
)
from duelmetrics.operators.reshape import long_form, pivot_metrics, share_of_total
from duelmetrics.plans import frames, incremental, marts, pipeline
from duelmetrics.plans.performance import player_performance
from duelmetrics.plans.staging import game_facts, stage_games, stage_players
from duelmetrics.quality import checks as dq
from duelmetrics.quality import history, monitors
from duelmetrics.quality.declared import expectations, schema_tests
from duelmetrics.registry import shapes
from duelmetrics.registry.shapes import read
from duelmetrics.schemas import ARCHIVE, RAW_GAMES
from duelmetrics.sources import parts, payloads, tables
from duelmetrics.sources.raw_tables import one_load, read_raw_games, read_raw_players
from duelmetrics.sources.scratch import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]

PLAYERS = [f"player{i}" for i in range(7)]
CHOSEN = ["player0", "player1", "player2"]
AS_OF = "2024-02-01T00:00:00"
BATCH = "2024-01-31T06:00:00"
DAYS = [date(2024, 1, 1) + timedelta(days=i) for i in range(31)]
HOST = r"^https?://(?:www\.|m\.|blog\.)?([^/?#]+)"
CAMPAIGN = r"[?&]utm_source=([^&#]+)"
LINEITEM_TIES = [
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
]

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# --- inputs ------------------------------------------------------------------


def _raw_games(spark: SparkSession, sf: str) -> DataFrame:
    return shapes.raw_games(read(spark, sf, "events"))


def _raw_players(spark: SparkSession, sf: str) -> DataFrame:
    return shapes.raw_players(read(spark, sf, "events"))


def _games(spark: SparkSession, sf: str) -> DataFrame:
    return stage_games(_raw_games(spark, sf))


def _facts(spark: SparkSession, sf: str) -> DataFrame:
    return game_facts(_raw_games(spark, sf))


def _written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table, for several passes over it."""
    path = scratch_dir(df.sparkSession, label)
    tables.replace_table(df, path)
    return tables.read_table(df.sparkSession, path)


def _stats(spark: SparkSession, sf: str) -> DataFrame:
    performance = player_performance(_games(spark, sf))
    return marts.player_stats(stage_players(_raw_players(spark, sf)), performance)


def _openings(spark: SparkSession, sf: str) -> DataFrame:
    return marts.opening_analysis(_facts(spark, sf))


def _progression(spark: SparkSession, sf: str) -> DataFrame:
    return marts.rating_progression(_games(spark, sf))


# --- tables over games -------------------------------------------------------


@query
def stg_games(spark, sf):
    return stage_games(_raw_games(spark, sf), text_ties=True)


@query
def stg_games_both_sides(spark, sf):
    return stage_games(_raw_games(spark, sf), key=("game_url", "username"))


@query
def stg_players(spark, sf):
    return stage_players(_raw_players(spark, sf))


@query
def int_player_performance(spark, sf):
    return player_performance(_games(spark, sf))


@query
def mart_player_stats(spark, sf):
    return _stats(spark, sf)


@query
def mart_opening_analysis(spark, sf):
    return _openings(spark, sf)


@query
def mart_elo_progression(spark, sf):
    return _progression(spark, sf)


@query
def mart_elo_progression_as_written(spark, sf):
    return marts.rating_progression(_games(spark, sf), grain="as_written")


# --- dashboard frames --------------------------------------------------------


@query
def kpi_row(spark, sf):
    return frames.kpi_row(_stats(spark, sf))


@query
def kpi_labels(spark, sf):
    return frames.kpi_labels(_stats(spark, sf))


@query
def best_blitz_player(spark, sf):
    return frames.best_blitz_player(_stats(spark, sf)).select("username", "blitz_win_rate_pct")


@query
def player_table(spark, sf):
    return frames.player_table(_stats(spark, sf))


@query
def games_share(spark, sf):
    return frames.games_share(_written(_stats(spark, sf), "stats"))


@query
def win_rate_long(spark, sf):
    return frames.win_rate_by_format(_stats(spark, sf))


@query
def rating_series(spark, sf):
    return frames.rating_series(_progression(spark, sf), CHOSEN, "blitz")


@query
def rating_change_series(spark, sf):
    return frames.rating_change_series(_progression(spark, sf), CHOSEN, "blitz")


@query
def top15(spark, sf):
    return frames.top_openings(_openings(spark, sf), "player0", "blitz", "white")


@query
def compare_two(spark, sf):
    return frames.compare_players(_stats(spark, sf), "player1", "player2")


@query
def openings_in_order(spark, sf):
    return frames.openings_in_order(_openings(spark, sf))


@query
def options_username(spark, sf):
    return frames.progression_options(_progression(spark, sf), "username")


@query
def options_time_class(spark, sf):
    return frames.progression_options(_progression(spark, sf), "time_class")


@query
def options_opening_username(spark, sf):
    return frames.opening_options(_openings(spark, sf), "username")


@query
def options_opening_time_class(spark, sf):
    return frames.opening_options(_openings(spark, sf), "time_class")


@query
def options_player(spark, sf):
    return frames.player_options(_stats(spark, sf))


@query
def default_players(spark, sf):
    return frames.default_players(_progression(spark, sf))


@query
def default_format(spark, sf):
    return frames.default_format(_progression(spark, sf))


@query
def default_opening_player(spark, sf):
    return frames.default_opening_choice(_openings(spark, sf), "username")


@query
def default_pair(spark, sf):
    return frames.default_pair(_stats(spark, sf))


# --- the operators on other tables -------------------------------------------


@query
def latest_per_key_lineitem(spark, sf):
    lines = read(spark, sf, "lineitem")
    return latest_per_key(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"], LINEITEM_TIES)


@query
def distinct_lineitem_flags(spark, sf):
    return (
        read(spark, sf, "lineitem")
        .select("l_returnflag", "l_linestatus", "l_linenumber", "l_tax")
        .dropDuplicates()
    )


@query
def perspective_orders(spark, sf):
    """Orders between a customer and a desk, seen from the customer."""
    customers = read(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    orders = read(spark, sf, "orders")
    even = F.col("o_orderkey") % 2 == 0
    desk = F.concat(F.lit("Desk"), (F.col("o_orderkey") % 50).cast("string"))
    balance, price = F.col("c_acctbal"), F.col("o_totalprice")
    sides = orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        "o_orderkey",
        "c_name",
        F.when(even, F.upper("c_name")).otherwise(desk).alias("buyer"),
        F.when(even, desk).otherwise(F.upper("c_name")).alias("seller"),
        F.when(even, balance).otherwise(price).alias("buyer_amount"),
        F.when(even, price).otherwise(balance).alias("seller_amount"),
    )
    seen = perspective(
        sides,
        me="c_name",
        first="buyer",
        fields={
            "own_amount": ("buyer_amount", "seller_amount"),
            "other_amount": ("seller_amount", "buyer_amount"),
            "other_party": ("seller", "buyer"),
        },
        side="role",
        labels=("buyer", "seller"),
    )
    return seen.select(
        "o_orderkey",
        F.lower("c_name").alias("customer"),
        "role",
        "own_amount",
        "other_amount",
        F.lower("other_party").alias("other_party"),
    )


def _order_performance(spark: SparkSession, sf: str, *keys: str) -> DataFrame:
    status, price = F.col("o_orderstatus"), F.floor("o_totalprice")
    even = F.col("o_orderkey") % 2 == 0
    filled = status == "F"
    return (
        read(spark, sf, "orders")
        .groupBy(*keys)
        .agg(
            row_count().alias("total_orders"),
            F.count_if(filled).alias("filled"),
            F.count_if(status == "O").alias("open_orders"),
            F.count_if(status == "P").alias("partial_orders"),
            rate_pct(filled).alias("fill_rate_pct"),
            F.count_if(even).alias("even_orders"),
            F.count_if(even & filled).alias("even_filled"),
            mean_rounded(price).alias("avg_price"),
            F.max(price).alias("max_price"),
            F.min(price).alias("min_price"),
            F.min("o_orderdate").alias("first_order_at"),
            F.max("o_orderdate").alias("last_order_at"),
        )
    )


@query
def customer_performance(spark, sf):
    return _order_performance(spark, sf, "o_custkey", "o_orderpriority")


@query
def order_pivot_by_status(spark, sf):
    """Customers with their orders per status side by side."""
    price = F.floor("o_totalprice")
    per_status = (
        read(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("c_custkey"), "o_orderstatus")
        .agg(row_count().alias("n"), F.max(price).alias("top"))
    )
    pivoted = pivot_metrics(
        per_status, "c_custkey", "o_orderstatus", ["F", "O", "P"], {"orders": "n", "top": "top"}
    )
    none = F.lit(0)
    customers = read(spark, sf, "customer").select("c_custkey", "c_name")
    return customers.join(pivoted, "c_custkey", "left").withColumn(
        "orders_all",
        F.coalesce("F_orders", none) + F.coalesce("O_orders", none) + F.coalesce("P_orders", none),
    )


@query
def url_tag_stats(spark, sf):
    """Pages per host and language, tags taken from the address."""
    unknown = F.lit("unknown")
    return (
        read(spark, sf, "pages")
        .select(
            F.coalesce(tag_value("url", HOST), unknown).alias("host"),
            F.coalesce(tag_value("url", CAMPAIGN), unknown).alias("campaign"),
            F.length("url").alias("url_length"),
        )
        .groupBy("host", "campaign")
        .agg(
            row_count().alias("total_pages"),
            rate_pct(F.col("url_length") > 40).alias("long_url_pct"),
            mean_rounded("url_length").alias("avg_length"),
        )
        .filter(F.col("total_pages") >= 3)
    )


def _event_days(spark: SparkSession, sf: str) -> DataFrame:
    events = read(spark, sf, "events").withColumn("day", utc_day(F.col("ts")))
    daily = period_close(
        events,
        keys=["user_id", "event_type", "day"],
        value="value",
        order=["ts", "event_id"],
        closing="closing",
        measures={
            "daily_max": F.max("value"),
            "daily_min": F.min("value"),
            "daily_rows": row_count(),
            "daily_hits": F.count_if(F.col("value") > 50),
        },
    )
    return change_vs_previous(daily, ["user_id", "event_type"], "day", "closing", "change")


@query
def event_daily_close(spark, sf):
    return _event_days(spark, sf).orderBy("user_id", "event_type", "day")


@query
def event_daily_close_as_written(spark, sf):
    return repeat_for_ties(_event_days(spark, sf), "daily_rows", "closing", "change")


@query
def event_change_vs_previous(spark, sf):
    daily = (
        read(spark, sf, "events")
        .groupBy("event_type", utc_day(F.col("ts")).alias("day"))
        .agg(row_count().alias("n_events"))
    )
    return change_vs_previous(daily, ["event_type"], "day", "n_events", "change")


@query
def order_status_long(spark, sf):
    """Counts per priority, unfolded to one row per status."""
    wide = _order_performance(spark, sf, "o_orderpriority")
    return long_form(
        wide, ["o_orderpriority"], ["filled", "open_orders", "partial_orders"], "status", "n_orders"
    )


@query
def segment_share(spark, sf):
    segments = read(spark, sf, "customer").groupBy("c_mktsegment").agg(row_count().alias("n"))
    return share_of_total(segments, "n", "share")


@query
def top_orders(spark, sf):
    orders = read(spark, sf, "orders").filter(F.col("o_orderstatus") == "F")
    return top_rows(orders, 15, ["o_totalprice"], ["o_orderkey"]).select(
        "o_orderkey", "o_totalprice"
    )


@query
def best_customer(spark, sf):
    customers = read(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return argmax_row(customers, "c_acctbal", [], ["c_custkey"])


@query
def ranking_null_ties(spark, sf):
    """The first row by price band, then by a key that some rows lack, in four forms."""
    orders = read(spark, sf, "orders").select(
        "o_orderkey",
        F.floor(F.col("o_totalprice") / 100000).alias("band"),
        F.when(F.col("o_custkey") % 3 != 0, F.col("o_custkey")).alias("rank"),
    )
    order = {"down": ["rank"], "up": ["o_orderkey"]}
    best = argmax_row(orders, "band", **order).select(F.col("o_orderkey").alias("by_row"))
    value = orders.agg(argmax_value("o_orderkey", "band", **order).alias("by_value"))
    top = top_rows(orders, 1, ["band", "rank"], ["o_orderkey"])
    seen = first_appearances(orders, "o_orderkey", 1, ["band", "rank"], ["o_orderkey"])
    parts = [
        best.select(F.lit("argmax_row").alias("form"), F.col("by_row").alias("o_orderkey")),
        value.select(F.lit("argmax_value"), "by_value"),
        top.select(F.lit("top_rows"), "o_orderkey"),
        seen.select(F.lit("first_appearances"), "o_orderkey"),
    ]
    return one_load(*[p.toDF("form", "o_orderkey") for p in parts])


@query
def text_ties(spark, sf):
    """Numbers in the middle between two shown ones, and others near it."""
    key = F.col("o_orderkey")
    value = F.when(key % 2 == 0, (key % 4001) / 20).otherwise((key % 997) / 8 - 50)
    unit = F.lit("%")
    return read(spark, sf, "orders").select(
        "o_orderkey",
        one_decimal(value, "%").alias("one_decimal"),
        signed_delta(value - 62.25, unit).alias("delta"),
        whole_number(value, unit).alias("whole"),
    )


@query
def epoch_to_day(spark, sf):
    seconds = epoch_from_utc(F.col("ts"))
    return (
        read(spark, sf, "events")
        .select("event_id", seconds.alias("end_time"))
        .withColumn("ended_at", utc_from_epoch(F.col("end_time")))
        .withColumn("game_date", utc_day(F.col("ended_at")))
    )


@query
def greatest_peak(spark, sf):
    """Largest of three amounts, of which some are missing."""
    amount = F.floor("l_extendedprice")
    parts = {
        flag: F.max(F.when(F.col("l_returnflag") == flag, amount)) for flag in ("A", "N", "R")
    }
    per_order = (
        read(spark, sf, "lineitem")
        .groupBy("l_orderkey")
        .agg(*[p.alias(f"peak_{f.lower()}") for f, p in parts.items()])
    )
    return per_order.withColumn(
        "peak", F.greatest(*[F.coalesce(f"peak_{f.lower()}", F.lit(0)) for f in parts])
    )


@query
def last_segment_of_url(spark, sf):
    pages = read(spark, sf, "pages")
    return pages.select("page_id", last_segment(F.col("url")).alias("segment"))


@query
def coalesce_defaults(spark, sf):
    segment = F.nullif(F.col("c_mktsegment"), F.lit("BUILDING"))
    return read(spark, sf, "customer").select(
        "c_custkey",
        F.initcap(F.coalesce(segment, F.lit("unknown"))).alias("segment"),
        F.replace("c_name", F.lit("Customer#"), F.lit("")).alias("number"),
    )


@query
def coverage_gaps_user_days(spark, sf):
    """Days of the month on which a user has no event."""
    events = read(spark, sf, "events")
    landed = events.select("user_id", utc_day(F.col("ts")).alias("day"))
    return coverage_gaps(None, landed, "user_id", "day", DAYS)


# --- sources and sinks -------------------------------------------------------


@query
def ndjson_round_trip(spark, sf):
    path = scratch_dir(spark, "raw-games-json")
    _raw_games(spark, sf).write.json(path)
    return read_raw_games(spark, path)


@query
def ndjson_players(spark, sf):
    path = scratch_dir(spark, "raw-players-json")
    _raw_players(spark, sf).write.json(path)
    return read_raw_players(spark, path)


def _land(df: DataFrame, path: str, *partitions: str, mode: str = "append") -> str:
    df.write.mode(mode).partitionBy(*partitions).json(path)
    return path


@query
def archive_flatten(spark, sf):
    landed = shapes.archives(_raw_games(spark, sf))
    path = _land(landed, scratch_dir(spark, "archives"), "username", "year", "month")
    return payloads.flatten_archives(payloads.read_archives(spark, path), BATCH)


@query
def archive_rejects(spark, sf):
    """Lines of a landing folder that are not archives."""
    path = scratch_dir(spark, "mixed-lines")
    events = read(spark, sf, "events")
    broken = F.concat(F.lit('{"games": [{"url": "'), F.col("event_id").cast("string"))
    line = F.when(F.col("event_id") % 100 == 0, broken).otherwise('{"games": []}')
    events.select(line.alias("value")).write.text(path)
    return payloads.rejected_lines(spark, path, ARCHIVE).select("line")


@query
def player_payload_join(spark, sf):
    players = _raw_players(spark, sf)
    profiles = _land(shapes.profiles(players), scratch_dir(spark, "profiles"), "username")
    stats = _land(shapes.stats(players), scratch_dir(spark, "stats"), "username")
    return payloads.flatten_players(
        payloads.read_profiles(spark, profiles), payloads.read_stats(spark, stats), BATCH
    )


@query
def player_payload_latest(spark, sf):
    """Every player lands twice, the second time with lower ratings and another name."""
    players = _raw_players(spark, sf)
    profiles, stats = scratch_dir(spark, "profiles"), scratch_dir(spark, "stats")
    _land(shapes.profiles(players), profiles, "username")
    _land(shapes.stats(players), stats, "username")
    fallen = players.withColumns(
        {c: F.col(c) - 200 for c in ("rapid_rating", "blitz_rating")}
    ).withColumn("name", F.concat(F.lit("A"), "name"))
    _land(shapes.profiles(fallen), profiles, "username", mode="append")
    _land(shapes.stats(fallen), stats, "username", mode="append")
    return payloads.flatten_players(
        payloads.read_profiles(spark, profiles), payloads.read_stats(spark, stats), BATCH
    )


@query
def bag_union(spark, sf):
    """Two loads of the same customers, duplicates kept."""
    customers = read(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return one_load(customers, customers.filter(F.col("c_mktsegment") == "BUILDING"))


@query
def overwrite_guard(spark, sf):
    """A table after a load of other rows and a load of none."""
    path = scratch_dir(spark, "guarded")
    orders = read(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    for status in ("O", "F", "no such status"):
        tables.replace_table(
            orders.filter(F.col("o_orderstatus") == status), path, keep_if_empty=True
        )
    return tables.read_table(spark, path)


@query
def repair_in_place(spark, sf):
    path = scratch_dir(spark, "repaired")
    tables.replace_table(read(spark, sf, "lineitem"), path)
    tables.repair_table(
        spark, path, ["l_orderkey", "l_linenumber"], ["l_shipdate"], LINEITEM_TIES
    )
    return tables.read_table(spark, path)


@query
def repair_raw_games(spark, sf):
    """Copies of games that differ in the last column only are told apart by it."""
    games = _raw_games(spark, sf)
    copies = games.filter(F.col("end_time") % 5 == 0).withColumn(
        "pgn", F.concat("pgn", F.lit(" *"))
    )
    root = scratch_dir(spark, "root")
    tables.replace_table(one_load(games, copies), pipeline.table_path(root, "raw_games"))
    tables.replace_table(_raw_players(spark, sf), pipeline.table_path(root, "raw_players"))
    pipeline.run_repair(spark, root)
    return pipeline.table(spark, root, "raw_games")


@query
def repair_raw_players(spark, sf):
    root = scratch_dir(spark, "root")
    tables.replace_table(_raw_games(spark, sf), pipeline.table_path(root, "raw_games"))
    players = _raw_players(spark, sf)
    renamed = players.withColumn("name", F.concat(F.lit("A"), "name"))
    tables.replace_table(one_load(players, renamed), pipeline.table_path(root, "raw_players"))
    pipeline.run_repair(spark, root)
    return pipeline.table(spark, root, "raw_players")


@query
def clustered_slice(spark, sf):
    """A slice of a table that is clustered by the columns of the filter."""
    path = scratch_dir(spark, "clustered")
    tables.replace_table(_raw_games(spark, sf), path, ["username", "time_class"])
    games = tables.read_table(spark, path)
    chosen = (F.col("username") == "Player1") & (F.col("time_class") == "blitz")
    return games.filter(chosen).select("game_url", "white_rating", "end_time")


@query
def interleaved_slice(spark, sf):
    """A slice by time alone of a table whose files narrow down player, format and time."""
    path = scratch_dir(spark, "interleaved")
    games = _raw_games(spark, sf)
    tables.replace_table(spread_evenly(games, ["username", "time_class", "end_time"]), path)
    slice_ = F.col("end_time").between(1704931200, 1705017599)
    return tables.read_table(spark, path).filter(slice_).select("game_url", "white_rating", "end_time")


# --- data quality ------------------------------------------------------------


@query
def dq_schema_tests(spark, sf):
    """Every declared test of the six tables."""
    games = _written(_facts(spark, sf), "facts")
    players = _written(stage_players(_raw_players(spark, sf)), "players")
    performance = _written(player_performance(games), "performance")
    built = {
        "stg_games": games,
        "stg_players": players,
        "int_player_performance": performance,
        "mart_player_stats": marts.player_stats(players, performance),
        "mart_opening_analysis": marts.opening_analysis(games),
        "mart_elo_progression": marts.rating_progression(games),
    }
    return one_load(
        *[
            dq.run_suite(built[name], name, declared)
            for name, declared in schema_tests(PLAYERS).items()
        ]
    )


def _expectation_results(spark: SparkSession, sf: str) -> DataFrame:
    games = _written(_games(spark, sf).drop("pgn"), "games")
    stats = marts.player_stats(stage_players(_raw_players(spark, sf)), player_performance(games))
    built = {"mart_player_stats": stats, "stg_games": games}
    return one_load(
        *[dq.run_suite(built[name], name, declared) for name, declared in expectations().items()]
    )


@query
def dq_expectations(spark, sf):
    return _expectation_results(spark, sf)


@query
def dq_summary(spark, sf):
    return dq.summarize(_expectation_results(spark, sf))


@query
def dq_not_null(spark, sf):
    pages = read(spark, sf, "pages").withColumn("campaign", tag_value("url", CAMPAIGN))
    return dq.run_suite(pages, "pages", [dq.not_null(c) for c in ("page_id", "url", "campaign")])


@query
def dq_unique(spark, sf):
    lines = read(spark, sf, "lineitem")
    return dq.run_suite(lines, "lineitem", [dq.unique("l_orderkey"), dq.unique("l_partkey")])


@query
def dq_accepted(spark, sf):
    orders = read(spark, sf, "orders")
    return dq.run_suite(
        orders,
        "orders",
        [
            dq.accepted_values("o_orderstatus", ["F", "O"]),
            dq.accepted_values("o_orderstatus", ["F", "O", "P"]),
        ],
    )


@query
def dq_between(spark, sf):
    customers = read(spark, sf, "customer")
    return dq.run_suite(
        customers,
        "customer",
        [dq.between("c_acctbal", 0.0, 5000.0), dq.between("c_nationkey", 0, 24)],
    )


@query
def dq_row_count(spark, sf):
    orders = read(spark, sf, "orders")
    return dq.run_suite(
        orders,
        "orders",
        [dq.row_count_between(1000, 500000), dq.row_count_between(4, 6), dq.row_count_above(1000)],
    )


@query
def dq_relationships(spark, sf):
    customers = read(spark, sf, "customer")
    some = customers.filter(F.col("c_mktsegment") != "BUILDING")
    return dq.run_suite(
        read(spark, sf, "orders"),
        "orders",
        [
            dq.relationships("o_custkey", customers, "c_custkey"),
            dq.relationships("o_custkey", some, "c_custkey"),
        ],
    )


@query
def source_freshness(spark, sf):
    return monitors.freshness(_raw_games(spark, sf), "ingested_at", AS_OF)


@query
def freshness_offsets(spark, sf):
    """Load times with and without an offset, all of the same instants."""
    games = _raw_games(spark, sf)
    at = utc_from_epoch(F.col("end_time"))
    shown = lambda hours: iso_from_utc(F.timestamp_add("HOUR", F.lit(hours), at))
    text = (
        F.when(F.col("end_time") % 4 == 0, F.concat(shown(5), F.lit("+05:00")))
        .when(F.col("end_time") % 4 == 1, F.concat(shown(-3), F.lit("-0300")))
        .when(F.col("end_time") % 4 == 2, F.concat(shown(0), F.lit("Z")))
        .otherwise(shown(0))
    )
    loaded = games.withColumn("ingested_at", text)
    return loaded.groupBy("username").agg(
        F.max(utc_from_iso(F.col("ingested_at"))).alias("loaded_until"),
        F.count(utc_from_iso(F.col("ingested_at"))).alias("readable"),
    )


@query
def volume_check(spark, sf):
    return monitors.volume_check(_raw_games(spark, sf), "raw_games")


@query
def table_profile(spark, sf):
    return monitors.table_profile(_games(spark, sf), "username", "ended_at")


@query
def volume_anomaly(spark, sf):
    return monitors.volume_anomaly(
        read(spark, sf, "events"), ["event_type"], "ts", trailing=7, deviations=1.5
    )


@query
def schema_change(spark, sf):
    """Customers before and after columns were changed."""
    before = read(spark, sf, "customer")
    segment, key = F.col("c_mktsegment"), F.col("c_custkey")
    after = before.select(
        "c_custkey",
        F.col("c_nationkey").cast("bigint").alias("c_nationkey"),
        F.when(key % 2 == 0, F.col("c_acctbal")).alias("c_acctbal"),
        segment,
        F.lit("load 2").alias("batch"),
    )
    return monitors.schema_change(before, after)


# --- the whole job -----------------------------------------------------------


def _landed_folder(spark: SparkSession, sf: str, games: DataFrame) -> str:
    landed = scratch_dir(spark, "landed")
    players = _raw_players(spark, sf)
    _land(shapes.archives(games), f"{landed}/archives", "username", "year", "month")
    _land(shapes.profiles(players), f"{landed}/profiles", "username")
    _land(shapes.stats(players), f"{landed}/stats", "username")
    return landed


def _built_root(spark: SparkSession, sf: str) -> str:
    """Payloads landed, loaded and modelled under a fresh root."""
    landed, root = _landed_folder(spark, sf, _raw_games(spark, sf)), scratch_dir(spark, "root")
    pipeline.run_ingestion(spark, landed, root, BATCH, more_than=100)
    pipeline.run_models(spark, root)
    return root


@query
def pipeline_player_stats(spark, sf):
    return pipeline.table(spark, _built_root(spark, sf), "mart_player_stats")


@query
def pipeline_checks(spark, sf):
    return pipeline.run_checks(spark, _built_root(spark, sf), PLAYERS)


@query
def pipeline_expectations(spark, sf):
    return pipeline.run_expectations(spark, _built_root(spark, sf))


@query
def pipeline_expectation_rows(spark, sf):
    return pipeline.expectation_results(spark, _built_root(spark, sf))


@query
def pipeline_rejects(spark, sf):
    """A load with archives that break off or run over several lines: rows and rejected lines."""
    games = _raw_games(spark, sf)
    landed, root = _landed_folder(spark, sf, games), scratch_dir(spark, "root")
    payload = F.to_json(F.struct(F.array(F.struct(F.col("game_url").alias("url"))).alias("games")))
    broken = (
        F.when(F.col("end_time") % 50 == 0, F.substring(payload, 1, 20))
        .when(F.col("end_time") % 50 == 1, F.replace(payload, F.lit('"games":'), F.lit('\n"games":\n')))
    )
    games.select(broken.alias("value"), "username").filter("value is not null").select(
        "value", "username", F.lit("2024").alias("year"), F.lit("02").alias("month")
    ).write.partitionBy("username", "year", "month").mode("append").text(f"{landed}/archives")
    done = pipeline.run_ingestion(spark, landed, root, BATCH, more_than=100, allow_rejects=True)
    listed = pipeline.table(spark, root, "rejects").filter("source = 'archives'")
    loaded = pipeline.table(spark, root, "raw_games")
    return one_load(
        loaded.agg(F.lit("games loaded").alias("what"), row_count().alias("n")),
        listed.agg(F.lit("lines listed").alias("what"), row_count().alias("n")),
        listed.agg(
            F.lit("lines counted").alias("what"),
            F.max(F.lit(done.rejected["archives"])).cast("bigint").alias("n"),
        ),
    )


@query
def pipeline_result_map(spark, sf):
    """The job on games whose losses are called lose and timeout."""
    games = _raw_games(spark, sf)
    lost = F.when(F.col("end_time") % 2 == 0, "lose").otherwise("Timeout")
    other = games.withColumns(
        {
            c: F.when(F.col(c) == "loss", lost).otherwise(F.col(c))
            for c in ("white_result", "black_result")
        }
    )
    landed, root = _landed_folder(spark, sf, other), scratch_dir(spark, "root")
    pipeline.run_ingestion(spark, landed, root, BATCH, more_than=100)
    pipeline.run_models(spark, root, result_map={"lose": "loss", "timeout": "loss"})
    return pipeline.table(spark, root, "int_player_performance")


# --- incremental loads and marts -----------------------------------------------

BATCH_AFTER = "2024-02-01T06:00:00"
LATE = 40 * 86400


def _two_batches(games: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Half of the games; the others, with corrections of some of the first that move them to another month."""
    corrected = games.filter(F.col("end_time") % 10 == 0).withColumns(
        {"white_rating": F.col("white_rating") + 50, "end_time": F.col("end_time") - LATE}
    )
    odd = F.col("end_time") % 2 == 1
    return games.filter(~odd), one_load(games.filter(odd), corrected)


def _updated_root(spark: SparkSession, sf: str) -> str:
    """Two batches landed one after the other, each followed by an update."""
    first, second = _two_batches(_raw_games(spark, sf))
    landed, root = _landed_folder(spark, sf, first), scratch_dir(spark, "root")
    incremental.run_update(spark, landed, root, BATCH, buckets=16)
    _land(shapes.archives(second), f"{landed}/archives", "username", "year", "month")
    incremental.run_update(spark, landed, root, BATCH_AFTER, buckets=16)
    return root


@query
def upsert_raw_games(spark, sf):
    """Rows by key after two batches; the second rewrites the buckets of its games only."""
    path = scratch_dir(spark, "keyed")
    first, second = _two_batches(_raw_games(spark, sf))
    ties = [c for c in RAW_GAMES.names if c not in ("game_url", "ingested_at")]
    for rows, loaded_at in ((first, BATCH), (second, BATCH_AFTER)):
        load = rows.withColumn("ingested_at", F.lit(loaded_at))
        parts.upsert(load, path, ["game_url"], ["ingested_at"], ties, buckets=16)
    return tables.read_table(spark, path, RAW_GAMES)


@query
def incremental_player_stats(spark, sf):
    return pipeline.table(spark, _updated_root(spark, sf), "mart_player_stats")


@query
def incremental_openings(spark, sf):
    return pipeline.table(spark, _updated_root(spark, sf), "mart_opening_analysis")


@query
def incremental_progression(spark, sf):
    return pipeline.table(spark, _updated_root(spark, sf), "mart_elo_progression")


# --- what changes from load to load ---------------------------------------------

PROFILED = ["game_url", "rated", "white_rating", "black_rating", "black_result", "end_time"]


def _profiled_loads(spark: SparkSession, sf: str) -> tuple[str, DataFrame, DataFrame]:
    """Two profiles; in the second load white's ratings have risen and some results are missing."""
    games = _raw_games(spark, sf).select(*PROFILED)
    odd = F.col("end_time") % 2 == 1
    first = games.filter(~odd)
    second = games.filter(odd).withColumns(
        {
            "white_rating": F.col("white_rating") + 400,
            "black_result": F.when(F.col("end_time") % 3 != 0, F.col("black_result")),
        }
    )
    folder = scratch_dir(spark, "profiles")
    history.record_profile(first, folder, "first")
    history.record_profile(second, folder, "second")
    return folder, first, second


@query
def profile_drift(spark, sf):
    folder, *_ = _profiled_loads(spark, sf)
    return history.profile_drift(spark, folder, "first", "second")


@query
def distinct_over_loads(spark, sf):
    """Exact distinct counts over two loads, and whether the kept sketches together are within 5 % of them."""
    folder, first, second = _profiled_loads(spark, sf)
    exact = one_load(first, second).agg(*[F.count_distinct(c).alias(c) for c in PROFILED])
    counted = exact.select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("distinct_values")) for c in PROFILED]))
    )
    near = F.abs(F.col("distinct_estimate") - F.col("distinct_values")) <= F.col("distinct_values") * 0.05
    return history.merged_columns(spark, folder).join(counted, "column_name").select(
        "column_name", "n_rows", "n_nulls", "distinct_values", near.alias("sketch_is_near")
    )


@query
def seasonal_volume(spark, sf):
    """Events per type and day with a weekly pattern and one planted spike."""
    events = read(spark, sf, "events").select("event_type", "ts")
    day = F.to_date("ts")
    busy = F.datediff(day, F.lit("1970-01-01").cast("date")) % 7 == 3
    spike = (day == F.lit("2024-01-25").cast("date")) & (F.col("event_type") == "view")
    copies = F.lit(1) + F.when(busy, 3).otherwise(0) + F.when(spike, 9).otherwise(0)
    repeated = events.withColumn("copy", F.explode(F.sequence(F.lit(1), copies))).drop("copy")
    return monitors.seasonal_anomaly(repeated, ["event_type"], "ts", weeks=3)
