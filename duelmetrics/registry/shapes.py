"""Game and player tables derived from an event log.

``events(event_id, ts, user_id, event_type, value, props)`` stands in for the
landed games of tracked players. Every event becomes one raw game; one event in
ten repeats the game of the event before it, so there is something to
de-duplicate.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duelmetrics.functions.clock import epoch_from_utc, iso_from_utc
from duelmetrics.schemas import RAW_GAMES, RAW_PLAYERS

LOADED_FIRST = "2024-01-01T00:00:00"
LOADED_LAST = "2024-01-31T06:00:00"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _numbered(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def raw_games(events: DataFrame) -> DataFrame:
    event, user, value = F.col("event_id"), F.col("user_id"), F.col("value")
    k = F.get_json_object("props", "$.k").cast("int")
    digit = (k % 10).cast("string")
    eco = F.concat(F.lit('[ECO "B'), digit, F.lit('0"]'))
    url = F.concat(
        F.lit(' [ECOUrl "https://www.chess.com/openings/Opening-'), digit, F.lit('"]')
    )
    tracked, other = _numbered("PLAYER", user % 5), _numbered("Opp", event % 50)
    even, third = event % 2 == 0, event % 3
    return events.select(
        _numbered(
            "https://games.example/", F.when(event % 10 == 1, event - 1).otherwise(event)
        ).alias("game_url"),
        _numbered("Player", user % 5).alias("username"),
        F.when(F.col("event_type") == "view", "Rapid")
        .when(F.col("event_type") == "click", "blitz")
        .when(F.col("event_type") == "purchase", "BULLET")
        .when(F.col("event_type") == "signup", "daily")
        .otherwise("Blitz")
        .alias("time_class"),
        F.lit("600").alias("time_control"),
        (event % 7 != 0).alias("rated"),
        F.when(k % 11 == 0, "1. e4 e5")
        .when(k % 11 == 1, F.concat(F.lit('[ECO "C'), digit, F.lit('0"]')))
        .otherwise(F.concat(eco, url))
        .alias("pgn"),
        F.when(even, tracked).otherwise(other).alias("white_username"),
        (1500 + F.floor(value)).cast("bigint").alias("white_rating"),
        F.when(third == 0, "Win").when(third == 1, "loss").otherwise("draw").alias("white_result"),
        F.when(even, other).otherwise(tracked).alias("black_username"),
        (1400 + F.floor(value / 2)).cast("bigint").alias("black_rating"),
        F.when(third == 0, "loss").when(third == 1, "win").otherwise("draw").alias("black_result"),
        epoch_from_utc(F.col("ts")).alias("end_time"),
        iso_from_utc(F.col("ts")).alias("ingested_at"),
    ).select(*RAW_GAMES.names)


def raw_players(events: DataFrame) -> DataFrame:
    """Two loads of seven players; two of them have no games.

    The first load knows no ratings. Spellings of the name agree, so the later
    load replaces it.
    """
    number = F.col("number")
    rating = (1500 + F.floor("value")).cast("bigint")
    ratings = events.groupBy((F.col("user_id") % 7).alias("number")).agg(
        F.max(F.when(F.col("event_type") == "view", rating)).alias("rapid"),
        F.max(F.when(F.col("event_type") == "click", rating)).alias("blitz"),
    )
    loads = F.explode(F.array(F.lit(LOADED_FIRST), F.lit(LOADED_LAST)))
    known = F.col("ingested_at") == LOADED_LAST
    none = F.lit(None).cast("bigint")
    return ratings.withColumn("ingested_at", loads).select(
        _numbered("Player", number).alias("username"),
        (1000 + number).alias("player_id"),
        F.when(number != 3, "gm").alias("title"),
        _numbered("Name ", number).alias("name"),
        F.lit("no").alias("country"),
        F.lit("Oslo").alias("location"),
        (number * 100).alias("followers"),
        (number % 2 == 0).alias("is_streamer"),
        F.when(known, F.col("rapid")).alias("rapid_rating"),
        F.when(known, F.col("blitz")).alias("blitz_rating"),
        none.alias("bullet_rating"),
        F.lit(50).cast("bigint").alias("rapid_games"),
        F.lit(60).cast("bigint").alias("blitz_games"),
        none.alias("bullet_games"),
        "ingested_at",
    ).select(*RAW_PLAYERS.names)


def archives(games: DataFrame) -> DataFrame:
    """Nested payloads: every game, some twice in one payload, some without a side.

    Further payloads have no games, either an empty array or none.
    """
    side = {
        s: F.struct(*[F.col(f"{s}_{f}").alias(f) for f in ("username", "rating", "result")])
        for s in ("white", "black")
    }
    third, no_side = F.col("end_time") % 3, F.col("end_time") % 13 == 0
    game = F.struct(
        F.col("game_url").alias("url"),
        "time_class",
        "time_control",
        "rated",
        "pgn",
        side["white"].alias("white"),
        F.when(~no_side, side["black"]).alias("black"),
        "end_time",
    )
    one = F.array(game)
    payloads = (
        F.when(third == 0, F.array(one, F.filter(one, lambda g: F.lit(False))))
        .when(third == 1, F.array(F.array(game, game)))
        .otherwise(F.array(one, F.lit(None)))
    )
    return games.select(
        F.explode(payloads).alias("games"),
        "username",
        F.lit("2024").alias("year"),
        F.lit("01").alias("month"),
    )


def profiles(players: DataFrame) -> DataFrame:
    """Profile payloads of the last load; one player has no country.

    For every player there is an empty profile of somebody else.
    """
    url = F.concat(F.lit("https://profiles.example/country/"), F.upper("country"))
    last = players.filter(F.col("ingested_at") == LOADED_LAST)
    full = last.select(
        "player_id",
        "title",
        "name",
        F.when(F.col("player_id") != 1002, url).alias("country"),
        "location",
        "followers",
        F.when(F.col("is_streamer"), True).alias("is_streamer"),
        "username",
    )
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in full.schema if f.name != "username"]
    empty = last.select(*nothing, F.concat(F.lit("No"), "username").alias("username"))
    return full.unionByName(empty)


def stats(players: DataFrame) -> DataFrame:
    """Stats payloads of the last load; one player has none."""

    def last(time_class: str) -> Column:
        inner = F.struct(
            F.col(f"{time_class}_rating").alias("rating"), F.col(f"{time_class}_games").alias("rd")
        )
        present = F.col(f"{time_class}_rating").isNotNull()
        return F.when(present, F.struct(inner.alias("last"))).alias(f"chess_{time_class}")

    return players.filter(
        (F.col("ingested_at") == LOADED_LAST) & (F.col("player_id") != 1006)
    ).select(last("rapid"), last("blitz"), last("bullet"), "username")
