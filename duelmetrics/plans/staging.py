"""Raw tables to typed, de-duplicated staging tables."""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duelmetrics import fixed_values as fixed
from duelmetrics.functions.clock import utc_from_epoch
from duelmetrics.functions.text import tag_value
from duelmetrics.operators.latest import latest_per_key
from duelmetrics.operators.perspective import perspective

OPENING_TAGS = {"opening_slug": fixed.OPENING_SLUG_TAG, "eco_code": fixed.ECO_CODE_TAG}

# After the load time: columns that every consumer reads anyway. Rows that agree
# in them are told apart by a hash of all other columns, taken before the shuffle,
# so the order is total without dragging wide columns along.
_GAME_TIES = [
    "username",
    "ended_at",
    "player_color",
    "player_result",
    "player_rating",
    "opponent_rating",
    "time_class",
]


def _coded(result: Column, result_map: Mapping[str, str] | None) -> Column:
    if not result_map:
        return result
    codes = F.create_map(*[F.lit(x) for pair in result_map.items() for x in pair])
    return F.coalesce(F.try_element_at(codes, result), result)


def with_opening_tags(games: DataFrame) -> DataFrame:
    """Add the opening tags found in the game text; NULL where there is none."""
    return games.withColumns({n: tag_value("pgn", p) for n, p in OPENING_TAGS.items()})


def stage_games(
    raw: DataFrame,
    key: Sequence[str] = ("game_url",),
    result_map: Mapping[str, str] | None = None,
    text_ties: bool = False,
    unique: bool = False,
) -> DataFrame:
    """Latest row per game, seen from the tracked player.

    A game between two tracked players is landed twice; with the default key one
    side survives, with ``("game_url", "username")`` both do. ``result_map``
    translates lower-case result codes; other codes pass through and count as
    neither win, loss nor draw.

    Every row is shaped before it is shuffled for the de-duplication. Columns
    the consumer does not read are pruned below the shuffle, among them the game
    text, whose tags (if ``raw`` carries them) are taken out before.

    Two rows may agree in all but the text. To readers of the other columns they
    are the same; ``text_ties`` lets the text decide too, which reads it.

    ``unique`` says that ``raw`` has one row per key already, as a table kept by
    ``parts.upsert`` with this key has: then nothing is shuffled or sorted.
    """
    lowered = raw.withColumns(
        {
            c: F.lower(c)
            for c in ("time_class", "white_username", "black_username", "username")
        }
        | {c: _coded(F.lower(c), result_map) for c in ("white_result", "black_result")}
    )
    sided = perspective(
        lowered,
        me="username",
        first="white_username",
        fields={
            "player_result": ("white_result", "black_result"),
            "player_rating": ("white_rating", "black_rating"),
            "opponent_rating": ("black_rating", "white_rating"),
            "opponent_username": ("black_username", "white_username"),
        },
        side="player_color",
        labels=("white", "black"),
    )
    rest = [c for c in raw.columns if c not in OPENING_TAGS and (text_ties or c != "pgn")]
    staged = sided.withColumn("_rest", F.xxhash64(*rest)).select(
        "_rest",
        "game_url",
        "pgn",
        "username",
        "time_class",
        "time_control",
        "rated",
        "white_username",
        "white_rating",
        "white_result",
        "black_username",
        "black_rating",
        "black_result",
        utc_from_epoch(F.col("end_time")).alias("ended_at"),
        "player_color",
        "player_result",
        "player_rating",
        "opponent_rating",
        "opponent_username",
        "ingested_at",
        *[c for c in OPENING_TAGS if c in raw.columns],
    )
    if unique:
        return staged.drop("_rest")
    ties = [*_GAME_TIES, *[c for c in OPENING_TAGS if c in raw.columns], "_rest"]
    return latest_per_key(staged, key, ["ingested_at"], ties).drop("_rest")


def game_facts(raw: DataFrame, **options) -> DataFrame:
    """Staged games with opening tags in place of the game text."""
    return stage_games(with_opening_tags(raw), **options).drop("pgn")


def stage_players(raw: DataFrame) -> DataFrame:
    """Latest row per player.

    The key is the name as landed; it is lower-cased afterwards, so spellings
    that differ in case stay separate rows.
    """
    ratings = ["rapid_rating", "blitz_rating", "bullet_rating"]
    others = [c for c in raw.columns if c not in ("username", "ingested_at")]
    latest = latest_per_key(raw, ["username"], ["ingested_at"], others)
    return latest.select(
        F.lower("username").alias("username"),
        "player_id",
        F.upper("title").alias("title"),
        F.col("name").alias("full_name"),
        F.upper("country").alias("country_code"),
        "location",
        "followers",
        "is_streamer",
        *ratings,
        F.greatest(*[F.coalesce(r, F.lit(0)) for r in ratings]).alias("peak_rating"),
        "ingested_at",
    )
