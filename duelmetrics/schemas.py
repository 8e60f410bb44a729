"""Declared schemas of landed payloads and raw tables."""

from pyspark.sql import types as T

_TYPES = {"string": T.StringType(), "bigint": T.LongType(), "boolean": T.BooleanType()}


def _fields(**columns: str | T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField(name, _TYPES[kind] if isinstance(kind, str) else kind)
            for name, kind in columns.items()
        ]
    )


_SIDE = _fields(username="string", rating="bigint", result="string")
_GAME = _fields(
    url="string",
    time_class="string",
    time_control="string",
    rated="boolean",
    pgn="string",
    white=_SIDE,
    black=_SIDE,
    end_time="bigint",
)

# One payload per player and month; `username`, `year` and `month` come from
# the directory names (username=<u>/year=<y>/month=<m>).
ARCHIVE = _fields(games=T.ArrayType(_GAME), username="string", year="string", month="string")

# One payload per player; `username` comes from the directory name.
PROFILE = _fields(
    player_id="bigint",
    title="string",
    name="string",
    country="string",
    location="string",
    followers="bigint",
    is_streamer="boolean",
    username="string",
)

_RATED = _fields(last=_fields(rating="bigint", rd="bigint"))
STATS = _fields(chess_rapid=_RATED, chess_blitz=_RATED, chess_bullet=_RATED, username="string")

RAW_GAMES = _fields(
    game_url="string",
    username="string",
    time_class="string",
    time_control="string",
    rated="boolean",
    pgn="string",
    white_username="string",
    white_rating="bigint",
    white_result="string",
    black_username="string",
    black_rating="bigint",
    black_result="string",
    end_time="bigint",
    ingested_at="string",
)

RAW_PLAYERS = _fields(
    username="string",
    player_id="bigint",
    title="string",
    name="string",
    country="string",
    location="string",
    followers="bigint",
    is_streamer="boolean",
    rapid_rating="bigint",
    blitz_rating="bigint",
    bullet_rating="bigint",
    rapid_games="bigint",
    blitz_games="bigint",
    bullet_games="bigint",
    ingested_at="string",
)
