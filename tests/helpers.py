"""Small hand-written inputs."""

from duelmetrics.schemas import RAW_GAMES, RAW_PLAYERS

GAME = {
    "game_url": "g1",
    "username": "ann",
    "time_class": "blitz",
    "time_control": "180",
    "rated": True,
    "pgn": "",
    "white_username": "Ann",
    "white_rating": 1500,
    "white_result": "win",
    "black_username": "Bob",
    "black_rating": 1400,
    "black_result": "loss",
    "end_time": 1735689600,
    "ingested_at": "2025-01-02T00:00:00",
}
PLAYER = {
    "username": "ann",
    "player_id": 1,
    "title": "gm",
    "name": "Ann A",
    "country": "no",
    "location": None,
    "followers": 10,
    "is_streamer": False,
    "rapid_rating": 1500,
    "blitz_rating": 1600,
    "bullet_rating": None,
    "rapid_games": 40,
    "blitz_games": 41,
    "bullet_games": None,
    "ingested_at": "2025-01-02T00:00:00",
}


def raw_games(spark, *changes):
    rows = [{**GAME, **c} for c in changes]
    return spark.createDataFrame([tuple(r[n] for n in RAW_GAMES.names) for r in rows], RAW_GAMES)


def raw_players(spark, *changes):
    rows = [{**PLAYER, **c} for c in changes]
    return spark.createDataFrame(
        [tuple(r[n] for n in RAW_PLAYERS.names) for r in rows], RAW_PLAYERS
    )


def rows(df, *columns):
    """The rows as a sorted list of tuples (NULL sorts first)."""
    picked = df.select(*columns) if columns else df
    found = [tuple(r) for r in picked.collect()]
    return sorted(found, key=lambda r: tuple((v is not None, v) for v in r))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()
