"""The checks declared for each table.

Fixed values: which checks exist is part of what the tables promise.
"""

from collections.abc import Sequence

from duelmetrics import fixed_values as fixed
from duelmetrics.quality.checks import (
    Check,
    accepted_values,
    between,
    not_null,
    row_count_between,
    unique,
)


def _not_null(*columns: str) -> list[Check]:
    return [not_null(c) for c in columns]


def schema_tests(players: Sequence[str] = fixed.TRACKED_PLAYERS) -> dict[str, list[Check]]:
    """Checks per table; ``players`` are the user names that may occur."""
    return {
        "stg_games": [
            *_not_null(
                "game_url",
                "username",
                "time_class",
                "player_color",
                "player_result",
                "player_rating",
                "ended_at",
                "white_rating",
                "black_rating",
            ),
            unique("game_url"),
            accepted_values("username", players),
            accepted_values("time_class", fixed.TIME_CLASSES),
            accepted_values("player_color", fixed.PLAYER_COLORS),
        ],
        "stg_players": [
            *_not_null("username", "player_id", "country_code", "peak_rating"),
            unique("username"),
            unique("player_id"),
            accepted_values("title", fixed.TITLES),
        ],
        "int_player_performance": _not_null(
            "username",
            "time_class",
            "total_games",
            "win_rate_pct",
            "avg_rating",
            "max_rating",
        ),
        "mart_player_stats": [
            *_not_null("username", "peak_rating", "total_games_all", "total_wins_all"),
            unique("username"),
        ],
        "mart_opening_analysis": _not_null(
            "username", "opening_slug", "total_games", "win_rate_pct"
        ),
        "mart_elo_progression": _not_null(
            "username", "time_class", "game_date", "closing_rating"
        ),
    }


def expectations() -> dict[str, list[Check]]:
    """Expectation suites per table."""
    return {
        "mart_player_stats": [
            not_null("username"),
            unique("username"),
            between("peak_rating", *fixed.PEAK_RATING_BOUNDS),
            between("total_games_all", *fixed.TOTAL_GAMES_BOUNDS),
            row_count_between(*fixed.PLAYER_COUNT_BOUNDS),
        ],
        "stg_games": [
            not_null("game_url"),
            accepted_values("time_class", fixed.TIME_CLASSES),
            accepted_values("player_color", fixed.PLAYER_COLORS),
            between("player_rating", *fixed.PLAYER_RATING_BOUNDS),
            row_count_between(*fixed.GAME_COUNT_BOUNDS),
        ],
    }
