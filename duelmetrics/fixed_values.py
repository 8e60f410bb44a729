"""Values that data sources and dashboards agree on.

Fixed values: they identify formats, tags, labels and thresholds that must be
spelled exactly like this for results to be right.
"""

# Game formats a staged game may carry.
TIME_CLASSES = ["rapid", "blitz", "bullet", "daily"]

# Formats that get their own columns in the player statistics table.
PIVOT_CLASSES = ["rapid", "blitz", "bullet"]

PLAYER_COLORS = ["white", "black"]

WIN, LOSS, DRAW = "win", "loss", "draw"

# Players that are tracked by default.
TRACKED_PLAYERS = [
    "magnuscarlsen",
    "hikaru",
    "fabianocaruana",
    "firouzja2003",
    "rpragchess",
]

# Federation titles a player may hold.
TITLES = ["GM", "IM", "FM", "CM", "NM", "WGM", "WIM", "WFM", "WCM"]

# Tags in the text of a game record; the group is the value that is kept.
OPENING_SLUG_TAG = r'\[ECOUrl "https://www\.chess\.com/openings/([^"]+)"\]'
ECO_CODE_TAG = r'\[ECO "([^"]+)"\]'
UNKNOWN_OPENING = "unknown"

# Fewest games for an opening to be reported.
MIN_OPENING_GAMES = 3

# Openings shown in one dashboard slice.
TOP_OPENINGS = 15

# Hours after which a source is stale.
FRESHNESS_WARN_HOURS = 24
FRESHNESS_ERROR_HOURS = 48

# A load must bring more rows than this.
MIN_RAW_GAMES = 1000

# Bounds of the expectation suites.
PEAK_RATING_BOUNDS = (1000, 4000)
TOTAL_GAMES_BOUNDS = (0, 100000)
PLAYER_COUNT_BOUNDS = (4, 6)
PLAYER_RATING_BOUNDS = (500, 4000)
GAME_COUNT_BOUNDS = (1000, 500000)

# Column headings of the player table on the dashboard.
PLAYER_TABLE_HEADINGS = {
    "username": "Player",
    "title": "Title",
    "country_code": "Country",
    "peak_rating": "Peak Rating",
    "blitz_rating": "Blitz",
    "rapid_rating": "Rapid",
    "total_games_all": "Total Games",
    "blitz_win_rate_pct": "Blitz WR%",
    "rapid_win_rate_pct": "Rapid WR%",
}

# Metrics of the two-player comparison: label, column, unit.
COMPARISON_METRICS = [
    ("Peak Rating", "peak_rating", ""),
    ("Blitz Rating", "blitz_rating", ""),
    ("Rapid Rating", "rapid_rating", ""),
    ("Total Games", "total_games_all", ""),
    ("Blitz Win Rate", "blitz_win_rate_pct", "%"),
    ("Rapid Win Rate", "rapid_win_rate_pct", "%"),
]
