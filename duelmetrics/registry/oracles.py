"""DuckDB SQL for the registered queries, over the same tables.

Written the plain way (windows over all rows, one filter and join per format),
so it also shows that the shorter Spark plans give the same rows.
"""

ORACLES: dict[str, str] = {}

RAW_GAMES = r"""
keyed AS (
    SELECT *, CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER) AS k FROM events
),
raw_games AS (
    SELECT
        'https://games.example/' || CAST(
            CASE WHEN event_id % 10 = 1 THEN event_id - 1 ELSE event_id END AS VARCHAR
        ) AS game_url,
        'Player' || CAST(user_id % 5 AS VARCHAR) AS username,
        CASE event_type
            WHEN 'view' THEN 'Rapid' WHEN 'click' THEN 'blitz'
            WHEN 'purchase' THEN 'BULLET' WHEN 'signup' THEN 'daily' ELSE 'Blitz'
        END AS time_class,
        '600' AS time_control,
        event_id % 7 <> 0 AS rated,
        CASE
            WHEN k % 11 = 0 THEN '1. e4 e5'
            WHEN k % 11 = 1 THEN '[ECO "C' || CAST(k % 10 AS VARCHAR) || '0"]'
            ELSE '[ECO "B' || CAST(k % 10 AS VARCHAR)
                || '0"] [ECOUrl "https://www.chess.com/openings/Opening-'
                || CAST(k % 10 AS VARCHAR) || '"]'
        END AS pgn,
        CASE WHEN event_id % 2 = 0 THEN 'PLAYER' || CAST(user_id % 5 AS VARCHAR)
             ELSE 'Opp' || CAST(event_id % 50 AS VARCHAR) END AS white_username,
        CAST(1500 + floor(value) AS BIGINT) AS white_rating,
        CASE event_id % 3 WHEN 0 THEN 'Win' WHEN 1 THEN 'loss' ELSE 'draw' END AS white_result,
        CASE WHEN event_id % 2 = 0 THEN 'Opp' || CAST(event_id % 50 AS VARCHAR)
             ELSE 'PLAYER' || CAST(user_id % 5 AS VARCHAR) END AS black_username,
        CAST(1400 + floor(value / 2) AS BIGINT) AS black_rating,
        CASE event_id % 3 WHEN 0 THEN 'loss' WHEN 1 THEN 'win' ELSE 'draw' END AS black_result,
        CAST(epoch_us(ts) // 1000000 AS BIGINT) AS end_time,
        strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS ingested_at
    FROM keyed
)"""

_STAGED = r"""
{name}_sided AS (
    SELECT
        * REPLACE (
            lower(username) AS username, lower(time_class) AS time_class,
            lower(white_username) AS white_username, lower(black_username) AS black_username,
            lower(white_result) AS white_result, lower(black_result) AS black_result
        ),
        lower(white_username) = lower(username) AS on_white
    FROM {source}
),
{name} AS (
    SELECT
        * EXCLUDE (end_time, on_white),
        make_timestamp(end_time * 1000000) AS ended_at,
        if(on_white, 'white', 'black') AS player_color,
        if(on_white, white_result, black_result) AS player_result,
        if(on_white, white_rating, black_rating) AS player_rating,
        if(on_white, black_rating, white_rating) AS opponent_rating,
        if(on_white, black_username, white_username) AS opponent_username
    FROM {name}_sided
    QUALIFY row_number() OVER (
        PARTITION BY {key}
        ORDER BY ingested_at DESC, username, end_time, player_color,
            player_result NULLS FIRST, player_rating NULLS FIRST,
            opponent_rating NULLS FIRST, time_class
    ) = 1
)"""


def staged(name: str = "games", source: str = "raw_games", key: str = "game_url") -> str:
    return _STAGED.format(name=name, source=source, key=key)


RAW_PLAYERS = r"""
rated_players AS (
    SELECT
        user_id % 7 AS number,
        max(CASE WHEN event_type = 'view' THEN CAST(1500 + floor(value) AS BIGINT) END) AS rapid,
        max(CASE WHEN event_type = 'click' THEN CAST(1500 + floor(value) AS BIGINT) END) AS blitz
    FROM events GROUP BY 1
),
raw_players AS (
    SELECT
        'Player' || CAST(number AS VARCHAR) AS username,
        CAST(1000 + number AS BIGINT) AS player_id,
        CASE WHEN number <> 3 THEN 'gm' END AS title,
        'Name ' || CAST(number AS VARCHAR) AS name,
        'no' AS country, 'Oslo' AS location,
        CAST(number * 100 AS BIGINT) AS followers,
        number % 2 = 0 AS is_streamer,
        CASE WHEN ingested_at = '2024-01-31T06:00:00' THEN rapid END AS rapid_rating,
        CASE WHEN ingested_at = '2024-01-31T06:00:00' THEN blitz END AS blitz_rating,
        CAST(NULL AS BIGINT) AS bullet_rating,
        CAST(50 AS BIGINT) AS rapid_games, CAST(60 AS BIGINT) AS blitz_games,
        CAST(NULL AS BIGINT) AS bullet_games,
        ingested_at
    FROM rated_players,
        (VALUES ('2024-01-01T00:00:00'), ('2024-01-31T06:00:00')) AS loads(ingested_at)
)"""


def staged_players(source: str = "raw_players") -> str:
    return f"""
players AS (
    SELECT
        lower(username) AS username, player_id, upper(title) AS title, name AS full_name,
        upper(country) AS country_code, location, followers, is_streamer,
        rapid_rating, blitz_rating, bullet_rating,
        coalesce(greatest(rapid_rating, blitz_rating, bullet_rating), 0) AS peak_rating,
        ingested_at
    FROM (
        SELECT * FROM {source}
        QUALIFY row_number() OVER (PARTITION BY username ORDER BY ingested_at DESC) = 1
    )
)"""


_RESULTS = """
    CAST(count(*) AS BIGINT) AS total_games,
    CAST(count(*) FILTER (player_result = 'win') AS BIGINT) AS {wins},
    CAST(count(*) FILTER (player_result = 'loss') AS BIGINT) AS {losses},
    CAST(count(*) FILTER (player_result = 'draw') AS BIGINT) AS {draws},
    round(count(*) FILTER (player_result = 'win') / count(*) * 100, 2) AS win_rate_pct,
    round(avg(player_rating), 0) AS avg_rating"""

PERFORMANCE = f"""
performance AS (
    SELECT
        username, time_class,
        {_RESULTS.format(wins="total_wins", losses="total_losses", draws="total_draws")},
        CAST(sum(if(player_color = 'white', 1, 0)) AS BIGINT) AS games_as_white,
        CAST(sum(if(player_color = 'black', 1, 0)) AS BIGINT) AS games_as_black,
        CAST(sum(if(player_color = 'white' AND player_result = 'win', 1, 0)) AS BIGINT)
            AS wins_as_white,
        CAST(sum(if(player_color = 'black' AND player_result = 'win', 1, 0)) AS BIGINT)
            AS wins_as_black,
        max(player_rating) AS max_rating, min(player_rating) AS min_rating,
        round(avg(opponent_rating), 0) AS avg_opponent_rating,
        min(ended_at) AS first_game_at, max(ended_at) AS last_game_at
    FROM games GROUP BY username, time_class
)"""

_FORMAT_COLUMNS = ",\n        ".join(
    f"{f}.total_games AS {f}_total_games, {f}.total_wins AS {f}_wins, "
    f"{f}.win_rate_pct AS {f}_win_rate_pct, {f}.avg_rating AS {f}_avg_rating"
    for f in ("rapid", "blitz", "bullet")
)
_FORMAT_JOINS = "\n    ".join(
    f"LEFT JOIN (SELECT * FROM performance WHERE time_class = '{f}') {f} "
    f"ON p.username = {f}.username"
    for f in ("rapid", "blitz", "bullet")
)
STATS = f"""
stats AS (
    SELECT
        p.username, full_name, title, country_code, followers, is_streamer,
        rapid_rating, blitz_rating, bullet_rating, peak_rating,
        {_FORMAT_COLUMNS},
        coalesce(rapid.total_games, 0) + coalesce(blitz.total_games, 0)
            + coalesce(bullet.total_games, 0) AS total_games_all,
        coalesce(rapid.total_wins, 0) + coalesce(blitz.total_wins, 0)
            + coalesce(bullet.total_wins, 0) AS total_wins_all
    FROM players p
    {_FORMAT_JOINS}
)"""

OPENINGS = f"""
tagged AS (
    SELECT *,
        regexp_extract(pgn, '\\[ECOUrl "https://www\\.chess\\.com/openings/([^"]+)"\\]', 1) AS slug,
        regexp_extract(pgn, '\\[ECO "([^"]+)"\\]', 1) AS eco
    FROM games
),
openings AS (
    SELECT
        username, time_class, player_color,
        if(slug = '' OR slug IS NULL, 'unknown', slug) AS opening_slug,
        if(eco = '' OR eco IS NULL, 'unknown', eco) AS eco_code,
        {_RESULTS.format(wins="wins", losses="losses", draws="draws")}
    FROM tagged GROUP BY 1, 2, 3, 4, 5 HAVING count(*) >= 3
)"""

DAILY = r"""
per_game AS (
    SELECT
        username, time_class, CAST(ended_at AS DATE) AS game_date,
        last_value(player_rating) OVER (
            day_rows ORDER BY ended_at, coalesce(player_rating, 0)
            ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING
        ) AS closing_rating,
        max(player_rating) OVER day_rows AS daily_max_rating,
        min(player_rating) OVER day_rows AS daily_min_rating,
        CAST(count(*) OVER day_rows AS BIGINT) AS daily_games,
        CAST(sum(CASE WHEN player_result = 'win' THEN 1 ELSE 0 END) OVER day_rows AS BIGINT)
            AS daily_wins
    FROM games
    WINDOW day_rows AS (PARTITION BY username, time_class, CAST(ended_at AS DATE))
)"""

_CHANGE = """
    closing_rating - lag(closing_rating) OVER (
        PARTITION BY username, time_class ORDER BY game_date NULLS FIRST
    ) AS rating_change"""

PROGRESSION = f"""
progression AS (
    SELECT *, {_CHANGE} FROM (SELECT DISTINCT * FROM per_game)
)"""

AS_WRITTEN = f"""
progression AS (
    SELECT DISTINCT *, {_CHANGE} FROM per_game
)"""


def sql(body: str, *tables: str) -> str:
    return ("WITH" + ",".join(tables) if tables else "") + "\n" + body


GAMES = (RAW_GAMES, staged())
ALL_STATS = (*GAMES, PERFORMANCE, RAW_PLAYERS, staged_players(), STATS)
ALL_OPENINGS = (*GAMES, OPENINGS)
ALL_DAYS = (*GAMES, DAILY, PROGRESSION)

# --- tables over games -------------------------------------------------------

ORACLES["stg_games"] = sql("SELECT * FROM games", *GAMES)
ORACLES["stg_games_both_sides"] = sql(
    "SELECT * FROM games", RAW_GAMES, staged(key="game_url, username")
)
ORACLES["stg_players"] = sql("SELECT * FROM players", RAW_PLAYERS, staged_players())
ORACLES["int_player_performance"] = sql("SELECT * FROM performance", *GAMES, PERFORMANCE)
ORACLES["mart_player_stats"] = sql("SELECT * FROM stats", *ALL_STATS)
ORACLES["mart_opening_analysis"] = sql("SELECT * FROM openings", *ALL_OPENINGS)
ORACLES["mart_elo_progression"] = sql("SELECT * FROM progression", *ALL_DAYS)
ORACLES["mart_elo_progression_as_written"] = sql(
    "SELECT * FROM progression", *GAMES, DAILY, AS_WRITTEN
)

# --- dashboard frames --------------------------------------------------------

ORACLES["kpi_row"] = sql(
    """
SELECT
    CAST((SELECT sum(total_games_all) FROM stats) AS BIGINT) AS total_games,
    CAST((SELECT count(*) FROM stats) AS BIGINT) AS players_tracked,
    wr.blitz_win_rate_pct AS best_blitz_win_rate, wr.username AS best_blitz_player,
    pk.peak_rating AS highest_peak_rating, pk.username AS highest_peak_player
FROM
    (SELECT * FROM stats WHERE blitz_win_rate_pct IS NOT NULL
     ORDER BY blitz_win_rate_pct DESC, total_games_all DESC, username LIMIT 1) wr,
    (SELECT * FROM stats ORDER BY peak_rating DESC, total_games_all DESC, username LIMIT 1) pk
""",
    *ALL_STATS,
)
ORACLES["kpi_labels"] = sql(
    """
SELECT
    format('{:,}', CAST(sum(total_games_all) AS BIGINT)) AS total_games,
    format('{:,}', count(*)) AS players_tracked,
    printf('%.1f', max(blitz_win_rate_pct)) || '%' AS best_blitz_win_rate,
    format('{:,}', max(peak_rating)) AS highest_peak_rating
FROM stats
""",
    *ALL_STATS,
)
ORACLES["best_blitz_player"] = sql(
    """
SELECT username, blitz_win_rate_pct FROM stats WHERE blitz_win_rate_pct IS NOT NULL
ORDER BY blitz_win_rate_pct DESC, total_games_all DESC, username LIMIT 1
""",
    *ALL_STATS,
)
ORACLES["player_table"] = sql(
    """
SELECT
    username AS "Player", title AS "Title", country_code AS "Country",
    peak_rating AS "Peak Rating", blitz_rating AS "Blitz", rapid_rating AS "Rapid",
    total_games_all AS "Total Games", blitz_win_rate_pct AS "Blitz WR%",
    rapid_win_rate_pct AS "Rapid WR%"
FROM stats ORDER BY total_games_all DESC, username
""",
    *ALL_STATS,
)
ORACLES["games_share"] = sql(
    """
SELECT
    username, total_games_all,
    CAST(total_games_all AS DOUBLE) / CAST(sum(total_games_all) OVER () AS DOUBLE) AS share
FROM stats
""",
    *ALL_STATS,
)
ORACLES["win_rate_long"] = sql(
    """
SELECT username, 'Blitz' AS format, blitz_win_rate_pct AS win_rate
FROM stats WHERE blitz_win_rate_pct IS NOT NULL
UNION ALL
SELECT username, 'Rapid', rapid_win_rate_pct FROM stats WHERE rapid_win_rate_pct IS NOT NULL
UNION ALL
SELECT username, 'Bullet', bullet_win_rate_pct FROM stats WHERE bullet_win_rate_pct IS NOT NULL
""",
    *ALL_STATS,
)
_CHOSEN = (
    "FROM progression WHERE username IN ('player0', 'player1', 'player2') "
    "AND time_class = 'blitz'"
)
ORACLES["rating_series"] = sql(f"SELECT username, game_date, closing_rating {_CHOSEN}", *ALL_DAYS)
ORACLES["rating_change_series"] = sql(
    f"SELECT username, game_date, rating_change {_CHOSEN}", *ALL_DAYS
)
ORACLES["top15"] = sql(
    """
SELECT opening_slug, win_rate_pct, total_games FROM openings
WHERE username = 'player0' AND time_class = 'blitz' AND player_color = 'white'
ORDER BY total_games DESC, opening_slug, eco_code LIMIT 15
""",
    *ALL_OPENINGS,
)
_METRICS = " UNION ALL ".join(
    f"SELECT '{label}' AS metric, '{unit}' AS unit, CAST(a.{c} AS DOUBLE) AS value_1, "
    f"CAST(b.{c} AS DOUBLE) AS value_2 FROM stats a, stats b "
    "WHERE a.username = 'player1' AND b.username = 'player2'"
    for label, c, unit in (
        ("Peak Rating", "peak_rating", ""),
        ("Blitz Rating", "blitz_rating", ""),
        ("Rapid Rating", "rapid_rating", ""),
        ("Total Games", "total_games_all", ""),
        ("Blitz Win Rate", "blitz_win_rate_pct", "%"),
        ("Rapid Win Rate", "rapid_win_rate_pct", "%"),
    )
)
ORACLES["compare_two"] = sql(
    f"""
SELECT
    metric, value_1, value_2, value_1 - value_2 AS delta,
    CASE WHEN value_1 > value_2 THEN '←' WHEN value_2 > value_1 THEN '→' ELSE '=' END AS winner,
    printf('%.0f', value_1) || unit AS text_1, printf('%.0f', value_2) || unit AS text_2,
    CASE WHEN value_1 <> value_2 THEN printf('%+.1f', value_1 - value_2) || unit END AS delta_1,
    CASE WHEN value_1 <> value_2 THEN printf('%+.1f', value_2 - value_1) || unit END AS delta_2
FROM ({_METRICS}) WHERE value_1 IS NOT NULL AND value_2 IS NOT NULL
""",
    *ALL_STATS,
)
ORACLES["openings_in_order"] = sql(
    "SELECT * FROM openings ORDER BY total_games DESC", *ALL_OPENINGS
)
_OPTIONS = """
SELECT {column}, row_number() OVER (ORDER BY first_row) AS position
FROM (
    SELECT {column}, min(n) AS first_row
    FROM (SELECT *, row_number() OVER (ORDER BY {order}) AS n FROM {table}) GROUP BY {column}
)"""
_BY_DAY = "username, time_class, game_date"
_MOST_PLAYED = "total_games DESC, username, time_class, player_color, opening_slug, eco_code"
for _name, _column in (("options_username", "username"), ("options_time_class", "time_class")):
    ORACLES[_name] = sql(
        _OPTIONS.format(column=_column, order=_BY_DAY, table="progression"), *ALL_DAYS
    )
for _column in ("username", "time_class"):
    ORACLES[f"options_opening_{_column}"] = sql(
        _OPTIONS.format(column=_column, order=_MOST_PLAYED, table="openings"), *ALL_OPENINGS
    )
ORACLES["options_player"] = sql(
    _OPTIONS.format(column="username", order="total_games_all DESC, username", table="stats"),
    *ALL_STATS,
)
ORACLES["default_players"] = sql(
    "SELECT DISTINCT username FROM progression ORDER BY username LIMIT 3", *ALL_DAYS
)
ORACLES["default_format"] = sql(
    "SELECT time_class FROM progression ORDER BY username, time_class, game_date LIMIT 1",
    *ALL_DAYS,
)
ORACLES["default_opening_player"] = sql(
    """
SELECT username FROM openings
ORDER BY total_games DESC, username, time_class, player_color, opening_slug, eco_code LIMIT 1
""",
    *ALL_OPENINGS,
)
ORACLES["default_pair"] = sql(
    "SELECT username FROM stats ORDER BY total_games_all DESC, username LIMIT 2", *ALL_STATS
)

# --- the operators on other tables -------------------------------------------

_LATEST_LINES = """
SELECT * FROM lineitem
QUALIFY row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
        l_tax, l_returnflag, l_linestatus
) = 1
"""
ORACLES["latest_per_key_lineitem"] = _LATEST_LINES
ORACLES["distinct_lineitem_flags"] = (
    "SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber, l_tax FROM lineitem"
)
ORACLES["perspective_orders"] = """
SELECT
    o_orderkey, lower(c_name) AS customer,
    CASE WHEN o_orderkey % 2 = 0 THEN 'buyer' ELSE 'seller' END AS role,
    c_acctbal AS own_amount, o_totalprice AS other_amount,
    'desk' || CAST(o_orderkey % 50 AS VARCHAR) AS other_party
FROM orders JOIN customer ON o_custkey = c_custkey
"""
_ORDER_MEASURES = """
    CAST(count(*) AS BIGINT) AS total_orders,
    CAST(count_if(o_orderstatus = 'F') AS BIGINT) AS filled,
    CAST(count_if(o_orderstatus = 'O') AS BIGINT) AS open_orders,
    CAST(count_if(o_orderstatus = 'P') AS BIGINT) AS partial_orders,
    round(count_if(o_orderstatus = 'F') / count(*) * 100, 2) AS fill_rate_pct,
    CAST(count_if(o_orderkey % 2 = 0) AS BIGINT) AS even_orders,
    CAST(count_if(o_orderkey % 2 = 0 AND o_orderstatus = 'F') AS BIGINT) AS even_filled,
    round(avg(CAST(floor(o_totalprice) AS BIGINT)), 0) AS avg_price,
    max(CAST(floor(o_totalprice) AS BIGINT)) AS max_price,
    min(CAST(floor(o_totalprice) AS BIGINT)) AS min_price,
    min(o_orderdate) AS first_order_at, max(o_orderdate) AS last_order_at
"""
ORACLES["customer_performance"] = (
    f"SELECT o_custkey, o_orderpriority, {_ORDER_MEASURES} FROM orders GROUP BY 1, 2"
)
_STATUS_JOINS = "\n".join(
    f"""LEFT JOIN (
    SELECT o_custkey, CAST(count(*) AS BIGINT) AS n,
        max(CAST(floor(o_totalprice) AS BIGINT)) AS top
    FROM orders WHERE o_orderstatus = '{s}' GROUP BY o_custkey
) {s.lower()} ON c_custkey = {s.lower()}.o_custkey"""
    for s in "FOP"
)
ORACLES["order_pivot_by_status"] = f"""
SELECT
    c_custkey, c_name,
    f.n AS "F_orders", f.top AS "F_top", o.n AS "O_orders", o.top AS "O_top",
    p.n AS "P_orders", p.top AS "P_top",
    coalesce(f.n, 0) + coalesce(o.n, 0) + coalesce(p.n, 0) AS orders_all
FROM customer
{_STATUS_JOINS}
"""
ORACLES["url_tag_stats"] = r"""
SELECT
    host, campaign, CAST(count(*) AS BIGINT) AS total_pages,
    round(count_if(url_length > 40) / count(*) * 100, 2) AS long_url_pct,
    round(avg(url_length), 0) AS avg_length
FROM (
    SELECT
        coalesce(nullif(regexp_extract(
            url, '^https?://(?:www\.|m\.|blog\.)?([^/?#]+)', 1), ''), 'unknown') AS host,
        coalesce(nullif(regexp_extract(
            url, '[?&]utm_source=([^&#]+)', 1), ''), 'unknown') AS campaign,
        length(url) AS url_length
    FROM pages
)
GROUP BY host, campaign HAVING count(*) >= 3
"""
_EVENT_ROWS = """
rows_of_day AS (
    SELECT
        user_id, event_type, CAST(ts AS DATE) AS day,
        last_value(value) OVER (
            w ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING
        ) AS closing,
        max(value) OVER w AS daily_max, min(value) OVER w AS daily_min,
        CAST(count(*) OVER w AS BIGINT) AS daily_rows,
        CAST(sum(CASE WHEN value > 50 THEN 1 ELSE 0 END) OVER w AS BIGINT) AS daily_hits
    FROM events
    WINDOW w AS (PARTITION BY user_id, event_type, CAST(ts AS DATE))
)"""
_EVENT_CHANGE = """closing - lag(closing) OVER (
    PARTITION BY user_id, event_type ORDER BY day NULLS FIRST) AS change"""
ORACLES["event_daily_close"] = sql(
    f"SELECT *, {_EVENT_CHANGE} FROM (SELECT DISTINCT * FROM rows_of_day)", _EVENT_ROWS
)
ORACLES["event_daily_close_as_written"] = sql(
    f"SELECT DISTINCT *, {_EVENT_CHANGE} FROM rows_of_day", _EVENT_ROWS
)
ORACLES["event_change_vs_previous"] = """
SELECT *, n_events - lag(n_events) OVER (
    PARTITION BY event_type ORDER BY day NULLS FIRST) AS change
FROM (
    SELECT event_type, CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS n_events
    FROM events GROUP BY 1, 2
)
"""
ORACLES["order_status_long"] = " UNION ALL ".join(
    f"SELECT o_orderpriority, '{name}' AS status, "
    f"CAST(count_if(o_orderstatus = '{code}') AS BIGINT) AS n_orders "
    "FROM orders GROUP BY o_orderpriority"
    for name, code in (("filled", "F"), ("open_orders", "O"), ("partial_orders", "P"))
)
ORACLES["segment_share"] = """
SELECT c_mktsegment, n, CAST(n AS DOUBLE) / CAST(sum(n) OVER () AS DOUBLE) AS share
FROM (SELECT c_mktsegment, CAST(count(*) AS BIGINT) AS n FROM customer GROUP BY 1)
"""
ORACLES["top_orders"] = """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
ORDER BY o_totalprice DESC, o_orderkey LIMIT 15
"""
ORACLES["best_customer"] = """
SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal IS NOT NULL
ORDER BY c_acctbal DESC, c_custkey LIMIT 1
"""
ORACLES["epoch_to_day"] = """
SELECT event_id, end_time, make_timestamp(end_time * 1000000) AS ended_at,
    CAST(make_timestamp(end_time * 1000000) AS DATE) AS game_date
FROM (SELECT event_id, CAST(epoch_us(ts) // 1000000 AS BIGINT) AS end_time FROM events)
"""
ORACLES["greatest_peak"] = """
SELECT *, greatest(coalesce(peak_a, 0), coalesce(peak_n, 0), coalesce(peak_r, 0)) AS peak
FROM (
    SELECT
        l_orderkey,
        max(CASE WHEN l_returnflag = 'A' THEN CAST(floor(l_extendedprice) AS BIGINT) END) AS peak_a,
        max(CASE WHEN l_returnflag = 'N' THEN CAST(floor(l_extendedprice) AS BIGINT) END) AS peak_n,
        max(CASE WHEN l_returnflag = 'R' THEN CAST(floor(l_extendedprice) AS BIGINT) END) AS peak_r
    FROM lineitem GROUP BY l_orderkey
)
"""
ORACLES["last_segment_of_url"] = """
SELECT page_id, list_extract(string_split(coalesce(url, ''), '/'), -1) AS segment FROM pages
"""
ORACLES["coalesce_defaults"] = """
SELECT
    c_custkey,
    CASE WHEN c_mktsegment = 'BUILDING' OR c_mktsegment IS NULL THEN 'Unknown'
         ELSE upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) END AS segment,
    replace(c_name, 'Customer#', '') AS number
FROM customer
"""
ORACLES["coverage_gaps_user_days"] = """
SELECT user_id, CAST(day AS DATE) AS day
FROM (SELECT DISTINCT user_id FROM events),
    generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-01-31', INTERVAL 1 DAY) AS days(day)
EXCEPT
SELECT user_id, CAST(ts AS DATE) FROM events
"""

# --- sources and sinks -------------------------------------------------------

ORACLES["ndjson_round_trip"] = sql("SELECT * FROM raw_games", RAW_GAMES)
ORACLES["ndjson_players"] = sql("SELECT * FROM raw_players", RAW_PLAYERS)
LOADED_GAMES = r"""
loaded_games AS (
    SELECT
        game_url, username, time_class, time_control, rated, pgn,
        white_username, white_rating, white_result,
        CASE WHEN end_time % 13 <> 0 THEN black_username END AS black_username,
        CASE WHEN end_time % 13 <> 0 THEN black_rating END AS black_rating,
        CASE WHEN end_time % 13 <> 0 THEN black_result END AS black_result,
        end_time, '2024-01-31T06:00:00' AS ingested_at
    FROM raw_games, (VALUES (1), (2)) AS copies(copy)
    WHERE copy = 1 OR end_time % 3 = 1
)"""
ORACLES["archive_flatten"] = sql("SELECT * FROM loaded_games", RAW_GAMES, LOADED_GAMES)
ORACLES["archive_rejects"] = """
SELECT '{"games": [{"url": "' || CAST(event_id AS VARCHAR) AS line
FROM events WHERE event_id % 100 = 0
"""
LOADED_PLAYERS = r"""
loaded_players AS (
    SELECT
        username, player_id, title, name,
        CASE WHEN player_id = 1002 THEN '' ELSE 'NO' END AS country,
        location, followers, is_streamer,
        CASE WHEN player_id <> 1006 THEN rapid_rating END AS rapid_rating,
        CASE WHEN player_id <> 1006 THEN blitz_rating END AS blitz_rating,
        CAST(NULL AS BIGINT) AS bullet_rating,
        CASE WHEN player_id <> 1006 AND rapid_rating IS NOT NULL THEN rapid_games END
            AS rapid_games,
        CASE WHEN player_id <> 1006 AND blitz_rating IS NOT NULL THEN blitz_games END
            AS blitz_games,
        CAST(NULL AS BIGINT) AS bullet_games,
        ingested_at
    FROM raw_players WHERE ingested_at = '2024-01-31T06:00:00'
)"""
ORACLES["player_payload_join"] = sql("SELECT * FROM loaded_players", RAW_PLAYERS, LOADED_PLAYERS)
ORACLES["player_payload_latest"] = sql(
    """
SELECT * REPLACE (
    'A' || name AS name, rapid_rating - 200 AS rapid_rating, blitz_rating - 200 AS blitz_rating)
FROM loaded_players
""",
    RAW_PLAYERS,
    LOADED_PLAYERS,
)
ORACLES["ranking_null_ties"] = """
SELECT unnest(['argmax_row', 'argmax_value', 'top_rows', 'first_appearances']) AS form, o_orderkey
FROM (
    SELECT o_orderkey FROM orders
    ORDER BY floor(o_totalprice / 100000) DESC,
        CASE WHEN o_custkey % 3 <> 0 THEN o_custkey END DESC NULLS LAST, o_orderkey LIMIT 1
)
"""
ORACLES["text_ties"] = """
SELECT o_orderkey, printf('%.1f%%', value) AS one_decimal,
    CASE WHEN value - 62.25 <> 0 THEN printf('%+.1f%%', value - 62.25) END AS delta,
    printf('%.0f%%', value) AS whole
FROM (
    SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN (o_orderkey % 4001) / 20::DOUBLE
        ELSE (o_orderkey % 997) / 8::DOUBLE - 50::DOUBLE END AS value
    FROM orders
)
"""
ORACLES["bag_union"] = """
SELECT c_custkey, c_mktsegment FROM customer
UNION ALL
SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'
"""
ORACLES["overwrite_guard"] = (
    "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'"
)
ORACLES["repair_in_place"] = _LATEST_LINES
_ALL_TIES = """username, time_class, time_control, rated, pgn, white_username, white_rating,
    white_result, black_username, black_rating, black_result, end_time"""
ORACLES["repair_raw_games"] = sql(
    f"""
SELECT * FROM (
    SELECT * FROM raw_games
    UNION ALL
    SELECT * REPLACE (pgn || ' *' AS pgn) FROM raw_games WHERE end_time % 5 = 0
)
QUALIFY row_number() OVER (PARTITION BY game_url ORDER BY ingested_at DESC, {_ALL_TIES}) = 1
""",
    RAW_GAMES,
)
ORACLES["repair_raw_players"] = sql(
    """
SELECT * REPLACE ('A' || name AS name) FROM raw_players WHERE ingested_at = '2024-01-31T06:00:00'
""",
    RAW_PLAYERS,
)
ORACLES["interleaved_slice"] = sql(
    "SELECT game_url, white_rating, end_time FROM raw_games WHERE end_time BETWEEN 1704931200 AND 1705017599",
    RAW_GAMES,
)
ORACLES["clustered_slice"] = sql(
    """
SELECT game_url, white_rating, end_time FROM raw_games
WHERE username = 'Player1' AND time_class = 'blitz'
""",
    RAW_GAMES,
)

# --- data quality ------------------------------------------------------------


def column_check(suite: str, table: str, kind: str, column: str, broken: str) -> str:
    return f"""
SELECT '{suite}' AS suite, '{kind}' AS check_name, '{column}' AS column_name,
    CAST(count(*) AS BIGINT) AS rows_checked,
    CAST(count_if({broken}) AS BIGINT) AS failures,
    count_if({broken}) = 0 AS success
FROM {table}"""


def not_null(suite: str, table: str, *columns: str) -> list[str]:
    return [column_check(suite, table, "not_null", c, f"{c} IS NULL") for c in columns]


def accepted(suite: str, table: str, column: str, values: list[str]) -> str:
    listed = ", ".join(f"'{v}'" for v in values)
    return column_check(suite, table, "accepted_values", column, f"{column} NOT IN ({listed})")


def between(suite: str, table: str, column: str, low, high) -> str:
    return column_check(
        suite, table, "between", column, f"NOT {column} BETWEEN {low} AND {high}"
    )


def unique(suite: str, table: str, column: str) -> str:
    return f"""
SELECT '{suite}' AS suite, 'unique' AS check_name, '{column}' AS column_name,
    CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_checked,
    CAST(count_if(repeated) AS BIGINT) AS failures, count_if(repeated) = 0 AS success
FROM (
    SELECT count(*) AS n, count(*) > 1 AND {column} IS NOT NULL AS repeated
    FROM {table} GROUP BY {column}
)"""


def row_count(suite: str, table: str, kind: str, broken: str) -> str:
    return f"""
SELECT '{suite}' AS suite, '{kind}' AS check_name, CAST(NULL AS VARCHAR) AS column_name,
    CAST(count(*) AS BIGINT) AS rows_checked,
    CAST(CASE WHEN {broken} THEN 1 ELSE 0 END AS BIGINT) AS failures,
    NOT ({broken}) AS success
FROM {table}"""


def relationship(suite: str, table: str, column: str, parent: str, key: str) -> str:
    return column_check(
        suite,
        f"(SELECT c.*, p.{key} AS found FROM {table} c LEFT JOIN {parent} p "
        f"ON c.{column} = p.{key})",
        "relationships",
        column,
        f"found IS NULL AND {column} IS NOT NULL",
    )


def together(parts: list[str]) -> str:
    return "\nUNION ALL".join(parts)


def schema_tests(games: str = "games") -> str:
    players = [f"player{i}" for i in range(7)]
    return together(
        not_null(
            "stg_games",
            games,
            *["game_url", "username", "time_class", "player_color", "player_result", "player_rating"],
            *["ended_at", "white_rating", "black_rating"],
        )
        + [
            unique("stg_games", games, "game_url"),
            accepted("stg_games", games, "username", players),
            accepted("stg_games", games, "time_class", ["rapid", "blitz", "bullet", "daily"]),
            accepted("stg_games", games, "player_color", ["white", "black"]),
        ]
        + not_null("stg_players", "players", "username", "player_id", "country_code", "peak_rating")
        + [
            unique("stg_players", "players", "username"),
            unique("stg_players", "players", "player_id"),
            accepted(
                "stg_players",
                "players",
                "title",
                ["GM", "IM", "FM", "CM", "NM", "WGM", "WIM", "WFM", "WCM"],
            ),
        ]
        + not_null(
            "int_player_performance",
            "performance",
            *["username", "time_class", "total_games", "win_rate_pct", "avg_rating", "max_rating"],
        )
        + not_null(
            "mart_player_stats",
            "stats",
            *["username", "peak_rating", "total_games_all", "total_wins_all"],
        )
        + [unique("mart_player_stats", "stats", "username")]
        + not_null(
            "mart_opening_analysis",
            "openings",
            *["username", "opening_slug", "total_games", "win_rate_pct"],
        )
        + not_null(
            "mart_elo_progression",
            "progression",
            *["username", "time_class", "game_date", "closing_rating"],
        )
    )


EXPECTATIONS = together(
    not_null("mart_player_stats", "stats", "username")
    + [
        unique("mart_player_stats", "stats", "username"),
        between("mart_player_stats", "stats", "peak_rating", 1000, 4000),
        between("mart_player_stats", "stats", "total_games_all", 0, 100000),
        row_count(
            "mart_player_stats", "stats", "row_count_between", "count(*) NOT BETWEEN 4 AND 6"
        ),
    ]
    + not_null("stg_games", "games", "game_url")
    + [
        accepted("stg_games", "games", "time_class", ["rapid", "blitz", "bullet", "daily"]),
        accepted("stg_games", "games", "player_color", ["white", "black"]),
        between("stg_games", "games", "player_rating", 500, 4000),
        row_count(
            "stg_games", "games", "row_count_between", "count(*) NOT BETWEEN 1000 AND 500000"
        ),
    ]
)
SUMMARY = f"""
SELECT suite, CAST(count_if(success) AS BIGINT) AS passed,
    CAST(count_if(NOT success) AS BIGINT) AS failed, bool_and(success) AS success
FROM ({EXPECTATIONS}) GROUP BY suite
"""
EVERYTHING = (*ALL_STATS, OPENINGS, DAILY, PROGRESSION)

ORACLES["dq_schema_tests"] = sql(schema_tests(), *EVERYTHING)
ORACLES["dq_expectations"] = sql(EXPECTATIONS, *ALL_STATS)
ORACLES["dq_summary"] = sql(SUMMARY, *ALL_STATS)
ORACLES["dq_not_null"] = sql(
    together(not_null("pages", "tagged", "page_id", "url", "campaign")),
    r"""
tagged AS (
    SELECT *, nullif(regexp_extract(url, '[?&]utm_source=([^&#]+)', 1), '') AS campaign FROM pages
)""",
)
ORACLES["dq_unique"] = together(
    [unique("lineitem", "lineitem", c) for c in ("l_orderkey", "l_partkey")]
)
ORACLES["dq_accepted"] = together(
    [accepted("orders", "orders", "o_orderstatus", v) for v in (["F", "O"], ["F", "O", "P"])]
)
ORACLES["dq_between"] = together(
    [
        between("customer", "customer", "c_acctbal", 0.0, 5000.0),
        between("customer", "customer", "c_nationkey", 0, 24),
    ]
)
ORACLES["dq_row_count"] = together(
    [
        row_count("orders", "orders", "row_count_between", "count(*) NOT BETWEEN 1000 AND 500000"),
        row_count("orders", "orders", "row_count_between", "count(*) NOT BETWEEN 4 AND 6"),
        row_count("orders", "orders", "row_count_above", "count(*) <= 1000"),
    ]
)
ORACLES["dq_relationships"] = together(
    [
        relationship("orders", "orders", "o_custkey", "customer", "c_custkey"),
        relationship(
            "orders",
            "orders",
            "o_custkey",
            "(SELECT * FROM customer WHERE c_mktsegment <> 'BUILDING')",
            "c_custkey",
        ),
    ]
)
ORACLES["source_freshness"] = sql(
    """
SELECT loaded_until, age_seconds,
    CASE WHEN age_seconds IS NULL OR age_seconds > 48 * 3600 THEN 'error'
         WHEN age_seconds > 24 * 3600 THEN 'warn' ELSE 'pass' END AS status
FROM (
    SELECT loaded_until, CAST(
        (epoch_us(TIMESTAMP '2024-02-01') - epoch_us(loaded_until)) // 1000000 AS BIGINT
    ) AS age_seconds
    FROM (SELECT max(CAST(ingested_at AS TIMESTAMP)) AS loaded_until FROM raw_games)
)
""",
    RAW_GAMES,
)
ORACLES["freshness_offsets"] = sql(
    """
SELECT username, max(make_timestamp(end_time * 1000000)) AS loaded_until,
    CAST(count(*) AS BIGINT) AS readable
FROM raw_games GROUP BY username
""",
    RAW_GAMES,
)
ORACLES["volume_check"] = sql(
    row_count("raw_games", "raw_games", "row_count_above", "count(*) <= 1000"), RAW_GAMES
)
ORACLES["table_profile"] = sql(
    """
SELECT CAST(count(*) AS BIGINT) AS total_games,
    CAST(count(DISTINCT username) AS BIGINT) AS unique_players,
    min(ended_at) AS earliest_game, max(ended_at) AS latest_game
FROM games
""",
    *GAMES,
)
ORACLES["volume_anomaly"] = """
WITH counts AS (
    SELECT event_type, CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS n
    FROM events GROUP BY 1, 2
),
days AS (
    SELECT event_type, CAST(unnest(generate_series(
        CAST(min(day) AS TIMESTAMP), CAST(max(day) AS TIMESTAMP), INTERVAL 1 DAY
    )) AS DATE) AS day
    FROM counts GROUP BY event_type
),
volume AS (
    SELECT event_type, day, coalesce(n, 0) AS n_rows
    FROM days LEFT JOIN counts USING (event_type, day)
),
judged AS (
    SELECT *,
        avg(n_rows) OVER before AS mean, stddev_samp(n_rows) OVER before AS spread,
        count(n_rows) OVER before = 7 AS known,
        lag(n_rows, 1, 1) OVER every_day AS n_before,
        row_number() OVER every_day AS nth,
        min(CASE WHEN n_rows > 0 THEN day END) OVER (
            PARTITION BY event_type ORDER BY day ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING
        ) AS next_day
    FROM volume
    WINDOW every_day AS (PARTITION BY event_type ORDER BY day), before AS (
        PARTITION BY event_type ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING)
)
SELECT event_type, day, CAST(n_rows AS BIGINT) AS n_rows,
    CAST(CASE WHEN n_rows > 0 THEN 1 ELSE next_day - day END AS INTEGER) AS days,
    CASE WHEN known THEN round(mean, 4) END AS trailing_mean,
    CASE WHEN known THEN round(spread, 4) END AS trailing_stddev,
    known AND abs(n_rows - mean) > 1.5 * spread AS is_anomaly
FROM judged WHERE n_rows > 0 OR n_before > 0
"""
ORACLES["schema_change"] = """
WITH before AS (SELECT * FROM customer),
after AS (
    SELECT c_custkey, CAST(c_nationkey AS BIGINT) AS c_nationkey,
        CASE WHEN c_custkey % 2 = 0 THEN c_acctbal END AS c_acctbal,
        c_mktsegment, 'load 2' AS batch
    FROM customer
),
named(sql_type, type) AS (VALUES
    ('BIGINT', 'bigint'), ('INTEGER', 'int'), ('DOUBLE', 'double'), ('VARCHAR', 'string')),
old_types AS (
    SELECT d.column_name, type AS type_before
    FROM (DESCRIBE SELECT * FROM before) d JOIN named ON d.column_type = sql_type
),
new_types AS (
    SELECT d.column_name, type AS type_after
    FROM (DESCRIBE SELECT * FROM after) d JOIN named ON d.column_type = sql_type
),
old_values AS (
    SELECT column_name, round(null_percentage / 100, 4) AS null_share_before,
        approx_unique AS values_before
    FROM (SUMMARIZE before)
),
new_values AS (
    SELECT column_name, round(null_percentage / 100, 4) AS null_share_after,
        approx_unique AS values_after
    FROM (SUMMARIZE after)
),
classed AS (
    SELECT column_name, type_before, type_after,
        CAST(null_share_before AS DOUBLE) AS null_share_before,
        CAST(null_share_after AS DOUBLE) AS null_share_after,
        CASE WHEN type_before IS NULL THEN 'added' WHEN type_after IS NULL THEN 'removed'
            WHEN type_before <> type_after THEN 'retyped'
            WHEN abs(null_share_after - null_share_before) > 0.1
                OR greatest(values_before, values_after) > 2 * least(values_before, values_after)
            THEN 'drifted' END AS change
    FROM old_types JOIN old_values USING (column_name)
    FULL JOIN (SELECT * FROM new_types JOIN new_values USING (column_name)) USING (column_name)
)
SELECT * FROM classed WHERE change IS NOT NULL
"""

# --- the whole job -----------------------------------------------------------

LOADED = (
    RAW_GAMES,
    LOADED_GAMES,
    staged(source="loaded_games"),
    PERFORMANCE,
    RAW_PLAYERS,
    LOADED_PLAYERS,
    staged_players("loaded_players"),
    STATS,
)
ORACLES["pipeline_player_stats"] = sql("SELECT * FROM stats", *LOADED)
ORACLES["pipeline_checks"] = sql(schema_tests(), *LOADED, OPENINGS, DAILY, PROGRESSION)
ORACLES["pipeline_expectations"] = sql(SUMMARY, *LOADED)
ORACLES["pipeline_expectation_rows"] = sql(EXPECTATIONS, *LOADED)
ORACLES["pipeline_rejects"] = sql(
    """
SELECT 'games loaded' AS what, CAST(count(*) AS BIGINT) AS n FROM loaded_games
UNION ALL
SELECT what, CAST(count_if(end_time % 50 = 0) + 3 * count_if(end_time % 50 = 1) AS BIGINT)
FROM raw_games, (VALUES ('lines listed'), ('lines counted')) AS kinds(what) GROUP BY what
""",
    RAW_GAMES,
    LOADED_GAMES,
)
ORACLES["pipeline_result_map"] = sql("SELECT * FROM performance", *LOADED)

# --- incremental loads and marts -----------------------------------------------

_BATCHES = """
first AS (SELECT * FROM raw_games WHERE end_time % 2 = 0),
second AS (
    SELECT * FROM raw_games WHERE end_time % 2 = 1
    UNION ALL
    SELECT * REPLACE (white_rating + 50 AS white_rating, end_time - 3456000 AS end_time)
    FROM raw_games WHERE end_time % 10 = 0
)"""
_NULLS_FIRST_TIES = ", ".join(f"{c.strip()} NULLS FIRST" for c in _ALL_TIES.split(","))


def _kept(first: str, second: str) -> str:
    return f"""
kept_games AS (
    SELECT * FROM (SELECT * FROM {first} UNION ALL SELECT * FROM {second})
    QUALIFY row_number() OVER (PARTITION BY game_url ORDER BY ingested_at DESC, {_NULLS_FIRST_TIES}) = 1
)"""


def _loaded(batch: str, at: str) -> str:
    shaped = LOADED_GAMES.replace("loaded_games", f"loaded_{batch}").replace("FROM raw_games", f"FROM {batch}")
    return shaped.replace("2024-01-31T06:00:00", at)


UPDATED = (
    RAW_GAMES,
    _BATCHES,
    _loaded("first", "2024-01-31T06:00:00"),
    _loaded("second", "2024-02-01T06:00:00"),
    _kept("loaded_first", "loaded_second"),
    staged(source="kept_games"),
)
ORACLES["upsert_raw_games"] = sql(
    "SELECT * FROM kept_games",
    RAW_GAMES,
    _BATCHES,
    "first_load AS (SELECT * REPLACE ('2024-01-31T06:00:00' AS ingested_at) FROM first)",
    "second_load AS (SELECT * REPLACE ('2024-02-01T06:00:00' AS ingested_at) FROM second)",
    _kept("first_load", "second_load"),
)
ORACLES["incremental_player_stats"] = sql(
    "SELECT * FROM stats",
    *UPDATED, PERFORMANCE, RAW_PLAYERS, LOADED_PLAYERS, staged_players("loaded_players"), STATS,
)
ORACLES["incremental_openings"] = sql("SELECT * FROM openings", *UPDATED, OPENINGS)
ORACLES["incremental_progression"] = sql("SELECT * FROM progression", *UPDATED, DAILY, PROGRESSION)

# --- what changes from load to load ---------------------------------------------

_PROFILED_LOADS = """
loads AS (
    SELECT 'first' AS load, game_url, rated, white_rating, black_rating, black_result, end_time
    FROM raw_games WHERE end_time % 2 = 0
    UNION ALL
    SELECT 'second', game_url, rated, white_rating + 400, black_rating,
        CASE WHEN end_time % 3 <> 0 THEN black_result END, end_time
    FROM raw_games WHERE end_time % 2 = 1
)"""
_PROFILED = {
    "game_url": ("string", "length(game_url)"), "rated": ("boolean", "rated::INTEGER"),
    "white_rating": ("bigint", "white_rating"), "black_rating": ("bigint", "black_rating"),
    "black_result": ("string", "length(black_result)"), "end_time": ("bigint", "end_time"),
}
ORACLES["profile_drift"] = sql(
    """
SELECT column_name, type AS type_before, type AS type_after,
    round(nulls_before / rows_before, 4) AS null_share_before,
    round(nulls_after / rows_after, 4) AS null_share_after, distance,
    CASE WHEN coalesce(distance, 0) > 0.1
        OR abs(round(nulls_after / rows_after, 4) - round(nulls_before / rows_before, 4)) > 0.1
    THEN 'drifted' END AS change
FROM (
    SELECT column_name, any_value(type) AS type, count(*) FILTER (load = 'first') AS rows_before,
        count(*) FILTER (load = 'second') AS rows_after,
        count(*) FILTER (load = 'first' AND missing) AS nulls_before,
        count(*) FILTER (load = 'second' AND missing) AS nulls_after
    FROM named GROUP BY column_name
) LEFT JOIN (
    SELECT column_name, round(max(abs(before - after)), 6) AS distance FROM (
        SELECT column_name,
            sum(b) OVER (PARTITION BY column_name ORDER BY bin) / sum(b) OVER (PARTITION BY column_name) AS before,
            sum(a) OVER (PARTITION BY column_name ORDER BY bin) / sum(a) OVER (PARTITION BY column_name) AS after
        FROM (
            SELECT column_name, sign(number) * (floor(ln(greatest(abs(number), 1)) / ln(1.02)) + 1) AS bin,
                count(*) FILTER (load = 'first') AS b, count(*) FILTER (load = 'second') AS a
            FROM named WHERE number IS NOT NULL GROUP BY 1, 2
        )
    ) GROUP BY column_name
) USING (column_name)
""",
    RAW_GAMES,
    _PROFILED_LOADS,
    "named AS ("
    + " UNION ALL ".join(
        f"SELECT load, '{c}' AS column_name, '{kind}' AS type, {c} IS NULL AS missing, ({number})::DOUBLE AS number FROM loads"
        for c, (kind, number) in _PROFILED.items()
    )
    + ")",
)
ORACLES["distinct_over_loads"] = sql(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_nulls, "
        f"count(DISTINCT {c}) AS distinct_values, true AS sketch_is_near FROM loads"
        for c in _PROFILED
    ),
    RAW_GAMES,
    _PROFILED_LOADS,
)
ORACLES["seasonal_volume"] = """
WITH repeated AS (
    SELECT event_type, CAST(ts AS DATE) AS day FROM events,
        range(1 + CASE WHEN (CAST(ts AS DATE) - DATE '1970-01-01') % 7 = 3 THEN 3 ELSE 0 END
            + CASE WHEN CAST(ts AS DATE) = DATE '2024-01-25' AND event_type = 'view' THEN 9 ELSE 0 END)
),
counted AS (
    SELECT event_type, day, count(*) AS n_rows,
        lead(day) OVER (PARTITION BY event_type ORDER BY day) AS following
    FROM repeated GROUP BY event_type, day
),
daily AS (
    SELECT event_type, day, n_rows, 1 AS days FROM counted
    UNION ALL
    SELECT event_type, day + 1, 0, following - day - 1 FROM counted WHERE following - day > 1
),
seen AS (
    SELECT d.event_type, d.day, d.n_rows, d.days,
        d.day - min(d.day) OVER (PARTITION BY d.event_type) AS age,
        list_resize(coalesce(h.past, []), 3, 0) AS past
    FROM daily d LEFT JOIN (
        SELECT a.event_type, a.day, list(b.n_rows) AS past FROM daily a JOIN daily b
            ON a.event_type = b.event_type AND (a.day - b.day) IN (7, 14, 21) GROUP BY a.event_type, a.day
    ) h USING (event_type, day)
),
middles AS (
    SELECT *, list_aggregate(past, 'median')::DOUBLE AS middle FROM seen
),
scaled AS (
    SELECT *, greatest(
        list_aggregate(list_transform(past, lambda n: abs(n - middle)), 'median') * 1.4826, sqrt(middle)) AS spread
    FROM middles
)
SELECT event_type, day, n_rows, CAST(days AS INTEGER) AS days, CASE WHEN age >= 21 THEN middle END AS usual,
    CASE WHEN age >= 21 THEN round(spread, 4) END AS scale,
    age >= 21 AND abs(n_rows - middle) > spread * 4 AS is_anomaly
FROM scaled
"""
