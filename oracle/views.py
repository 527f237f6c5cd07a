"""DuckDB text of the three inputs, as leading CTEs of every statement.

The mapping is that of FIXTURES.md; `matchledger/sources/demo.py` has it as
DataFrames.
"""

INPUTS = """
tagged AS (
    SELECT event_id, ts, user_id, event_type, value,
           CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           event_id // 5 AS room, (event_id // 5) % 7 AS tournament
    FROM events
),
game_events AS (
    SELECT * , CAST(timestamp_utc AS DATE) AS date_utc FROM (
        SELECT 'tournamentJoined' AS event_name,
               ts - to_minutes(k % 40 + 20) AS timestamp_utc,
               user_id AS player_id, room AS room_id, tournament AS tournament_id,
               1000 + (event_id * 37) % 500 AS balance_before,
               CASE WHEN k % 10 <> 0 THEN 10 * (1 + room % 4) END AS entry_fee,
               CAST(5 AS INTEGER) AS players_capacity,
               CAST(NULL AS BIGINT) AS play_duration,
               CAST(NULL AS BIGINT) AS players_submited,
               CAST(NULL AS BIGINT) AS players_active_in_toom,
               CAST(NULL AS BIGINT) AS score,
               CAST(NULL AS BIGINT) AS position,
               CAST(NULL AS BIGINT) AS reward,
               CAST(NULL AS BIGINT) AS coins_claimed,
               CAST(NULL AS DOUBLE) AS price_usd
        FROM tagged WHERE event_type <> 'purchase'
        UNION ALL
        SELECT 'tournamentFinished', ts - to_minutes(15), user_id, room, tournament,
               990 + (event_id * 37) % 500, NULL, NULL,
               CASE WHEN k % 9 <> 0 THEN 30 + k END, 1 + k % 5, 3 + k % 3,
               CASE WHEN k % 11 <> 0 THEN CAST(floor(value * 10) AS BIGINT) END,
               NULL, NULL, NULL, NULL
        FROM tagged WHERE event_type <> 'purchase' AND k % 8 <> 0
        UNION ALL
        SELECT 'tournamentRoomClosed', ts - to_minutes(10), user_id, room, tournament,
               990 + (event_id * 37) % 500, NULL, NULL, NULL, NULL, NULL,
               CASE WHEN k % 4 <> 0 THEN CAST(floor(value * 10) AS BIGINT) END,
               k % 5,
               CASE k % 5 WHEN 0 THEN 40 WHEN 1 THEN 20 WHEN 2 THEN 0 END,
               CASE WHEN k % 7 = 0 THEN 5 END, NULL
        FROM tagged WHERE event_type <> 'purchase' AND k % 6 <> 0
        UNION ALL
        SELECT 'tournamentRewardClaimed', ts, user_id, room, tournament,
               990 + (event_id * 37) % 500, NULL, NULL, NULL, NULL, NULL,
               CAST(floor(value * 10) AS BIGINT), k % 5,
               CASE k % 5 WHEN 0 THEN 40 WHEN 1 THEN 20 END,
               CASE WHEN k % 7 = 0 THEN 5 END, NULL
        FROM tagged WHERE event_type <> 'purchase' AND k % 5 < 3
        UNION ALL
        SELECT 'purchase', ts, user_id, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
               NULL, NULL, NULL, NULL, 100 * (1 + k % 3), value
        FROM tagged WHERE event_type = 'purchase'
    )
),
installs_attribution AS (
    SELECT DISTINCT user_id AS player_id,
           DATE '2024-01-30' - CAST((user_id * 7) % 113 - 3 AS INTEGER) AS install_date,
           CASE user_id % 4 WHEN 0 THEN 'Organic' WHEN 1 THEN 'AdNetA'
                            WHEN 2 THEN 'AdNetB' ELSE 'AdNetC' END AS media_source,
           'C' || CAST(user_id % 3 AS VARCHAR) AS install_country
    FROM events
),
marketing_spend AS (
    SELECT media_source, country,
           CASE WHEN media_source = 'AdNetC' AND country = 'C0' THEN 0.0
                ELSE abs(s_acctbal) END AS spend
    FROM (
        SELECT CASE s_suppkey % 3 WHEN 0 THEN 'AdNetA' WHEN 1 THEN 'AdNetB' ELSE 'AdNetC' END AS media_source,
               'C' || CAST(s_nationkey % 3 AS VARCHAR) AS country, s_acctbal
        FROM supplier
    )
),
cuts AS (
    SELECT CAST(min(date_utc) + CAST(date_diff('day', min(date_utc), max(date_utc)) * 2 // 3 AS INTEGER) AS DATE) AS first_until,
           CAST(min(date_utc) + CAST(date_diff('day', min(date_utc), max(date_utc)) // 2 AS INTEGER) AS DATE) AS merged_from
    FROM game_events
),
first_run AS (SELECT * FROM game_events WHERE date_utc <= (SELECT first_until FROM cuts))
"""
