"""DuckDB statements that each registered query must agree with.

They follow the written models literally: one aggregate per metric, rank
windows, the full calendar and the joins, where the Spark plans take one pass.
"""

from __future__ import annotations

from oracle.views import INPUTS


def statement(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([INPUTS.strip(), *[c.strip() for c in ctes]]) + "\n" + body.strip()


def of_type(name: str, source: str = "game_events") -> str:
    return f"(SELECT * FROM {source} WHERE event_name = '{name}')"


def joined(source: str = "game_events", extra: str = "") -> str:
    return f"(SELECT * FROM {source} WHERE event_name = 'tournamentJoined' {extra})"


def finished(source: str = "game_events") -> str:
    return of_type("tournamentFinished", source)


def closed(source: str = "game_events") -> str:
    return of_type("tournamentRoomClosed", source)


def claimed(source: str = "game_events") -> str:
    return of_type("tournamentRewardClaimed", source)


def bought(source: str = "game_events") -> str:
    return of_type("purchase", source)


# ---------------------------------------------------------------- games

GAME_COLUMNS = """
    player_id, room_id, tournament_id, j.date_utc, j.timestamp_utc AS joined_time,
    f.timestamp_utc AS submit_time, c.timestamp_utc AS room_close_time,
    f.play_duration, j.balance_before,
    c.balance_before + coalesce(c.reward, c.coins_claimed) AS balance_after_claim,
    j.entry_fee, j.players_capacity, f.players_active_in_toom AS actual_players_in_room,
    coalesce(c.score, f.score) AS score, c.position,
    coalesce(c.reward, c.coins_claimed) AS reward,
    r.timestamp_utc IS NOT NULL AS did_claim_reward, r.timestamp_utc AS claim_time
"""


def games(name: str, source: str = "game_events", extra: str = "") -> str:
    return f"""
{name} AS (
    SELECT {GAME_COLUMNS}
    FROM {joined(source, extra)} j
    LEFT JOIN {finished(source)} f USING (player_id, room_id, tournament_id)
    LEFT JOIN {closed(source)} c USING (player_id, room_id, tournament_id)
    LEFT JOIN {claimed(source)} r USING (player_id, room_id, tournament_id)
)"""


def _earliest(view: str, order: str) -> str:
    return f"""(SELECT DISTINCT ON (player_id, room_id, tournament_id) * FROM {view}
        ORDER BY player_id, room_id, tournament_id, {order})"""


def games_dedup(name: str, source: str = "game_events") -> str:
    close_order = (
        "timestamp_utc NULLS LAST, position NULLS LAST, coalesce(reward, coins_claimed) NULLS LAST, "
        "balance_before + coalesce(reward, coins_claimed) NULLS LAST, score NULLS LAST"
    )
    return f"""
{name} AS (
    SELECT {GAME_COLUMNS}
    FROM {_earliest(joined(source), 'timestamp_utc NULLS LAST, balance_before NULLS LAST, entry_fee NULLS LAST, players_capacity NULLS LAST')} j
    LEFT JOIN {_earliest(finished(source), 'timestamp_utc NULLS LAST, play_duration NULLS LAST, score NULLS LAST, players_active_in_toom NULLS LAST')} f
        USING (player_id, room_id, tournament_id)
    LEFT JOIN {_earliest(closed(source), close_order)} c USING (player_id, room_id, tournament_id)
    LEFT JOIN {_earliest(claimed(source), 'timestamp_utc')} r USING (player_id, room_id, tournament_id)
)"""


# ---------------------------------------------------------------- rooms

def room_parts(source: str = "game_events", tag: str = "") -> str:
    return f"""
opened{tag} AS (
    SELECT tournament_id, room_id, min(timestamp_utc) AS room_open_time,
           CAST(sum(coalesce(entry_fee, 0)) AS BIGINT) AS total_coins_sink
    FROM {joined(source)} GROUP BY ALL
),
shut{tag} AS (
    SELECT tournament_id, room_id, max(timestamp_utc) AS room_close_time,
           CAST(sum(coalesce(reward, 0)) AS BIGINT) AS total_coins_rewards
    FROM {closed(source)} GROUP BY ALL
),
lasted{tag} AS (
    SELECT tournament_id, room_id, players_active_in_toom,
           avg(coalesce(play_duration, 0)) AS total_matches_duration
    FROM {finished(source)} GROUP BY ALL
)"""


ROOM_FLAGS = """
    date_sub('minute', room_open_time, room_close_time) AS room_open_duration,
    coalesce(date_sub('minute', room_open_time, room_close_time) > 45, false)
        OR coalesce(actual_players = players_capacity, false) AS is_closed,
    coalesce(actual_players = players_capacity, false) AS is_full
"""


def rooms(name: str, source: str = "game_events", extra: str = "") -> str:
    tag = f"_{name}"
    return room_parts(source, tag) + f""",
{name}_wide AS (
    SELECT room_id, tournament_id, d.players_capacity, d.entry_fee, room_open_time,
           room_close_time, l.players_active_in_toom AS actual_players, total_coins_sink,
           total_coins_rewards, total_matches_duration
    FROM {joined(source, extra)} d
    LEFT JOIN opened{tag} USING (room_id, tournament_id)
    LEFT JOIN shut{tag} USING (room_id, tournament_id)
    LEFT JOIN lasted{tag} l USING (room_id, tournament_id)
),
{name} AS (SELECT *, {ROOM_FLAGS} FROM {name}_wide)"""


def rooms_dedup(name: str, source: str = "game_events") -> str:
    tag = f"_{name}"
    return room_parts(source, tag) + f""",
{name}_wide AS (
    SELECT room_id, tournament_id, players_capacity, entry_fee, room_open_time,
           room_close_time, actual_players, total_coins_sink, total_coins_rewards,
           total_matches_duration
    FROM (SELECT room_id, tournament_id, max(players_capacity) AS players_capacity,
                 max(entry_fee) AS entry_fee FROM {joined(source)} GROUP BY ALL)
    LEFT JOIN opened{tag} USING (room_id, tournament_id)
    LEFT JOIN shut{tag} USING (room_id, tournament_id)
    LEFT JOIN (SELECT room_id, tournament_id, max(players_active_in_toom) AS actual_players,
                      avg(coalesce(play_duration, 0)) AS total_matches_duration
               FROM {finished(source)} GROUP BY ALL) USING (room_id, tournament_id)
),
{name} AS (SELECT *, {ROOM_FLAGS} FROM {name}_wide)"""


# ---------------------------------------------------------------- daily

def _opening(source: str, since: str = "") -> str:
    return f"""SELECT date_utc, player_id, balance_before
    FROM (SELECT *, rank() OVER (PARTITION BY player_id, date_utc ORDER BY timestamp_utc) AS r
          FROM {joined(source, since)}) WHERE r = 1"""


def _closing(source: str) -> str:
    return f"""SELECT date_utc, player_id, balance_before AS balance_day_end
    FROM (SELECT *, rank() OVER (PARTITION BY player_id, date_utc ORDER BY timestamp_utc DESC) AS r
          FROM {finished(source)}) WHERE r = 1"""


def _spine(source: str) -> str:
    return f"""SELECT player_id, CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS date_utc
    FROM (SELECT player_id, CAST(min(date_utc) AS TIMESTAMP) AS first_day,
                 (SELECT CAST(max(date_utc) AS TIMESTAMP) FROM {source}) AS last_day
          FROM {source} GROUP BY player_id)"""


SUMMARY = """max(coalesce(score, 0)) AS max_score, avg(coalesce(score, 0)) AS avg_score,
    max(position) AS max_position, avg(position) AS avg_position"""


def _played(source: str) -> str:
    return f"SELECT date_utc, player_id, count(*) AS matches_played FROM {joined(source)} GROUP BY ALL"


def _lasted(source: str) -> str:
    return f"""SELECT date_utc, player_id, CAST(sum(coalesce(play_duration, 0)) AS BIGINT) AS total_matches_duration
    FROM {finished(source)} GROUP BY ALL"""


def _scores(source: str) -> str:
    return f"""SELECT date_utc, player_id, {SUMMARY} FROM {source}
    WHERE event_name IN ('tournamentRoomClosed', 'tournamentRewardClaimed') GROUP BY ALL"""


def _rewards(source: str) -> str:
    return f"""SELECT date_utc, player_id,
        -- The written CASE is never NULL, so counting it counts every claim.
        count(*) AS matches_won_reward,
        count(*) AS matches_claimed
    FROM {claimed(source)} GROUP BY ALL"""


def _coins(source: str) -> str:
    return f"""SELECT date_utc, player_id,
        CAST(sum(if(event_name = 'tournamentJoined', entry_fee, 0)) AS BIGINT) AS coins_sink_tournaments,
        CAST(sum(if(event_name = 'tournamentRewardClaimed', reward, 0)) AS BIGINT) AS coins_source_tournaments
    FROM {source} GROUP BY ALL"""


def _purchases(source: str) -> str:
    return f"""SELECT date_utc, player_id, sum(price_usd) AS revenue,
        CAST(sum(coins_claimed) AS BIGINT) AS coins_source_purchases
    FROM {bought(source)} GROUP BY ALL"""


def _flags(source: str) -> str:
    """Flags of room closings with those of the row before, in time order."""
    return f"""SELECT *, row_number() OVER w AS event_order,
        lag(is_win, 1, 0) OVER w AS previous_is_win, lag(is_loss, 1, 0) OVER w AS previous_is_loss
    FROM (SELECT *, if(position = 0, 1, 0) AS is_win, if(coalesce(reward, 0) = 0, 1, 0) AS is_loss
          FROM {closed(source)})
    WINDOW w AS (PARTITION BY player_id, date_utc ORDER BY timestamp_utc, is_win, is_loss)"""


def _groups(source: str) -> str:
    """Change counts with the day as the order key: all rows of a day are peers."""
    return f"""SELECT *,
        CAST(sum(if(is_win <> previous_is_win, 1, 0)) OVER day AS BIGINT) AS win_streak_group,
        CAST(sum(if(is_loss <> previous_is_loss, 1, 0)) OVER day AS BIGINT) AS loss_streak_group
    FROM ({_flags(source)})
    WINDOW day AS (PARTITION BY player_id, date_utc ORDER BY date_utc)"""


def _lengths(source: str) -> str:
    return f"""SELECT player_id, date_utc, win_streak_group, loss_streak_group,
        count(*) FILTER (is_win = 1) AS win_streak_length,
        count(*) FILTER (is_loss = 1) AS loss_streak_length
    FROM ({_groups(source)}) GROUP BY ALL"""


def _streaks(source: str) -> str:
    return f"""SELECT player_id, date_utc, max(win_streak_length) AS max_reward_won_streak,
        max(loss_streak_length) AS max_losing_streak
    FROM ({_lengths(source)}) GROUP BY ALL"""


CARRIED = [
    "balance_day_start", "balance_day_end", "matches_played", "total_matches_duration",
    "coins_sink_tournaments", "coins_source_tournaments", "max_score", "avg_score",
    "max_position", "avg_position", "max_reward_won_streak", "max_losing_streak",
]
ZEROED = ["matches_won_reward", "matches_claimed", "revenue", "coins_source_purchases"]


def day_table(name: str, source: str = "game_events", since: str = "") -> str:
    """The calendar joined with one aggregate per metric, before the fill."""
    return f"""
{name} AS (
    SELECT player_id, date_utc, balance_before AS balance_day_start, balance_day_end,
           matches_played, total_matches_duration, max_score, round(avg_score, 3) AS avg_score,
           max_position, round(avg_position, 3) AS avg_position,
           coalesce(matches_won_reward, 0) AS matches_won_reward,
           coalesce(matches_claimed, 0) AS matches_claimed,
           coins_sink_tournaments, coins_source_tournaments,
           coalesce(revenue, 0) AS revenue,
           coalesce(coins_source_purchases, 0) AS coins_source_purchases,
           max_reward_won_streak, max_losing_streak
    FROM ({_spine(source)})
    LEFT JOIN ({_opening(source, since)}) USING (player_id, date_utc)
    LEFT JOIN ({_closing(source)}) USING (player_id, date_utc)
    LEFT JOIN ({_played(source)}) USING (player_id, date_utc)
    LEFT JOIN ({_lasted(source)}) USING (player_id, date_utc)
    LEFT JOIN ({_scores(source)}) USING (player_id, date_utc)
    LEFT JOIN ({_rewards(source)}) USING (player_id, date_utc)
    LEFT JOIN ({_coins(source)}) USING (player_id, date_utc)
    LEFT JOIN ({_purchases(source)}) USING (player_id, date_utc)
    LEFT JOIN ({_streaks(source)}) USING (player_id, date_utc)
)"""


def daily(name: str, source: str = "game_events", since: str = "") -> str:
    fills = ",\n           ".join(
        f"last_value({c} IGNORE NULLS) OVER so_far AS {c}" for c in CARRIED + ZEROED
    )
    return day_table(f"{name}_days", source, since) + f""",
{name} AS (
    SELECT date_utc, player_id,
           {fills}
    FROM {name}_days
    WINDOW so_far AS (PARTITION BY player_id ORDER BY date_utc
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
)"""


ROUNDED = "SELECT * REPLACE (round(revenue, 2) AS revenue) FROM "


# ---------------------------------------------------------------- roas

def revenue_rows(name: str, days: str) -> str:
    """Installs with their player's running revenue over the days not before the latest."""
    return f"""
{name} AS (
    SELECT i.player_id, d.date_utc, i.install_date, i.media_source, i.install_country, d.revenue,
           date_diff('day', i.install_date, d.date_utc) AS days_since_install,
           coalesce(sum(d.revenue) OVER (PARTITION BY i.player_id ORDER BY d.date_utc
               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS cumulative_revenue
    FROM installs_attribution i LEFT JOIN {days} d ON d.player_id = i.player_id
    WHERE d.date_utc >= (SELECT max(date_utc) FROM {days})
)"""


BAND = """CASE WHEN days_since_install <= 7 THEN 'D7' WHEN days_since_install <= 14 THEN 'D14'
         WHEN days_since_install <= 30 THEN 'D30' WHEN days_since_install <= 90 THEN 'D90' END"""

SPEND = """
spent AS (
    SELECT media_source, country AS install_country, sum(spend) AS total_spend
    FROM marketing_spend GROUP BY ALL
)"""


def cohorts(name: str, rows: str) -> str:
    return f"""
{name} AS (
    SELECT media_source, install_country, install_date, {BAND} AS cohort_period,
           sum(cumulative_revenue) AS cohort_revenue, total_spend
    FROM {rows} LEFT JOIN spent USING (media_source, install_country)
    WHERE days_since_install <= 90 GROUP BY ALL
)"""


ROAS = """SELECT media_source, install_country, install_date, cohort_period,
    round(cohort_revenue / nullif(total_spend, 0), 3) AS roas FROM """


def roas(name: str, days: str) -> str:
    return revenue_rows(f"{name}_rows", days) + "," + cohorts(f"{name}_cohorts", f"{name}_rows") + f""",
{name} AS ({ROAS} {name}_cohorts)"""


# ---------------------------------------------------------------- merge

def merged(old: str, new: str, keys: str) -> str:
    """New rows, and the old rows whose key they do not have."""
    return f"""SELECT * FROM {new} UNION ALL BY NAME SELECT * FROM {old} ANTI JOIN {new} USING ({keys})"""


MATCH = "player_id, room_id, tournament_id"
ROOM = "room_id, tournament_id"
COHORT = "media_source, install_country, install_date, cohort_period"


def checks(rows: list[tuple[str, str, str, str]]) -> str:
    return "\nUNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{test}' AS test, ({count}) AS failures"
        for table, column, test, count in rows
    )


def nulls(table: str, label: str, *columns: str) -> list[tuple[str, str, str, str]]:
    return [(label, c, "not_null", f"SELECT count(*) FROM {table} WHERE {c} IS NULL") for c in columns]


def all_statements() -> dict[str, str]:
    s: dict[str, str] = {}
    day, log = "date_utc, player_id", "game_events"

    # sources and typed views
    s["src_events"] = statement("SELECT * FROM game_events")
    s["src_installs_attribution"] = statement("SELECT * FROM installs_attribution")
    s["src_marketing_spend"] = statement("SELECT * FROM marketing_spend")
    s["event_purchase"] = statement(f"SELECT * FROM {bought()}")
    s["event_tournament_finished"] = statement(f"SELECT * FROM {finished()}")
    s["event_tournament_joined"] = statement(f"SELECT * FROM {joined()}")
    s["event_tournament_reward_claimed"] = statement(f"SELECT * FROM {claimed()}")
    s["event_tournament_room_closed"] = statement(f"SELECT * FROM {closed()}")
    s["filter_in_list"] = statement(
        "SELECT * FROM game_events WHERE event_name IN ('tournamentRoomClosed', 'tournamentRewardClaimed')"
    )

    # games
    s["project_joined"] = statement(
        f"""SELECT player_id, room_id, tournament_id, date_utc, balance_before, entry_fee,
            players_capacity, timestamp_utc AS joined_time FROM {joined()}"""
    )
    s["join_game_lifecycle"] = statement(
        f"""SELECT player_id, room_id, tournament_id, j.timestamp_utc AS joined_time,
            f.timestamp_utc AS submit_time, c.timestamp_utc AS room_close_time, r.timestamp_utc AS claim_time
        FROM {joined()} j LEFT JOIN {finished()} f USING ({MATCH})
        LEFT JOIN {closed()} c USING ({MATCH}) LEFT JOIN {claimed()} r USING ({MATCH})"""
    )
    s["balance_after_claim"] = statement(
        f"""SELECT player_id, room_id, tournament_id, timestamp_utc AS room_close_time,
            coalesce(reward, coins_claimed) AS reward,
            balance_before + coalesce(reward, coins_claimed) AS balance_after_claim FROM {closed()}"""
    )
    s["scalar_null_handling"] = statement(
        """SELECT event_name, player_id, timestamp_utc, coalesce(score, 0) AS score_or_zero,
            coalesce(play_duration, 0) AS duration_or_zero,
            CASE WHEN reward IS NULL THEN coins_claimed ELSE reward END AS reward_or_coins
        FROM game_events"""
    )
    s["did_claim_flag"] = statement(
        f"SELECT {MATCH}, joined_time, claim_time, did_claim_reward FROM g", games("g")
    )
    s["fct_games"] = statement("SELECT * FROM g", games("g"))
    s["fct_games_split"] = s["fct_games"]
    s["fct_games_dedup"] = statement("SELECT * FROM g", games_dedup("g"))
    s["partitioned_roundtrip"] = s["fct_games"]

    # rooms
    s["room_open"] = statement("SELECT * FROM opened", room_parts())
    s["room_close"] = statement("SELECT * FROM shut", room_parts())
    s["room_match_duration"] = statement("SELECT * FROM lasted", room_parts())
    s["room_open_duration"] = statement(
        """SELECT room_id, tournament_id, room_open_time, room_close_time,
            date_sub('minute', room_open_time, room_close_time) AS room_open_duration
        FROM opened JOIN shut USING (room_id, tournament_id)""",
        room_parts(),
    )
    s["join_room_lifecycle"] = statement(
        """SELECT room_id, tournament_id, players_capacity, entry_fee, room_open_time,
            room_close_time, actual_players FROM r""",
        rooms("r"),
    )
    s["room_flags"] = statement(
        """SELECT room_id, tournament_id, players_capacity, actual_players, room_open_duration,
            is_closed, is_full FROM r""",
        rooms("r"),
    )
    s["fct_rooms"] = statement("SELECT * FROM r", rooms("r"))
    s["fct_rooms_dedup"] = statement("SELECT * FROM r", rooms_dedup("r"))
    s["partitioned_roundtrip_ts"] = s["fct_rooms"]

    # daily metrics
    s["player_first_appearance"] = statement(
        "SELECT player_id, min(date_utc) AS first_appearance_date FROM game_events GROUP BY ALL"
    )
    s["date_bounds"] = statement(
        "SELECT min(date_utc) AS min_date, max(date_utc) AS max_date FROM game_events"
    )
    s["date_spine"] = statement(_spine(log))
    s["balance_start"] = statement(_opening(log))
    s["balance_end"] = statement(_closing(log))
    s["balance_start_dedup"] = statement(
        f"""SELECT DISTINCT ON (player_id, date_utc) date_utc, player_id, balance_before FROM {joined()}
        ORDER BY player_id, date_utc, timestamp_utc, room_id, tournament_id, balance_before"""
    )
    s["first_event_per_day"] = statement(
        f"""SELECT player_id, date_utc, timestamp_utc, room_id, tournament_id FROM {joined()}
        QUALIFY rank() OVER (PARTITION BY player_id, date_utc ORDER BY timestamp_utc) = 1"""
    )
    s["matches_played"] = statement(_played(log))
    s["match_duration_daily"] = statement(_lasted(log))
    s["match_summary"] = statement(
        f"SELECT * REPLACE (round(avg_score, 3) AS avg_score, round(avg_position, 3) AS avg_position) FROM ({_scores(log)})"
    )
    s["match_summary_closed_only"] = statement(
        f"""SELECT * REPLACE (round(avg_score, 3) AS avg_score, round(avg_position, 3) AS avg_position)
        FROM (SELECT {day}, {SUMMARY} FROM {closed()} GROUP BY ALL)"""
    )
    s["match_reward"] = statement(_rewards(log))
    s["matches_won_true"] = statement(
        f"""SELECT {day}, count(*) FILTER (reward IS NOT NULL OR coins_claimed IS NOT NULL) AS matches_won_reward,
            count(*) AS matches_claimed FROM {claimed()} GROUP BY ALL"""
    )
    s["coins_summary"] = statement(_coins(log))
    s["purchases_daily"] = statement(ROUNDED + f"({_purchases(log)})")
    s["win_loss_flags"] = statement(
        f"""SELECT player_id, date_utc, room_id, tournament_id, timestamp_utc,
            if(position = 0, 1, 0) AS is_win, if(coalesce(reward, 0) = 0, 1, 0) AS is_loss FROM {closed()}"""
    )
    flag_columns = "player_id, date_utc, room_id, tournament_id, timestamp_utc, is_win, is_loss"
    s["event_order"] = statement(
        f"SELECT player_id, date_utc, room_id, tournament_id, timestamp_utc, event_order FROM ({_flags(log)})"
    )
    s["previous_flags"] = statement(
        f"SELECT {flag_columns}, previous_is_win, previous_is_loss FROM ({_flags(log)})"
    )
    s["streak_groups"] = statement(
        f"SELECT {flag_columns}, win_streak_group, loss_streak_group FROM ({_groups(log)})"
    )
    s["streak_lengths"] = statement(
        f"SELECT player_id, date_utc, win_streak_length, loss_streak_length FROM ({_lengths(log)})"
    )
    s["final_streaks"] = statement(_streaks(log))
    s["true_streaks"] = statement(
        """SELECT player_id, date_utc,
            max(run) FILTER (kind = 'win') AS max_reward_won_streak,
            max(run) FILTER (kind = 'loss') AS max_losing_streak
        FROM (SELECT player_id, date_utc, kind, misses, CAST(sum(hit) AS BIGINT) AS run
              FROM (SELECT *, sum(1 - hit) OVER (PARTITION BY player_id, date_utc, kind
                        ORDER BY event_order ROWS UNBOUNDED PRECEDING) AS misses
                    FROM (SELECT player_id, date_utc, event_order, 'win' AS kind, is_win AS hit FROM flagged
                          UNION ALL
                          SELECT player_id, date_utc, event_order, 'loss', is_loss FROM flagged))
              GROUP BY ALL)
        GROUP BY ALL""",
        f"flagged AS ({_flags(log)})",
    )
    s["daily_metrics_joined"] = statement(ROUNDED + "m", day_table("m"))
    s["forward_fill"] = statement(ROUNDED + "d", daily("d"))
    s["daily_player"] = s["forward_fill"]
    s["daily_player_single_pass"] = s["forward_fill"]
    others = [c for c in CARRIED + ZEROED if not c.startswith("balance_") and c != "revenue"]
    s["daily_player_zero_filled"] = statement(
        f"""SELECT date_utc, player_id,
            last_value(balance_day_start IGNORE NULLS) OVER so_far AS balance_day_start,
            last_value(balance_day_end IGNORE NULLS) OVER so_far AS balance_day_end,
            {', '.join(f'coalesce({c}, 0) AS {c}' for c in others)}, round(revenue, 2) AS revenue
        FROM m WINDOW so_far AS (PARTITION BY player_id ORDER BY date_utc
                                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
        day_table("m"),
    )

    # roas
    rows = [daily("d"), revenue_rows("earned", "d"), SPEND]
    s["scalar_max_date"] = statement("SELECT max(date_utc) AS max_date FROM d", daily("d"))
    s["filter_latest_date"] = statement(
        """SELECT player_id, date_utc, round(revenue, 2) AS revenue FROM d
        WHERE date_utc >= (SELECT max(date_utc) FROM d)""",
        daily("d"),
    )
    install = "player_id, install_date, media_source, install_country"
    s["latest_revenue"] = statement(
        f"SELECT {install}, date_utc, round(revenue, 2) AS revenue FROM earned", *rows
    )
    s["cumulative_revenue"] = statement(
        f"SELECT {install}, date_utc, round(cumulative_revenue, 2) AS cumulative_revenue FROM earned", *rows
    )
    aged = f"{install}, days_since_install, round(cumulative_revenue, 2) AS cumulative_revenue"
    s["days_since_install"] = statement(f"SELECT {aged} FROM earned", *rows)
    s["filter_cohort_90"] = statement(f"SELECT {aged} FROM earned WHERE days_since_install <= 90", *rows)
    s["cohort_bucket"] = statement(
        f"SELECT {install}, days_since_install, {BAND} AS cohort_period FROM earned", *rows
    )
    s["spend_totals"] = statement(
        "SELECT media_source, install_country, round(total_spend, 2) AS total_spend FROM spent", SPEND
    )
    s["cohort_spend_join"] = statement(
        f"""SELECT {aged}, round(total_spend, 2) AS total_spend
        FROM earned LEFT JOIN spent USING (media_source, install_country)""",
        *rows,
    )
    money = "round(cohort_revenue, 2) AS cohort_revenue, round(total_spend, 2) AS total_spend"
    s["cohort_revenue"] = statement(f"SELECT {COHORT}, {money} FROM c", *rows, cohorts("c", "earned"))
    s["safe_ratio"] = statement(
        f"SELECT {COHORT}, {money}, round(cohort_revenue / nullif(total_spend, 0), 3) AS roas FROM c",
        *rows,
        cohorts("c", "earned"),
    )
    s["marketing_roas"] = statement("SELECT * FROM a", SPEND, daily("d"), roas("a", "d"))
    s["roas_cumulative"] = statement(
        f"""SELECT media_source, install_country, install_date, cohort_period,
            round(sum(coalesce(revenue, 0)) / nullif(any_value(total_spend), 0), 3) AS roas
        FROM (SELECT i.*, upper.cohort_period, p.revenue
              FROM installs_attribution i
              CROSS JOIN (VALUES ('D7', 7), ('D14', 14), ('D30', 30), ('D90', 90)) upper(cohort_period, days)
              LEFT JOIN ({_purchases(log)}) p ON p.player_id = i.player_id
                   AND date_diff('day', i.install_date, p.date_utc) BETWEEN 0 AND upper.days)
        LEFT JOIN spent USING (media_source, install_country)
        GROUP BY media_source, install_country, install_date, cohort_period""",
        SPEND,
    )

    # incremental
    s["incremental_watermark"] = statement(
        "SELECT max(joined_time) AS max_joined_time FROM old", games("old", "first_run")
    )
    s["incremental_filter"] = statement(
        f"""SELECT player_id, room_id, tournament_id, date_utc, balance_before, entry_fee,
            players_capacity, timestamp_utc AS joined_time FROM {joined()}
        WHERE timestamp_utc > (SELECT max(timestamp_utc) FROM {joined('first_run')})"""
    )
    s["merge_upsert_games"] = statement(
        merged("old", "new", MATCH),
        games_dedup("old", "first_run"),
        games_dedup("every"),
        "new AS (SELECT * FROM every WHERE joined_time >= (SELECT merged_from FROM cuts))",
    )
    s["merge_upsert_rooms"] = statement(
        merged("old", "new", ROOM),
        rooms_dedup("old", "first_run"),
        rooms_dedup("every"),
        "new AS (SELECT * FROM every WHERE room_open_time >= (SELECT merged_from FROM cuts))",
    )
    s["merge_upsert_daily_player"] = statement(
        ROUNDED + f"({merged('old', 'new', 'player_id, date_utc')})",
        daily("old", "first_run"),
        daily("every"),
        "new AS (SELECT * FROM every WHERE date_utc >= (SELECT merged_from FROM cuts))",
    )
    s["merge_upsert_roas"] = statement(
        merged("old", "new", COHORT),
        SPEND,
        daily("d1", "first_run"),
        roas("old", "d1"),
        daily("d2"),
        roas("new", "d2"),
    )
    s["marketing_roas_incremental"] = s["merge_upsert_roas"]
    s["fct_games_incremental"] = statement(
        merged("old", "new", MATCH),
        games("old", "first_run"),
        games("new", extra="AND timestamp_utc > (SELECT max(joined_time) FROM old)"),
    )
    s["fct_rooms_incremental"] = statement(
        merged("old", "new", ROOM),
        rooms("old", "first_run"),
        rooms("new", extra="AND timestamp_utc > (SELECT max(room_open_time) FROM old)"),
    )
    s["daily_player_incremental"] = statement(
        ROUNDED + f"({merged('old', 'new', 'player_id, date_utc')})",
        daily("old", "first_run"),
        daily("new", since="AND date_utc > (SELECT max(date_utc) FROM old)"),
    )
    s["fct_games_incremental_fixed"] = s["fct_games"]
    s["fct_rooms_incremental_fixed"] = s["fct_rooms"]
    s["daily_player_incremental_fixed"] = s["daily_player"]
    s["fct_games_late_fixed"] = s["fct_games"]
    s["fct_rooms_late_fixed"] = s["fct_rooms"]
    s["daily_player_late_fixed"] = s["daily_player"]
    s["fct_games_late_published"] = s["fct_games"]
    s["daily_player_late_published"] = s["daily_player"]
    s["fct_games_streamed"] = s["fct_games"]
    s["fct_rooms_streamed"] = s["fct_rooms"]

    # checks
    of_sources = (
        nulls("game_events", "events", "event_name", "timestamp_utc")
        + nulls("installs_attribution", "installs_attribution", "player_id", "install_date")
        + nulls("marketing_spend", "marketing_spend", "media_source", "spend")
    )
    unique_installs = [(
        "installs_attribution", "player_id", "unique",
        """SELECT count(*) FROM (SELECT player_id FROM installs_attribution
           WHERE player_id IS NOT NULL GROUP BY player_id HAVING count(*) > 1)""",
    )]
    of_models = (
        nulls("g", "fct_games", "player_id", "room_id")
        + nulls("r", "fct_rooms", "room_id", "tournament_id")
        + nulls("d", "daily_player", "player_id", "date_utc")
        + nulls("a", "marketing_roas", "media_source", "install_country")
    )
    paid_roas = [(
        "marketing_roas", "roas", "custom_not_null_roas",
        "SELECT count(*) FROM a WHERE media_source <> 'Organic' AND roas IS NULL",
    )]
    models = (games("g"), rooms("r"), SPEND, daily("d"), roas("a", "d"))
    s["dq_sources_not_null"] = statement(checks(of_sources))
    s["dq_installs_unique"] = statement(checks(unique_installs))
    s["dq_models_not_null"] = statement(checks(of_models), *models)
    s["dq_all"] = statement(checks(of_sources + unique_installs + of_models + paid_roas), *models)
    s["dq_roas_not_null"] = statement(
        "SELECT * FROM a WHERE media_source <> 'Organic' AND roas IS NULL", SPEND, daily("d"), roas("a", "d")
    )
    return s
