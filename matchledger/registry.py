"""Every operator as a named query over the test tables.

Money is a double, and the order of a distributed sum is not fixed, so sums of
money are shown to the cent; the plans themselves do not round them.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchledger.functions import cohort_label, minutes_between, or_else, or_zero, round3
from matchledger.operators import quality as dq
from matchledger.operators import spine, streaks
from matchledger.operators.upsert import upsert_frame
from matchledger.operators.watermark import high_water_mark
from matchledger.plans import daily, games, roas, rooms
from matchledger.plans.refresh import FACTS, Inputs, refresh
from matchledger.schemas import DAILY, DAY_KEYS, GAMES, MATCH_KEYS, ROAS, ROOM_KEYS, ROOMS
from matchledger.session import Workspace, tune
from matchledger.sources import demo, views
from matchledger.sources.tables import create_fact, read_fact
from matchledger.streaming.hourly import keep_current

Query = Callable[[SparkSession, str], DataFrame]


def cents(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 2) for c in columns or ("revenue",)})


def over_events(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(demo.game_events(tune(spark), sf_dir))


class DemoInputs:
    """The inputs of one query, each built when it is first asked for."""

    arrived = key_days = None

    def __init__(self, spark: SparkSession, sf_dir: str, first_run: bool = False):
        self._spark, self._sf_dir, self._first_run = spark, sf_dir, first_run

    @cached_property
    def events(self) -> DataFrame:
        events = demo.game_events(self._spark, self._sf_dir)
        return demo.first_run(events) if self._first_run else events

    @cached_property
    def installs(self) -> DataFrame:
        return demo.installs(self._spark, self._sf_dir)

    @cached_property
    def spend(self) -> DataFrame:
        return demo.spend(self._spark, self._sf_dir)

    @cached_property
    def daily(self) -> DataFrame:
        return daily.daily_player(self.events)

    @property
    def latest(self) -> Column:
        """Last day of the daily fact: its calendar ends where the log does."""
        return spine.last_date(self.events)


def over_inputs(build: Callable[[DemoInputs], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(DemoInputs(tune(spark), sf_dir))


def _roas(inputs: DemoInputs) -> DataFrame:
    return roas.marketing_roas(inputs.daily, inputs.installs, inputs.spend, inputs.latest)


def _ages(inputs: DemoInputs) -> DataFrame:
    return roas.days_since_install(inputs.daily, inputs.installs, inputs.latest)


# games ---------------------------------------------------------------------

def _lifecycle(events: DataFrame) -> DataFrame:
    return games.lifecycle(
        games.joins(events), games.submissions(events), games.closings(events), games.claims(events)
    ).select(*MATCH_KEYS, "joined_time", "submit_time", "room_close_time", "claim_time")


def _split_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return games.fct_games_split(demo.game_events(tune(spark), sf_dir), Workspace(spark))


def _null_handling(events: DataFrame) -> DataFrame:
    return events.select(
        "event_name", "player_id", "timestamp_utc",
        or_zero("score").alias("score_or_zero"),
        or_zero("play_duration").alias("duration_or_zero"),
        or_else("reward", "coins_claimed").alias("reward_or_coins"),
    )


def _did_claim(events: DataFrame) -> DataFrame:
    return games.fct_games(events).select(*MATCH_KEYS, "joined_time", "claim_time", "did_claim_reward")


def _closing_balance(events: DataFrame) -> DataFrame:
    return games.closings(events).select(*MATCH_KEYS, "room_close_time", "reward", "balance_after_claim")


# rooms ---------------------------------------------------------------------

def _room_span(events: DataFrame) -> DataFrame:
    return rooms.room_open(events).join(rooms.room_close(events), ROOM_KEYS).select(
        *ROOM_KEYS, "room_open_time", "room_close_time",
        minutes_between("room_open_time", "room_close_time").alias("room_open_duration"),
    )


# daily ---------------------------------------------------------------------

def _rounded_summary(summary: DataFrame) -> DataFrame:
    return summary.withColumns({c: round3(c) for c in ("avg_score", "avg_position")})


FLAG_COLUMNS = [*DAY_KEYS, "room_id", "tournament_id", "timestamp_utc"]


def _event_order(events: DataFrame) -> DataFrame:
    return streaks.ordered_flags(daily.win_loss_flags(events)).select(*FLAG_COLUMNS, "event_order")


def _previous_flags(events: DataFrame) -> DataFrame:
    return streaks.ordered_flags(daily.win_loss_flags(events)).select(
        *FLAG_COLUMNS, "is_win", "is_loss", "previous_is_win", "previous_is_loss"
    )


def _streak_groups(events: DataFrame) -> DataFrame:
    return streaks.streak_groups(daily.win_loss_flags(events)).select(
        *FLAG_COLUMNS, "is_win", "is_loss", "win_streak_group", "loss_streak_group"
    )


# roas ----------------------------------------------------------------------

def _latest_days(inputs: DemoInputs) -> DataFrame:
    return roas.latest_days(inputs.daily, inputs.latest).select(*DAY_KEYS, "revenue")


def _bucketed(inputs: DemoInputs) -> DataFrame:
    return _ages(inputs).select(
        "player_id", "install_date", "media_source", "install_country", "days_since_install",
        cohort_label("days_since_install").alias("cohort_period"),
    )


def _cohorts(inputs: DemoInputs) -> DataFrame:
    return roas.cohort_revenue(inputs.daily, inputs.installs, inputs.spend, inputs.latest)


def _ratios(inputs: DemoInputs) -> DataFrame:
    cohorts = _cohorts(inputs)
    ratio = roas.ratio_or_null("cohort_revenue", "total_spend")
    return cents(cohorts.withColumn("roas", round3(ratio)), "cohort_revenue", "total_spend")


# merges --------------------------------------------------------------------

def _merged_from(events: DataFrame) -> Column:
    """The merge queries bring everything from this day on as their new rows."""
    return demo.day_at(events, demo.MERGED_FROM)


def _merge_games(events: DataFrame) -> DataFrame:
    new = games.fct_games_dedup(events).filter(F.col("joined_time") >= _merged_from(events).cast("timestamp_ntz"))
    return upsert_frame(games.fct_games_dedup(demo.first_run(events)), new, GAMES.keys)


def _merge_rooms(events: DataFrame) -> DataFrame:
    new = rooms.fct_rooms_dedup(events).filter(F.col("room_open_time") >= _merged_from(events).cast("timestamp_ntz"))
    return upsert_frame(rooms.fct_rooms_dedup(demo.first_run(events)), new, ROOMS.keys)


def _merge_daily(events: DataFrame) -> DataFrame:
    new = daily.daily_player(events).filter(F.col("date_utc") >= _merged_from(events))
    return cents(upsert_frame(daily.daily_player(demo.first_run(events)), new, DAILY.keys))


def _merge_roas(spark: SparkSession, sf_dir: str) -> DataFrame:
    tune(spark)
    old, new = _roas(DemoInputs(spark, sf_dir, first_run=True)), _roas(DemoInputs(spark, sf_dir))
    return upsert_frame(old, new, ROAS.keys)


def _stored_first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = Workspace(spark).table(GAMES.name)
    create_fact(games.fct_games(demo.first_run(demo.game_events(tune(spark), sf_dir))), table, GAMES)
    return read_fact(spark, table, GAMES)


def _new_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = high_water_mark(_stored_first_run(spark, sf_dir), "joined_time")
    return games.joins(demo.game_events(spark, sf_dir), since=mark)


def _mark(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = high_water_mark(_stored_first_run(spark, sf_dir), "joined_time")
    return spark.range(1).select(mark.alias("max_joined_time"))


def _late(name: str, snapshots: bool = False) -> Query:
    """Build a stored fact without the events that come in late, then refresh it with those.

    Matches and rooms keep an index of their days, so only those are read again.
    """

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        workspace = Workspace(spark)
        table = workspace.table(name)
        key_days = workspace.table("key_days")
        on_time = Inputs(events=demo.on_time(spark, sf_dir), key_days=key_days)
        refresh(spark, name, table, on_time, workspace, snapshots=snapshots)
        inputs = Inputs(
            events=demo.game_events(spark, sf_dir), arrived=demo.arrived_late(spark, sf_dir), key_days=key_days
        )
        out = refresh(spark, name, table, inputs, workspace, "reprocess", "keep_all" if name != DAILY.name else "error")
        return cents(out) if name == DAILY.name else out

    return query


def _two_runs(name: str, late: str = "as_written", on_duplicate: str = "error") -> Query:
    """Build a stored fact from the first part of the log, refresh it with all of it."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        workspace = Workspace(spark)
        table = workspace.table(name)
        refresh(spark, name, table, DemoInputs(spark, sf_dir, first_run=True), workspace)
        out = refresh(spark, name, table, DemoInputs(spark, sf_dir), workspace, late, on_duplicate)
        return cents(out) if name == DAILY.name else out

    return query


def _stored(name: str, build: Callable[[DataFrame], DataFrame]) -> Query:
    """Write a fact as a partitioned table and read it back."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = demo.game_events(tune(spark), sf_dir)
        table = Workspace(spark).table(name)
        create_fact(build(events), table, FACTS[name])
        return read_fact(spark, table, FACTS[name])

    return query


def _streamed(name: str) -> Query:
    """Keep a fact current from a stream of the raw events, until all are in."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        workspace = Workspace(spark)
        # A pattern, since a stream takes a plain path for a folder, and this may be a file.
        raw = spark.readStream.schema(demo.RAW_EVENTS).parquet(f"{sf_dir}/event[s].parquet")
        location = spark.sql(f"DESCRIBE DATABASE {workspace.database}").filter(
            "info_name = 'Location'"
        ).first()["info_value"]
        table = workspace.table(name)
        keep_current(
            spark, demo.game_log(raw), lambda: demo.game_events(spark, sf_dir), name, table, workspace,
            f"{location}/checkpoint_{name}",
        ).awaitTermination()
        return read_fact(spark, table, FACTS[name])

    return query


# checks --------------------------------------------------------------------

def _source_checks(inputs: DemoInputs) -> DataFrame:
    nulls = [
        (inputs.events, "events", dq.EVENT_CHECKS),
        (inputs.installs, "installs_attribution", dq.INSTALL_CHECKS),
        (inputs.spend, "marketing_spend", dq.SPEND_CHECKS),
    ]
    out = None
    for df, table, checks in nulls:
        part = dq.run_checks(df, table, [c for c in checks if isinstance(c, dq.NotNull)])
        out = part if out is None else out.unionByName(part)
    return out


def _unique_check(inputs: DemoInputs) -> DataFrame:
    checks = [c for c in dq.INSTALL_CHECKS if isinstance(c, dq.Unique)]
    return dq.run_checks(inputs.installs, "installs_attribution", checks)


def _all_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All checks over stored tables, as a scheduler runs them after a refresh."""
    inputs = DemoInputs(tune(spark), sf_dir)
    workspace = Workspace(spark)
    tables = {name: workspace.table(name) for name in dq.ALL_CHECKS}
    for name, df in (("events", inputs.events), ("installs_attribution", inputs.installs), ("marketing_spend", inputs.spend)):
        df.write.saveAsTable(tables[name])
    for name, build in (
        (GAMES.name, lambda: games.fct_games(spark.table(tables["events"]))),
        (ROOMS.name, lambda: rooms.fct_rooms(spark.table(tables["events"]))),
        (DAILY.name, lambda: daily.daily_player(spark.table(tables["events"]))),
    ):
        create_fact(build(), tables[name], FACTS[name])
    stored_daily = read_fact(spark, tables[DAILY.name], DAILY)
    latest = high_water_mark(stored_daily, "date_utc")
    create_fact(roas.marketing_roas(stored_daily, inputs.installs, inputs.spend, latest), tables[ROAS.name], ROAS)
    return dq.check_tables(spark, tables)


def _model_checks(inputs: DemoInputs) -> DataFrame:
    return (
        dq.run_checks(games.fct_games(inputs.events), "fct_games", dq.GAME_CHECKS)
        .unionByName(dq.run_checks(rooms.fct_rooms(inputs.events), "fct_rooms", dq.ROOM_CHECKS))
        .unionByName(dq.run_checks(inputs.daily, "daily_player", dq.DAILY_CHECKS))
        .unionByName(dq.run_checks(_roas(inputs), "marketing_roas", dq.ROAS_CHECKS))
    )


def all_queries() -> dict[str, Query]:
    return {
        # sources and typed views
        "src_events": over_events(lambda e: e),
        "src_installs_attribution": demo.installs,
        "src_marketing_spend": demo.spend,
        "event_purchase": over_events(views.purchase_events),
        "event_tournament_finished": over_events(views.finished_events),
        "event_tournament_joined": over_events(views.joined_events),
        "event_tournament_reward_claimed": over_events(views.reward_claimed_events),
        "event_tournament_room_closed": over_events(views.room_closed_events),
        "filter_in_list": over_events(daily.scored_events),
        # games
        "project_joined": over_events(games.joins),
        "join_game_lifecycle": over_events(_lifecycle),
        "balance_after_claim": over_events(_closing_balance),
        "scalar_null_handling": over_events(_null_handling),
        "did_claim_flag": over_events(_did_claim),
        "fct_games": over_events(games.fct_games),
        "fct_games_split": _split_games,
        "fct_games_dedup": over_events(games.fct_games_dedup),
        "partitioned_roundtrip": _stored("fct_games", games.fct_games),
        # rooms
        "room_open": over_events(rooms.room_open),
        "room_close": over_events(rooms.room_close),
        "room_match_duration": over_events(rooms.room_match_duration),
        "room_open_duration": over_events(_room_span),
        "join_room_lifecycle": over_events(
            lambda e: rooms.fct_rooms(e).select(
                *ROOM_KEYS, "players_capacity", "entry_fee", "room_open_time", "room_close_time", "actual_players"
            )
        ),
        "room_flags": over_events(
            lambda e: rooms.fct_rooms(e).select(
                *ROOM_KEYS, "players_capacity", "actual_players", "room_open_duration", "is_closed", "is_full"
            )
        ),
        "fct_rooms": over_events(rooms.fct_rooms),
        "fct_rooms_dedup": over_events(rooms.fct_rooms_dedup),
        "partitioned_roundtrip_ts": _stored("fct_rooms", rooms.fct_rooms),
        # daily
        "player_first_appearance": over_events(spine.first_appearance),
        "date_bounds": over_events(spine.date_bounds),
        "date_spine": over_events(spine.date_spine),
        "balance_start": over_events(daily.balance_start),
        "balance_end": over_events(daily.balance_end),
        "balance_start_dedup": over_events(daily.balance_start_dedup),
        "first_event_per_day": over_events(daily.first_event_per_day),
        "matches_played": over_events(daily.matches_played),
        "match_duration_daily": over_events(daily.match_duration_daily),
        "match_summary": over_events(lambda e: _rounded_summary(daily.match_summary(e))),
        "match_summary_closed_only": over_events(lambda e: _rounded_summary(daily.match_summary_closed_only(e))),
        "match_reward": over_events(daily.match_reward),
        "matches_won_true": over_events(daily.matches_won_true),
        "coins_summary": over_events(daily.coins_summary),
        "purchases_daily": over_events(lambda e: cents(daily.purchases_daily(e))),
        "win_loss_flags": over_events(daily.win_loss_flags),
        "event_order": over_events(_event_order),
        "previous_flags": over_events(_previous_flags),
        "streak_groups": over_events(_streak_groups),
        "streak_lengths": over_events(daily.streak_lengths),
        "final_streaks": over_events(daily.final_streaks),
        "true_streaks": over_events(lambda e: streaks.true_streaks(daily.win_loss_flags(e))),
        "daily_metrics_joined": over_events(lambda e: cents(daily.daily_metrics_joined(e))),
        "forward_fill": over_events(lambda e: cents(daily.forward_filled(e))),
        "daily_player": over_events(lambda e: cents(daily.daily_player(e))),
        "daily_player_single_pass": over_events(lambda e: cents(daily.daily_player(e, ties="first"))),
        "daily_player_zero_filled": over_events(lambda e: cents(daily.daily_player_zero_filled(e))),
        # roas
        "scalar_max_date": over_inputs(lambda i: i.daily.agg(F.max("date_utc").alias("max_date"))),
        "filter_latest_date": over_inputs(lambda i: cents(_latest_days(i))),
        "latest_revenue": over_inputs(
            lambda i: cents(roas.latest_revenue(i.daily, i.installs, i.latest))
        ),
        "cumulative_revenue": over_inputs(
            lambda i: cents(roas.cumulative_revenue(i.daily, i.installs, i.latest), "cumulative_revenue")
        ),
        "days_since_install": over_inputs(lambda i: cents(_ages(i), "cumulative_revenue")),
        "filter_cohort_90": over_inputs(lambda i: cents(roas.within_90_days(_ages(i)), "cumulative_revenue")),
        "cohort_bucket": over_inputs(_bucketed),
        "spend_totals": over_inputs(lambda i: cents(roas.spend_totals(i.spend), "total_spend")),
        "cohort_spend_join": over_inputs(
            lambda i: cents(roas.with_spend(_ages(i), i.spend), "cumulative_revenue", "total_spend")
        ),
        "cohort_revenue": over_inputs(lambda i: cents(_cohorts(i), "cohort_revenue", "total_spend")),
        "safe_ratio": over_inputs(_ratios),
        "marketing_roas": over_inputs(_roas),
        "roas_cumulative": over_inputs(
            lambda i: roas.roas_cumulative(daily.purchases_daily(i.events), i.installs, i.spend)
        ),
        # merges and refreshes
        "incremental_watermark": _mark,
        "incremental_filter": _new_joins,
        "merge_upsert_games": over_events(_merge_games),
        "merge_upsert_rooms": over_events(_merge_rooms),
        "merge_upsert_daily_player": over_events(_merge_daily),
        "merge_upsert_roas": _merge_roas,
        "fct_games_incremental": _two_runs("fct_games", on_duplicate="keep_all"),
        "fct_rooms_incremental": _two_runs("fct_rooms", on_duplicate="keep_all"),
        "daily_player_incremental": _two_runs("daily_player"),
        "marketing_roas_incremental": _two_runs("marketing_roas"),
        "fct_games_incremental_fixed": _two_runs("fct_games", "reprocess", "keep_all"),
        "fct_rooms_incremental_fixed": _two_runs("fct_rooms", "reprocess", "keep_all"),
        "daily_player_incremental_fixed": _two_runs("daily_player", "reprocess"),
        "fct_games_late_fixed": _late("fct_games"),
        "fct_rooms_late_fixed": _late("fct_rooms"),
        "daily_player_late_fixed": _late("daily_player"),
        "fct_games_late_published": _late("fct_games", snapshots=True),
        "daily_player_late_published": _late("daily_player", snapshots=True),
        "fct_games_streamed": _streamed("fct_games"),
        "fct_rooms_streamed": _streamed("fct_rooms"),
        # checks
        "dq_sources_not_null": over_inputs(_source_checks),
        "dq_installs_unique": over_inputs(_unique_check),
        "dq_models_not_null": over_inputs(_model_checks),
        "dq_all": _all_checks,
        "dq_roas_not_null": over_inputs(lambda i: dq.failing_rows(_roas(i), dq.PAID_ROAS_CHECK)),
    }
