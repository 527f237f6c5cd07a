"""First builds and incremental refreshes of the stored facts.

`late="as_written"` keeps the high-water marks as the models write them.
`late="reprocess"` rebuilds what new events touch, so that the table equals a
full rebuild. What is new is best said by the caller, who knows what was loaded:
`Inputs.arrived` holds the events that came in since the last refresh, whatever
their time. Without it, events later than anything stored count as new, and
with `redo_from` those of that day and later ones; an event that came in late
for an earlier time is then not seen.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchledger.operators.joins import any_null
from matchledger.operators.keydays import days_of, distinct_days, on_days, record_days
from matchledger.operators.observed import ObservedChecks
from matchledger.operators.quality import ALL_CHECKS
from matchledger.operators.upsert import merge_into, only_writer
from matchledger.operators.watermark import (
    high_water_mark,
    incremental_filter,
    partition_days,
    stored_high_water_mark,
    typed_literal,
)
from matchledger.plans import daily, games, roas, rooms
from matchledger.schemas import DAILY, GAMES, MATCH_KEYS, PURCHASE, ROAS, ROOM_KEYS, ROOMS
from matchledger.session import Workspace
from matchledger.sources.snapshots import create_published
from matchledger.sources.tables import create_fact, qualified, read_fact


@dataclass(frozen=True)
class Inputs:
    """What the facts are built from; `latest` is the last day of `daily` where it is known.

    `arrived`: the events that came in since the last refresh, also part of `events`.
    `key_days`: a table of its own for one stored fact, in which refreshes of matches, rooms
    or player-days record the days of each match, room or player; with it they read those
    days only. It needs `arrived`, and must be there from the first build on.
    """

    events: DataFrame | None = None
    arrived: DataFrame | None = None
    key_days: str | None = None
    installs: DataFrame | None = None
    spend: DataFrame | None = None
    daily: DataFrame | None = None
    latest: Column | None = None


FACTS = {fact.name: fact for fact in (GAMES, ROOMS, DAILY, ROAS)}
#: Facts whose refresh may keep an index of days, and its keys.
INDEXED = {GAMES.name: MATCH_KEYS, ROOMS.name: ROOM_KEYS, DAILY.name: daily.PLAYER}


def refresh(
    spark: SparkSession,
    name: str,
    table: str,
    inputs: Inputs,
    workspace: Workspace,
    late: str = "as_written",
    on_duplicate: str = "error",
    redo_from: dt.date | None = None,
    snapshots: bool = False,
    checks: ObservedChecks | None = None,
) -> DataFrame:
    """Build `table` if it is not there, else merge what is new; returns the stored fact.

    With `snapshots` the first build makes a published fact, whose readers see each
    later refresh as a whole (see `sources.snapshots`); refreshes find out by themselves.
    `checks` counts the failures of the fact's NULL checks among the rows that are written.
    One refresh of a table at a time; a second one gets a `ConcurrentMerge` error.
    """
    if late not in ("as_written", "reprocess"):
        raise ValueError("late must be 'as_written' or 'reprocess'")
    if late == "as_written" and (redo_from is not None or inputs.arrived is not None):
        raise ValueError("redo_from and arrived events are for late='reprocess'")
    fact = FACTS[name]
    staged: list[str] = []
    try:
        if not spark.catalog.tableExists(table):
            rows = _full(name, inputs, workspace, staged)
            if checks:
                rows = checks.watch(rows, name, ALL_CHECKS[name])
            if snapshots:
                create_published(spark, rows, table, fact)
            else:
                create_fact(rows, table, fact)
            if inputs.key_days and name in INDEXED:
                record_days(spark, inputs.key_days, inputs.events, INDEXED[name])
            return read_fact(spark, table, fact)
        table = qualified(spark, table)
        # What is read of the stored fact has to be what the merge meets.
        with only_writer(spark, table):
            _refreshed(spark, name, table, inputs, workspace, staged, late, on_duplicate, redo_from, checks)
    finally:
        workspace.release(*staged)
    return read_fact(spark, table, fact)


def _refreshed(
    spark: SparkSession, name: str, table: str, inputs: Inputs, workspace: Workspace, staged: list[str],
    late: str, on_duplicate: str, redo_from: dt.date | None, checks: ObservedChecks | None,
) -> None:
    fact, within = FACTS[name], None
    watch = checks and (lambda content: checks.watch(content, name, ALL_CHECKS[name]))
    stored = read_fact(spark, table, fact)
    if late == "as_written":
        source = _as_written(name, inputs, spark, table, workspace, staged)
    elif name == DAILY.name and inputs.arrived is not None and redo_from is None and not stored.isEmpty():
        source = _repaired_days(spark, table, inputs, stored, workspace, staged)
    elif inputs.key_days and name in INDEXED and name != DAILY.name:
        source, within = _reprocessed_by_day(spark, name, inputs, workspace, staged, redo_from)
    else:
        source = _reprocessed(name, inputs, stored, workspace, staged, redo_from)
    # What is rebuilt takes the place of what was there, under incomplete keys too.
    merge_into(
        spark, table, source, fact, workspace, on_duplicate, null_safe=late == "reprocess", within=within, watch=watch
    )


def _full(name: str, inputs: Inputs, workspace: Workspace, staged: list[str]) -> DataFrame:
    if name == GAMES.name:
        return games.fct_games_split(inputs.events, workspace, staged=staged)
    if name == ROOMS.name:
        return rooms.fct_rooms(inputs.events)
    if name == DAILY.name:
        return daily.daily_player(inputs.events)
    return roas.marketing_roas(inputs.daily, inputs.installs, inputs.spend, inputs.latest)


def _as_written(
    name: str, inputs: Inputs, spark: SparkSession, table: str, workspace: Workspace, staged: list[str]
) -> DataFrame:
    events = inputs.events

    def high_mark(field: str) -> Column:
        return stored_high_water_mark(spark, table, field, FACTS[name].partition_column)

    if name == GAMES.name:
        since = high_mark("joined_time")
        new = _stage(workspace, staged, games.joins(events, since), "new_joins")
        sides = [
            side(events).join(new.select(*MATCH_KEYS), MATCH_KEYS, "left_semi")
            for side in (games.submissions, games.closings, games.claims)
        ]
        return games.as_games(games.split_lifecycle(new, sides, workspace, staged))
    if name == ROOMS.name:
        since = high_mark("room_open_time")
        new = incremental_filter(
            rooms.joined_events(events), "timestamp_utc", since, day_column="date_utc"
        ).select(*ROOM_KEYS).distinct()
        touched = _stage(workspace, staged, new.dropna(), "new_rooms")
        of_rooms = events.join(touched, ROOM_KEYS, "left_semi")
        # A join without a room has no opening to compute, so only new ones count.
        keyless = incremental_filter(
            rooms.joined_events(events).filter(any_null(ROOM_KEYS)), "timestamp_utc", since, day_column="date_utc"
        )
        return rooms.fct_rooms(of_rooms.unionByName(keyless), since)
    if name == DAILY.name:
        return daily.daily_player(events, opening_since=high_mark("date_utc"))
    return _full(name, inputs, workspace, staged)


def _reprocessed(
    name: str,
    inputs: Inputs,
    stored: DataFrame,
    workspace: Workspace,
    staged: list[str],
    redo_from: dt.date | None,
) -> DataFrame:
    events = inputs.events
    if stored.isEmpty():
        return _full(name, inputs, workspace, staged)
    if name == GAMES.name:
        times = ("joined_time", "submit_time", "room_close_time", "claim_time")
        touched = _touched(inputs, MATCH_KEYS, stored, times, redo_from)
        return games.games_of(events, _stage(workspace, staged, touched, "touched"), workspace, staged)
    if name == ROOMS.name:
        touched = _touched(inputs, ROOM_KEYS, stored, ("room_open_time", "room_close_time"), redo_from)
        return rooms.rooms_of(events, _stage(workspace, staged, touched, "touched"))
    if name == DAILY.name:
        days = [high_water_mark(stored, "date_utc")]
        if redo_from is not None:
            days.append(F.lit(redo_from))
        if inputs.arrived is not None:  # with redo_from: all players from the earlier day on
            days.append(typed_literal(inputs.arrived, F.min("date_utc"), inputs.arrived.schema["date_utc"].dataType))
        return daily.daily_player_from(events, stored, F.least(*days) if len(days) > 1 else days[0])
    return _full(name, inputs, workspace, staged)


def _repaired_days(
    spark: SparkSession, table: str, inputs: Inputs, stored: DataFrame, workspace: Workspace, staged: list[str]
) -> DataFrame:
    """The player-days that the arrived events change, and the days that the calendar gained.

    Each touched player is redone from its own first touched day on. With an index of days
    the log is read on these players' days only; without one, from the first of all touched days on.
    """
    old_last = partition_days(spark, table, DAILY.partition_column)[0]
    # No later than the first day that is not stored yet, so that the day before it is.
    touched = daily.touched_players(inputs.arrived).withColumn("_from", F.least("_from", F.date_add(F.lit(old_last), 1)))
    touched = _stage(workspace, staged, touched, "touched")
    if inputs.key_days:
        if not spark.catalog.tableExists(inputs.key_days):
            raise ValueError("key_days has to be there from the first build on")
        record_days(spark, inputs.key_days, inputs.arrived, daily.PLAYER)
    bounds = touched.agg(F.min("_from").alias("first")).first()
    if bounds["first"] is None:
        return stored.limit(0)
    newest = inputs.arrived.agg(F.max("date_utc")).first()[0]
    last, old_end = F.lit(max(old_last, newest)), F.lit(old_last)
    events = inputs.events.filter(F.col("date_utc") >= F.lit(bounds["first"]))
    if inputs.key_days:
        events = events.filter(on_days("date_utc", days_of(spark, inputs.key_days, touched, daily.PLAYER)))
    seeds = distinct_days(touched.select(F.date_sub("_from", 1).alias("seed")), "seed")
    redone = _stage(workspace, staged, daily.segments_redone(events, stored, touched, seeds, last), "redone")
    known = stored.filter(F.col("date_utc") >= F.lit(bounds["first"])).alias("a")
    of_players = known.join(touched.alias("b"), F.col("a.player_id").eqNullSafe(F.col("b.player_id")), "left_semi")
    changed = daily.changed_days(redone, of_players)
    if newest <= old_last:
        return changed
    return changed.unionByName(daily.calendar_extended(stored, touched, old_end, last))


def _reprocessed_by_day(
    spark: SparkSession, name: str, inputs: Inputs, workspace: Workspace, staged: list[str], redo_from: dt.date | None
) -> tuple[DataFrame, set[dt.date | None]]:
    """The touched matches or rooms, read from the days they have events on, and those days."""
    if inputs.arrived is None or not spark.catalog.tableExists(inputs.key_days):
        raise ValueError("key_days needs the arrived events, and to be there from the first build on")
    keys = INDEXED[name]
    record_days(spark, inputs.key_days, inputs.arrived, keys)
    found = touched_keys(inputs.arrived, keys)
    if redo_from is not None:
        found = found.union(touched_keys(inputs.events.filter(F.col("date_utc") >= F.lit(redo_from)), keys)).distinct()
    touched = _stage(workspace, staged, found, "touched")
    days = days_of(spark, inputs.key_days, touched, keys)
    events = inputs.events.filter(on_days("date_utc", days))
    if name == GAMES.name:
        return games.games_of(events, touched, workspace, staged), days | {None}
    return rooms.rooms_of(events, touched), days | {None}


def _touched(
    inputs: Inputs, keys: list[str], stored: DataFrame, times: tuple[str, ...], redo_from: dt.date | None
) -> DataFrame:
    """Keys that the arrived events mention, or else later ones than any stored, and those from `redo_from` on."""
    if inputs.arrived is not None:
        found = touched_keys(inputs.arrived, keys)
    else:
        found = touched_keys(inputs.events, keys, _latest(stored, *times))
    if redo_from is not None:
        again = inputs.events.filter(F.col("date_utc") >= F.lit(redo_from))
        found = found.union(touched_keys(again, keys)).distinct()
    return found


def _latest(stored: DataFrame, *times: str) -> Column:
    """The newest time stored. Anything newer is new; a little that is not may be redone."""
    return typed_literal(stored, F.greatest(*[F.max(t) for t in times]), stored.schema[times[0]].dataType)


def touched_keys(events: DataFrame, keys: list[str], since: Column | None = None) -> DataFrame:
    """Keys that any tournament event (after `since`) mentions, incomplete ones included."""
    new = incremental_filter(events, "timestamp_utc", since, day_column="date_utc")
    return new.filter(F.col("event_name") != PURCHASE).select(*keys).distinct()


def _stage(workspace: Workspace, staged: list[str], df: DataFrame, label: str) -> DataFrame:
    name, frame = workspace.stage(df, label)
    staged.append(name)
    return frame
