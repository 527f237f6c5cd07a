"""Room facts: opening, closing, coins and match durations.

The fact has one row per join event and per distinct player count of the room.
Joins with equal columns give equal rows, so they travel as one row with a
count, and the copies are made at the very end. No shuffle carries raw events:
a room that holds a third of the log arrives as a few aggregated rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from matchledger.functions import as_truth, minutes_between, or_zero
from matchledger.operators.joins import any_null, rows_of
from matchledger.operators.multiplicity import repeat_rows
from matchledger.schemas import FINISHED, JOINED, ROOM_CLOSED, ROOM_KEYS, ROOMS
from matchledger.sources.views import finished_events, joined_events, room_closed_events


def room_open(events: DataFrame) -> DataFrame:
    return joined_events(events).groupBy(*ROOM_KEYS).agg(
        F.min("timestamp_utc").alias("room_open_time"),
        F.sum(or_zero("entry_fee")).alias("total_coins_sink"),
    )


def room_close(events: DataFrame) -> DataFrame:
    return room_closed_events(events).groupBy(*ROOM_KEYS).agg(
        F.max("timestamp_utc").alias("room_close_time"),
        F.sum(or_zero("reward")).alias("total_coins_rewards"),
    )


def room_match_duration(events: DataFrame) -> DataFrame:
    """Average duration (despite its name) per distinct player count of a room."""
    return finished_events(events).groupBy(*ROOM_KEYS, "players_active_in_toom").agg(
        F.avg(or_zero("play_duration")).alias("total_matches_duration")
    )


def room_entries(events: DataFrame, since: Column | None = None) -> DataFrame:
    """Distinct join details of each room with their count, and the room's opening.

    All joins count toward the opening; `since` limits which are counted as
    entries. A room without a complete key matches no opening, as in a join.
    """
    late = F.lit(True) if since is None else F.col("timestamp_utc") > since
    entries = joined_events(events).groupBy(*ROOM_KEYS, "entry_fee", "players_capacity").agg(
        F.count_if(late).alias("entries"),
        F.min("timestamp_utc").alias("_first"),
        F.sum(or_zero("entry_fee")).alias("_coins"),
    )
    # Partitioned as the joins to come are, so those need no shuffle of this side.
    room = W.partitionBy(*ROOM_KEYS)
    known = ~any_null(ROOM_KEYS)
    return entries.select(
        *ROOM_KEYS, "entry_fee", "players_capacity", "entries",
        F.when(known, F.min("_first").over(room)).alias("room_open_time"),
        F.when(known, F.sum("_coins").over(room)).alias("total_coins_sink"),
    ).filter(F.col("entries") > 0)


def with_flags(rooms: DataFrame) -> DataFrame:
    """Elapsed minutes, and the closed and full flags; NULL comparisons are false."""
    full = F.col("actual_players") == F.col("players_capacity")
    return (
        rooms.withColumn("room_open_duration", minutes_between("room_open_time", "room_close_time"))
        .withColumn("is_closed", as_truth((F.col("room_open_duration") > 45) | full))
        .withColumn("is_full", as_truth(full))
    )


def lifecycle(entries: DataFrame, events: DataFrame) -> DataFrame:
    durations = room_match_duration(events).withColumnRenamed("players_active_in_toom", "actual_players")
    return entries.join(room_close(events), ROOM_KEYS, "left").join(durations, ROOM_KEYS, "left")


def fct_rooms(events: DataFrame, since: Column | None = None) -> DataFrame:
    rooms = lifecycle(room_entries(events, since), events)
    return repeat_rows(with_flags(rooms), "entries", ROOM_KEYS).select(*ROOMS.columns)


def fct_rooms_dedup(events: DataFrame) -> DataFrame:
    """One row per room, every metric a conditional aggregate of one pass.

    Details are the largest seen, and the duration is the average over all
    finished matches of the room. Rooms without a complete key keep only what
    their joins say.
    """
    name = F.col("event_name")
    of_rooms = events.filter(name.isin(JOINED, ROOM_CLOSED, FINISHED))

    def at(event: str, value: Column | str) -> Column:
        return F.when(name == event, F.col(value) if isinstance(value, str) else value)

    rooms = of_rooms.groupBy(*ROOM_KEYS).agg(
        F.count_if(name == JOINED).alias("entries"),
        F.max(at(JOINED, "players_capacity")).alias("players_capacity"),
        F.max(at(JOINED, "entry_fee")).alias("entry_fee"),
        F.min(at(JOINED, "timestamp_utc")).alias("room_open_time"),
        F.sum(at(JOINED, or_zero("entry_fee"))).alias("total_coins_sink"),
        F.max(at(ROOM_CLOSED, "timestamp_utc")).alias("room_close_time"),
        F.sum(at(ROOM_CLOSED, or_zero("reward"))).alias("total_coins_rewards"),
        F.max(at(FINISHED, "players_active_in_toom")).alias("actual_players"),
        F.avg(at(FINISHED, or_zero("play_duration"))).alias("total_matches_duration"),
    ).filter(F.col("entries") > 0)
    from_elsewhere = [
        "room_open_time", "total_coins_sink", "room_close_time", "total_coins_rewards",
        "actual_players", "total_matches_duration",
    ]
    known = ~any_null(ROOM_KEYS)
    rooms = rooms.select(
        *[F.when(known, F.col(c)).alias(c) if c in from_elsewhere else F.col(c) for c in rooms.columns]
    )
    return with_flags(rooms).select(*ROOMS.columns)


def rooms_of(events: DataFrame, touched: DataFrame) -> DataFrame:
    """The fact for the rooms in `touched` only; see `games.games_of`."""
    return fct_rooms(rows_of(events, touched, ROOM_KEYS))
