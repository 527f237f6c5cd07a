"""One row per player's match: join, submission, room close and reward claim."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from matchledger.functions import as_truth, or_else
from matchledger.operators.joins import (
    any_null,
    laned_left_joins,
    left_joins,
    repeated_keys,
    rows_of,
)
from matchledger.operators.watermark import incremental_filter
from matchledger.operators.windows import first_row
from matchledger.schemas import GAMES, MATCH_KEYS
from matchledger.session import Workspace
from matchledger.sources.views import (
    finished_events,
    joined_events,
    reward_claimed_events,
    room_closed_events,
)


def joins(events: DataFrame, since: Column | None = None) -> DataFrame:
    new = incremental_filter(joined_events(events), "timestamp_utc", since, day_column="date_utc")
    return new.select(
        *MATCH_KEYS, "date_utc", "balance_before", "entry_fee", "players_capacity",
        F.col("timestamp_utc").alias("joined_time"),
    )


def submissions(events: DataFrame) -> DataFrame:
    return finished_events(events).select(
        *MATCH_KEYS, "play_duration",
        F.col("players_active_in_toom").alias("actual_players_in_room"),
        F.col("score").alias("submitted_score"),
        F.col("timestamp_utc").alias("submit_time"),
    )


def closings(events: DataFrame) -> DataFrame:
    """Room close with the reward, or the coins claimed where there is none."""
    reward = or_else("reward", "coins_claimed")
    return room_closed_events(events).select(
        *MATCH_KEYS,
        reward.alias("reward"),
        (F.col("balance_before") + reward).alias("balance_after_claim"),
        "position",
        F.col("score").alias("closing_score"),
        F.col("timestamp_utc").alias("room_close_time"),
    )


def claims(events: DataFrame) -> DataFrame:
    return reward_claimed_events(events).select(
        *MATCH_KEYS, F.col("timestamp_utc").alias("claim_time")
    )


def lifecycle(joined: DataFrame, submitted: DataFrame, closed: DataFrame, claimed: DataFrame) -> DataFrame:
    """Each join with everything that followed; repeated events multiply it."""
    return left_joins(joined, [submitted, closed, claimed], MATCH_KEYS)


def as_games(matches: DataFrame) -> DataFrame:
    return (
        matches.withColumn("score", or_else("closing_score", "submitted_score"))
        .withColumn("did_claim_reward", as_truth(F.col("claim_time").isNotNull()))
        .select(*GAMES.columns)
    )


def fct_games(events: DataFrame, since: Column | None = None) -> DataFrame:
    """The fact as written: only the join side knows the high-water mark."""
    return as_games(
        lifecycle(joins(events, since), submissions(events), closings(events), claims(events))
    )


#: A match with more later events of one type than this is cut into lanes.
LANE_ROWS = 1_000_000


def split_lifecycle(
    joined: DataFrame, later: list[DataFrame], workspace: Workspace, staged: list[str], limit: int = LANE_ROWS
) -> DataFrame:
    """`lifecycle` for inputs in which single matches may repeat a later event very often.

    Counts the later events per match first, and stages the few matches with
    more than `limit` of one type, under a name added to `staged`; the caller
    releases it when the result has been written. Without any, the joins are
    the plain ones. Very many *joins* of a match need no such care: the
    adaptive join splits them.
    """
    name, repeated = workspace.stage(repeated_keys(later, MATCH_KEYS, limit), "repeated")
    if repeated.isEmpty():
        workspace.release(name)
        return left_joins(joined, later, MATCH_KEYS)
    staged.append(name)
    return laned_left_joins(joined, later, MATCH_KEYS, repeated)


def fct_games_split(
    events: DataFrame, workspace: Workspace, limit: int = LANE_ROWS, staged: list[str] | None = None
) -> DataFrame:
    """`fct_games` with a look at the counts first; see `split_lifecycle`, also for `staged`."""
    later = [submissions(events), closings(events), claims(events)]
    return as_games(split_lifecycle(joins(events), later, workspace, [] if staged is None else staged, limit))


def _earliest(df: DataFrame, time: str, *tie_breakers: str) -> DataFrame:
    order = [F.asc_nulls_last(time), *[F.asc_nulls_last(c) for c in tie_breakers]]
    return first_row(df, MATCH_KEYS, *order)


def fct_games_dedup(events: DataFrame) -> DataFrame:
    """One row per match: the earliest event of each type.

    Joins without a complete key are not a match that could repeat; they stay.
    """
    joined = joins(events)
    whole = joined.filter(~any_null(MATCH_KEYS))
    partial = joined.filter(any_null(MATCH_KEYS))
    # Whole keys only, so the joins go by them as the windows do, and nothing is shuffled again.
    submitted, closed, claimed = (
        side(events).dropna(subset=MATCH_KEYS) for side in (submissions, closings, claims)
    )
    matches = (
        _earliest(whole, "joined_time", "balance_before", "entry_fee", "players_capacity")
        .join(
            _earliest(submitted, "submit_time", "play_duration", "submitted_score", "actual_players_in_room"),
            MATCH_KEYS, "left",
        )
        .join(
            _earliest(closed, "room_close_time", "position", "reward", "balance_after_claim", "closing_score"),
            MATCH_KEYS, "left",
        )
        .join(claimed.groupBy(*MATCH_KEYS).agg(F.min("claim_time").alias("claim_time")), MATCH_KEYS, "left")
    )
    return as_games(matches.unionByName(partial, allowMissingColumns=True))


def games_of(
    events: DataFrame, touched: DataFrame, workspace: Workspace, staged: list[str], limit: int = LANE_ROWS
) -> DataFrame:
    """The fact for the match keys in `touched` only, incomplete keys included.

    Every input is cut to those matches by a semi join first. `touched` should
    be a staged table: its known size lets the planner broadcast it when it is
    small, and the history is then filtered where it lies, not shuffled.
    """
    sides = [
        side(events).join(touched, MATCH_KEYS, "left_semi") for side in (submissions, closings, claims)
    ]
    return as_games(split_lifecycle(rows_of(joins(events), touched, MATCH_KEYS), sides, workspace, staged, limit))
