"""One row per player-day from the first day seen to the last day of the log.

All metrics of a day come out of one conditional aggregation, combined before
the shuffle; only the two balances have rank windows of their own, and those
are limited before the shuffle. What crosses the next shuffle is a player's
active days, a number the calendar bounds.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from matchledger.functions import as_flag, or_zero, round3
from matchledger.operators.keydays import on_days
from matchledger.operators.spine import date_spine, days_through, last_date
from matchledger.operators.streaks import micros
from matchledger.operators.watermark import incremental_filter
from matchledger.operators.windows import extreme_rows, first_row, forward_fill, running_frame
from matchledger.schemas import (
    DAILY,
    DAY_KEYS,
    FINISHED,
    JOINED,
    PURCHASE,
    REWARD_CLAIMED,
    ROOM_CLOSED,
)
from matchledger.sources.views import (
    finished_events,
    joined_events,
    purchase_events,
    reward_claimed_events,
    room_closed_events,
)

# Zero, not NULL, on a day without such events; hence never carried forward.
ZERO_FILLED = ["matches_won_reward", "matches_claimed", "revenue", "coins_source_purchases"]
CARRIED = [c for c in DAILY.columns if c not in (*DAY_KEYS, *ZERO_FILLED)]
BALANCES = ["balance_day_start", "balance_day_end"]
# The rows of a player, those of one day in an order that the input's order can't change.
DAY_ORDER = ["date_utc", *BALANCES]


# Single metrics -----------------------------------------------------------

def balance_start(events: DataFrame, since: Column | None = None) -> DataFrame:
    """Balance of the first join of a day; joins at the same instant all stay."""
    joined = incremental_filter(joined_events(events), "date_utc", since)
    return extreme_rows(
        joined.select(*DAY_KEYS, "timestamp_utc", "balance_before"), DAY_KEYS, F.asc("timestamp_utc")
    ).select("date_utc", "player_id", "balance_before")


def balance_end(events: DataFrame) -> DataFrame:
    """Balance before the last finished match of a day, ties kept."""
    return extreme_rows(
        finished_events(events).select(*DAY_KEYS, "timestamp_utc", "balance_before"),
        DAY_KEYS,
        F.desc("timestamp_utc"),
    ).select("date_utc", "player_id", F.col("balance_before").alias("balance_day_end"))


def balance_start_dedup(events: DataFrame) -> DataFrame:
    """One opening balance per day; the smallest room, then balance, breaks a tie."""
    return first_row(
        joined_events(events),
        DAY_KEYS,
        F.asc("timestamp_utc"), F.asc("room_id"), F.asc("tournament_id"), F.asc("balance_before"),
    ).select("date_utc", "player_id", "balance_before")


def first_event_per_day(events: DataFrame) -> DataFrame:
    """Where each player's first match of a day was."""
    narrow = joined_events(events).select(*DAY_KEYS, "timestamp_utc", "room_id", "tournament_id")
    return extreme_rows(narrow, DAY_KEYS, F.asc("timestamp_utc"))


def matches_played(events: DataFrame) -> DataFrame:
    return joined_events(events).groupBy(*DAY_KEYS).agg(F.count("*").alias("matches_played"))


def match_duration_daily(events: DataFrame) -> DataFrame:
    return finished_events(events).groupBy(*DAY_KEYS).agg(
        F.sum(or_zero("play_duration")).alias("total_matches_duration")
    )


def _summary(scored: DataFrame) -> DataFrame:
    return scored.groupBy(*DAY_KEYS).agg(
        F.max(or_zero("score")).alias("max_score"),
        F.avg(or_zero("score")).alias("avg_score"),
        F.max("position").alias("max_position"),
        F.avg("position").alias("avg_position"),
    )


def scored_events(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_name").isin(ROOM_CLOSED, REWARD_CLAIMED))


def match_summary(events: DataFrame) -> DataFrame:
    """Scores and positions over close and claim events together, so a claimed match counts twice."""
    return _summary(scored_events(events))


def match_summary_closed_only(events: DataFrame) -> DataFrame:
    return _summary(room_closed_events(events))


def match_reward(events: DataFrame) -> DataFrame:
    """Both columns count every claim: the case expression under the count is never NULL."""
    return reward_claimed_events(events).groupBy(*DAY_KEYS).agg(
        F.count("*").alias("matches_won_reward"),
        F.count("*").alias("matches_claimed"),
    )


def matches_won_true(events: DataFrame) -> DataFrame:
    """Claims that carry a reward or coins, against all claims."""
    paid = F.col("reward").isNotNull() | F.col("coins_claimed").isNotNull()
    return reward_claimed_events(events).groupBy(*DAY_KEYS).agg(
        F.count_if(paid).alias("matches_won_reward"),
        F.count("*").alias("matches_claimed"),
    )


def coins_summary(events: DataFrame) -> DataFrame:
    name = F.col("event_name")
    return events.groupBy(*DAY_KEYS).agg(
        F.sum(F.when(name == JOINED, F.col("entry_fee")).otherwise(0)).alias("coins_sink_tournaments"),
        F.sum(F.when(name == REWARD_CLAIMED, F.col("reward")).otherwise(0)).alias("coins_source_tournaments"),
    )


def purchases_daily(events: DataFrame) -> DataFrame:
    return purchase_events(events).groupBy(*DAY_KEYS).agg(
        F.sum("price_usd").alias("revenue"),
        F.sum("coins_claimed").alias("coins_source_purchases"),
    )


def win_loss_flags(events: DataFrame) -> DataFrame:
    """Position 0 wins; no reward loses. A row can be both."""
    return room_closed_events(events).select(
        *DAY_KEYS, "room_id", "tournament_id", "timestamp_utc",
        as_flag(F.col("position") == 0).alias("is_win"),
        as_flag(or_zero("reward") == 0).alias("is_loss"),
    )


def streak_lengths(events: DataFrame) -> DataFrame:
    """Wins and losses of a day as its only island.

    The written window orders by the day within the day, so all its rows are
    peers of one group, and the length of the streak is the count of the flag.
    """
    return win_loss_flags(events).groupBy(*DAY_KEYS).agg(
        F.count_if(F.col("is_win") == 1).alias("win_streak_length"),
        F.count_if(F.col("is_loss") == 1).alias("loss_streak_length"),
    )


def final_streaks(events: DataFrame) -> DataFrame:
    return streak_lengths(events).select(
        *DAY_KEYS,
        F.col("win_streak_length").alias("max_reward_won_streak"),
        F.col("loss_streak_length").alias("max_losing_streak"),
    )


# All metrics in one pass --------------------------------------------------

def day_metrics(events: DataFrame, ties: str = "keep", opening_since: Column | None = None) -> DataFrame:
    """All metrics of every active player-day.

    A metric is NULL when the day has no event of its type, except the
    zero-filled four. A player without an id matches no metric.

    `ties="keep"` takes the balances from rank windows, so a player-day with
    two first joins at one instant has two rows. `ties="first"` takes one of
    them inside the aggregation and reads the log once: the one whose room,
    tournament and balance hash lower (for the closing balance, higher), so the
    order of the input does not matter.
    """
    if ties not in ("keep", "first"):
        raise ValueError("ties must be 'keep' or 'first'")
    name = F.col("event_name")
    scored = name.isin(ROOM_CLOSED, REWARD_CLAIMED)
    closed = name == ROOM_CLOSED

    def when(event: str, value: Column | str) -> Column:
        return F.when(name == event, F.col(value) if isinstance(value, str) else value)

    def present(event: str, count: Column) -> Column:
        return F.when(F.count_if(name == event) > 0, count)

    one_pass = []
    if ties == "first":
        opens = name == JOINED
        if opening_since is not None:
            opens = opens & (F.col("date_utc") > opening_since)
        at = _time_and_content(events)
        one_pass = [
            F.min_by("balance_before", F.when(opens, at)).alias("balance_day_start"),
            F.max_by("balance_before", F.when(name == FINISHED, at)).alias("balance_day_end"),
        ]
    metrics = events.filter(F.col("date_utc").isNotNull()).groupBy(*DAY_KEYS).agg(
        *one_pass,
        present(JOINED, F.count_if(name == JOINED)).alias("matches_played"),
        F.sum(when(FINISHED, or_zero("play_duration"))).alias("total_matches_duration"),
        F.max(F.when(scored, or_zero("score"))).alias("max_score"),
        round3(F.avg(F.when(scored, or_zero("score")))).alias("avg_score"),
        F.max(F.when(scored, F.col("position"))).alias("max_position"),
        round3(F.avg(F.when(scored, F.col("position")))).alias("avg_position"),
        F.count_if(name == REWARD_CLAIMED).alias("matches_won_reward"),
        F.count_if(name == REWARD_CLAIMED).alias("matches_claimed"),
        F.sum(F.when(name == JOINED, F.col("entry_fee")).otherwise(0)).alias("coins_sink_tournaments"),
        F.sum(F.when(name == REWARD_CLAIMED, F.col("reward")).otherwise(0)).alias("coins_source_tournaments"),
        present(ROOM_CLOSED, F.count_if(closed & (F.col("position") == 0))).alias("max_reward_won_streak"),
        present(ROOM_CLOSED, F.count_if(closed & (or_zero("reward") == 0))).alias("max_losing_streak"),
        or_zero(F.sum(when(PURCHASE, "price_usd"))).alias("revenue"),
        or_zero(F.sum(when(PURCHASE, "coins_claimed"))).alias("coins_source_purchases"),
    )
    if ties == "keep":
        opening = balance_start(events, opening_since).withColumnRenamed("balance_before", "balance_day_start")
        metrics = metrics.join(opening, DAY_KEYS, "left").join(balance_end(events), DAY_KEYS, "left")
    return _without_anonymous(metrics).select(*DAILY.columns)


def _time_and_content(events: DataFrame) -> Column:
    """A decimal that orders events by time, then by a hash of where and with what balance; NULL without a time.

    Unlike a struct it has a fixed width, so the aggregation by it needs no sort.
    """
    content = F.xxhash64("room_id", "tournament_id", "balance_before").cast("decimal(19,0)")
    return micros(events, "timestamp_utc").cast("decimal(18,0)") * F.lit(str(2**64)).cast("decimal(20,0)") + content


def _without_anonymous(metrics: DataFrame) -> DataFrame:
    known = F.col("player_id").isNotNull()
    masked = {
        **{c: F.when(known, F.col(c)) for c in CARRIED},
        **{c: F.when(known, F.col(c)).otherwise(0) for c in ZERO_FILLED},
    }
    return metrics.select(*[masked.get(c, F.col(c)).alias(c) for c in metrics.columns])


def fill_days(days: DataFrame, last_day: Column, carried: list[str] = CARRIED) -> DataFrame:
    """Carry values along each player's days and add the days in between.

    Columns in `carried` take their last value before the gap rows are made;
    then each active day is repeated up to the day before the next one. On the
    days added, every other metric is zero. Of several rows of one day, which
    differ in their balances, the one with the largest is the last and only
    that one is repeated.
    """
    following = F.lead("date_utc").over(W.partitionBy("player_id").orderBy(*DAY_ORDER))
    frame = running_frame(["player_id"], *DAY_ORDER)
    until = F.greatest(F.col("date_utc"), F.coalesce(F.date_sub("_next", 1), F.col("_last_day")))
    zeroed = [c for c in DAILY.columns if c not in (*DAY_KEYS, *carried)]
    active = F.col("_day") == F.col("date_utc")
    return (
        days.select(
            *DAY_KEYS,
            *[F.last(c, ignorenulls=True).over(frame).alias(c) for c in carried],
            *zeroed,
            following.alias("_next"),
        )
        .withColumn("_last_day", last_day)
        .withColumn("_day", F.explode(days_through(F.col("date_utc"), until)))
        .select(
            "player_id",
            F.col("_day").alias("date_utc"),
            *carried,
            *[F.when(active, F.col(c)).otherwise(0).alias(c) for c in zeroed],
        )
        .select(*DAILY.columns)
    )


def daily_player(events: DataFrame, ties: str = "keep", opening_since: Column | None = None) -> DataFrame:
    """The fact as written. `opening_since` is the mark that only the opening balance knows."""
    return fill_days(day_metrics(events, ties, opening_since), last_date(events))


def daily_player_zero_filled(events: DataFrame) -> DataFrame:
    """Balances are carried; every other metric is zero on a day without events.

    A metric that is NULL on an active day (no event of its type) is zero too.
    """
    metrics = day_metrics(events)
    plain = metrics.select(
        *[or_zero(c).alias(c) if c not in (*DAY_KEYS, *BALANCES) else F.col(c) for c in metrics.columns]
    )
    return fill_days(plain, last_date(events), carried=BALANCES)


def daily_metrics_joined(events: DataFrame) -> DataFrame:
    """The calendar with the metrics of each day, before anything is carried."""
    joined = date_spine(events).join(day_metrics(events), DAY_KEYS, "left")
    return joined.select(
        *[or_zero(c).alias(c) if c in ZERO_FILLED else F.col(c) for c in DAILY.columns]
    )


def forward_filled(events: DataFrame) -> DataFrame:
    """The fact by way of the full calendar and a fill over every row of it."""
    measures = [c for c in DAILY.columns if c not in DAY_KEYS]
    return forward_fill(daily_metrics_joined(events), ["player_id"], DAY_ORDER, measures)


def daily_player_from(events: DataFrame, stored: DataFrame, first_day: Column) -> DataFrame:
    """The fact from `first_day` on, continued from the stored day before it.

    Reads one stored day and the log from `first_day`; equal to a full rebuild
    as long as no earlier event has arrived since that day was stored.
    """
    day_before = F.date_sub(first_day, 1)
    seed = stored.filter(F.col("date_utc") == day_before).select(*DAILY.columns)
    fresh = events.filter(F.col("date_utc") >= first_day)
    days = seed.unionByName(day_metrics(fresh))
    return fill_days(days, last_date(events)).filter(F.col("date_utc") >= first_day)


PLAYER = ["player_id"]


def touched_players(arrived: DataFrame) -> DataFrame:
    """(player_id, _from): the players of the arrived events, each with the first day that came in."""
    return arrived.filter(F.col("date_utc").isNotNull()).groupBy(*PLAYER).agg(F.min("date_utc").alias("_from"))


def _of_touched(df: DataFrame, touched: DataFrame) -> DataFrame:
    """`df` with each touched player's `_from`; players without an id are one player."""
    same = F.col("a.player_id").eqNullSafe(F.col("b.player_id"))
    return df.alias("a").join(touched.alias("b"), same).select("a.*", "b._from")


def segments_redone(
    events: DataFrame, stored: DataFrame, touched: DataFrame, seed_days: Iterable[dt.date], last_day: Column
) -> DataFrame:
    """The touched players' days, each from its own first touched day on, up to `last_day`.

    Continued from the stored day before that one, which must be among `seed_days`. `events`
    need to hold the touched players' events from there on, `stored` the rows of the seed days.
    """
    fresh = _of_touched(events, touched).filter(F.col("date_utc") >= F.col("_from")).drop("_from")
    before = _of_touched(stored.filter(on_days("date_utc", seed_days)), touched)
    seed = before.filter(F.col("date_utc") == F.date_sub("_from", 1)).select(*DAILY.columns)
    filled = fill_days(seed.unionByName(day_metrics(fresh)), last_day)
    return _of_touched(filled, touched).filter(F.col("date_utc") >= F.col("_from")).select(*DAILY.columns)


def calendar_extended(stored: DataFrame, touched: DataFrame, old_last: Column, last_day: Column) -> DataFrame:
    """The days after `old_last` up to `last_day` of the players that nothing arrived for, carried on from it."""
    end = stored.filter(F.col("date_utc") == old_last).alias("a")
    others = end.join(touched.alias("b"), F.col("a.player_id").eqNullSafe(F.col("b.player_id")), "left_anti")
    return fill_days(others.select(*DAILY.columns), last_day).filter(F.col("date_utc") > old_last)


def changed_days(redone: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of `redone` on the player-days whose rows are others than those stored.

    A day can have several rows, which differ in their balances; they are compared as a set with counts.
    """
    def as_days(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy(*DAY_KEYS).agg(F.array_sort(F.collect_list(F.struct(*DAILY.columns))).alias(name))

    new, old = as_days(redone, "_new").alias("a"), as_days(stored, "_old").alias("b")
    same_day = (F.col("a.date_utc") == F.col("b.date_utc")) & F.col("a.player_id").eqNullSafe(F.col("b.player_id"))
    differ = new.join(old, same_day, "left").filter(~F.col("_new").eqNullSafe(F.col("_old")))
    return differ.select(F.explode("_new").alias("_row")).select("_row.*")
