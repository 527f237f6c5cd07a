"""Order within a player-day without one task per player-day.

A day is cut into short time slices. Windows run inside (player, day, slice);
what a slice must know of the ones before it is computed from one summary row
per slice, of which a day has a fixed number. A player who produces a third of
the log is so spread over many tasks, and the result is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W
from pyspark.sql import types as T

from matchledger.functions import as_flag
from matchledger.schemas import DAY_KEYS

SLICE_SECONDS = 60


def micros(df: DataFrame, column: str) -> Column:
    """Microseconds since 1970, for times with and without zone."""
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return F.timestamp_diff("MICROSECOND", F.expr("timestamp_ntz'1970-01-01'"), F.col(column))
    return F.unix_micros(column)


# Rows without a time come first in their day, in a slice of their own.
_NO_TIME = -(2**62)


def _sliced(flags: DataFrame, slice_seconds: int) -> DataFrame:
    """Add `_key`, a total order of rows that differ, and the `_slice` it lies in.

    The flags are part of the key, so rows equal in it are interchangeable.
    """
    at = F.coalesce(micros(flags, "timestamp_utc") * 4, F.lit(_NO_TIME))
    key = at + F.coalesce("is_win", F.lit(0)) * 2 + F.coalesce("is_loss", F.lit(0))
    per_slice = 4_000_000 * slice_seconds
    return flags.withColumn("_key", key).withColumn("_slice", F.expr(f"_key div {per_slice}"))


def _ordered(flags: DataFrame, slice_seconds: int) -> DataFrame:
    """The rows with their number, the flags before them, and the day's changes of either flag."""
    inside = W.partitionBy(*DAY_KEYS, "_slice").orderBy("_key")
    rows = _sliced(flags, slice_seconds)
    columns = rows.columns
    changed = {f: as_flag(F.col(f) != F.lag(f).over(inside)) for f in ("is_win", "is_loss")}
    slices = rows.select(*columns, changed["is_win"].alias("_win_change"), changed["is_loss"].alias("_loss_change")).groupBy(
        *DAY_KEYS, "_slice"
    ).agg(
        F.count("*").alias("_rows"),
        F.min_by("is_win", "_key").alias("_win_first"), F.max_by("is_win", "_key").alias("_win"),
        F.min_by("is_loss", "_key").alias("_loss_first"), F.max_by("is_loss", "_key").alias("_loss"),
        F.sum("_win_change").alias("_win_changes"), F.sum("_loss_change").alias("_loss_changes"),
    )
    earlier = W.partitionBy(*DAY_KEYS).orderBy("_slice")
    linked = slices.select(
        *DAY_KEYS, "_slice", "_rows", "_win_first", "_loss_first", "_win_changes", "_loss_changes",
        F.lag("_win", 1, 0).over(earlier).alias("is_win"),
        F.lag("_loss", 1, 0).over(earlier).alias("is_loss"),
    )
    day = W.partitionBy(*DAY_KEYS)
    # One row per slice that sorts ahead of its rows and stands for all before it.
    heads = linked.select(
        *DAY_KEYS,
        "_slice",
        "is_win",
        "is_loss",
        F.lit(True).alias("_head"),
        F.coalesce(
            F.sum("_rows").over(earlier.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)
        ).alias("_before"),
        F.sum(F.col("_win_changes") + as_flag(F.col("_win_first") != F.col("is_win"))).over(day).alias("_win_total"),
        F.sum(F.col("_loss_changes") + as_flag(F.col("_loss_first") != F.col("is_loss"))).over(day).alias("_loss_total"),
    )
    both = rows.unionByName(heads, allowMissingColumns=True)
    heads_first = W.partitionBy(*DAY_KEYS, "_slice").orderBy(F.asc_nulls_last("_head"), "_key")
    so_far = heads_first.rowsBetween(W.unboundedPreceding, W.currentRow)

    def of_head(column: str) -> Column:
        return F.last(column, ignorenulls=True).over(so_far)

    return (
        both.select(
            *columns,
            "_head",
            (of_head("_before") + F.row_number().over(heads_first) - 1).alias("event_order"),
            F.lag("is_win").over(heads_first).alias("previous_is_win"),
            F.lag("is_loss").over(heads_first).alias("previous_is_loss"),
            of_head("_win_total").alias("win_streak_group"),
            of_head("_loss_total").alias("loss_streak_group"),
        )
        .filter(F.col("_head").isNull())
        .drop("_key", "_head")
    )


def ordered_flags(flags: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Number each row of a player-day in time order and give it the flags before it.

    Rows without a time come first.
    """
    return _ordered(flags, slice_seconds).drop("win_streak_group", "loss_streak_group")


def streak_groups(flags: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Number of flag changes of the day, on each of its rows.

    The running sum has the day itself as its order, so all rows of a day are
    peers and each has the day's total.
    """
    return _ordered(flags, slice_seconds)


def true_streaks(flags: DataFrame, slice_seconds: int = SLICE_SECONDS) -> DataFrame:
    """Longest run of wins and of losses of each player-day, in time order.

    Each slice is reduced to its run at the start, its run at the end and its
    longest run; runs that cross slices are put together from those.
    """
    group = [*DAY_KEYS, "_kind"]
    inside = W.partitionBy(*DAY_KEYS, "_slice").orderBy("_key").rowsBetween(W.unboundedPreceding, W.currentRow)

    def numbered(kind: str, flag: str) -> Column:
        """The flag with the number of its run: the misses so far, 0 at the start of a slice."""
        return F.struct(
            F.lit(kind).alias("_kind"), F.col(flag).alias("_hit"), F.col(f"_{kind}_run").alias("_run")
        )

    runs = (
        _sliced(flags, slice_seconds)
        .select(
            *DAY_KEYS, "_slice", "is_win", "is_loss",
            F.sum(1 - F.col("is_win")).over(inside).alias("_win_run"),
            F.sum(1 - F.col("is_loss")).over(inside).alias("_loss_run"),
        )
        .select(
            *DAY_KEYS, "_slice",
            F.inline(F.array(numbered("win", "is_win"), numbered("loss", "is_loss"))),
        )
        .groupBy(*group, "_slice", "_run")
        .agg(F.sum("_hit").alias("_length"))
    )
    slices = runs.groupBy(*group, "_slice").agg(
        F.max("_length").alias("_longest"),
        F.max("_run").alias("_misses"),
        F.max_by("_length", "_run").alias("_at_end"),
        F.coalesce(F.max(F.when(F.col("_run") == 0, F.col("_length"))), F.lit(0)).alias("_at_start"),
    )
    # A chain crosses slices: it ends in the next slice with a miss.
    broken = as_flag(F.col("_misses") > 0)
    earlier = W.partitionBy(*group).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    chain = F.coalesce(F.sum(broken).over(earlier), F.lit(0))
    linked = slices.withColumn("_chain", chain).withColumn(
        "_links",
        F.when(
            F.col("_misses") == 0,
            F.array(F.struct(F.col("_chain").alias("chain"), F.col("_at_end").alias("length"))),
        ).otherwise(
            F.array(
                F.struct(F.col("_chain").alias("chain"), F.col("_at_start").alias("length")),
                F.struct((F.col("_chain") + 1).alias("chain"), F.col("_at_end").alias("length")),
            )
        ),
    )
    per_chain = (
        linked.select(*group, "_longest", F.explode("_links").alias("_link"))
        .groupBy(*group, F.col("_link.chain").alias("_chain"))
        .agg(F.sum("_link.length").alias("_joined"), F.max("_longest").alias("_longest"))
    )
    longest = F.greatest("_joined", "_longest")
    return per_chain.groupBy(*DAY_KEYS).agg(
        F.max(F.when(F.col("_kind") == "win", longest)).alias("max_reward_won_streak"),
        F.max(F.when(F.col("_kind") == "loss", longest)).alias("max_losing_streak"),
    )
