"""Equi-joins that stay even when many rows have no key.

A NULL key never matches, yet all rows with it hash to one task of an outer
join. `spread` gives such rows a hash of their own content as one more join
key; rows with a complete key all get 0, so matches are not affected.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPREAD = "_spread"


def any_null(keys: Sequence[str]) -> Column:
    return reduce(or_, [F.col(k).isNull() for k in keys])


def spread(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    content = F.xxhash64(*df.columns)
    return df.withColumn(SPREAD, F.when(any_null(keys), content).otherwise(F.lit(0).cast("bigint")))


def left_joins(left: DataFrame, rights: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Chain left joins on one key list, each input shuffled once.

    Nothing is deduplicated: a key with several rows on the right multiplies.
    """
    on = [*keys, SPREAD]
    out = spread(left, keys)
    for right in rights:
        out = out.join(spread(right, keys), on, "left")
    return out.drop(SPREAD)


def repeated_keys(rights: Sequence[DataFrame], keys: Sequence[str], limit: int) -> DataFrame:
    """Keys that one of `rights` has more than `limit` times, with the side that has most.

    `_lanes` is how many parts of at most about `limit` rows that side makes.
    Rows are counted before the shuffle; the result has at most one row per
    `limit` input rows.
    """
    per_side = [
        right.dropna(subset=list(keys))
        .groupBy(*keys)
        .agg(F.count("*").alias("_rows"))
        .filter(F.col("_rows") > limit)
        .withColumn("_side", F.lit(i))
        for i, right in enumerate(rights)
    ]
    return (
        reduce(DataFrame.unionByName, per_side)
        .groupBy(*keys)
        .agg(F.max_by("_side", "_rows").alias("_side"), F.max("_rows").alias("_rows"))
        .select(*keys, "_side", F.ceil(F.col("_rows") / limit).cast("int").alias("_lanes"))
    )


def laned_left_joins(
    left: DataFrame, rights: Sequence[DataFrame], keys: Sequence[str], repeated: DataFrame
) -> DataFrame:
    """`left_joins` where a key that a right side repeats very often is cut into lanes.

    An outer join can be split at run time on its preserved side only. So the
    rows of the repeated side go to one lane each, and all else that has the
    key goes to every lane. Left rows in a lane that stayed empty are dropped:
    the key is known to have rows on that side, hence in another lane.
    `repeated` must be that of the same inputs; staged, it is joined in place.
    """
    def laned(df: DataFrame, lane_of: Callable[[Column], Column]) -> DataFrame:
        lanes = F.sequence(F.lit(0), F.coalesce("_lanes", F.lit(1)) - 1)
        content = F.xxhash64(*df.columns)
        spread_out = F.when(any_null(keys), F.array(content)).otherwise(
            F.transform(lane_of(lanes), lambda lane: lane.cast("bigint"))
        )
        return df.join(repeated, list(keys), "left").select(
            *df.columns, "_side", F.explode(spread_out).alias(SPREAD)
        )

    def one_lane(side: int, df: DataFrame) -> Callable[[Column], Column]:
        own = F.pmod(F.xxhash64(*df.columns), F.col("_lanes")).cast("int")
        return lambda lanes: F.when(F.col("_side") == side, F.array(own)).otherwise(lanes)

    # The part of the scan a row is in tells apart events that were sent twice.
    rights = [right.withColumn("_scan", F.spark_partition_id()) for right in rights]
    out = laned(left, lambda lanes: lanes)
    for side, right in enumerate(rights):
        mark = f"_has_{side}"
        parts = laned(right, one_lane(side, right)).drop("_side", "_scan").withColumn(mark, F.lit(True))
        empty_lane = (F.col("_side") == side) & F.col(mark).isNull()
        out = out.join(parts, [*keys, SPREAD], "left").filter(~F.coalesce(empty_lane, F.lit(False))).drop(mark)
    return out.drop(SPREAD, "_side")


def rows_of(df: DataFrame, wanted: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of `df` whose keys are among `wanted`, a NULL being equal to a NULL."""
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    return df.alias("a").join(wanted.alias("b"), reduce(and_, same), "left_semi")
