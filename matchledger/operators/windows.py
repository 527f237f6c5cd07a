"""Windows used by the plans.

Ranks keep rank 1 straight after the window, which Spark turns into a group
limit ahead of the shuffle: a hot player-day sends one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W


def extreme_rows(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """Rows that come first in `order` within their keys, ties kept."""
    rank = F.rank().over(W.partitionBy(*keys).orderBy(order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def first_row(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """Exactly one row per key: the first in `order`."""
    position = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_position", position).filter(F.col("_position") == 1).drop("_position")


def running_frame(keys: Sequence[str], *order: str):
    """Rows from the start of the key up to and with the current one."""
    return W.partitionBy(*keys).orderBy(*order).rowsBetween(W.unboundedPreceding, W.currentRow)


def forward_fill(df: DataFrame, keys: Sequence[str], order: str | Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Replace each NULL in `columns` by the last value before it."""
    frame = running_frame(keys, *([order] if isinstance(order, str) else order))
    filled = {c: F.last(c, ignorenulls=True).over(frame) for c in columns}
    return df.select(*[filled[c].alias(c) if c in filled else F.col(c) for c in df.columns])
