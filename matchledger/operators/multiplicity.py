"""Give a counted row its copies back, with no task emitting them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def repeat_rows(
    df: DataFrame, count_column: str, keys: Sequence[str], run_length: int = 4096
) -> DataFrame:
    """Each row as often as `count_column` says; the column is dropped.

    A count is first cut into numbered runs of at most `run_length`. The runs
    are then rebalanced by `keys` and number, so the copies of one very
    frequent row come out of many tasks.
    """
    n = F.col(count_column)
    columns = [c for c in df.columns if c != count_column]
    runs = df.filter(n > 0).select(
        *columns,
        n.alias("_n"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"({count_column} - 1) div {run_length}"))).alias("_run"),
    )
    length = F.least(F.lit(run_length).cast("bigint"), F.col("_n") - F.col("_run") * run_length)
    return (
        runs.select(*columns, "_run", length.cast("int").alias("_length"))
        .hint("rebalance", *keys, "_run")
        .select(*columns, F.explode(F.array_repeat(F.lit(0), F.col("_length"))).alias("_copy"))
        .select(*columns)
    )
