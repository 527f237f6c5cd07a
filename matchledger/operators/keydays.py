"""On which days a match, room or player has events: what a refresh reads of the history.

The index is a table of distinct keys and days, to which each arrival adds what is new. It
is exact, unlike a window that looks some days back. It is bucketed and sorted by its keys,
so it is joined where it lies and never shuffled, and a key that is recorded
twice is not there twice, so a refresh that runs again may record again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchledger.operators.joins import any_null, rows_of
from matchledger.session import Workspace

DAY = "date_utc"
#: Buckets of an index that is made; one that is there keeps its own number.
INDEX_BUCKETS = 64


def _write(rows: DataFrame, index: str, keys: Sequence[str], buckets: int, mode: str) -> None:
    # One task a bucket, so that an arrival adds one file to each at most.
    (
        rows.repartition(buckets, *keys)
        .write.format("parquet")
        .mode(mode)
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .saveAsTable(index)
    )


def _buckets(spark: SparkSession, index: str) -> int:
    described = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {index}").collect()}
    return int(described["Num Buckets"])


def record_days(
    spark: SparkSession, index: str, events: DataFrame, keys: Sequence[str], buckets: int = INDEX_BUCKETS
) -> None:
    """Add the keys and days of the events to the index, which is made if it is not there."""
    found = events.select(*keys, DAY).distinct()
    if spark.catalog.tableExists(index):
        buckets = _buckets(spark, index)
        found = unknown_days(spark.table(index), found, keys)
        _write(found, index, keys, buckets, "append")
    else:
        _write(found, index, keys, buckets, "errorifexists")
    spark.catalog.refreshTable(index)  # a stream's batch is written by a session of its own


def unknown_days(index: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys and days that the index does not have; whole keys are looked up where they lie."""
    whole = found.filter(~any_null([*keys, DAY])).join(index, [*keys, DAY], "left_anti")
    names = [*keys, DAY]
    odd, known = found.filter(any_null(names)).alias("a"), index.filter(any_null(names)).alias("b")
    same = F.lit(True)
    for name in names:
        same = same & F.col(f"a.{name}").eqNullSafe(F.col(f"b.{name}"))
    return whole.unionByName(odd.join(known, same, "left_anti"))


def compact_days(spark: SparkSession, index: str, keys: Sequence[str], workspace: Workspace) -> None:
    """Rewrite the index with one file a bucket; for the scheduler, between refreshes."""
    buckets = _buckets(spark, index)
    name, staged = workspace.stage(spark.table(index).distinct(), "key_days")
    try:
        _write(staged, index, keys, buckets, "overwrite")
        spark.catalog.refreshTable(index)
    finally:
        workspace.release(name)


def key_days(index: DataFrame, touched: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of the index of the touched keys, incomplete ones included."""
    whole = index.join(touched.select(*keys).distinct(), list(keys), "left_semi")
    return whole.unionByName(rows_of(index.filter(any_null(keys)), touched.filter(any_null(keys)), keys))


def days_of(spark: SparkSession, index: str, touched: DataFrame, keys: Sequence[str]) -> set[dt.date | None]:
    """All days of the touched keys: as many as the calendar of the data has, not its rows."""
    return distinct_days(key_days(spark.table(index), touched, keys), DAY)


def distinct_days(df: DataFrame, column: str) -> set[dt.date | None]:
    return {row[0] for row in df.select(column).distinct().collect()}


def on_days(column: str, days: Iterable[dt.date | None]) -> Column:
    """A literal filter on the partition column, so that the scan prunes by it."""
    known = sorted(d for d in days if d is not None)
    condition = F.col(column).isin([F.lit(d) for d in known]) if known else F.lit(False)
    return condition | F.col(column).isNull() if None in set(days) else condition
