"""Partitioned parquet tables: the event log and the stored facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchledger.schemas import Fact


def qualified(spark: SparkSession, table: str) -> str:
    """The full name of the stored table that this session means by `table`.

    A session of another current database must not take it for a table of its
    own, so writers pass this name on. Temporary views are refused.
    """
    found = spark.catalog.getTable(table)
    if found.isTemporary or not found.namespace:
        raise ValueError(f"{table} is not a stored table")
    return ".".join(f"`{part}`" for part in (found.catalog, *found.namespace, found.name))


def utc_day(time: Column, data_type: T.DataType) -> Column:
    """The day of a time in UTC, whatever the zone of the session."""
    if isinstance(data_type, T.TimestampType):
        return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(F.unix_seconds(time) / 86_400).cast("int"))
    return F.to_date(time)


def write_event_log(events: DataFrame, table: str, mode: str = "errorifexists") -> None:
    """Write the log by day, each file sorted by event type.

    REBALANCE gathers a day into files of the advisory size, and splits a day
    that is too large for one, so neither small files nor one hot day hurts.
    """
    (
        events.hint("rebalance", "date_utc")
        .sortWithinPartitions("date_utc", "event_name")
        .write.format("parquet")
        .partitionBy("date_utc")
        .mode(mode)
        .saveAsTable(table)
    )


def with_partition(df: DataFrame, fact: Fact) -> DataFrame:
    """`df` in table order: the fact's columns with the partition column last."""
    if fact.derives_partition:
        source = fact.partition_source
        day = utc_day(F.col(source), df.schema[source].dataType).alias(fact.partition_column)
        return df.select(*fact.columns, day)
    rest = [c for c in fact.columns if c != fact.partition_column]
    return df.select(*rest, fact.partition_column)


def create_fact(df: DataFrame, table: str, fact: Fact) -> None:
    """First build: write every row of the query as it is, duplicates included."""
    (
        with_partition(df, fact)
        .hint("rebalance", fact.partition_column)
        .write.format("parquet")
        .partitionBy(fact.partition_column)
        .mode("overwrite")
        .saveAsTable(table)
    )


def read_fact(spark: SparkSession, table: str, fact: Fact) -> DataFrame:
    """The stored fact with its declared columns in their declared order."""
    return spark.table(table).select(*fact.columns)
