"""High-water marks: what a table has seen so far, and the rows beyond it."""

from __future__ import annotations

import datetime as dt
import warnings

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchledger.sources.snapshots import stored_table
from matchledger.sources.tables import utc_day


def _value(df: DataFrame, value: Column, data_type: T.DataType):
    """An aggregate of `df` as a plain value, by way of text or, for zoned times, of microseconds.

    No Python datetime and no local zone is involved, in which an hour in
    autumn would be two.
    """
    zoned = isinstance(data_type, T.TimestampType)
    return df.agg(F.unix_micros(value) if zoned else value.cast("string")).first()[0]


def _literal(value, data_type: T.DataType) -> Column:
    if isinstance(data_type, T.TimestampType):
        return F.timestamp_micros(F.lit(value).cast("bigint"))
    return F.lit(value).cast(data_type)


def typed_literal(df: DataFrame, value: Column, data_type: T.DataType) -> Column:
    """An aggregate of `df` as a literal of the given type."""
    return _literal(_value(df, value, data_type), data_type)


def high_water_mark(target: DataFrame, field: str) -> Column:
    """The largest `field` in `target` as a typed literal; NULL for an empty target.

    As a literal it can prune partitions and row groups.
    """
    data_type = target.schema[field].dataType
    found = _value(target, F.max(field), data_type)
    if found is None:
        _warn(field)
    return _literal(found, data_type)


def _warn(field: str) -> None:
    warnings.warn(f"no high-water mark: {field} has no value in the target", stacklevel=3)


def stored_high_water_mark(spark: SparkSession, table: str, field: str, part: str) -> Column:
    """The same for a table partitioned by the UTC day of `field`, or by `field` itself.

    The catalog names the partitions; the newest that has a value is the only one read.
    """
    rows = spark.table(table)
    data_type = rows.schema[field].dataType
    for day in partition_days(spark, table, part):
        found = _value(rows.filter(F.col(part) == F.lit(day)), F.max(field), data_type)
        if found is not None:
            return _literal(found, data_type)
    _warn(field)
    return _literal(None, data_type)


def partition_days(spark: SparkSession, table: str, part: str) -> list[dt.date]:
    """The days a table has partitions of, newest first, without the one of rows that have no day."""
    shown = spark.sql(f"SHOW PARTITIONS {stored_table(spark, table)}").collect()
    names = (row[0].removeprefix(f"{part}=") for row in shown)
    return sorted((dt.date.fromisoformat(n) for n in names if n not in ("__HIVE_DEFAULT_PARTITION__", "null")), reverse=True)


def incremental_filter(
    df: DataFrame, field: str, mark: Column | None, day_column: str | None = None
) -> DataFrame:
    """Rows strictly after the mark. No mark means a first build: all rows.

    A mark that is NULL (the target exists but is empty) selects nothing.
    `day_column`, when given, must hold the day of `field` in UTC; the mark's day
    is then compared with it as well, which prunes a log partitioned by day.
    """
    if mark is None:
        return df
    if day_column is not None and day_column != field:
        df = df.filter(F.col(day_column) >= utc_day(mark, df.schema[field].dataType))
    return df.filter(F.col(field) > mark)
