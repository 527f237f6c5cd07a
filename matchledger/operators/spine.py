"""The calendar of each player: every day from the first one seen to the last day of the log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_appearance(events: DataFrame) -> DataFrame:
    return events.groupBy("player_id").agg(F.min("date_utc").alias("first_appearance_date"))


def date_bounds(events: DataFrame) -> DataFrame:
    return events.agg(F.min("date_utc").alias("min_date"), F.max("date_utc").alias("max_date"))


def last_date(df: DataFrame) -> Column:
    """The latest `date_utc` as an uncorrelated scalar subquery.

    On a table partitioned by day it reads the partition column only.
    """
    return df.agg(F.max("date_utc")).scalar()


def days_through(first: Column, last: Column) -> Column:
    """Array of the days from `first` to `last`, empty or NULL when there are none."""
    return F.when(first <= last, F.sequence(first, last, F.expr("interval 1 day")))


def date_spine(events: DataFrame) -> DataFrame:
    days = days_through(F.col("first_appearance_date"), F.col("max_date"))
    return (
        first_appearance(events)
        .withColumn("max_date", last_date(events))
        .select("player_id", F.explode(days).alias("date_utc"))
    )
