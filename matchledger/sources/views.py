"""Typed views of the event log: all columns, one event type.

The filter is a plain equality on the column the log is sorted by, so parquet
statistics skip the row groups of the other types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from matchledger import schemas


def typed_events(events: DataFrame, name: str) -> DataFrame:
    return events.filter(F.col("event_name") == name)


def purchase_events(events: DataFrame) -> DataFrame:
    return typed_events(events, schemas.PURCHASE)


def finished_events(events: DataFrame) -> DataFrame:
    return typed_events(events, schemas.FINISHED)


def joined_events(events: DataFrame) -> DataFrame:
    return typed_events(events, schemas.JOINED)


def reward_claimed_events(events: DataFrame) -> DataFrame:
    return typed_events(events, schemas.REWARD_CLAIMED)


def room_closed_events(events: DataFrame) -> DataFrame:
    return typed_events(events, schemas.ROOM_CLOSED)
