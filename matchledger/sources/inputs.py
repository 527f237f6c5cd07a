"""Readers of the three inputs: a parquet path, or a table of the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from matchledger import schemas


def _read(spark: SparkSession, location: str, schema: T.StructType) -> DataFrame:
    is_path = "/" in location
    df = spark.read.parquet(location) if is_path else spark.table(location)
    return schemas.conform(df, schema)


def read_events(spark: SparkSession, location: str) -> DataFrame:
    return _read(spark, location, schemas.EVENTS)


def read_installs(spark: SparkSession, location: str) -> DataFrame:
    return _read(spark, location, schemas.INSTALLS)


def read_spend(spark: SparkSession, location: str) -> DataFrame:
    return _read(spark, location, schemas.SPEND)
