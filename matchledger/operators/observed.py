"""Data checks counted while a table is written, with no scan of their own."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from matchledger.operators.quality import NotNull, Unique


class ObservedChecks:
    """NULL checks of the rows that pass by on their way into a table.

    Of a first build these are all its rows, of a refresh the rows of the partitions it
    rewrites. A uniqueness check is an aggregation of its own and is left to `run_checks`.
    A stage that is run again after a lost executor may count its failures twice, but never
    makes a failing check pass or a passing one fail.
    """

    def __init__(self) -> None:
        self._seen: list[tuple[str, list[NotNull], Observation]] = []

    def watch(self, df: DataFrame, table: str, checks: Sequence[NotNull | Unique]) -> DataFrame:
        """`df`, which counts the failures when it is written; it has to be written once."""
        nulls = [c for c in checks if isinstance(c, NotNull)]
        if not nulls:
            return df
        seen = Observation(f"{table}_{uuid.uuid4().hex[:8]}")
        self._seen.append((table, nulls, seen))
        return df.observe(seen, *[F.count(F.when(c.fails(), 1)).alias(f"_{i}") for i, c in enumerate(nulls)])

    def results(self, spark: SparkSession) -> DataFrame:
        """(table_name, column_name, test, failures) of all that was written; 0 failures is a pass."""
        rows = [
            (table, check.column, check.name, int(seen.get[f"_{i}"]))
            for table, checks, seen in self._seen
            for i, check in enumerate(checks)
        ]
        return spark.createDataFrame(rows, "table_name string, column_name string, test string, failures bigint")
