"""Declarative data checks: one aggregation per table, one result row per check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class NotNull:
    """No NULL in `column`, among the rows `where` selects if it is given (SQL text)."""

    column: str
    where: str | None = None
    name: str = "not_null"

    def fails(self) -> Column:
        fails = F.col(self.column).isNull()
        return fails if self.where is None else fails & F.expr(self.where)


@dataclass(frozen=True)
class Unique:
    """No value of `column` occurs twice; NULLs do not count."""

    column: str
    name: str = "unique"


EVENT_CHECKS = (NotNull("event_name"), NotNull("timestamp_utc"))
INSTALL_CHECKS = (NotNull("player_id"), Unique("player_id"), NotNull("install_date"))
SPEND_CHECKS = (NotNull("media_source"), NotNull("spend"))
GAME_CHECKS = (NotNull("player_id"), NotNull("room_id"))
ROOM_CHECKS = (NotNull("room_id"), NotNull("tournament_id"))
DAILY_CHECKS = (NotNull("player_id"), NotNull("date_utc"))
ROAS_CHECKS = (NotNull("media_source"), NotNull("install_country"))
PAID_ROAS_CHECK = NotNull("roas", where="media_source != 'Organic'", name="custom_not_null_roas")


#: The checks of every table, sources and facts.
ALL_CHECKS: dict[str, tuple[NotNull | Unique, ...]] = {
    "events": EVENT_CHECKS,
    "installs_attribution": INSTALL_CHECKS,
    "marketing_spend": SPEND_CHECKS,
    "fct_games": GAME_CHECKS,
    "fct_rooms": ROOM_CHECKS,
    "daily_player": DAILY_CHECKS,
    "marketing_roas": (*ROAS_CHECKS, PAID_ROAS_CHECK),
}


def failing_rows(df: DataFrame, check: NotNull | Unique) -> DataFrame:
    """The rows a check selects: NULL rows, or repeated values with their count."""
    if isinstance(check, Unique):
        return _repeated(df, check.column)
    return df.filter(check.fails())


def _repeated(df: DataFrame, column: str) -> DataFrame:
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n_records"))
        .filter(F.col("n_records") > 1)
    )


def run_checks(df: DataFrame, table: str, checks: Sequence[NotNull | Unique]) -> DataFrame:
    """(table_name, column_name, test, failures) for each check; 0 failures is a pass.

    All NULL checks of a table share one pass; a uniqueness check adds one
    aggregation by its column.
    """
    parts = []
    nulls = [c for c in checks if isinstance(c, NotNull)]
    if nulls:
        counts = df.agg(*[F.count_if(c.fails()).alias(f"_{i}") for i, c in enumerate(nulls)])
        rows = F.explode(
            F.array(*[_result(table, c, F.col(f"_{i}")) for i, c in enumerate(nulls)])
        )
        parts.append(counts.select(rows.alias("r")).select("r.*"))
    for check in checks:
        if isinstance(check, Unique):
            count = _repeated(df, check.column).agg(F.count("*").alias("_n"))
            parts.append(count.select(_result(table, check, F.col("_n")).alias("r")).select("r.*"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def check_tables(spark: SparkSession, tables: Mapping[str, str]) -> DataFrame:
    """All checks of the named tables, each read as it is stored: (check name of a table -> stored table)."""
    parts = [run_checks(spark.table(stored), name, ALL_CHECKS[name]) for name, stored in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def _result(table: str, check: NotNull | Unique, failures: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.name).alias("test"),
        failures.alias("failures"),
    )
