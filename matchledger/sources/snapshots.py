"""Stored facts that change in one step: a view over versions of a table.

A published fact is a view `t` that reads one version, an external table `t__v7`. The next version holds
the partitions that a merge wrote, in a folder of its own, and points at the folders of older versions for
all others, so nothing untouched is copied. One `ALTER VIEW` then moves the readers. Whoever reads before it
sees all the old rows, whoever reads after it all the new ones, and a run that fails before it has changed
nothing. Which folder a partition lies in is noted in a small table beside each version, `t__v7_days`.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from matchledger.schemas import Fact
from matchledger.sources.tables import qualified, with_partition

#: Versions that stay: the current one, and the one that a reader may have begun with.
KEPT_VERSIONS = 2
#: Partitions named by one statement.
BATCH = 500

_VERSION = "__v"
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def create_published(spark: SparkSession, df: DataFrame, table: str, fact: Fact) -> None:
    """First build of a published fact: write every row of the query as it is, duplicates included."""
    parts = table.replace("`", "").split(".")
    here = [spark.catalog.currentCatalog(), spark.catalog.currentDatabase()]
    view = ".".join(f"`{part}`" for part in [*here[: 3 - len(parts)], *parts])
    _write_version(spark, view, 1, with_partition(df, fact), fact.partition_column, {})
    spark.sql(f"CREATE VIEW {view} AS SELECT * FROM {_version(view, 1)}")


def is_published(spark: SparkSession, table: str) -> bool:
    """Whether a stored name is a published fact; other views are refused."""
    if spark.catalog.getTable(table).tableType != "VIEW":
        return False
    _current(spark, qualified(spark, table))
    return True


def stored_table(spark: SparkSession, table: str) -> str:
    """The table that holds the rows: the current version of a published fact, else the table itself."""
    if not is_published(spark, table):
        return table
    view = qualified(spark, table)
    return _version(view, _current(spark, view))


def publish(
    spark: SparkSession, table: str, content: DataFrame, part: str, touched: set[dt.date | None],
    keep: int = KEPT_VERSIONS,
) -> None:
    """Make `content` what a published fact holds on the `touched` days; its caller is its only writer.

    Touched days without rows in `content` are gone from the new version. Versions before the
    last `keep` are dropped, with the files that no kept one points at.
    """
    if keep < 1:
        raise ValueError("keep must be at least 1")
    view = qualified(spark, table)
    old = _current(spark, view)
    names = {None if day is None else day.isoformat() for day in touched}
    carried = {day: folder for day, folder in _folders(spark, view, old).items() if day not in names}
    _write_version(spark, view, old + 1, content, part, carried)
    spark.sql(f"ALTER VIEW {view} AS SELECT * FROM {_version(view, old + 1)}")
    _sweep(spark, view, old + 1, keep)


def drop_published(spark: SparkSession, table: str) -> None:
    """Drop a published fact with all its versions and their files."""
    view = qualified(spark, table)
    current, home = _current(spark, view), _home(spark, view)
    spark.sql(f"DROP VIEW {view}")
    _drop_versions(spark, view, current + 1)
    _delete(spark, home)


def _write_version(
    spark: SparkSession, view: str, number: int, content: DataFrame, part: str, carried: dict[str | None, str]
) -> None:
    """A version of the rows of `content` and the folders carried over, not read by anyone yet."""
    version, days = _version(view, number), _days(view, number)
    for leftover in (version, days):  # of a run that failed
        spark.sql(f"DROP TABLE IF EXISTS {leftover}")
    # A folder no other run has written to.
    folder = f"{_home(spark, view)}/{number}-{uuid.uuid4().hex[:8]}"
    rows = content.hint("rebalance", part).write.format("parquet").partitionBy(part)
    rows.option("path", folder).saveAsTable(version)
    shown = [row[0].removeprefix(f"{part}=") for row in spark.sql(f"SHOW PARTITIONS {version}").collect()]
    written = {None if name in (_NO_DAY, "null") else name for name in shown}
    places = list(carried.items())
    for i in range(0, len(places), BATCH):
        added = " ".join(f"PARTITION ({part} = {_literal(day)}) LOCATION '{at}'" for day, at in places[i : i + BATCH])
        spark.sql(f"ALTER TABLE {version} ADD {added}")
    places += [(day, f"{folder}/{part}={day or _NO_DAY}") for day in written]
    noted = spark.createDataFrame(places, "day string, folder string")
    noted.coalesce(1).write.format("parquet").saveAsTable(days)


def _literal(day: str | None) -> str:
    return "NULL" if day is None else f"DATE'{day}'"


def _version(view: str, number: int) -> str:
    return f"{view[:-1]}{_VERSION}{number}`"


def _days(view: str, number: int) -> str:
    return f"{view[:-1]}{_VERSION}{number}_days`"


def _current(spark: SparkSession, view: str) -> int:
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {view}").filter("col_name = 'View Text'").first()
    stem = re.escape(f"SELECT * FROM {view[:-1]}{_VERSION}")
    found = described and re.fullmatch(rf"{stem}(\d+)`", described["data_type"])
    if not found:
        raise ValueError(f"{view} is a view, but not of a published fact")
    return int(found[1])


def _folders(spark: SparkSession, view: str, number: int) -> dict[str | None, str]:
    """Day -> folder, one entry a partition."""
    return {row["day"]: row["folder"] for row in spark.table(_days(view, number)).collect()}


def _home(spark: SparkSession, view: str) -> str:
    """The folder of all versions, beside the tables of the database."""
    catalog, database, name = view[1:-1].split("`.`")
    where = spark.catalog.getDatabase(f"`{catalog}`.`{database}`").locationUri
    return f"{where.rstrip('/')}/{name}__versions"


def _drop_versions(spark: SparkSession, view: str, below: int) -> None:
    """Forget all versions under a number; the files of their partitions stay."""
    prefix, name = view.rsplit(".", 1)
    pattern = re.compile(rf"{re.escape(name[1:-1])}{_VERSION}(\d+)(_days)?")
    for row in spark.sql(f"SHOW TABLES IN {prefix}").collect():
        found = pattern.fullmatch(row["tableName"])
        if found and int(found[1]) < below:
            spark.sql(f"DROP TABLE IF EXISTS {prefix}.`{row['tableName']}`")


def _sweep(spark: SparkSession, view: str, current: int, keep: int) -> None:
    """Drop old versions, and delete what no kept version points at, leftovers of failed runs included."""
    oldest = max(1, current - keep + 1)
    kept = {folder for n in range(oldest, current + 1) for folder in _folders(spark, view, n).values()}
    _drop_versions(spark, view, oldest)
    own = {spark.sql(f"DESCRIBE TABLE EXTENDED {_version(view, n)}").filter("col_name = 'Location'").first()["data_type"]
           for n in range(oldest, current + 1)}
    own_names, kept_names = {_tail(folder, 1) for folder in own}, {_tail(folder, 2) for folder in kept}
    home = _home(spark, view)
    for version in _children(spark, home):
        inside = [day for day in _children(spark, version) if "=" in _tail(day, 1)]
        dead = [day for day in inside if _tail(day, 2) not in kept_names]
        if len(dead) == len(inside) and _tail(version, 1) not in own_names:
            _delete(spark, version)
        else:
            for day in dead:
                _delete(spark, day)


def _tail(path: str, parts: int) -> str:
    return "/".join(path.rstrip("/").split("/")[-parts:])


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), at


def _children(spark: SparkSession, path: str) -> list[str]:
    files, at = _at(spark, path)
    return [child.getPath().toString() for child in files.listStatus(at) if child.isDirectory()] if files.exists(at) else []


def _delete(spark: SparkSession, path: str) -> None:
    files, at = _at(spark, path)
    files.delete(at, True)
