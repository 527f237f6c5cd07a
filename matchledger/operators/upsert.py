"""Merge by key: a matched row takes all new values, an unmatched one is added.

Built-in parquet tables have no row-level merge, so the table form rewrites the
partitions a merge touches and no others.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from matchledger.operators.joins import SPREAD, any_null, spread
from matchledger.operators.keydays import distinct_days, on_days
from matchledger.schemas import Fact
from matchledger.session import Workspace
from matchledger.sources.snapshots import is_published, publish
from matchledger.sources.tables import qualified, with_partition


class DuplicateKeys(ValueError):
    """Two source rows would update one target row."""


class ConcurrentMerge(RuntimeError):
    """Another merge into the table is under way, or one was cut off before it could say that it ended."""


@contextmanager
def only_writer(spark: SparkSession, table: str) -> Iterator[None]:
    """Hold the mark of a table, an empty table beside it; only one writer can create it.

    `table` is a full name. The mark of a writer that died is left behind; drop it by hand once
    it is certain that nothing writes any more, for a merge that was cut off may be half done.
    """
    mark = f"{table[:-1]}{MARK}`"
    try:
        spark.sql(f"CREATE TABLE {mark} (since TIMESTAMP) USING parquet")
    except AnalysisException as refused:
        if spark.catalog.tableExists(mark.replace("`", "")):
            raise ConcurrentMerge(f"{mark} is there: another merge into {table} is under way or was cut off") from refused
        raise
    try:
        yield
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {mark}")


#: What the mark of a table is called, after the table's own name.
MARK = "__being_merged"


def _check_mode(on_duplicate: str) -> None:
    if on_duplicate not in ("error", "keep_all"):
        raise ValueError("on_duplicate must be 'error' or 'keep_all'")


def _keys_equal(keys: Sequence[str], left: str, right: str, null_safe: bool) -> Column:
    condition = F.lit(True)
    for key in keys:
        a, b = F.col(f"{left}.{key}"), F.col(f"{right}.{key}")
        condition = condition & (a.eqNullSafe(b) if null_safe else a == b)
    return condition


def upsert_frame(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    on_duplicate: str = "error",
    null_safe: bool = False,
) -> DataFrame:
    """`target` after merging `source`, as one lazy frame.

    With "error" the source must be unique by key, which is checked inside the
    plan; one full outer join then gives the merge, and a key that the target
    holds twice is updated twice. With "keep_all" all source rows of a key take
    the place of all target rows of it.

    A NULL key matches nothing, so such rows are added again by each run,
    unless `null_safe` makes NULLs equal.
    """
    _check_mode(on_duplicate)
    source = source.select(*target.columns)
    if on_duplicate == "error":
        source = _unique_or_error(source, keys, null_safe)
    return _merge(target, source, keys, on_duplicate, null_safe)


def _unique_or_error(source: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """Mark every row with `_here`; evaluating it fails on a repeated key.

    The column that spreads incomplete keys stays, so the merge needs no further shuffle.
    """
    rows = source if null_safe else spread(source, keys)
    together = W.partitionBy(*keys, *([] if null_safe else [SPREAD]))
    repeated = F.count("*").over(together) > 1
    if not null_safe:
        repeated = repeated & ~any_null(keys)
    message = F.lit(f"several source rows for one key ({', '.join(keys)})")
    # raise_error has no type of its own; the flag is NULL-free either way.
    here = F.when(repeated, F.raise_error(message).cast("boolean")).otherwise(F.lit(True))
    return rows.withColumn("_here", here)


def has_duplicates(df: DataFrame, keys: Sequence[str], null_safe: bool = False) -> bool:
    whole = df if null_safe else df.dropna(subset=list(keys))
    return not whole.groupBy(*keys).count().filter(F.col("count") > 1).isEmpty()


def upsert_table(
    spark: SparkSession,
    table: str,
    source: DataFrame,
    fact: Fact,
    workspace: Workspace,
    on_duplicate: str = "error",
    null_safe: bool = False,
    within: set[dt.date | None] | None = None,
) -> None:
    """Merge `source` into the partitioned `table`.

    `within`: days that are known to hold every target row the source matches;
    other partitions are then not read.

    1. The source is staged: evaluated once, and its size is known, so joins
       with it are broadcast exactly when it is small enough.
    2. Touched partitions are those of the source rows and those where matched
       target rows are now, since a row may move to another day.
    3. Their new content is staged as well, then written with dynamic partition
       overwrite. A run that fails before leaves the table alone; one that
       fails while writing keeps the staged content, to be written again.
    4. Touched partitions that end up with no rows are dropped.

    A table has one writer at a time: a second merge into it gets a `ConcurrentMerge`
    error, before anything is read. Readers may see a row that moved
    to another day twice until step 4 is done; those of a published fact (see
    `sources.snapshots`) never do, as it gets a new version instead of steps 3 and 4.
    """
    table = qualified(spark, table)
    with only_writer(spark, table):
        merge_into(spark, table, source, fact, workspace, on_duplicate, null_safe, within)


def merge_into(
    spark: SparkSession, table: str, source: DataFrame, fact: Fact, workspace: Workspace,
    on_duplicate: str = "error", null_safe: bool = False, within: set[dt.date | None] | None = None,
    watch: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """`upsert_table` for a caller that is the `only_writer` of `table`, given by its full name.

    `watch` gets the new content of the touched partitions before it is written, to count on it.
    """
    _check_mode(on_duplicate)
    part, keys = fact.partition_column, list(fact.keys)
    staged_name, staged = workspace.stage(with_partition(source, fact), f"{fact.name}_source")
    names = [staged_name]
    try:
        if on_duplicate == "error" and has_duplicates(staged, keys, null_safe):
            raise DuplicateKeys(f"several source rows for one key of {fact.name}")
        target = spark.table(table)
        touched = distinct_days(staged, part)
        if part in keys:
            # A matched row is in the partition of the source row that matches it.
            before = target.filter(on_days(part, touched))
            content = _merge(before, staged, keys, on_duplicate, null_safe)
        else:
            # Keys of the target that the source matches, with the day they are stored under.
            wanted = staged.select(*keys).distinct().alias("s")
            hits_name, hits = workspace.stage(
                (target if within is None else target.filter(on_days(part, within)))
                .select(*keys, part)
                .alias("t")
                .join(wanted, _keys_equal(keys, "t", "s", null_safe), "left_semi")
                .distinct(),
                f"{fact.name}_matched",
            )
            names.append(hits_name)
            touched |= distinct_days(hits, part)
            before = target.filter(on_days(part, touched))
            if on_duplicate == "keep_all":
                content = _merge(before, staged, keys, on_duplicate, null_safe)
            else:
                content = _update_and_add(before, staged, hits, keys, null_safe)
        content = content.select(*target.columns)
        after_name, after = workspace.stage(watch(content) if watch else content, f"{fact.name}_after")
        names.append(after_name)
        if is_published(spark, table):
            publish(spark, table, after, part, touched)
            return
        try:
            overwrite_partitions(spark, after_name, table, part)
        except Exception as failure:
            names.remove(after_name)
            failure.add_note(f"{after_name} holds the new content; finish with overwrite_partitions")
            raise
        for day in touched - distinct_days(after, part):
            value = "NULL" if day is None else f"DATE'{day.isoformat()}'"
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({part} = {value})")
        spark.catalog.refreshTable(table)
    finally:
        workspace.release(*names)


def overwrite_partitions(spark: SparkSession, staged: str, table: str, part: str) -> None:
    """Replace the partitions that occur in `staged` and no others.

    The mode is a setting, and without it the whole table would be replaced, so
    the write has a session of its own that no other thread can change. That
    session knows neither the caller's current database, hence full names, nor the
    caller's settings, which are copied.
    """
    staged, table = qualified(spark, staged), qualified(spark, table)
    session = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key):
            session.conf.set(key, value)
    session.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    session.table(staged).hint("rebalance", part).write.insertInto(table, overwrite=True)


def _update_and_add(
    before: DataFrame, staged: DataFrame, hits: DataFrame, keys: Sequence[str], null_safe: bool
) -> DataFrame:
    """New content of touched partitions, for a source that may be far smaller than they are.

    The big side is the left one of a left join, so it stays where it is when
    the source is small enough to broadcast, and can be split when it is skewed.
    """
    columns = staged.columns
    old, new, on = _sides(before, staged.withColumn("_here", F.lit(True)), keys, null_safe)
    updated = old.join(new, on, "left").select(*_new_or_old(columns))
    arriving, known, on = _sides(staged, hits.select(*keys).distinct(), keys, null_safe)
    return updated.unionByName(arriving.join(known, on, "left_anti").select(*columns))


def _merge(
    target: DataFrame, source: DataFrame, keys: Sequence[str], on_duplicate: str, null_safe: bool
) -> DataFrame:
    """The merge in one join; a source that is not "keep_all" is unique by key."""
    columns = target.columns
    source = source.select(*columns, *[c for c in source.columns if c in ("_here", SPREAD)])
    if on_duplicate == "keep_all":
        old, new, on = _sides(target, source.select(*keys).distinct(), keys, null_safe)
        return old.join(new, on, "left_anti").select(*columns).unionByName(source)
    if "_here" not in source.columns:
        source = source.withColumn("_here", F.lit(True))
    old, new, on = _sides(target, source, keys, null_safe)
    return old.join(new, on, "full_outer").select(*_new_or_old(columns))


def _new_or_old(columns: Sequence[str]) -> list[Column]:
    """The values of the source where there is a source row, else of the target."""
    matched = F.col("s._here").isNotNull()
    return [F.when(matched, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in columns]


def _sides(
    left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool
) -> tuple[DataFrame, DataFrame, Column]:
    """Both sides as `t` and `s` with their join condition, NULL keys spread out."""
    if null_safe:
        return left.alias("t"), right.alias("s"), _keys_equal(keys, "t", "s", True)
    left, right = (df if SPREAD in df.columns else spread(df, keys) for df in (left, right))
    return left.alias("t"), right.alias("s"), _keys_equal([*keys, SPREAD], "t", "s", False)
