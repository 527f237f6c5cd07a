"""Published facts: a reader sees a merge as a whole or not at all."""

from pathlib import Path
from urllib.parse import urlparse

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from matchledger.operators.upsert import upsert_table
from matchledger.operators.watermark import partition_days
from matchledger.plans.games import fct_games
from matchledger.plans.refresh import Inputs, refresh
from matchledger.schemas import GAMES
from matchledger.sources import snapshots
from matchledger.sources.snapshots import create_published, drop_published, is_published, stored_table
from matchledger.sources.tables import create_fact, qualified, read_fact
from tests.conftest import bag, claimed, closed, day, finished, joined
from tests.test_upsert import ITEMS, MERGED, NEW, OLD, frame, rows

OLD_ROWS = sorted(OLD, key=repr)


@pytest.fixture()
def items(spark, workspace):
    table = workspace.table("items")
    create_published(spark, frame(spark, *OLD), table, ITEMS)
    return table


def files(spark, table):
    return {r[0] for r in spark.table(stored_table(spark, table)).select("_metadata.file_path").distinct().collect()}


def on_disk(spark, workspace):
    where = spark.catalog.getDatabase(workspace.database).locationUri
    return sorted(f"{p}" for p in Path(urlparse(where).path, "items__versions").rglob("*.parquet"))


def test_merge_and_read_back(spark, workspace, items):
    upsert_table(spark, items, frame(spark, *NEW), ITEMS, workspace)
    assert rows(read_fact(spark, items, ITEMS)) == MERGED
    assert is_published(spark, items)
    assert partition_days(spark, items, "d") == [day(4 - i) for i in range(1, 4)]


def test_a_reader_between_any_two_steps_sees_the_old_or_the_new_rows(spark, workspace, items, monkeypatch):
    # One row moves to another day, one partition empties, one is new.
    new = frame(spark, (3, "moved", 1), (4, "D", 3))
    after = [(1, "a", 1), (2, "b", 1), (3, "moved", 1), (4, "D", 3)]
    seen, watching = [], []
    sql, save = type(spark).sql, DataFrameWriter.saveAsTable

    def look():
        if not watching:
            watching.append(True)
            seen.append(rows(sql(spark, f"SELECT * FROM {items}")))
            watching.pop()

    def looking(step):
        def run(*args, **kwargs):
            look()
            result = step(*args, **kwargs)
            look()
            return result

        return run

    monkeypatch.setattr(type(spark), "sql", looking(sql))
    monkeypatch.setattr(DataFrameWriter, "saveAsTable", looking(save))
    upsert_table(spark, items, new, ITEMS, workspace)
    monkeypatch.undo()
    changes = [a for a, b in zip(seen, [None, *seen], strict=False) if a != b]
    assert changes == [OLD_ROWS, after] and len(seen) > 20
    assert rows(spark.table(items)) == after


def test_untouched_partitions_are_not_copied(spark, workspace, items):
    before = files(spark, items)
    upsert_table(spark, items, frame(spark, *NEW), ITEMS, workspace)
    of_day_2 = {f for f in before if "d=2024-01-02" in f}
    assert of_day_2 and of_day_2 <= files(spark, items)
    assert not (before - of_day_2) & files(spark, items)


def test_an_open_reader_ends_and_old_files_go(spark, workspace, items):
    open_reader = spark.table(items)
    upsert_table(spark, items, frame(spark, (1, "x", 1)), ITEMS, workspace)
    assert rows(open_reader) == OLD_ROWS  # of the version it began with
    for value in "yz":
        upsert_table(spark, items, frame(spark, (1, value, 1)), ITEMS, workspace)
    assert rows(spark.table(items)) == [(1, "z", 1), (2, "b", 1), (3, "c", 2)]
    # Day 2 of the first version, and day 1 of the last two.
    kept = on_disk(spark, workspace)
    assert len({Path(f).parent for f in kept}) == 3
    tables = {r.tableName for r in spark.sql(f"SHOW TABLES IN {workspace.database}").collect()}
    assert tables == {"items", "items__v3", "items__v3_days", "items__v4", "items__v4_days"}


def test_a_failed_run_changes_nothing_and_the_next_one_clears_up(spark, workspace, items, monkeypatch):
    write = snapshots._write_version

    def fail(*args):
        write(*args)
        raise OSError("lost before the readers were moved")

    monkeypatch.setattr(snapshots, "_write_version", fail)
    with pytest.raises(OSError, match="lost"):
        upsert_table(spark, items, frame(spark, *NEW), ITEMS, workspace)
    monkeypatch.undo()
    assert rows(spark.table(items)) == OLD_ROWS
    upsert_table(spark, items, frame(spark, *NEW), ITEMS, workspace)
    assert rows(spark.table(items)) == MERGED
    named = {Path(urlparse(f).path).resolve() for n in (1, 2) for f in files(spark, f"{items}__v{n}")}
    assert {Path(f).resolve() for f in on_disk(spark, workspace)} == named


def test_rows_without_a_day_are_carried_and_replaced(spark, workspace):
    table = workspace.table("items")
    create_published(spark, frame(spark, (1, "a", None), (2, "b", 1)), table, ITEMS)
    upsert_table(spark, table, frame(spark, (2, "B", 1)), ITEMS, workspace)
    assert rows(spark.table(table)) == [(1, "a", None), (2, "B", 1)]
    upsert_table(spark, table, frame(spark, (1, "A", 2)), ITEMS, workspace)
    assert rows(spark.table(table)) == [(1, "A", 2), (2, "B", 1)]


def test_all_rows_may_go_and_an_empty_fact_grow(spark, workspace):
    table = workspace.table("items")
    create_published(spark, frame(spark, *OLD).limit(0), table, ITEMS)
    upsert_table(spark, table, frame(spark, *OLD).limit(0), ITEMS, workspace)
    assert rows(spark.table(table)) == []
    upsert_table(spark, table, frame(spark, *OLD), ITEMS, workspace)
    assert rows(spark.table(table)) == OLD_ROWS
    drop_published(spark, table)
    assert on_disk(spark, workspace) == []
    assert spark.sql(f"SHOW TABLES IN {workspace.database}").collect() == []


def test_other_views_are_refused(spark, workspace):
    table, view = workspace.table("plain"), workspace.table("items")
    create_fact(frame(spark, *OLD), table, ITEMS)
    assert stored_table(spark, table) == table
    spark.sql(f"CREATE VIEW {view} AS SELECT * FROM {table}")
    with pytest.raises(ValueError, match="not of a published fact"):
        upsert_table(spark, view, frame(spark, *NEW), ITEMS, workspace)


def test_names_of_the_current_database(spark, workspace):
    before = spark.catalog.currentDatabase()
    spark.catalog.setCurrentDatabase(workspace.database)
    try:
        create_published(spark, frame(spark, *OLD), "items", ITEMS)
        upsert_table(spark, "items", frame(spark, *NEW), ITEMS, workspace)
    finally:
        spark.catalog.setCurrentDatabase(before)
    assert rows(spark.table(workspace.table("items"))) == MERGED
    assert qualified(spark, workspace.table("items")).endswith("`items`")


@pytest.mark.parametrize("key_days", [False, True])
def test_refreshes_of_a_published_fact_equal_a_full_build(spark, workspace, log, key_days):
    first = [joined("05 10:00"), joined("06 10:00", room_id=11), finished("06 10:05", room_id=11)]
    late = [finished("05 10:04"), closed("07 09:00"), claimed("07 09:30"), joined("07 11:00", room_id=12)]
    table = workspace.table("games")
    index = workspace.table("games_days") if key_days else None

    def at(events, arrived=None):
        return refresh(
            spark, "fct_games", table, Inputs(events=events, arrived=arrived, key_days=index), workspace,
            late="reprocess", snapshots=True,
        )

    at(log(*first))
    out = at(log(*first, *late), log(*late))
    assert bag(out) == bag(fct_games(log(*first, *late)))
    assert is_published(spark, table)


def test_high_water_mark_of_a_published_fact(spark, workspace, log):
    table = workspace.table("games")
    first = [joined("05 10:00"), joined("06 10:00", room_id=11)]
    refresh(spark, "fct_games", table, Inputs(events=log(*first)), workspace, snapshots=True)
    more = log(*first, joined("08 10:00", room_id=12))
    out = refresh(spark, "fct_games", table, Inputs(events=more), workspace)
    assert bag(out) == bag(fct_games(more))
    assert out.columns == list(GAMES.columns)
    assert out.filter(F.col("date_utc") == F.lit(day(8))).count() == 1
