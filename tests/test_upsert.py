import pytest
from pyspark.sql import functions as F

from matchledger.operators.upsert import ConcurrentMerge, DuplicateKeys, only_writer, upsert_frame, upsert_table
from matchledger.operators.watermark import high_water_mark, incremental_filter
from matchledger.plans.games import fct_games
from matchledger.schemas import GAMES, Fact
from matchledger.sources.tables import create_fact, qualified, read_fact

ITEMS = Fact("items", ("k", "v", "d"), ("k",), "d", "d")
DATED = Fact("dated", ("k", "v", "d"), ("k", "d"), "d", "d")
SCHEMA = "k bigint, v string, d date"


def frame(spark, *rows):
    return spark.createDataFrame([(k, v, None if d is None else f"2024-01-{d:02d}") for k, v, d in rows], "k bigint, v string, d string").withColumn("d", F.col("d").cast("date"))


def rows(df):
    return sorted(((r.k, r.v, r.d and r.d.day) for r in df.collect()), key=repr)


@pytest.fixture()
def apply(spark, workspace):
    """Merge through a stored table, after any number of earlier merges."""

    def run(fact, target, *sources, **options):
        table = workspace.table("target")
        create_fact(target, table, fact)
        for source in sources:
            upsert_table(spark, table, source, fact, workspace, **options)
        return read_fact(spark, table, fact)

    return run


OLD = [(1, "a", 1), (2, "b", 1), (3, "c", 2)]
NEW = [(2, "B", 1), (4, "D", 3)]
MERGED = [(1, "a", 1), (2, "B", 1), (3, "c", 2), (4, "D", 3)]


def test_update_and_insert(spark, apply):
    old, new = frame(spark, *OLD), frame(spark, *NEW)
    assert rows(upsert_frame(old, new, ["k"])) == MERGED
    assert rows(apply(ITEMS, old, new)) == MERGED


def test_merging_again_changes_nothing(spark, apply):
    new = frame(spark, *NEW)
    assert rows(apply(ITEMS, frame(spark, *OLD), new, new)) == MERGED


def test_partition_column_among_the_keys(spark, apply):
    old, new = frame(spark, *OLD), frame(spark, (2, "B", 1), (2, "new day", 2))
    expected = [(1, "a", 1), (2, "B", 1), (2, "new day", 2), (3, "c", 2)]
    assert rows(upsert_frame(old, new, DATED.keys)) == expected
    assert rows(apply(DATED, old, new)) == expected


def test_a_row_moves_and_its_old_partition_empties(spark, apply, workspace):
    out = apply(ITEMS, frame(spark, *OLD), frame(spark, (3, "moved", 1)))
    assert rows(out) == [(1, "a", 1), (2, "b", 1), (3, "moved", 1)]
    parts = spark.sql(f"SHOW PARTITIONS {workspace.table('target')}").collect()
    assert [p[0] for p in parts] == ["d=2024-01-01"]


def test_other_partitions_are_not_rewritten(spark, apply, workspace):
    table = workspace.table("target")
    create_fact(frame(spark, *OLD), table, ITEMS)

    def files(d):
        at = spark.table(table).filter(F.col("d") == F.lit(f"2024-01-{d:02d}").cast("date"))
        return {r[0] for r in at.select("_metadata.file_path").distinct().collect()}

    before = files(2)
    upsert_table(spark, table, frame(spark, *NEW), ITEMS, workspace)
    assert files(2) == before
    assert rows(read_fact(spark, table, ITEMS)) == MERGED


def test_rows_without_a_partition_day(spark, apply):
    old = frame(spark, (1, "a", None), (2, "b", 1))
    assert rows(apply(ITEMS, old, frame(spark, (1, "A", None)))) == [(1, "A", None), (2, "b", 1)]
    assert rows(upsert_frame(old, frame(spark, (1, "A", 1)), ["k"])) == [(1, "A", 1), (2, "b", 1)]


def test_a_day_arrives_for_a_row_that_had_none(spark, apply, workspace):
    out = apply(ITEMS, frame(spark, (1, "a", None), (2, "b", 1)), frame(spark, (1, "A", 1)))
    assert rows(out) == [(1, "A", 1), (2, "b", 1)]


def test_duplicate_source_keys_are_refused(spark, apply):
    old, new = frame(spark, *OLD), frame(spark, (2, "x", 1), (2, "y", 1))
    with pytest.raises(DuplicateKeys):
        apply(ITEMS, old, new)
    with pytest.raises(Exception, match="several source rows"):
        upsert_frame(old, new, ["k"]).collect()


def test_keep_all_replaces_the_key(spark, apply):
    old, new = frame(spark, *OLD, (2, "b2", 1)), frame(spark, (2, "x", 1), (2, "y", 2))
    expected = [(1, "a", 1), (2, "x", 1), (2, "y", 2), (3, "c", 2)]
    assert rows(upsert_frame(old, new, ["k"], on_duplicate="keep_all")) == expected
    assert rows(apply(ITEMS, old, new, on_duplicate="keep_all")) == expected


def test_a_key_the_target_has_twice_is_updated_twice(spark, apply):
    old, new = frame(spark, (1, "a", 1), (1, "b", 2), (2, "c", 2)), frame(spark, (1, "z", 1))
    expected = [(1, "z", 1), (1, "z", 1), (2, "c", 2)]
    assert rows(upsert_frame(old, new, ["k"])) == expected
    assert rows(apply(ITEMS, old, new)) == expected


def test_null_keys_are_added_each_time_unless_null_safe(spark, apply):
    old, new = frame(spark, (None, "a", 1)), frame(spark, (None, "b", 1))
    assert rows(upsert_frame(old, new, ["k"])) == [(None, "a", 1), (None, "b", 1)]
    assert rows(apply(ITEMS, old, new)) == [(None, "a", 1), (None, "b", 1)]
    assert rows(upsert_frame(old, new, ["k"], null_safe=True)) == [(None, "b", 1)]
    assert rows(apply(ITEMS, old, new, null_safe=True)) == [(None, "b", 1)]


def test_several_null_keys_are_not_duplicates(spark, apply):
    new = frame(spark, (None, "x", 1), (None, "x", 1))
    assert rows(upsert_frame(frame(spark, *OLD), new, ["k"]))[-2:] == [(None, "x", 1)] * 2
    assert len(rows(apply(ITEMS, frame(spark, *OLD), new))) == 5


def test_empty_source(spark, apply):
    assert rows(apply(ITEMS, frame(spark, *OLD), frame(spark, *NEW).limit(0))) == sorted(OLD, key=repr)


def test_staged_tables_are_released(spark, apply, workspace):
    apply(ITEMS, frame(spark, *OLD), frame(spark, *NEW))
    assert [r.tableName for r in spark.sql(f"SHOW TABLES IN {workspace.database}").collect()] == ["target"]


def test_a_failed_write_can_be_finished(spark, workspace, monkeypatch):
    from matchledger.operators import upsert

    table = workspace.table("target")
    create_fact(frame(spark, *OLD), table, ITEMS)
    write = upsert.overwrite_partitions

    def fail(*_args):
        raise OSError("disk gone")

    monkeypatch.setattr(upsert, "overwrite_partitions", fail)
    with pytest.raises(OSError) as failed:
        upsert_table(spark, table, frame(spark, *NEW), ITEMS, workspace)
    staged = failed.value.__notes__[0].split()[0]
    assert rows(read_fact(spark, table, ITEMS)) == sorted(OLD, key=repr)
    write(spark, staged, table, "d")
    spark.catalog.refreshTable(table)
    assert rows(read_fact(spark, table, ITEMS)) == MERGED


def test_mark_of_an_empty_target_selects_nothing(spark):
    stored = spark.createDataFrame([], "joined_time timestamp_ntz")
    with pytest.warns(UserWarning, match="no high-water mark"):
        mark = high_water_mark(stored, "joined_time")
    events = spark.createDataFrame([("2024-01-05 10:00:00",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    assert incremental_filter(events, "t", mark).count() == 0
    assert incremental_filter(events, "t", None).count() == 1


def test_mark_is_strict_and_exact_to_the_microsecond(spark):
    events = spark.sql(
        "SELECT * FROM VALUES (timestamp_ntz'2024-01-05 10:00:00.000001'), (timestamp_ntz'2024-01-05 10:00:00.000002') AS t(t)"
    )
    mark = high_water_mark(events.limit(1).orderBy("t"), "t")
    assert incremental_filter(events, "t", mark).count() == 1
    assert incremental_filter(events, "t", high_water_mark(events, "t")).count() == 0


def test_fact_columns_come_back_in_order(spark, workspace, log):
    from tests.conftest import joined

    table = workspace.table("games")
    create_fact(fct_games(log(joined("05 10:00"))), table, GAMES)
    assert read_fact(spark, table, GAMES).columns == list(GAMES.columns)


def test_a_second_writer_gets_an_error_and_the_first_one_ends(spark, workspace):
    table, new = workspace.table("items"), frame(spark, (1, "b", 6))
    create_fact(frame(spark, (1, "a", 5)), table, ITEMS)
    with only_writer(spark, qualified(spark, table)), pytest.raises(ConcurrentMerge, match="under way"):
        upsert_table(spark, table, new, ITEMS, workspace)
    assert rows(spark.table(table)) == [(1, "a", 5)]
    with pytest.raises(DuplicateKeys):
        upsert_table(spark, table, new.union(new), ITEMS, workspace)
    upsert_table(spark, table, new, ITEMS, workspace)  # neither error left a mark behind
    assert rows(spark.table(table)) == [(1, "b", 6)]
