import warnings

import pytest
from pyspark.sql import functions as F

from matchledger import schemas
from matchledger.plans import daily, games, rooms
from matchledger.plans.refresh import Inputs, refresh
from matchledger.session import Workspace, shared_folder
from matchledger.sources import demo, read_events, write_event_log
from matchledger.streaming.hourly import keep_current
from tests.conftest import SF_DIR, bag, claimed, closed, day, finished, joined, purchase


def two_runs(spark, workspace, name, first, all_events, **options):
    table = workspace.table(name)
    refresh(spark, name, table, Inputs(events=first), workspace)
    return refresh(spark, name, table, Inputs(events=all_events), workspace, **options)


FIRST = [
    joined("05 10:00", balance_before=100, players_capacity=2),
    joined("05 10:01", player_id=2, balance_before=50, players_capacity=2),
    joined("05 10:02", player_id=3, tournament_id=None),
]
LATER = [
    finished("06 10:00", play_duration=9, players_active_in_toom=2),
    closed("06 10:10", position=0, reward=40),
    claimed("06 10:20"),
    joined("06 11:00", player_id=4, room_id=11, balance_before=70),
    joined("06 11:01", player_id=5, tournament_id=None),
]


def test_as_written_games_never_see_a_late_finish(spark, workspace, log):
    out = two_runs(spark, workspace, "fct_games", log(*FIRST), log(*FIRST, *LATER))
    got = {r.player_id: r for r in out.collect()}
    assert sorted(got) == [1, 2, 3, 4, 5]
    assert got[1].submit_time is None


def test_reprocessed_games_equal_a_full_build(spark, workspace, log):
    everything = log(*FIRST, *LATER)
    out = two_runs(spark, workspace, "fct_games", log(*FIRST), everything, late="reprocess", on_duplicate="keep_all")
    assert bag(out) == bag(games.fct_games(everything))


def test_reprocessed_rooms_equal_a_full_build(spark, workspace, log):
    everything = log(*FIRST, *LATER)
    out = two_runs(spark, workspace, "fct_rooms", log(*FIRST), everything, late="reprocess", on_duplicate="keep_all")
    assert bag(out) == bag(rooms.fct_rooms(everything))


def test_as_written_daily_loses_old_opening_balances(spark, workspace, log):
    out = two_runs(spark, workspace, "daily_player", log(*FIRST), log(*FIRST, *LATER))
    got = {(r.player_id, r.date_utc): r for r in out.collect()}
    assert got[(1, day(5))].balance_day_start is None
    assert got[(4, day(6))].balance_day_start == 70


@pytest.mark.parametrize("cut", [1, 2, 3])
def test_continued_daily_equals_a_full_build(spark, workspace, log, cut):
    events = [*FIRST, purchase("05 12:00", price_usd=1.0), purchase("08 09:00", price_usd=2.0), *LATER, joined("07 10:00", player_id=6)]
    everything = log(*events)
    first = everything.filter(F.col("date_utc") <= F.lit(f"2024-01-{4 + cut:02d}").cast("date"))
    out = two_runs(spark, workspace, "daily_player", first, everything, late="reprocess")
    assert bag(out) == bag(daily.daily_player(everything))


def test_daily_is_redone_from_a_day_with_late_events(spark, workspace, log):
    on_time = [joined("05 10:00", balance_before=100), purchase("06 09:00", player_id=2, price_usd=1.0),
               joined("08 10:00", balance_before=70)]
    late = [joined("06 08:00", balance_before=90), purchase("07 08:00", player_id=3, price_usd=2.0)]
    everything = log(*on_time, *late, finished("09 10:00", balance_before=60))
    out = two_runs(
        spark, workspace, "daily_player", log(*on_time), everything, late="reprocess", redo_from=day(6)
    )
    assert bag(out) == bag(daily.daily_player(everything))


@pytest.mark.parametrize(("name", "full"), [("fct_games", games.fct_games), ("fct_rooms", rooms.fct_rooms)])
def test_events_that_come_in_late_are_seen_whatever_their_time(spark, workspace, log, name, full):
    """Earlier than what is stored, and with a join from the future already there."""
    first = [*FIRST, joined("20 10:00", player_id=9, room_id=99)]
    late = [finished("05 11:00", play_duration=9, players_active_in_toom=2), joined("04 09:00", player_id=8, room_id=12)]
    everything = log(*first, *late)
    table = workspace.table(name)
    refresh(spark, name, table, Inputs(events=log(*first)), workspace)
    out = refresh(
        spark, name, table, Inputs(events=everything, arrived=log(*late)), workspace, "reprocess", "keep_all"
    )
    assert bag(out) == bag(full(everything))


@pytest.mark.parametrize(("name", "full"), [("fct_games", games.fct_games), ("fct_rooms", rooms.fct_rooms)])
def test_an_index_of_days_prunes_log_and_target(spark, workspace, log, name, full, monkeypatch):
    """Among them a match whose events lie twenty days apart."""
    from matchledger.operators import upsert

    first = [*FIRST, *[joined(f"{d:02d} 10:00", player_id=d, room_id=100 + d) for d in range(6, 25)]]
    late = [claimed("25 10:00"), finished("10 11:00", player_id=10, room_id=110)]
    table, key_days = workspace.table(name), workspace.table("key_days")
    stored_log = workspace.table("log")
    write_event_log(log(*first, *late), stored_log)
    everything = read_events(spark, stored_log)
    refresh(spark, name, table, Inputs(events=log(*first), key_days=key_days), workspace)
    plans = []
    plain = upsert.merge_into

    def seen(spark, table, source, *args, **options):
        plans.append((source._jdf.queryExecution().executedPlan().toString(), options["within"]))
        return plain(spark, table, source, *args, **options)

    monkeypatch.setattr("matchledger.plans.refresh.merge_into", seen)
    inputs = Inputs(events=everything, arrived=log(*late), key_days=key_days)
    out = refresh(spark, name, table, inputs, workspace, "reprocess", "keep_all")
    assert bag(out) == bag(full(log(*first, *late)))
    (text, within), = plans
    import re

    of_log = [s for s in re.findall(r"FileScan parquet [^\n]*", text) if ".log[" in s]
    assert of_log and all("date_utc" in re.search(r"PartitionFilters: \[([^\]]*)\]", s).group(1) for s in of_log)
    assert within == {day(5), day(10), day(25), None}
    # Once more, as after a failure.
    again = refresh(spark, name, table, inputs, workspace, "reprocess", "keep_all")
    assert bag(again) == bag(full(log(*first, *late)))


def test_an_index_of_days_has_to_be_complete(spark, workspace, log):
    events, table = log(joined("05 10:00")), workspace.table("fct_games")
    refresh(spark, "fct_games", table, Inputs(events=events), workspace)
    for inputs in (Inputs(events=events, key_days="no_days"), Inputs(events=events, arrived=events, key_days="no_days")):
        with pytest.raises(ValueError, match="key_days"):
            refresh(spark, "fct_games", table, inputs, workspace, "reprocess")


@pytest.mark.parametrize(("name", "full"), [("fct_games", games.fct_games), ("fct_rooms", rooms.fct_rooms)])
def test_redo_from_a_day_sees_its_late_events(spark, workspace, log, name, full):
    late = [finished("05 11:00", play_duration=9, players_active_in_toom=2)]
    everything = log(*FIRST, joined("08 10:00", player_id=7, room_id=13), *late)
    first = log(*FIRST, joined("08 10:00", player_id=7, room_id=13))
    unseen = two_runs(spark, workspace, name, first, everything, late="reprocess", on_duplicate="keep_all")
    assert bag(unseen) != bag(full(everything))
    out = refresh(
        spark, name, workspace.table(name), Inputs(events=everything), workspace, "reprocess", "keep_all", redo_from=day(5)
    )
    assert bag(out) == bag(full(everything))


def test_daily_is_redone_from_the_first_day_that_came_in(spark, workspace, log):
    late = [joined("06 08:00", balance_before=90), purchase("07 08:00", player_id=3, price_usd=2.0)]
    on_time = [joined("05 10:00", balance_before=100), joined("08 10:00", balance_before=70)]
    everything = log(*on_time, *late)
    table = workspace.table("daily_player")
    refresh(spark, "daily_player", table, Inputs(events=log(*on_time)), workspace)
    out = refresh(spark, "daily_player", table, Inputs(events=everything, arrived=log(*late)), workspace, "reprocess")
    assert bag(out) == bag(daily.daily_player(everything))


def test_rules_for_late_events_need_reprocessing(spark, workspace, log):
    events = log(joined("05 10:00"))
    with pytest.raises(ValueError, match="reprocess"):
        refresh(spark, "fct_games", "t", Inputs(events=events), workspace, redo_from=day(5))
    with pytest.raises(ValueError, match="reprocess"):
        refresh(spark, "fct_games", "t", Inputs(events=events, arrived=events), workspace)


def test_only_the_table_of_the_current_database_is_written(spark, workspace, log):
    """A table of the same name in the default database is left alone."""
    elsewhere, everything = log(joined("01 10:00", player_id=77)), log(*FIRST, *LATER)
    database = spark.catalog.currentDatabase()
    spark.sql("USE default")
    games.fct_games(elsewhere).write.saveAsTable("same_name_games")
    before = bag(spark.table("default.same_name_games"))
    try:
        spark.sql(f"USE {workspace.database}")
        for events in (log(*FIRST), everything):
            out = refresh(spark, "fct_games", "same_name_games", Inputs(events=events), workspace, "reprocess", "keep_all")
        assert bag(out) == bag(games.fct_games(everything))
        assert bag(spark.table(f"{workspace.database}.same_name_games").select(*out.columns)) == bag(out)
        assert bag(spark.table("default.same_name_games")) == before
    finally:
        spark.sql(f"USE {database}")
        spark.sql("DROP TABLE IF EXISTS default.same_name_games")


def test_a_view_is_not_refreshed(spark, workspace, log):
    games.fct_games(log(*FIRST)).createOrReplaceTempView("a_view_of_games")
    with pytest.raises(ValueError, match="not a stored table"):
        refresh(spark, "fct_games", "a_view_of_games", Inputs(events=log(*FIRST)), workspace)
    spark.catalog.dropTempView("a_view_of_games")


@pytest.fixture()
def zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    yield lambda name: spark.conf.set("spark.sql.session.timeZone", name)
    spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("name", ["fct_games", "fct_rooms"])
def test_zoned_times_give_one_table_in_any_session_zone(spark, workspace, zone, name):
    """Across midnight UTC, and in the hour that New York has twice."""
    times = ["2024-11-03 05:30:00", "2024-11-03 06:30:00", "2024-11-03 23:30:00", "2024-11-04 00:30:00"]
    row = "{p}, '{n}', timestamp_seconds({s}), DATE'{d}', {r}, 3"

    def events(upto: int):
        import calendar
        import time

        rows = []
        for i, t in enumerate(times[:upto]):
            seconds = calendar.timegm(time.strptime(t, "%Y-%m-%d %H:%M:%S"))
            for kind, offset in ((schemas.JOINED, 0), (schemas.FINISHED, 60)):
                rows.append("(" + row.format(p=i, n=kind, s=seconds + offset, d=t[:10], r=10 + i) + ")")
        df = spark.sql(f"SELECT * FROM VALUES {', '.join(rows)} AS e(player_id, event_name, timestamp_utc, date_utc, room_id, tournament_id)")
        missing = [f for f in schemas.EVENTS.fields if f.name not in df.columns]
        return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing]).select(*schemas.EVENTS.names)

    found = []
    for k, session_zone in enumerate(("UTC", "Asia/Tokyo", "America/New_York")):
        zone(session_zone)
        table = workspace.table(f"{name}_{k}")
        for late in ("as_written", "reprocess"):
            spark.sql(f"DROP TABLE IF EXISTS {table}")
            refresh(spark, name, table, Inputs(events=events(1)), workspace)
            out = refresh(spark, name, table, Inputs(events=events(4)), workspace, late, "keep_all")
            times_out = [c for c, t in out.dtypes if t == "timestamp"]
            exact = out.select(*[F.unix_micros(c).alias(c) if c in times_out else F.col(c) for c in out.columns])
            parts = sorted(r[0] for r in spark.sql(f"SHOW PARTITIONS {table}").collect())
            found.append((bag(exact), parts))
    assert all(f == found[0] for f in found)
    assert len(found[0][0]) == 4 and len(found[0][1]) == 2


def test_empty_target_loads_nothing_as_written(spark, workspace, log):
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        out = two_runs(spark, workspace, "fct_games", log(joined("05 10:00")).limit(0), log(joined("05 10:00")))
    assert out.count() == 0


def test_unknown_late_rule_is_refused(spark, workspace, log):
    with pytest.raises(ValueError):
        refresh(spark, "fct_games", "t", Inputs(events=log(joined("05 10:00"))), workspace, late="maybe")


@pytest.mark.parametrize("name", ["fct_games", "fct_rooms"])
def test_stream_in_several_batches_equals_a_full_build(spark, workspace, tmp_path, name):
    raw = demo.raw_events(spark, SF_DIR)
    # By id modulo, so that every batch brings events of matches seen before.
    for i in range(3):
        raw.filter(F.col("event_id") % 3 == i).coalesce(1).write.parquet(f"{tmp_path}/in/{i}")
    stream = (
        spark.readStream.schema(demo.RAW_EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    )
    query = keep_current(
        spark, demo.game_log(stream), lambda: demo.game_events(spark, SF_DIR), name,
        workspace.table(name), workspace, f"{tmp_path}/checkpoint", workspace.table("key_days"),
    )
    query.awaitTermination()
    assert query.lastProgress is not None and query.lastProgress["batchId"] >= 2
    full = {"fct_games": games.fct_games, "fct_rooms": rooms.fct_rooms}[name](demo.game_events(spark, SF_DIR))
    fact_columns = full.columns
    assert bag(spark.table(workspace.table(name)).select(*fact_columns)) == bag(full)


def test_stream_replaces_joins_without_a_key(spark, workspace, log, tmp_path):
    """Such joins are merged as a group, so a repeated batch cannot add them twice."""
    everything = log(*FIRST, *LATER)
    log(*FIRST).coalesce(1).write.parquet(f"{tmp_path}/in/0")
    log(*LATER, FIRST[2]).coalesce(1).write.parquet(f"{tmp_path}/in/1")
    stream = spark.readStream.schema(schemas.EVENTS).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
    for name, full in (("fct_games", games.fct_games), ("fct_rooms", rooms.fct_rooms)):
        table = workspace.table(name)
        keep_current(
            spark, stream, lambda: everything, name, table, workspace, f"{tmp_path}/checkpoint_{name}"
        ).awaitTermination()
        expected = full(everything)
        assert bag(spark.table(table).select(*expected.columns)) == bag(expected)


def test_event_log_table_is_partitioned_and_readable(spark, workspace):
    events = demo.game_events(spark, SF_DIR)
    table = workspace.table("log")
    write_event_log(events, table)
    stored = read_events(spark, table)
    assert stored.count() == events.count()
    assert bag(games.fct_games(stored)) == bag(games.fct_games(events))
    one_day = stored.filter(F.col("date_utc") == F.lit("2024-01-05").cast("date"))
    assert "PartitionFilters: [isnotnull(date_utc" in one_day._jdf.queryExecution().executedPlan().toString()


def test_missing_and_mistyped_columns_fail_early(spark, tmp_path):
    events = demo.game_events(spark, SF_DIR)
    events.drop("score").write.parquet(f"{tmp_path}/short")
    with pytest.raises(ValueError, match="missing columns: score"):
        read_events(spark, f"{tmp_path}/short")
    with pytest.raises(ValueError, match="date_utc is string"):
        schemas.conform(events.withColumn("date_utc", F.col("date_utc").cast("string")), schemas.EVENTS)
    extra = schemas.conform(events.withColumn("more", F.lit(1)), schemas.EVENTS)
    assert extra.columns == schemas.EVENTS.names


def test_workspace_lies_in_the_shared_folder(spark):
    workspace = Workspace(spark)
    described = {r.info_name: r.info_value for r in spark.sql(f"DESCRIBE DATABASE {workspace.database}").collect()}
    assert shared_folder(spark).removeprefix("file://") in described["Location"]
