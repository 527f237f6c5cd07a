"""A daily refresh that costs what arrived: single players' days, the index of days, marks from partitions."""

import datetime as dt
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from matchledger import schemas
from matchledger.operators import keydays
from matchledger.operators.watermark import partition_days, stored_high_water_mark
from matchledger.plans import daily, refresh as refreshing
from matchledger.plans.refresh import Inputs, refresh
from matchledger.sources.tables import write_event_log
from tests.conftest import bag, claimed, closed, day, finished, joined, purchase


def some_events(rng, n, days=range(1, 25), players=(1, 2, 3, 4, 5, 6, None)):
    made = []
    for _ in range(n):
        kind, player = rng.choice([joined, joined, finished, closed, claimed, purchase]), rng.choice(players)
        more = {"player_id": player, "balance_before": rng.randrange(100)} if kind is not purchase else {"player_id": player, "price_usd": 1.5}
        made.append(kind(f"{rng.choice(days):02d} {rng.randrange(24):02d}:{rng.choice([0, 30]):02d}", **more))
    return made


@pytest.mark.parametrize("seed", range(2))
@pytest.mark.parametrize("indexed", [False, True])
def test_several_arrivals_equal_a_full_build(spark, workspace, log, seed, indexed):
    rng = random.Random(seed)
    everything = some_events(rng, 40, range(5, 20))
    table, index = workspace.table("daily_player"), workspace.table("days") if indexed else None
    refresh(spark, "daily_player", table, Inputs(events=log(*everything), key_days=index), workspace)
    for days in (range(1, 20), range(10, 24), [3]):
        arrived = some_events(rng, rng.randrange(1, 6), days, (1, 2, 7, 8, None))
        everything += arrived
        inputs = Inputs(events=log(*everything), arrived=log(*arrived), key_days=index)
        out = refresh(spark, "daily_player", table, inputs, workspace, "reprocess", "keep_all")
        found, full = (Counter(map(str, bag(df.select("player_id", "date_utc", *sorted(set(df.columns) - set(schemas.DAY_KEYS)))))) for df in (out, daily.daily_player(log(*everything))))
        assert (found - full, full - found) == (Counter(), Counter())


def test_one_late_event_reads_and_writes_one_player(spark, workspace, log, monkeypatch):
    events = [joined(f"{d:02d} 10:00", player_id=p, balance_before=10 * p + d) for p in range(1, 6) for d in (2, 9, 16, 23)]
    late = [joined("05 12:00", player_id=3, balance_before=7)]
    stored_log, table, index = (workspace.table(n) for n in ("log", "daily_player", "days"))
    refresh(spark, "daily_player", table, Inputs(events=log(*events), key_days=index), workspace)
    everything = log(*events, *late)
    write_event_log(everything, stored_log)
    sources, logs = [], []
    real_upsert, real_redone = refreshing.merge_into, daily.segments_redone
    monkeypatch.setattr(refreshing, "merge_into", lambda spark, table, source, *a, **k: (sources.append(bag(source)), real_upsert(spark, table, source, *a, **k)))
    monkeypatch.setattr(daily, "segments_redone", lambda events, *a: (logs.append(events), real_redone(events, *a))[1])
    inputs = Inputs(events=spark.table(stored_log), arrived=log(*late), key_days=index)
    out = refresh(spark, "daily_player", table, inputs, workspace, "reprocess")
    assert bag(out) == bag(daily.daily_player(everything))
    # Player 3's days from the late one up to its next active day, and no others.
    days = [dict(zip(sorted(schemas.DAILY.columns), row, strict=True)) for row in sources[0]]
    assert {(r["player_id"], r["date_utc"]) for r in days} == {(3, day(d)) for d in range(5, 9)}
    assert "PartitionFilters: [isnotnull(date_utc" in logs[0]._jdf.queryExecution().executedPlan().toString()
    assert {r[0] for r in logs[0].select("date_utc").distinct().collect()} <= {day(d) for d in (2, 5, 9, 16, 23)}


def test_nothing_arrived(spark, workspace, log):
    events = log(joined("05 10:00"))
    table = workspace.table("daily_player")
    refresh(spark, "daily_player", table, Inputs(events=events), workspace)
    out = refresh(spark, "daily_player", table, Inputs(events=events, arrived=events.limit(0)), workspace, "reprocess")
    assert bag(out) == bag(daily.daily_player(events))


def test_index_holds_each_key_and_day_once(spark, workspace, log):
    keys, index = schemas.ROOM_KEYS, workspace.table("room_days")
    arrivals = [
        [joined("05 10:00"), joined("05 11:00"), joined("06 10:00", room_id=None)],
        [joined("05 12:00"), joined("07 10:00"), joined("06 11:00", room_id=None)],
        [joined("07 10:00"), joined("08 10:00", room_id=12)],
    ]
    for some in arrivals:
        keydays.record_days(spark, index, log(*some), keys, buckets=4)
    expected = bag(log(*[e for some in arrivals for e in some]).select(*keys, "date_utc").distinct())
    assert bag(spark.table(index)) == expected
    keydays.compact_days(spark, index, keys, workspace)
    assert bag(spark.table(index)) == expected
    assert len(spark.table(index).inputFiles()) <= 4
    touched = log(joined("01 10:00"), joined("01 10:00", room_id=None)).select(*keys).distinct()
    assert keydays.days_of(spark, index, touched, keys) == {day(5), day(6), day(7)}


def test_index_is_joined_without_a_shuffle(spark, workspace, log):
    keys, index = schemas.ROOM_KEYS, workspace.table("room_days")
    events = log(*[joined(f"{d:02d} 10:00", room_id=d) for d in range(1, 20)])
    keydays.record_days(spark, index, events, keys, buckets=4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        touched = workspace.stage(events.filter("room_id < 5").select(*keys).distinct(), "touched")[1]
        plan = keydays.key_days(spark.table(index), touched, keys)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    whole = plan[plan.index("SortMergeJoin"):].split("SortMergeJoin")[1]
    index_side = whole[: whole.index("FileScan")]
    assert "Bucketed: true" in whole and "Exchange" not in index_side


def test_marks_read_the_newest_partition_that_has_a_value(spark, workspace, log):
    table = workspace.table("marks")
    rows = [(dt.date(2024, 1, 1) + dt.timedelta(d), d if d < 25 else None) for d in range(28)] + [(None, 99)]
    spark.createDataFrame(rows, "date_utc date, seen int").write.partitionBy("date_utc").format("parquet").saveAsTable(table)
    assert partition_days(spark, table, "date_utc")[:2] == [day(28), day(27)]
    seen = stored_high_water_mark(spark, table, "seen", "date_utc")
    last = stored_high_water_mark(spark, table, "date_utc", "date_utc")
    assert spark.range(1).select(seen, last).first()[:] == (24, day(28))


def test_marks_of_an_empty_table(spark, workspace):
    table = workspace.table("marks")
    spark.createDataFrame([], "date_utc date, seen int").write.partitionBy("date_utc").format("parquet").saveAsTable(table)
    with pytest.warns(UserWarning, match="no high-water mark"):
        mark = stored_high_water_mark(spark, table, "seen", "date_utc")
    assert spark.range(1).select(F.isnull(mark)).first()[0]
