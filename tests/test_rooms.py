from pyspark.sql import functions as F

from matchledger.operators.multiplicity import repeat_rows
from matchledger.plans.rooms import fct_rooms, fct_rooms_dedup
from matchledger.schemas import ROOMS
from tests.conftest import closed, finished, joined


def test_room_totals_and_flags(log):
    events = log(
        joined("05 10:00", entry_fee=10, players_capacity=2),
        joined("05 10:02", player_id=2, entry_fee=None, players_capacity=2),
        finished("05 10:10", play_duration=30, players_active_in_toom=2),
        finished("05 10:11", player_id=2, play_duration=None, players_active_in_toom=2),
        closed("05 10:30", reward=40),
        closed("05 10:20", player_id=2),
    )
    rows = fct_rooms(events).orderBy(F.asc_nulls_first("entry_fee")).collect()
    assert fct_rooms(events).columns == list(ROOMS.columns)
    assert [r.entry_fee for r in rows] == [None, 10]
    for r in rows:
        assert (r.total_coins_sink, r.total_coins_rewards, r.total_matches_duration) == (10, 40, 15.0)
        assert r.room_open_time.minute == 0 and r.room_close_time.minute == 30
        assert (r.room_open_duration, r.is_full, r.is_closed) == (30, True, True)


def test_one_row_per_join_and_player_count(log):
    same = [joined("05 10:00", players_capacity=5)] * 3
    ends = [finished("05 10:10", players_active_in_toom=n) for n in (3, 4, 4)]
    events = log(*same, *ends)
    assert fct_rooms(events).count() == 6
    only = fct_rooms_dedup(events).collect()
    assert len(only) == 1 and only[0].actual_players == 4


def test_open_room_without_capacity(log):
    row = fct_rooms(log(joined("05 10:00"), finished("05 10:10", players_active_in_toom=3))).first()
    assert (row.room_close_time, row.room_open_duration) == (None, None)
    assert (row.is_closed, row.is_full) == (False, False)


def test_duration_is_truncated_and_closes_after_45_minutes(log):
    def at(close):
        return fct_rooms(log(joined("05 10:00:30"), closed(close))).first()

    assert (at("05 10:46:29").room_open_duration, at("05 10:46:29").is_closed) == (45, False)
    assert (at("05 10:46:30").room_open_duration, at("05 10:46:30").is_closed) == (46, True)
    assert at("05 09:59:31").room_open_duration == 0


def test_rooms_without_a_key_keep_their_joins_only(log):
    events = log(
        joined("05 10:00", room_id=None, entry_fee=10), joined("05 10:01", room_id=None, entry_fee=10),
        closed("05 10:30", room_id=None),
    )
    rows = fct_rooms(events).collect()
    assert [(r.entry_fee, r.room_open_time, r.total_coins_sink, r.room_close_time) for r in rows] == [
        (10, None, None, None)
    ] * 2


def test_mark_limits_the_entries_not_the_totals(log):
    events = log(joined("05 10:00", entry_fee=10), joined("06 10:00", player_id=2, entry_fee=10))
    rows = fct_rooms(events, F.lit("2024-01-05 10:00:00").cast("timestamp_ntz")).collect()
    assert [(r.total_coins_sink, r.room_open_time.day) for r in rows] == [(20, 5)]


def test_copies_come_back_from_several_runs(spark):
    df = spark.createDataFrame([("a", 10), ("b", 1), ("c", 0), ("d", 7)], "k string, n bigint")
    counts = {r.k: r["count"] for r in repeat_rows(df, "n", ["k"], run_length=3).groupBy("k").count().collect()}
    assert counts == {"a": 10, "b": 1, "d": 7}
