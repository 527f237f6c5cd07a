"""Ordered operators against a plain Python walk over small groups."""

import datetime as dt
import random
from itertools import groupby

import pytest

from matchledger.operators import streaks

SCHEMA = "player_id bigint, date_utc date, timestamp_utc timestamp_ntz, is_win int, is_loss int"


def make(seed: int, n: int = 120):
    rng = random.Random(seed)
    rows = []
    for player in (1, 2, None):
        at = dt.datetime(2024, 1, 5)
        for _ in range(n if player == 1 else 15):
            at += dt.timedelta(seconds=rng.choice([0, 1, 20, 70, 400]))
            rows.append((player, dt.date(2024, 1, 5), at, int(rng.random() < 0.6), int(rng.random() < 0.3)))
    rng.shuffle(rows)
    return rows


def groups(rows):
    for player in (1, 2, None):
        yield player, sorted((r for r in rows if r[0] == player), key=lambda r: (r[2], r[3], r[4]))


def longest(flags):
    return max((sum(run) for hit, run in groupby(flags) if hit), default=0)


@pytest.mark.parametrize("slice_seconds", [1, 60, 86400])
@pytest.mark.parametrize("seed", [1, 2])
def test_order_and_previous_flags(spark, seed, slice_seconds):
    rows = make(seed)
    out = streaks.ordered_flags(spark.createDataFrame(rows, SCHEMA), slice_seconds).collect()
    for player, ordered in groups(rows):
        got = sorted((r for r in out if r.player_id == player), key=lambda r: r.event_order)
        assert [r.event_order for r in got] == list(range(1, len(ordered) + 1))
        assert [(r.timestamp_utc, r.is_win, r.is_loss) for r in got] == [r[2:] for r in ordered]
        assert [r.previous_is_win for r in got] == [0] + [r[3] for r in ordered[:-1]]
        assert [r.previous_is_loss for r in got] == [0] + [r[4] for r in ordered[:-1]]


@pytest.mark.parametrize("slice_seconds", [1, 60, 86400])
@pytest.mark.parametrize("seed", [3, 4, 5])
def test_longest_runs(spark, seed, slice_seconds):
    rows = make(seed)
    out = {r.player_id: r for r in streaks.true_streaks(spark.createDataFrame(rows, SCHEMA), slice_seconds).collect()}
    for player, ordered in groups(rows):
        assert out[player].max_reward_won_streak == longest([r[3] for r in ordered])
        assert out[player].max_losing_streak == longest([r[4] for r in ordered])


@pytest.mark.parametrize("slice_seconds", [30, 86400])
def test_groups_hold_the_changes_of_the_day(spark, slice_seconds):
    rows = make(6)
    out = streaks.streak_groups(spark.createDataFrame(rows, SCHEMA), slice_seconds).collect()
    assert len(out) == len(rows)
    for player, ordered in groups(rows):
        wins = [0] + [r[3] for r in ordered]
        losses = [0] + [r[4] for r in ordered]
        changes = [sum(a != b for a, b in zip(f, f[1:])) for f in (wins, losses)]
        assert {(r.win_streak_group, r.loss_streak_group) for r in out if r.player_id == player} == {tuple(changes)}


def test_three_wins_of_which_two_in_a_row(spark):
    at = dt.datetime(2024, 1, 5, 10)
    rows = [
        (1, at.date(), at + dt.timedelta(minutes=m), win, 1 - win) for m, win in enumerate([1, 1, 0, 1])
    ]
    row = streaks.true_streaks(spark.createDataFrame(rows, SCHEMA)).first()
    assert (row.max_reward_won_streak, row.max_losing_streak) == (2, 1)


def test_rows_without_a_time_stay_and_come_first(spark):
    at = dt.datetime(2024, 1, 5, 10)
    rows = [(1, at.date(), None, 1, 0), (1, at.date(), at, 0, 1), (1, at.date(), None, 0, 0), (2, at.date(), None, 1, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = {(r.player_id, r.event_order): r for r in streaks.ordered_flags(df).collect()}
    assert sorted(out) == [(1, 1), (1, 2), (1, 3), (2, 1)]
    assert [out[(1, k)].timestamp_utc for k in (1, 2, 3)] == [None, None, at]
    assert [out[(1, k)].previous_is_win for k in (1, 2, 3)] == [0, 0, 1]
    groups = streaks.streak_groups(df).collect()
    assert sorted((r.player_id, r.win_streak_group, r.loss_streak_group) for r in groups) == [(1, 2, 1)] * 3 + [(2, 1, 0)]
    longest_wins = {r.player_id: r.max_reward_won_streak for r in streaks.true_streaks(df).collect()}
    assert longest_wins == {1: 1, 2: 1}


def test_zoned_timestamps_give_the_same_order(spark):
    rows = make(7, n=30)
    plain = spark.createDataFrame(rows, SCHEMA)
    zoned = plain.withColumn("timestamp_utc", plain.timestamp_utc.cast("timestamp"))
    columns = ["player_id", "is_win", "is_loss", "event_order", "previous_is_win"]
    a = streaks.ordered_flags(plain).select(*columns).collect()
    b = streaks.ordered_flags(zoned).select(*columns).collect()
    assert sorted(map(repr, a)) == sorted(map(repr, b))
