import datetime as dt

import pytest
from pyspark.sql import functions as F

from matchledger.operators.spine import date_spine
from matchledger.operators.windows import forward_fill
from matchledger.plans import daily
from matchledger.schemas import DAILY
from matchledger.sources import demo
from tests.conftest import SF_DIR, bag, claimed, closed, day, finished, joined, purchase


def by_day(df, player=1):
    return {r.date_utc: r for r in df.filter(F.col("player_id") == player).collect()}


def test_carried_and_zeroed_columns(log):
    rows = by_day(
        daily.daily_player(
            log(
                joined("05 10:00", balance_before=100, entry_fee=10),
                finished("05 10:05", balance_before=90, play_duration=30),
                closed("05 10:20", position=0, reward=40, score=9),
                claimed("05 10:30", position=0, reward=40, score=9),
                purchase("05 11:00", price_usd=2.5, coins_claimed=100),
                purchase("08 11:00", price_usd=1.0, coins_claimed=50, player_id=2),
            )
        )
    )
    assert sorted(rows) == [day(5), day(6), day(7), day(8)]
    first, gap = rows[day(5)], rows[day(7)]
    assert (first.balance_day_start, first.balance_day_end) == (100, 90)
    assert (first.matches_played, first.total_matches_duration) == (1, 30)
    assert (first.coins_sink_tournaments, first.coins_source_tournaments) == (10, 40)
    assert (first.revenue, first.coins_source_purchases) == (2.5, 100)
    for c in daily.CARRIED:
        assert gap[c] == first[c]
    assert [gap[c] for c in daily.ZERO_FILLED] == [0, 0, 0.0, 0]


def test_a_day_without_matches_carries_the_metrics_it_lacks(log):
    rows = by_day(
        daily.daily_player(
            log(joined("05 10:00", balance_before=100, entry_fee=10), purchase("06 09:00", price_usd=1.0))
        )
    )
    second = rows[day(6)]
    assert (second.balance_day_start, second.matches_played) == (100, 1)
    assert second.coins_sink_tournaments == 0  # every active day has a sum of its own
    assert second.revenue == 1.0


def test_both_plan_forms_agree(log):
    events = log(
        joined("05 10:00", balance_before=1), closed("07 10:00", score=None), purchase("06 09:00", player_id=2),
        finished("09 10:00", balance_before=3, player_id=2), joined("08 10:00", player_id=3),
    )
    assert bag(daily.daily_player(events)) == bag(daily.forward_filled(events))
    assert bag(daily.daily_player(events)) == bag(daily.daily_player(events, ties="first"))


def test_tied_first_joins_multiply_the_day_but_not_the_gaps(log):
    events = log(
        joined("05 10:00", balance_before=100), joined("05 10:00", balance_before=200, room_id=11),
        purchase("07 10:00", player_id=2),
    )
    assert daily.balance_start(events).count() == 2
    assert daily.balance_start_dedup(events).count() == 1
    kept = daily.daily_player(events).filter("player_id = 1")
    assert [r["count"] for r in kept.groupBy("date_utc").count().orderBy("date_utc").collect()] == [2, 1, 1]
    single = daily.daily_player(events, ties="first").filter("player_id = 1")
    assert single.count() == 3


def test_equal_tied_rows_are_both_kept(log):
    events = log(joined("05 10:00", balance_before=100), joined("05 10:00", balance_before=100))
    assert daily.daily_player(events).count() == 2
    assert daily.daily_player(events).first().matches_played == 2


def test_streaks_as_written_count_the_day(log):
    wins = [closed("05 10:00", position=0, reward=40), closed("05 10:01", position=0, reward=40)]
    loss = closed("05 10:02", position=3, reward=None)
    events = log(*wins, loss, closed("05 10:03", position=0, reward=40))
    row = daily.daily_player(events).first()
    assert (row.max_reward_won_streak, row.max_losing_streak) == (3, 1)


def test_a_claim_counts_whether_paid_or_not(log):
    events = log(claimed("05 10:00"), claimed("05 10:01", reward=20), claimed("05 10:02", coins_claimed=5))
    row = daily.match_reward(events).first()
    assert (row.matches_won_reward, row.matches_claimed) == (3, 3)
    assert daily.matches_won_true(events).first().matches_won_reward == 2


def test_summary_counts_a_claimed_match_twice(log):
    events = log(closed("05 10:00", score=None, position=1), claimed("05 10:01", score=30, position=1))
    assert daily.match_summary(events).first().avg_score == 15.0
    assert daily.match_summary_closed_only(events).first().avg_score == 0.0


def test_a_player_without_an_id_has_no_metrics(log):
    rows = daily.daily_player(log(joined("05 10:00", player_id=None, balance_before=9), joined("06 10:00"))).filter(
        "player_id IS NULL"
    ).collect()
    assert len(rows) == 2
    for row in rows:
        assert all(row[c] is None for c in daily.CARRIED)
        assert all(row[c] == 0 for c in daily.ZERO_FILLED)


def test_zero_filled_carries_balances_only(log):
    rows = by_day(
        daily.daily_player_zero_filled(
            log(joined("05 10:00", balance_before=100, entry_fee=10), purchase("06 11:00", player_id=2))
        )
    )
    gap = rows[day(6)]
    assert gap.balance_day_start == 100
    assert (gap.matches_played, gap.coins_sink_tournaments, gap.max_score) == (0, 0, 0)


def test_mark_reaches_the_opening_balance_only(log):
    events = log(joined("05 10:00", balance_before=100), joined("06 10:00", balance_before=200))
    for ties in ("keep", "first"):
        rows = by_day(daily.daily_player(events, ties, F.lit("2024-01-05").cast("date")))
        assert (rows[day(5)].balance_day_start, rows[day(6)].balance_day_start) == (None, 200)
        assert rows[day(5)].matches_played == 1


def test_unknown_tie_rule_is_refused(log):
    with pytest.raises(ValueError):
        daily.daily_player(log(joined("05 10:00")), ties="last")


def test_spine_length_and_columns(spark):
    events = demo.game_events(spark, SF_DIR)
    last = events.agg(F.max("date_utc")).first()[0]
    expected = events.groupBy("player_id").agg(F.min("date_utc").alias("d")).select(
        F.sum(F.datediff(F.lit(last), "d") + 1)
    ).first()[0]
    assert date_spine(events).count() == expected
    assert daily.daily_player(events).count() == expected
    assert daily.daily_player(events).columns == list(DAILY.columns)


def test_fill_is_idempotent(spark):
    rows = [(1, dt.date(2024, 1, n), v) for n, v in enumerate([None, 4, None, None, 7, None], start=1)]
    df = spark.createDataFrame(rows, "player_id int, date_utc date, v int")
    once = forward_fill(df, ["player_id"], "date_utc", ["v"])
    assert [r.v for r in once.orderBy("date_utc").collect()] == [None, 4, 4, 4, 7, 7]
    assert bag(forward_fill(once, ["player_id"], "date_utc", ["v"])) == bag(once)


def test_tied_days_give_one_result_for_any_order_of_the_input(spark, log):
    events = [
        joined("05 10:00", room_id=2, balance_before=200), joined("05 10:00", room_id=1, balance_before=100),
        finished("05 11:00", room_id=2, balance_before=20), finished("05 11:00", room_id=1, balance_before=10),
        joined("08 10:00", balance_before=5),
    ]
    for ties in ("keep", "first"):
        one, other = log(*events), log(*reversed(events))
        results = [bag(daily.daily_player(e.coalesce(1), ties)) for e in (one, other)]
        results += [bag(daily.daily_player(e.repartition(3), ties)) for e in (one, other)]
        assert all(r == results[0] for r in results)
    assert bag(daily.forward_filled(one)) == bag(daily.forward_filled(other))
