import datetime as dt

import pytest

from matchledger import schemas
from matchledger.operators import quality as dq
from matchledger.plans import daily, roas
from tests.conftest import joined, purchase

SPEND = [("AdNetA", "C0", 4.0), ("AdNetA", "C0", 6.0), ("AdNetB", "C0", 5.0), ("AdNetB", "C0", -5.0)]


@pytest.fixture()
def inputs(spark, log):
    events = log(
        purchase("05 10:00", price_usd=8.0),
        purchase("20 10:00", price_usd=5.0),
        purchase("20 11:00", player_id=2, price_usd=2.0),
        purchase("20 11:00", player_id=3, price_usd=1.0),
        joined("20 12:00", player_id=4),
    )

    def d(n):
        return dt.date(2024, 1, n)

    installs = spark.createDataFrame(
        [
            (1, d(5), "AdNetA", "C0"), (2, d(13), "AdNetB", "C0"), (3, d(25), "Organic", "C0"),
            (4, dt.date(2023, 1, 1), "AdNetA", "C0"), (9, d(13), "AdNetA", "C0"),
        ],
        schemas.INSTALLS,
    )
    return daily.daily_player(events), installs, spark.createDataFrame(SPEND, schemas.SPEND)


def result(df):
    return {(r.media_source, r.install_date.day, r.cohort_period): r.roas for r in df.collect()}


def test_latest_day_bands_and_null_ratios(inputs):
    got = result(roas.marketing_roas(*inputs))
    # Player 4 is older than 90 days, player 9 has no days, 13 has a spend of zero.
    assert got == {("AdNetA", 5, "D30"): 0.5, ("AdNetB", 13, "D7"): None, ("Organic", 25, "D7"): None}


def test_running_revenue_is_that_of_the_latest_day(inputs):
    rows = {r.player_id: r.cumulative_revenue for r in roas.cumulative_revenue(inputs[0], inputs[1]).collect()}
    assert rows == {1: 5.0, 2: 2.0, 3: 1.0, 4: 0.0}


def test_cumulative_periods_are_nested(inputs):
    got = result(roas.roas_cumulative(*inputs))
    assert [got[("AdNetA", 5, p)] for p in ("D7", "D14", "D30", "D90")] == [0.8, 0.8, 1.3, 1.3]
    assert got[("AdNetA", 13, "D7")] == 0.0
    assert got[("Organic", 25, "D90")] is None
    assert len(got) == 5 * 4


def test_cohorts_of_a_hot_source_are_summed_before_the_join(inputs):
    plan = roas.marketing_roas(*inputs)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join LeftOuter") < plan.index("sum(cumulative_revenue")


def test_paid_cohorts_without_ratio_are_reported(inputs):
    failing = dq.failing_rows(roas.marketing_roas(*inputs), dq.PAID_ROAS_CHECK).collect()
    assert [r.media_source for r in failing] == ["AdNetB"]


def test_checks_count_failures(spark):
    installs = spark.createDataFrame(
        [(1, dt.date(2024, 1, 1), "a", "b"), (1, None, "a", "b"), (None, None, "a", "b"), (None, dt.date(2024, 1, 1), "a", "b")],
        schemas.INSTALLS,
    )
    rows = dq.run_checks(installs, "installs_attribution", dq.INSTALL_CHECKS).collect()
    assert {(r.column_name, r.test): r.failures for r in rows} == {
        ("player_id", "not_null"): 2, ("install_date", "not_null"): 2, ("player_id", "unique"): 1,
    }
    assert dq.failing_rows(installs, dq.Unique("player_id")).collect()[0].n_records == 2


def test_event_name_check(log):
    rows = dq.run_checks(log(joined("05 10:00"), {"at": "05 11:00"}), "events", dq.EVENT_CHECKS).collect()
    assert {r.column_name: r.failures for r in rows} == {"event_name": 1, "timestamp_utc": 0}
