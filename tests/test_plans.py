"""The shape of the physical plans, over a stored log and with no broadcast."""

import re

import pytest

from matchledger.operators import streaks
from matchledger.operators.upsert import upsert_frame
from matchledger.plans import daily, games, roas, rooms
from matchledger.registry import all_queries
from matchledger.schemas import MATCH_KEYS
from matchledger.sources import demo, write_event_log
from tests.conftest import SF_DIR


@pytest.fixture(scope="module")
def stored(spark):
    from matchledger.session import Workspace

    workspace = Workspace(spark)
    table = workspace.table("events")
    write_event_log(demo.game_events(spark, SF_DIR), table)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield spark.table(table)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    workspace.drop()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text: str) -> int:
    return len(re.findall(r"Exchange hashpartitioning", text))


def scans(text: str) -> list[str]:
    return re.findall(r"FileScan parquet [^\n]*", text)


def test_games_shuffle_each_input_once(stored):
    text = plan(games.fct_games(stored))
    assert exchanges(text) == 4
    assert len(scans(text)) == 4
    # Each join has the column that spreads incomplete keys among its keys.
    assert len(re.findall(r"SortMergeJoin \[[^\]]*_spread[^\]]*\]", text)) == 3
    for scan in scans(text):
        assert "EqualTo(event_name," in scan
        assert "price_usd" not in scan


def test_claims_read_only_keys_and_time(stored):
    claim_scan = next(s for s in scans(plan(games.fct_games(stored))) if "tournamentRewardClaimed" in s)
    columns = re.search(r"\[([^\]]*)\]", claim_scan).group(1)
    assert {c.split("#")[0] for c in columns.split(",")} == {
        "event_name", "timestamp_utc", "player_id", "room_id", "tournament_id", "date_utc"
    }


def test_rooms_shuffle_aggregated_rows_only(stored):
    text = plan(rooms.fct_rooms(stored))
    # Five to aggregate and join, and the one that spreads the copies.
    assert exchanges(text) == 6
    assert text.count("REBALANCE_PARTITIONS_BY_COL") == 1
    # Ahead of each scan's shuffle there is a partial aggregation.
    assert len(re.findall(r"functions=\[partial_", text)) == 3


def test_rooms_of_one_row_take_one_pass(stored):
    text = plan(rooms.fct_rooms_dedup(stored))
    assert (exchanges(text), len(scans(text))) == (1, 1)


def test_daily_in_one_pass(stored):
    text = plan(daily.daily_player(stored, ties="first"))
    # By player-day, then by player; the second scan reads the partition column.
    assert exchanges(text) == 2
    assert len(scans(text)) == 2
    assert "ObjectHashAggregate" not in text and "SortAggregate" not in text


def test_ranks_are_limited_before_the_shuffle(stored):
    text = plan(daily.balance_start(stored))
    assert re.search(r"WindowGroupLimit.*Partial", text) and exchanges(text) == 1


def test_roas_over_a_stored_daily_fact_prunes_to_one_day(spark, stored, workspace):
    from matchledger.operators.watermark import high_water_mark
    from matchledger.schemas import DAILY
    from matchledger.sources.tables import create_fact, read_fact

    table = workspace.table("daily")
    create_fact(daily.daily_player(stored), table, DAILY)
    stored_daily = read_fact(spark, table, DAILY)
    latest = high_water_mark(stored_daily, "date_utc")
    df = roas.marketing_roas(stored_daily, demo.installs(spark, SF_DIR), demo.spend(spark, SF_DIR), latest)
    scan = next(s for s in scans(plan(df)) if ".daily[" in s)
    assert "date_utc" in re.search(r"PartitionFilters: \[([^\]]*)\]", scan).group(1)
    assert "matches_played" not in scan


def test_deduplicated_games_shuffle_each_input_once(stored):
    assert exchanges(plan(games.fct_games_dedup(stored))) == 4


def test_a_merge_shuffles_either_side_once(stored):
    text = plan(upsert_frame(stored.select(*MATCH_KEYS, "score"), stored.select(*MATCH_KEYS, "score"), MATCH_KEYS))
    assert exchanges(text) == 2


def test_streak_groups_order_the_rows_once(stored):
    text = plan(streaks.streak_groups(daily.win_loss_flags(stored)))
    assert len(scans(text)) == 2


def test_stored_checks_build_no_fact(spark):
    text = plan(all_queries()["dq_all"](spark, SF_DIR))
    assert "Join" not in text and "Window" not in text


CHEAP_TO_BUILD = [n for n in all_queries() if not re.search(r"incremental|roundtrip|streamed|late_fixed|dq_all", n)]


@pytest.mark.parametrize("name", CHEAP_TO_BUILD)
def test_no_cross_join_no_python(spark, name):
    text = plan(all_queries()[name](spark, SF_DIR))
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|Python|Pandas", text)
