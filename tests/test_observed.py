"""Checks counted while writing agree with checks of the written table."""

import pytest
from pyspark.sql import functions as F

from matchledger.operators import quality as dq
from matchledger.operators.observed import ObservedChecks
from matchledger.operators.watermark import high_water_mark
from matchledger.plans import games, rooms
from matchledger.plans.refresh import FACTS, Inputs, refresh
from matchledger.schemas import GAMES
from matchledger.sources.tables import create_fact, read_fact
from tests.conftest import bag, finished, joined

LOG = [
    joined("05 10:00"), joined("05 11:00", player_id=None), joined("06 10:00", room_id=None),
    finished("06 10:05"), joined("07 10:00", player_id=None, room_id=None),
]


def nulls(table):
    return [c for c in dq.ALL_CHECKS[table] if isinstance(c, dq.NotNull)]


@pytest.mark.parametrize("name,build", [("fct_games", games.fct_games), ("fct_rooms", rooms.fct_rooms)])
def test_counts_of_a_first_build(spark, workspace, log, name, build):
    seen, table = ObservedChecks(), workspace.table(name)
    create_fact(seen.watch(build(log(*LOG)), name, dq.ALL_CHECKS[name]), table, FACTS[name])
    expected = dq.run_checks(read_fact(spark, table, FACTS[name]), name, nulls(name))
    assert bag(seen.results(spark)) == bag(expected)
    assert seen.results(spark).agg(F.sum("failures")).first()[0] > 0


@pytest.mark.parametrize("snapshots", [False, True])
def test_counts_of_refreshes(spark, workspace, log, snapshots):
    table = workspace.table("games")
    first, late = LOG[:3], LOG[3:]
    built, merged = ObservedChecks(), ObservedChecks()
    refresh(spark, GAMES.name, table, Inputs(events=log(*first)), workspace, snapshots=snapshots, checks=built)
    assert {r.column_name: r.failures for r in built.results(spark).collect()} == {"player_id": 1, "room_id": 1}
    out = refresh(
        spark, GAMES.name, table, Inputs(events=log(*LOG), arrived=log(*late)), workspace,
        late="reprocess", on_duplicate="keep_all", checks=merged,
    )
    # The late events are a join of the 7th and a submission of the match of the 5th.
    mark = high_water_mark(out, "date_utc")
    rewritten = out.filter((F.col("date_utc") == mark) | (F.col("date_utc") == F.lit("2024-01-05").cast("date")))
    assert bag(merged.results(spark)) == bag(dq.run_checks(rewritten, GAMES.name, nulls(GAMES.name)))


def test_a_table_without_checks_or_rows(spark, workspace, log):
    seen = ObservedChecks()
    plain = log(*LOG)
    assert seen.watch(plain, "plain", [dq.Unique("player_id")]) is plain
    assert seen.results(spark).count() == 0
    table = workspace.table("games")
    create_fact(seen.watch(games.fct_games(log()), "fct_games", dq.GAME_CHECKS), table, GAMES)
    assert [r.failures for r in seen.results(spark).collect()] == [0, 0]
