import pytest
from pyspark.sql import functions as F

from matchledger import schemas
from matchledger.operators import joins as joins_module
from matchledger.plans.games import claims, fct_games, fct_games_dedup, fct_games_split, joins
from matchledger.schemas import GAMES, MATCH_KEYS
from matchledger.sources import demo
from tests.conftest import SF_DIR, bag, claimed, closed, finished, joined


def test_whole_match(log):
    events = log(
        joined("05 10:00", balance_before=100, entry_fee=10, players_capacity=5),
        finished("05 10:05", play_duration=60, score=7, players_active_in_toom=4),
        closed("05 10:20", balance_before=90, position=0, reward=40, score=8),
        claimed("05 10:30"),
    )
    row = fct_games(events).first()
    assert fct_games(events).columns == list(GAMES.columns)
    assert (row.score, row.position, row.reward) == (8, 0, 40)
    assert row.balance_after_claim == 130
    assert row.actual_players_in_room == 4
    assert row.did_claim_reward is True


def test_missing_steps_are_null_and_unclaimed(log):
    row = fct_games(log(joined("05 10:00"))).first()
    assert row.did_claim_reward is False
    assert (row.submit_time, row.room_close_time, row.reward, row.score) == (None,) * 4


def test_score_and_reward_fall_back(log):
    row = fct_games(
        log(
            joined("05 10:00"),
            finished("05 10:05", score=7),
            closed("05 10:20", balance_before=90, coins_claimed=5),
        )
    ).first()
    assert (row.score, row.reward, row.balance_after_claim) == (7, 5, 95)


def test_repeated_claims_multiply_and_dedup_keeps_the_first(log):
    events = log(joined("05 10:00"), claimed("05 10:30"), claimed("05 10:31"))
    assert fct_games(events).count() == 2
    only = fct_games_dedup(events).collect()
    assert len(only) == 1 and only[0].claim_time.minute == 30


def test_null_keys_match_nothing_and_are_all_kept(log):
    keyless = [joined(f"05 10:{m:02d}", tournament_id=None) for m in range(20)]
    events = log(*keyless, claimed("05 11:00", tournament_id=None))
    rows = fct_games(events).collect()
    assert len(rows) == 20
    assert not any(r.did_claim_reward for r in rows)
    assert fct_games_dedup(events).count() == 20


def test_null_keys_are_spread_over_partitions(spark, log):
    from matchledger.operators.joins import spread
    from matchledger.schemas import MATCH_KEYS

    df = spread(joins(log(*[joined(f"05 10:{m:02d}", room_id=None) for m in range(30)])), MATCH_KEYS)
    assert df.select("_spread").distinct().count() == 30
    whole = spread(joins(log(joined("05 10:00"), joined("05 10:01"))), MATCH_KEYS)
    assert {r[0] for r in whole.select("_spread").collect()} == {0}


def test_key_columns_may_be_text(log):
    events = log(joined("05 10:00"), claimed("05 10:30")).withColumns(
        {c: F.col(c).cast("string") for c in ("player_id", "room_id", "tournament_id")}
    )
    assert fct_games(events).first().did_claim_reward is True


def test_only_joins_know_the_mark(log):
    events = log(
        joined("05 10:00"), joined("06 10:00", room_id=11), finished("05 10:05"), finished("04 09:00", room_id=11)
    )
    since = F.lit("2024-01-05 10:00:00").cast("timestamp_ntz")
    rows = fct_games(events, since).collect()
    assert [r.room_id for r in rows] == [11]
    assert rows[0].submit_time is not None


@pytest.fixture()
def eager_skew_splitting(spark):
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def _typed(spark, name, player):
    """30000 events of one type; `player` is an expression over `id`."""
    given = spark.range(0, 30000, numPartitions=6).selectExpr(
        f"'{name}' AS event_name",
        "timestampadd(SECOND, id, timestamp_ntz'2024-01-05 00:00:00') AS timestamp_utc",
        f"{player} AS player_id", "10L AS room_id", "3L AS tournament_id",
        "hash(id) + 0L AS balance_before", "DATE'2024-01-05' AS date_utc",
    )
    return spark.createDataFrame([], schemas.EVENTS).unionByName(given, allowMissingColumns=True)


def test_a_match_with_a_third_of_the_joins_is_split(spark, eager_skew_splitting):
    """The adaptive skew join cuts the hot partition in every join of the chain."""
    events = _typed(spark, schemas.JOINED, "if(id % 3 = 0, 0, id)")
    for name in (schemas.FINISHED, schemas.ROOM_CLOSED, schemas.REWARD_CLAIMED):
        events = events.unionByName(_typed(spark, name, "id").filter("player_id < 25000"))
    df = fct_games(events)
    rows = df.collect()
    assert len(rows) == 30000
    assert sum(r.did_claim_reward for r in rows) == 10000 + sum(1 for i in range(25000) if i % 3)
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("SortMergeJoin(skew=true)") == 3


def test_a_match_with_a_third_of_the_claims_is_cut_into_lanes(spark, workspace):
    claims_of = _typed(spark, schemas.REWARD_CLAIMED, "if(id % 3 = 0, 0, id)")
    events = claims_of
    for name in (schemas.JOINED, schemas.FINISHED, schemas.ROOM_CLOSED):
        events = events.unionByName(_typed(spark, name, "id").filter("player_id < 900"))
    laned = joins_module.repeated_keys([claims(events)], MATCH_KEYS, 500)
    assert [(r.player_id, r["_side"], r["_lanes"]) for r in laned.collect()] == [(0, 0, 20)]
    staged = []
    split = fct_games_split(events, workspace, limit=500, staged=staged)
    assert split.count() == 900 - 1 + 10000
    assert bag(split) == bag(fct_games(events))
    assert len(staged) == 1
    # The copies of the one join are in as many lanes, none of which holds much of the result.
    rows = joins_module.laned_left_joins(joins(events), [claims(events)], MATCH_KEYS, laned)
    assert rows.filter("player_id = 0").count() == 10000
    workspace.release(*staged)
    assert spark.sql(f"SHOW TABLES IN {workspace.database}").isEmpty()


@pytest.mark.parametrize("limit", [1, 2, 1000])
def test_lanes_change_nothing_over_the_whole_log(spark, workspace, limit):
    events = demo.game_events(spark, SF_DIR)
    assert bag(fct_games_split(events, workspace, limit)) == bag(fct_games(events))


@pytest.mark.parametrize("limit", [1, 2, 100])
def test_lanes_agree_with_the_plain_join(log, workspace, limit):
    events = log(
        joined("05 10:00"), joined("05 10:01", player_id=2), joined("05 10:02", tournament_id=None),
        joined("05 10:03"), joined("05 10:04", player_id=5),
        finished("05 10:05", score=1), finished("05 10:06", score=2), finished("05 10:07", score=3),
        claimed("05 10:30"), claimed("05 10:31"), claimed("05 10:30", player_id=3), claimed("05 10:30", tournament_id=None),
        closed("05 10:20", player_id=2), closed("05 10:21", player_id=2), closed("05 10:22", player_id=2),
    )
    assert fct_games(events).count() == 2 * 3 * 2 + 3 + 1 + 1
    assert bag(fct_games_split(events, workspace, limit)) == bag(fct_games(events))


def test_no_match_is_cut_where_none_repeats(spark, workspace, log):
    events = log(joined("05 10:00"), claimed("05 11:00"))
    staged = []
    assert bag(fct_games_split(events, workspace, staged=staged)) == bag(fct_games(events))
    assert staged == [] and spark.sql(f"SHOW TABLES IN {workspace.database}").isEmpty()


def test_refreshes_cut_matches_into_lanes(spark, workspace, log, monkeypatch):
    from matchledger.plans import games
    from matchledger.plans.refresh import Inputs, refresh

    plain = games.split_lifecycle
    monkeypatch.setattr(games, "split_lifecycle", lambda *args: plain(*args[:4], 5))
    seen = []
    laned = games.laned_left_joins
    monkeypatch.setattr(games, "laned_left_joins", lambda *args: seen.append(1) or laned(*args))
    first = [joined("05 10:00"), joined("05 10:05", player_id=2), *[claimed(f"05 11:{i:02d}") for i in range(20)]]
    later = [finished("06 10:00", play_duration=3), claimed("06 10:01", player_id=2)]
    for late in ("as_written", "reprocess"):
        table = workspace.table(f"games_{late}")
        refresh(spark, "fct_games", table, Inputs(events=log(*first)), workspace)
        out = refresh(spark, "fct_games", table, Inputs(events=log(*first, *later)), workspace, late, "keep_all")
        expected = fct_games(log(*first, *later) if late == "reprocess" else log(*first))
        assert bag(out) == bag(expected)
    assert len(seen) >= 3
    assert {r.tableName for r in spark.sql(f"SHOW TABLES IN {workspace.database}").collect()} == {"games_as_written", "games_reprocess"}
