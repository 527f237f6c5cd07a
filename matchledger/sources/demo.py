"""The three inputs derived from the test tables `events` and `supplier`.

FIXTURES.md gives the mapping; `oracle/views.py` states it again in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from matchledger import schemas

# How far into the days of the log a first refresh sees, and where the merge queries begin.
FIRST_RUN, MERGED_FROM = (2, 3), (1, 2)

RAW_EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
RAW_SUPPLIER = "s_suppkey BIGINT, s_nationkey INT, s_acctbal DOUBLE"

# `props` is text such as {"k": 69}. A pattern reads it at a fifth of the cost of
# parsing it as JSON, and every event type needs it.
K_PATTERN = r"""r'"k": *([0-9]+)'"""

PLACE = {"room_id": "event_id div 5", "tournament_id": "(event_id div 5) % 7"}
AFTER_JOIN = {**PLACE, "balance_before": "990 + (event_id * 37) % 500"}
POINTS = "floor(value * 10)"
BONUS = "CASE WHEN k % 7 = 0 THEN 5 END"

# Per event name: which raw rows give one, when it happened, and its columns.
# A column that is not named is NULL.
EVENT_TYPES = {
    schemas.JOINED: (
        "event_type <> 'purchase'",
        "timestampadd(MINUTE, -(k % 40 + 20), ts)",
        {
            **PLACE,
            "balance_before": "1000 + (event_id * 37) % 500",
            "entry_fee": "CASE WHEN k % 10 <> 0 THEN 10 * (1 + (event_id div 5) % 4) END",
            "players_capacity": "5",
        },
    ),
    schemas.FINISHED: (
        "event_type <> 'purchase' AND k % 8 <> 0",
        "timestampadd(MINUTE, -15, ts)",
        {
            **AFTER_JOIN,
            "play_duration": "CASE WHEN k % 9 <> 0 THEN 30 + k END",
            "players_submited": "1 + k % 5",
            "players_active_in_toom": "3 + k % 3",
            "score": f"CASE WHEN k % 11 <> 0 THEN {POINTS} END",
        },
    ),
    schemas.ROOM_CLOSED: (
        "event_type <> 'purchase' AND k % 6 <> 0",
        "timestampadd(MINUTE, -10, ts)",
        {
            **AFTER_JOIN,
            "score": f"CASE WHEN k % 4 <> 0 THEN {POINTS} END",
            "position": "k % 5",
            "reward": "CASE k % 5 WHEN 0 THEN 40 WHEN 1 THEN 20 WHEN 2 THEN 0 END",
            "coins_claimed": BONUS,
        },
    ),
    schemas.REWARD_CLAIMED: (
        "event_type <> 'purchase' AND k % 5 < 3",
        "ts",
        {
            **AFTER_JOIN,
            "score": POINTS,
            "position": "k % 5",
            "reward": "CASE k % 5 WHEN 0 THEN 40 WHEN 1 THEN 20 END",
            "coins_claimed": BONUS,
        },
    ),
    schemas.PURCHASE: (
        "event_type = 'purchase'",
        "ts",
        {"coins_claimed": "100 * (1 + k % 3)", "price_usd": "value"},
    ),
}


def game_log(raw: DataFrame) -> DataFrame:
    """The game event log as a projection of raw event rows (batch or stream)."""
    raw = raw.selectExpr(
        "event_id", "ts", "user_id", "event_type", "value",
        f"CAST(regexp_extract(props, {K_PATTERN}, 1) AS INT) AS k",
    )
    log = None
    for name, (rows, at, values) in EVENT_TYPES.items():
        values = {
            "event_name": f"'{name}'", "timestamp_utc": at, "player_id": "user_id",
            "date_utc": f"to_date({at})", **values,
        }
        typed = raw.filter(rows).selectExpr(
            *[
                f"CAST({values.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}"
                for f in schemas.EVENTS.fields
            ]
        )
        log = typed if log is None else log.unionByName(typed)
    return log


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(RAW_EVENTS).parquet(f"{sf_dir}/events.parquet")


def game_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return game_log(raw_events(spark, sf_dir))


def installs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        raw_events(spark, sf_dir)
        .select("user_id")
        .distinct()
        .selectExpr(
            "user_id AS player_id",
            "date_sub(DATE'2024-01-30', CAST((user_id * 7) % 113 - 3 AS INT)) AS install_date",
            "CASE user_id % 4 WHEN 0 THEN 'Organic' WHEN 1 THEN 'AdNetA' "
            "WHEN 2 THEN 'AdNetB' ELSE 'AdNetC' END AS media_source",
            "concat('C', user_id % 3) AS install_country",
        )
    )


def spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        spark.read.schema(RAW_SUPPLIER)
        .parquet(f"{sf_dir}/supplier.parquet")
        .selectExpr(
            "CASE s_suppkey % 3 WHEN 0 THEN 'AdNetA' WHEN 1 THEN 'AdNetB' ELSE 'AdNetC' END AS media_source",
            "concat('C', s_nationkey % 3) AS country",
            "s_acctbal",
        )
        .selectExpr(
            "media_source", "country",
            "CASE WHEN media_source = 'AdNetC' AND country = 'C0' THEN 0.0D ELSE abs(s_acctbal) END AS spend",
        )
    )


def day_at(events: DataFrame, share: tuple[int, int]) -> Column:
    """The day at a share of the log's days, as an uncorrelated scalar subquery."""
    first, last = F.min("date_utc"), F.max("date_utc")
    return events.agg(F.date_add(first, F.floor(F.datediff(last, first) * share[0] / share[1]).cast("int"))).scalar()


def first_run(events: DataFrame) -> DataFrame:
    """The part of the log that a first refresh sees."""
    return events.filter(F.col("date_utc") <= day_at(events, FIRST_RUN))


#: Which raw events come in late: by id, so they are of all times.
LATE_ROWS = "event_id % 7 = 3"


def on_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return game_log(raw_events(spark, sf_dir).filter(f"NOT ({LATE_ROWS})"))


def arrived_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    return game_log(raw_events(spark, sf_dir).filter(LATE_ROWS))
