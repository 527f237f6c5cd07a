"""Fixed schemas of the three inputs and the four fact tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Event names as the game client sends them (fixed values).
JOINED = "tournamentJoined"
FINISHED = "tournamentFinished"
ROOM_CLOSED = "tournamentRoomClosed"
REWARD_CLAIMED = "tournamentRewardClaimed"
PURCHASE = "purchase"

MATCH_KEYS = ["player_id", "room_id", "tournament_id"]
ROOM_KEYS = ["room_id", "tournament_id"]
DAY_KEYS = ["player_id", "date_utc"]
COHORT_KEYS = ["media_source", "install_country", "install_date", "cohort_period"]

# One wide nullable row shape for every event; `date_utc` is the day of
# `timestamp_utc` and the partition column of the log. The misspelt names are
# the wire names.
EVENTS = T.StructType(
    [
        T.StructField("event_name", T.StringType()),
        T.StructField("timestamp_utc", T.TimestampNTZType()),
        T.StructField("player_id", T.LongType()),
        T.StructField("room_id", T.LongType()),
        T.StructField("tournament_id", T.LongType()),
        T.StructField("balance_before", T.LongType()),
        T.StructField("entry_fee", T.LongType()),
        T.StructField("players_capacity", T.IntegerType()),
        T.StructField("play_duration", T.LongType()),
        T.StructField("players_submited", T.LongType()),
        T.StructField("players_active_in_toom", T.LongType()),
        T.StructField("score", T.LongType()),
        T.StructField("position", T.LongType()),
        T.StructField("reward", T.LongType()),
        T.StructField("coins_claimed", T.LongType()),
        T.StructField("price_usd", T.DoubleType()),
        T.StructField("date_utc", T.DateType()),
    ]
)

INSTALLS = T.StructType(
    [
        T.StructField("player_id", T.LongType()),
        T.StructField("install_date", T.DateType()),
        T.StructField("media_source", T.StringType()),
        T.StructField("install_country", T.StringType()),
    ]
)

SPEND = T.StructType(
    [
        T.StructField("media_source", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("spend", T.DoubleType()),
    ]
)


@dataclass(frozen=True)
class Fact:
    """Shape of one stored fact: columns in order, merge keys, partitioning.

    `partition_column` is the physical partition; when it differs from
    `partition_source` it is the day of that timestamp, added on write and
    dropped on read.
    """

    name: str
    columns: tuple[str, ...]
    keys: tuple[str, ...]
    partition_source: str
    partition_column: str

    @property
    def derives_partition(self) -> bool:
        return self.partition_source != self.partition_column


GAMES = Fact(
    name="fct_games",
    columns=(
        "player_id", "date_utc", "joined_time", "submit_time", "room_close_time",
        "play_duration", "balance_before", "balance_after_claim", "tournament_id",
        "room_id", "entry_fee", "players_capacity", "actual_players_in_room",
        "score", "position", "reward", "did_claim_reward", "claim_time",
    ),
    keys=tuple(MATCH_KEYS),
    partition_source="date_utc",
    partition_column="date_utc",
)

ROOMS = Fact(
    name="fct_rooms",
    columns=(
        "room_id", "tournament_id", "players_capacity", "entry_fee",
        "room_open_time", "room_close_time", "actual_players", "total_coins_sink",
        "total_coins_rewards", "total_matches_duration", "room_open_duration",
        "is_closed", "is_full",
    ),
    keys=tuple(ROOM_KEYS),
    partition_source="room_open_time",
    partition_column="room_open_day",
)

DAILY = Fact(
    name="daily_player",
    columns=(
        "date_utc", "player_id", "balance_day_start", "balance_day_end",
        "matches_played", "total_matches_duration", "matches_won_reward",
        "matches_claimed", "coins_sink_tournaments", "coins_source_tournaments",
        "max_score", "avg_score", "max_position", "avg_position",
        "max_reward_won_streak", "max_losing_streak", "revenue",
        "coins_source_purchases",
    ),
    keys=tuple(DAY_KEYS),
    partition_source="date_utc",
    partition_column="date_utc",
)

ROAS = Fact(
    name="marketing_roas",
    columns=(
        "media_source", "install_country", "install_date", "cohort_period", "roas",
    ),
    keys=tuple(COHORT_KEYS),
    partition_source="install_date",
    partition_column="install_date",
)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project `df` to `schema`, failing at once on a missing or mistyped column.

    Key columns may be of any type (ids are opaque), and a timestamp may be
    with or without zone.
    """
    have = {f.name: f.dataType for f in df.schema.fields}
    missing = [f.name for f in schema.fields if f.name not in have]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    opaque = set(MATCH_KEYS)
    wrong = [
        f"{f.name} is {have[f.name].simpleString()}, expected {f.dataType.simpleString()}"
        for f in schema.fields
        if f.name not in opaque and not _compatible(have[f.name], f.dataType)
    ]
    if wrong:
        raise ValueError("; ".join(wrong))
    return df.select(*[F.col(f.name) for f in schema.fields])


def _compatible(have: T.DataType, want: T.DataType) -> bool:
    timestamps = (T.TimestampType, T.TimestampNTZType)
    if isinstance(want, timestamps):
        return isinstance(have, timestamps)
    if isinstance(want, T.NumericType):
        return isinstance(have, T.NumericType)
    return have == want
