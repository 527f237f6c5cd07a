"""The two hourly facts kept up to date from a stream of events.

The stream's checkpoint takes the place of the high-water mark, so an event
that arrives late is an event like any other: each micro-batch names the
matches or rooms it touches, these are rebuilt from the log, and merged. A
batch that is repeated after a failure gives the same table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from matchledger.operators.keydays import days_of, on_days, record_days
from matchledger.operators.upsert import upsert_table
from matchledger.plans import games, rooms
from matchledger.plans.refresh import FACTS, touched_keys
from matchledger.schemas import GAMES, MATCH_KEYS, ROOM_KEYS, Fact
from matchledger.session import Workspace
from matchledger.sources.snapshots import create_published
from matchledger.sources.tables import create_fact

def keep_current(
    spark: SparkSession,
    stream: DataFrame,
    log: Callable[[], DataFrame],
    name: str,
    table: str,
    workspace: Workspace,
    checkpoint: str,
    key_days: str | None = None,
    snapshots: bool = False,
) -> StreamingQuery:
    """Start a query that merges what arrives on `stream` into the fact `name`.

    `log` gives the stored event log at the time of a batch; it must hold the
    batch's own events by then. The trigger takes what is there and stops, so
    a scheduler can call this every hour. `key_days` names an index of the days of
    each match or room (see `Inputs`), which the stream has to keep from its start;
    with it a batch reads and rewrites only days that matter. With `snapshots` the first
    batch makes a published fact, whose readers see each batch as a whole.
    """
    fact = FACTS[name]
    keys = MATCH_KEYS if fact is GAMES else ROOM_KEYS

    def merge(batch: DataFrame, _batch_id: int) -> None:
        touched_name, touched = workspace.stage(touched_keys(batch, keys), "touched")
        staged = [touched_name]
        try:
            events, within = log(), None
            if key_days:
                record_days(spark, key_days, batch, keys)
                within = days_of(spark, key_days, touched, keys)
                events = events.filter(on_days("date_utc", within))
                within = within | {None}
            rows = _rebuilt(fact, events, touched, workspace, staged)
            if spark.catalog.tableExists(table):
                upsert_table(
                    spark, table, rows, fact, workspace, on_duplicate="keep_all", null_safe=True, within=within
                )
            elif snapshots:
                create_published(spark, rows, table, fact)
            else:
                create_fact(rows, table, fact)
        finally:
            workspace.release(*staged)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _rebuilt(
    fact: Fact, events: DataFrame, touched: DataFrame, workspace: Workspace, staged: list[str]
) -> DataFrame:
    if fact is GAMES:
        return games.games_of(events, touched, workspace, staged)
    return rooms.rooms_of(events, touched)
