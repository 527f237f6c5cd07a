from __future__ import annotations

import datetime as dt
import os
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from matchledger import schemas  # noqa: E402
from matchledger.session import Workspace, local_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores=8, shuffle_partitions=4, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture()
def workspace(spark):
    space = Workspace(spark)
    yield space
    space.drop()


@pytest.fixture()
def log(spark):
    """Build an event log from dicts; `at` is 'DD HH:MM[:SS]' of January 2024."""

    def build(*events: dict):
        rows = []
        for event in events:
            event = dict(event)
            at = event.pop("at")
            stamp = dt.datetime.strptime(f"2024-01-{at}" + (":00" if at.count(":") == 1 else ""), "%Y-%m-%d %H:%M:%S")
            event = {"player_id": 1, "timestamp_utc": stamp, "date_utc": stamp.date(), **event}
            unknown = set(event) - set(schemas.EVENTS.names)
            assert not unknown, unknown
            rows.append(tuple(event.get(name) for name in schemas.EVENTS.names))
        return spark.createDataFrame(rows, schemas.EVENTS)

    return build


def joined(at, **more):
    return {"event_name": schemas.JOINED, "at": at, "room_id": 10, "tournament_id": 3, **more}


def finished(at, **more):
    return {"event_name": schemas.FINISHED, "at": at, "room_id": 10, "tournament_id": 3, **more}


def closed(at, **more):
    return {"event_name": schemas.ROOM_CLOSED, "at": at, "room_id": 10, "tournament_id": 3, **more}


def claimed(at, **more):
    return {"event_name": schemas.REWARD_CLAIMED, "at": at, "room_id": 10, "tournament_id": 3, **more}


def purchase(at, **more):
    return {"event_name": schemas.PURCHASE, "at": at, **more}


def day(n: int) -> dt.date:
    return dt.date(2024, 1, n)


def bag(df) -> list[tuple]:
    """Rows as a sorted list, columns by name."""
    names = sorted(df.columns)
    return sorted((tuple(r) for r in df.select(*names).collect()), key=repr)
