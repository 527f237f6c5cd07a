from matchledger.sources.inputs import read_events, read_installs, read_spend
from matchledger.sources.tables import create_fact, read_fact, write_event_log
from matchledger.sources.views import (
    finished_events,
    joined_events,
    purchase_events,
    reward_claimed_events,
    room_closed_events,
    typed_events,
)

__all__ = [
    "create_fact",
    "finished_events",
    "joined_events",
    "purchase_events",
    "read_events",
    "read_fact",
    "read_installs",
    "read_spend",
    "reward_claimed_events",
    "room_closed_events",
    "typed_events",
    "write_event_log",
]
