from pulselens.sources.tables import (
    FEED_SCHEMA,
    MESSAGE_SCHEMA,
    SLICE_SCHEMA,
    all_activity,
    feed_actions,
    feed_from_events,
    load_events,
    message_actions,
    messages_from_events,
    order_activity,
    read_feed_table,
    read_message_table,
    read_table,
    write_event_table,
)
from pulselens.sources.sink import read_slices, write_slices

__all__ = [
    "FEED_SCHEMA", "MESSAGE_SCHEMA", "SLICE_SCHEMA", "all_activity", "feed_actions",
    "feed_from_events", "load_events", "message_actions", "messages_from_events",
    "order_activity", "read_table", "read_feed_table", "read_message_table", "write_event_table", "read_slices", "write_slices",
]
