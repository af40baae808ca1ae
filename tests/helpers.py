"""Rows and schemas that tests share."""

SMALL = "/root/testdata/sf0.001"
EVENTS = (
    "row_id bigint, batch_id bigint, group_id string, msg_id string, ts double, created_at string, role string, who string, "
    "name string, kind string, parent_id string, task_id string, thread_id string, text string, ingested_at timestamp"
)
GROUPS = "group_id string, tz string, locale string, title string, schema_version int"


def event(row_id, **values):
    """A row of chat_events with nulls in all other columns."""
    names = [c.strip().split()[0] for c in EVENTS.split(",")]
    return tuple({"row_id": row_id, **values}.get(n) for n in names)
