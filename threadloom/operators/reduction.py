"""The raw event log of rollouts as entity tables: typed dispatch with fatal rules, and code cells."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA_VERSION = 1
# The kinds of events, by entity: what starts it, and what ends it with which status.
ENTITIES: dict[str, tuple[str, dict[str, str | None]]] = {
    "rollout": ("rollout_started", {"rollout_ended": None}),
    "thread": ("thread_started", {"thread_ended": None}),
    "turn": ("turn_started", {"turn_ended": None}),
    "inference": ("inference_started", {"inference_completed": "completed", "inference_failed": "failed", "inference_cancelled": "cancelled"}),
    "tool_call": ("tool_call_started", {"tool_call_ended": None}),
    "tool_runtime": ("tool_call_runtime_started", {"tool_call_runtime_ended": None}),
    "code_cell": ("code_cell_started", {"code_cell_ended": None}),
    "compaction": ("compaction_request_started", {"compaction_request_completed": "completed", "compaction_request_failed": "failed"}),
}
NOTES = ("mcp_tool_call_correlation_assigned", "code_cell_initial_response", "compaction_installed", "agent_result_observed", "protocol_event_observed", "other")
KINDS = (*(k for start, ends in ENTITIES.values() for k in (start, *ends)), *NOTES)
RUNNING = "running"


def _plain_kinds(events: DataFrame) -> DataFrame:
    """Kinds of turns without the name that a writer may put before them."""
    return events.withColumn("kind", F.regexp_replace("kind", r"^[a-z]+_(turn_(?:started|ended))$", "$1"))


def faults(events: DataFrame) -> DataFrame:
    """(fault, n): what makes a log unfit for replay.

    ``events`` has rollout_id, seq, schema_version, kind and ref, the id of the
    entity. Unknown kinds and versions, numbers given twice, entities started
    twice or ended without a start or before it are faults.
    """
    events = _plain_kinds(events)
    entity = _entity(F.col("kind"))
    marked = events.withColumns({"entity": entity, "starts": F.col("kind").isin(*(s for s, _ in ENTITIES.values()))})
    simple = marked.agg(F.count_if(~F.coalesce(F.col("kind").isin(*KINDS), F.lit(False))).alias("unknown_kind"), F.count_if(F.col("schema_version") != SCHEMA_VERSION).alias("schema_version"))
    twice = events.groupBy("rollout_id", "seq").agg(F.count("*").alias("n")).agg(F.count_if(F.col("n") > 1).alias("seq_twice"))
    per = marked.where("entity is not null").groupBy("rollout_id", "entity", "ref").agg(F.count_if("starts").alias("s"), F.min(F.when(F.col("starts"), F.col("seq"))).alias("a"), F.min(F.when(~F.col("starts"), F.col("seq"))).alias("z"))
    spans_ = per.agg(F.count_if(F.col("s") > 1).alias("started_twice"), F.count_if(F.col("s") == 0).alias("never_started"), F.count_if(F.col("z") < F.col("a")).alias("ended_before_start"))
    flat = lambda df: df.select(F.explode(F.array(*(F.struct(F.lit(c).alias("fault"), F.col(c).alias("n")) for c in df.columns))).alias("r")).select("r.*")
    return flat(simple).unionByName(flat(twice)).unionByName(flat(spans_)).where("n > 0")


def _entity(kind: F.Column) -> F.Column:
    out = F.when(F.lit(False), F.lit(""))
    for name, (start, ends) in ENTITIES.items():
        out = out.when(kind.isin(start, *ends), F.lit(name))
    return out


def reduced(events: DataFrame, strict: bool = True) -> DataFrame:
    """(rollout_id, entity, ref, thread_id, turn_id, started_seq, ended_seq, status), a row per entity.

    Each kind goes to the entity it speaks of and start and end meet by its id,
    so no log is folded in order. The first end counts, its own status or that
    of its kind; what never ended is running. A log with faults is refused when
    ``strict``.
    """
    if strict:
        found = {r["fault"]: r["n"] for r in faults(events).collect()}  # one row per kind of fault
        if found:
            raise ValueError(f"the log cannot be replayed: {found}")
    events = _plain_kinds(events)
    status = F.col("status")
    for _, ends in ENTITIES.values():
        for kind, own in ends.items():
            if own is not None:
                status = F.when(F.col("kind") == kind, F.lit(own)).otherwise(status)
    starts = F.col("kind").isin(*(s for s, _ in ENTITIES.values()))
    first = F.when(starts, F.struct("seq", "thread_id", "turn_id"))
    last = F.when(~starts, F.struct("seq", status.alias("status")))
    rows = events.withColumn("entity", _entity(F.col("kind"))).where("entity is not null")
    g = rows.groupBy("rollout_id", "entity", "ref").agg(F.min(first).alias("a"), F.min(last).alias("z"))
    return g.where("a is not null").select("rollout_id", "entity", "ref", "a.thread_id", "a.turn_id", F.col("a.seq").alias("started_seq"), F.col("z.seq").alias("ended_seq"), F.when(F.col("z").isNull(), RUNNING).otherwise(F.col("z.status")).alias("status"))


def code_cells(events: DataFrame, items: DataFrame) -> DataFrame:
    """(cell, visible_seq, n_responses, status): cells with the item that shows them.

    A start waits until its source item was seen, so the later of both counts;
    its lifecycle then follows in the order of the log. ``items`` has call and
    seq. A cell whose item never comes stays pending, with a null place.
    """
    mine = events.where(F.col("kind").startswith("code_cell_"))
    g = mine.groupBy(F.col("ref").alias("cell")).agg(
        F.min(F.when(F.col("kind") == "code_cell_started", F.struct("seq", "call"))).alias("s"), F.count_if(F.col("kind") != "code_cell_started").alias("n_responses"),
        F.max(F.when(F.col("kind") != "code_cell_started", F.struct("seq", "status")))["status"].alias("status"),
    )
    seen = items.groupBy("call").agg(F.min("seq").alias("item_seq"))
    j = g.where("s is not null").select("cell", F.col("s.seq").alias("seq"), F.col("s.call").alias("call"), "n_responses", "status").join(seen, "call", "left")
    here = F.col("item_seq").isNotNull()
    return j.select("cell", F.when(here, F.greatest("seq", "item_seq")).alias("visible_seq"), "n_responses", F.when(~here, F.lit("pending")).otherwise(F.coalesce("status", F.lit(RUNNING))).alias("status"))
