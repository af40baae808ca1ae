"""Ordered folds whose next step depends on all earlier ones.

Rows are sent to the task of their key and sorted there; the fold then streams
over batches with the state of one key, so a long key is never held at once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.operators import forest, ordered
from threadloom.session import materialise

WINDOW_CHARS = 20_000
OVERLAP_ROWS = 8


def fold(rows: DataFrame, keys: list[str], order: list[str], start: Callable[[], object], step: Callable[[object, dict], list[dict]], schema: str) -> DataFrame:
    """``step(state, row)`` gives output rows; the state is new for each key."""
    names = [c.strip().split()[0] for c in schema.split(",")]
    n_keys = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None
        out_schema = None
        for batch in batches:
            out: list[dict] = []
            for row in batch.to_pylist():
                key = tuple(row[k] for k in keys)
                if current is None or key != current:
                    current, state = key, start()
                out += step(state, row)
            if out:
                arrays = {n: [r.get(n) for r in out] for n in names}
                out_schema = out_schema or pa.schema([(n, _ARROW[t]) for n, t in (c.strip().split() for c in schema.split(","))])
                yield pa.RecordBatch.from_pydict(arrays, schema=out_schema)

    return rows.repartition(*(F.col(k) for k in keys[:n_keys])).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


_ARROW = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "double": pa.float64()}


def char_windows(rows: DataFrame, key: str, order: list[str], n_chars: str, budget: int = WINDOW_CHARS, overlap: int = OVERLAP_ROWS) -> DataFrame:
    """(key, pos, window): rows in windows of at most ``budget`` characters.

    A window ends before the row that would exceed the budget; the next begins
    with the last ``overlap`` rows, whose characters count. A single row beyond
    the budget stays whole.
    """

    def start():
        return {"pos": 0, "window": 0, "held": [], "chars": 0}

    def step(s, row):
        n = row[n_chars] or 0
        out = []
        if s["held"] and s["chars"] + n > budget:
            s["window"] += 1
            s["held"] = s["held"][-overlap:] if overlap else []
            s["chars"] = sum(c for _, c in s["held"])
            out += [{key: row[key], "pos": p, "window": s["window"]} for p, _ in s["held"]]
        s["held"].append((s["pos"], n))
        s["chars"] += n
        out.append({key: row[key], "pos": s["pos"], "window": s["window"]})
        s["pos"] += 1
        return out

    return fold(rows.select(key, *order, n_chars), [key], order, start, step, f"{key} string, pos bigint, window bigint")


def routed_sessions(rows: DataFrame, key: str, order: list[str], judge: Callable[[str, list[str]], int | None] | None = None) -> DataFrame:
    """(key, id, session, reason): requests opened or sent to sessions, other rows inherit the last one.

    A request that replies to an assigned row goes there; the first opens a
    session; others go where ``judge`` (the request, the titles) says, and a
    new session opens when it names none that exists.
    """

    def start():
        return {"of": {}, "last": None, "titles": []}

    def opened(s, row, reason):
        s["titles"].append((row["text"] or "")[:30])
        s["last"] = len(s["titles"]) - 1
        return reason

    def step(s, row):
        if not row["is_request"]:
            if s["last"] is None:
                return []
            reason = "inherited"
        elif row["parent"] in s["of"]:
            s["last"] = s["of"][row["parent"]]
            reason = "reply"
        elif not s["titles"]:
            reason = opened(s, row, "opener")
        else:
            choice = judge(row["text"] or "", s["titles"]) if judge else None
            if choice is None or not 0 <= choice < len(s["titles"]):
                reason = opened(s, row, "new")
            else:
                s["last"], reason = choice, "judged"
        s["of"][row["id"]] = s["last"]
        return [{key: row[key], "id": row["id"], "session": s["last"], "reason": reason}]

    return fold(rows.select(key, *order, "id", "parent", "text", "is_request"), [key], order, start, step, f"{key} string, id string, session bigint, reason string")


def routed_plainly(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """As ``routed_sessions`` without a judge, and without a fold: every request that replies to nothing opens a session.

    Each row then points at an earlier one, a reply at what it replies to and
    other rows at the last request, and where the pointers end tells the
    session. So a key of any size spreads over all tasks. Ids must be unique,
    and the last column of ``order`` a number of its own for each row.
    """
    row = rows.select(key, *order, "id", "parent", "is_request")
    placed = ordered.running(row, [key], order, {"__request": (ordered.LAST, F.when(F.col("is_request"), F.col("id")))})
    known = materialise(placed.where("__request is not null"), "requests")
    up = known.select(F.col("id").alias("__up"), F.col(key).alias("__key"), F.struct(*order).alias("__at"))
    j = known.join(up, (F.col("parent") == F.col("__up")) & F.col(key).eqNullSafe(F.col("__key")) & (F.col("__at") < F.struct(*order)), "left")
    opens = F.col("is_request") & F.col("__up").isNull()
    target = F.when(~F.col("is_request"), F.col("__request")).otherwise(F.col("__up"))
    j = ordered.running(j.select(key, *order, "id", "is_request", target.alias("__target"), opens.alias("__opens")), [key], order, {"__n": (ordered.SUM, F.col("__opens").cast("int"))})
    j = materialise(j, "pointers")
    ends = forest.resolve(j.select("id", F.col("__target").alias("parent"), F.col(order[-1]).cast("bigint").alias("pos"))).select("id", "root")
    numbers = j.where("__opens").select(F.col("id").alias("root"), (F.col("__n") - 1).cast("bigint").alias("session"))
    reason = F.when(~F.col("is_request"), "inherited").when(~F.col("__opens"), "reply").when(F.col("__n") == 1, "opener").otherwise("new")
    return j.join(ends, "id").join(numbers, "root").select(key, "id", "session", reason.alias("reason"))


def reconciled_items(snapshots: DataFrame, key: str, full: bool = True) -> DataFrame:
    """(key, snapshot, idx, item_id): ids of items that stay the same from snapshot to snapshot.

    An equal item at the same place keeps its id; in full snapshots else the
    first equal item of the previous one that is not used yet; else it is new.
    In incremental mode a different item at a known place is an error. Rows
    with a true ``installed``, if there is such a column, are a compaction: they
    replace what the next snapshot is compared with, and give ids themselves.
    """

    def start():
        return {"previous": [], "current": [], "snapshot": None, "next": 0, "used": set(), "by_item": {}}

    def step(s, row):
        if row["snapshot"] != s["snapshot"]:
            s["previous"], s["current"], s["used"], s["snapshot"] = s["current"], [], set(), row["snapshot"]
            s["by_item"] = {}
            for x, i in reversed(s["previous"]):
                s["by_item"].setdefault(x, []).append(i)
        before = s["previous"]
        at, item = row["idx"], row["item"]
        found = None
        if at < len(before) and before[at][0] == item and before[at][1] not in s["used"]:
            found = before[at][1]
        elif not full and at < len(before):
            raise ValueError(f"item {at} of snapshot {row['snapshot']} changed")
        elif full:
            # Equal items wait in line under their value, so a snapshot is read once.
            line = s["by_item"].get(item, ())
            while line and line[-1] in s["used"]:
                line.pop()
            found = line[-1] if line else None
        if found is None:
            found = s["next"]
            s["next"] += 1
        s["used"].add(found)
        s["current"].append((item, found))
        return [{key: row[key], "snapshot": row["snapshot"], "idx": at, "item_id": found}]

    return fold(snapshots, [key], ["snapshot", "idx"], start, step, f"{key} string, snapshot bigint, idx bigint, item_id bigint")
