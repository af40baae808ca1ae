"""Nested records as flat tables, by columnar shredding.

Each batch of records is shredded into one column per leaf path, holding
values, repetition and definition levels. The tables of the repeated ancestors
are then rebuilt from the levels of a leaf below them alone: an entry whose
repetition level does not exceed the ancestor's begins a new element, counts of
repetition levels give its positions in all enclosing arrays, and a definition
level beyond the element's says that it is an object. Other leaves that no
array separates from the ancestor have one entry per element, so values line
up with the elements. Only where all objects of an array are without leaves
does the ancestor get a column of levels of its own.

A definition level counts what exists on the way: an array slot, an object
around a member, and at last a plain value.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Members whose text counts as structure when it parses.
TEXT_MEMBERS = frozenset({"arguments", "args", "tool_inputs", "tool_outputs", "output_messages"})


ROOT, VALUE = "$", "$value"
"""The table of the records themselves, and the member that holds a plain value of an array."""

CHUNK = 1000
"""Records shredded together."""


def escaped(name: str) -> str:
    """A member's name with its dots and brackets marked, so that joined names stay apart."""
    return re.sub(r"[\\.\[\]]", r"\\\g<0>", name)


class _Column:
    """Levels, record numbers and values of one path of a batch."""

    def __init__(self, full: int) -> None:
        self.full = full
        self.record: list[int] = []
        self.r: list[int] = []
        self.d: list[int] = []
        self.value: list = []

    def add(self, record: int, r: int, d: int, value=None) -> None:
        self.record.append(record)
        self.r.append(r)
        self.d.append(d)
        self.value.append(value)


class _Node:
    """What a batch holds at one path, over all its records."""

    def __init__(self, steps: tuple[str, ...], d: int) -> None:
        self.steps = steps  # one entry per array passed: the members before it; the last entry: members after it
        self.d = d
        self.objects = False
        self.members: dict[str, _Node] = {}
        self.element: _Node | None = None
        self.bare: _Column | None = None  # levels of objects that have no leaf
        self.levels: _Column | None = None  # the column that tells of this node's objects
        self.leaf: _Column | None = None
        self.below: list[_Column] = []

    def member(self, name: str, escape: bool) -> _Node:
        found = self.members.get(name)
        if found is None:
            shown = escaped(name) if escape else name
            last = f"{self.steps[-1]}.{shown}" if self.steps[-1] or len(self.steps) > 1 else shown
            found = self.members[name] = _Node((*self.steps[:-1], last), self.d + 1)
        return found

    def elements(self) -> _Node:
        if self.element is None:
            self.element = _Node((*self.steps, ""), self.d + 1)
        return self.element


def _structure(name: str, value):
    """The structure in a text member, or the text itself."""
    if name in TEXT_MEMBERS and isinstance(value, str) and value[:1] in ("[", "{"):
        try:
            return json.loads(value)
        except (ValueError, RecursionError):
            return value
    return value


def _infer(root: _Node, records: list, escape: bool) -> None:
    """Lifts text members into structure and notes every path that occurs."""
    stack = [(root, r) for r in records]
    while stack:
        node, value = stack.pop()
        if isinstance(value, dict):
            node.objects = True
            for name, x in value.items():
                if isinstance(x, str):
                    lifted = _structure(name, x)
                    if lifted is not x:
                        value[name] = x = lifted
                if isinstance(x, (dict, list)):
                    stack.append((node.member(name, escape), x))
                elif x is not None:
                    kid = node.member(name, escape)
                    kid.leaf = kid.leaf or _Column(kid.d + 1)
        elif isinstance(value, list):
            kid = node.elements()
            for x in value:
                if isinstance(x, (dict, list)):
                    stack.append((kid, x))
                elif x is not None:
                    kid.leaf = kid.leaf or _Column(kid.d + 1)


def _collect(root: _Node) -> list[_Node]:
    """All nodes, parents first; fills in the columns below each and the one that tells of its objects."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack += [*node.members.values(), *([node.element] if node.element else [])]
    for node in reversed(order):
        inside = [c for kid in node.members.values() for c in kid.below]
        if node.objects and len(node.steps) > 1:
            node.levels = min(inside, key=lambda c: c.full) if inside else _Column(node.d + 1)
            if not inside:
                node.bare = node.levels
        node.below = [*(c for c in (node.bare, node.leaf) if c), *inside, *(node.element.below if node.element else [])]
    return order


def _shred(root: _Node, records: list) -> None:
    """Fills the columns.

    They are sparse: a path that a record lacks outside all arrays has no entry
    for it, so members whose names are data cost nothing in other records.
    Inside arrays each element has its entry, present or not.
    """
    for record, value in enumerate(records):
        stack = [(root, value, 0, 0)]  # node, value, repetition level, arrays passed
        while stack:
            node, value, r, depth = stack.pop()
            is_object, is_array = isinstance(value, dict), isinstance(value, list) and bool(value)
            if node.bare:
                node.bare.add(record, r, node.d + is_object)
            if node.leaf:
                plain = value is not None and not isinstance(value, (dict, list))
                node.leaf.add(record, r, node.d + plain, value if plain else None)
            if node.element:
                if is_array:
                    kid = node.element
                    stack.extend((kid, value[i], depth + 1 if i else r, depth + 1) for i in range(len(value) - 1, -1, -1))
                elif depth:
                    for c in node.element.below:
                        c.add(record, r, node.d)
            for name, kid in node.members.items():
                if not kid.below:
                    continue
                if is_object and name in value:
                    stack.append((kid, value[name], r, depth))
                elif depth:
                    for c in kid.below:
                        c.add(record, r, node.d + is_object)


def _positions(r: np.ndarray, levels: int) -> list[np.ndarray]:
    """The index in each enclosing array, from repetition levels."""
    at = np.arange(len(r))
    out = []
    for j in range(1, levels + 1):
        seen = np.cumsum(r == j)
        reset = np.maximum.accumulate(np.where(r < j, at, 0))
        out.append(seen - seen[reset])
    return out


def _paths(steps: tuple[str, ...], positions: list[np.ndarray]) -> tuple[list[str], list[str]]:
    """Element paths and the paths of the nearest enclosing elements."""
    named = max((j for j in range(len(positions)) if steps[j]), default=0)
    prefix = [""] * len(positions[0])
    parent = ["$"] * len(positions[0])
    for j, p in enumerate(positions):
        if j == named and j:
            parent = prefix
        prefix = [f"{a}{steps[j]}[{i}]" for a, i in zip(prefix, p.tolist(), strict=True)]
    return prefix, parent


def _text(x) -> str:
    return x if isinstance(x, str) else json.dumps(x)


def _member_leaves(node: _Node) -> Iterator[tuple[str, _Column]]:
    """The plain members of objects at ``node``, those of objects within them too."""
    inner = [(escaped(name), kid) for name, kid in node.members.items()]
    while inner:
        name, kid = inner.pop()
        inner += [(f"{name}.{escaped(n)}", k) for n, k in kid.members.items()]
        if kid.leaf:
            yield name, kid.leaf


def _root_table(root: _Node, records: list) -> tuple[str, np.ndarray, list[str], list[str | None], list[dict]]:
    """The records that are objects, with path ``$`` and no parent."""
    there = [i for i, x in enumerate(records) if isinstance(x, dict)]
    members: list[dict] = [{} for _ in records]
    for name, leaf in _member_leaves(root):
        for i, d, x in zip(leaf.record, leaf.d, leaf.value, strict=True):
            if d == leaf.full:
                members[i][name] = _text(x)
    return ROOT, np.asarray(there, dtype=int), [ROOT] * len(there), [None] * len(there), [members[i] for i in there]


def tables(records: list, whole: bool = False) -> Iterator[tuple[str, np.ndarray, list[str], list[str | None], list[dict] | None]]:
    """Of a batch of parsed records, per repeated ancestor: its name, the record
    of each object in it, the objects' paths, their parents' and their members.

    ``whole`` adds members, the records themselves as table ``$``, and a row
    for each plain value in an array, its only member being ``$value``. Dots
    and brackets in names are then escaped, so each value has one place.
    """
    root = _Node(("",), 0)
    _infer(root, records, whole)
    nodes = _collect(root)
    _shred(root, records)
    if whole:
        yield _root_table(root, records)
    for node in nodes:
        name = "".join(f"{s}[]" for s in node.steps[:-1])
        levels = len(node.steps) - 1
        if whole and node.leaf and levels and not node.steps[-1]:
            r, d = np.asarray(node.leaf.r), np.asarray(node.leaf.d)
            there = np.flatnonzero(d == node.leaf.full)
            paths, parents = _paths(node.steps, [p[there] for p in _positions(r, levels)])
            yield name, np.asarray(node.leaf.record)[there], paths, parents, [{VALUE: _text(node.leaf.value[i])} for i in there.tolist()]
        # Only elements of arrays make rows; an object in a member belongs to the object around it.
        if node.levels is None or node.steps[-1]:
            continue
        r, d = np.asarray(node.levels.r), np.asarray(node.levels.d)
        slots = np.flatnonzero(r <= levels)
        r, there = r[slots], np.flatnonzero(d[slots] > node.d)
        paths, parents = _paths(node.steps, [p[there] for p in _positions(r, levels)])
        members = None
        if whole:
            members = [{} for _ in there]
            for member, leaf in _member_leaves(node):
                for out, i in zip(members, there.tolist(), strict=True):
                    if leaf.d[i] == leaf.full:
                        out[member] = _text(leaf.value[i])
        yield name, np.asarray(node.levels.record)[slots][there], paths, parents, members


def parse_item(text: str | None):
    """The object in ``text``, also wrapped once as a JSON string; else None."""
    if text is None:
        return None
    try:
        value = json.loads(text)
        if isinstance(value, str):
            value = json.loads(value)
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, (dict, list)) else None


_LINKS = "owner_key string, child_path string, parent_path string"
_ROWS = "owner_key string, table_path string, child_path string, parent_path string, members map<string,string>"


def _flatten(records_of, leaves: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            owners, records = records_of(batch)
            out: list[list] = [[], [], [], [], []]
            for first in range(0, len(records), CHUNK):
                for name, record, paths, parents, members in tables(records[first : first + CHUNK], leaves):
                    out[0] += [owners[first + i] for i in record.tolist()]
                    out[1] += [name] * len(paths)
                    out[2] += paths
                    out[3] += parents
                    out[4] += members or []
            text = [pa.array(x, pa.string()) for x in out[:4]]
            if leaves:
                maps = pa.array([list(m.items()) for m in out[4]], pa.map_(pa.string(), pa.string()))
                yield pa.RecordBatch.from_arrays([*text, maps], ["owner_key", "table_path", "child_path", "parent_path", "members"])
            else:
                yield pa.RecordBatch.from_arrays([text[0], text[2], text[3]], ["owner_key", "child_path", "parent_path"])

    return run


def _items(batch: pa.RecordBatch) -> tuple[list, list]:
    return batch["owner_key"].to_pylist(), [parse_item(t) for t in batch["item_json"].to_pylist()]


def _traces(batch: pa.RecordBatch) -> tuple[list, list]:
    steps, messages = batch["steps"].to_pylist(), batch["messages"].to_pylist()
    return batch["owner_key"].to_pylist(), [{"steps": s, "messages": m} for s, m in zip(steps, messages, strict=True)]


def item_key() -> F.Column:
    return F.concat_ws("/", *(F.coalesce(F.col(c), F.lit("")) for c in ("thread_id", "turn_id", "item_id")))


def flatten_items(items: DataFrame, leaves: bool = False) -> DataFrame:
    """Objects in arrays of ``item_json``, once for rows repeated.

    Of rows with one key that with the smallest ordinal, if there is such a
    column, then the smallest text is the item; rows that lack a part of the key count by their text. Text that does
    not parse, null and empty arrays give no rows.
    """
    parts = [F.col(c) for c in ("thread_id", "turn_id", "item_id")]
    unkeyed = parts[0].isNull() | parts[1].isNull() | parts[2].isNull()
    rows = items.select(item_key().alias("owner_key"), F.when(unkeyed, F.col("item_json")).alias("own"), F.struct(*(c for c in ("rollout_ordinal",) if c in items.columns), "item_json").alias("r")).where("r.item_json is not null")
    rows = rows.groupBy("owner_key", "own").agg(F.min("r").alias("r")).select("owner_key", "r.item_json")
    return rows.mapInArrow(_flatten(_items, leaves), _ROWS if leaves else _LINKS)


def flatten_traces(traces: DataFrame, leaves: bool = False) -> DataFrame:
    """Objects in ``steps`` and ``messages``; null elements keep their index and give no row."""
    rows = traces.select(F.col("trace_id").alias("owner_key"), "steps", "messages")
    return rows.mapInArrow(_flatten(_traces, leaves), _ROWS if leaves else _LINKS)


def nested_objects(items: DataFrame, traces: DataFrame, leaves: bool = False) -> DataFrame:
    """Both sources as (table_name, owner_key, child_path, parent_path[, table_path, members])."""
    a = flatten_items(items, leaves).withColumn("table_name", F.lit("thread_items"))
    b = flatten_traces(traces, leaves).withColumn("table_name", F.lit("trajectory"))
    return a.unionByName(b)
