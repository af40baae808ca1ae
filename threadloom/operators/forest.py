"""Full hierarchies from parent-child rows of unknown depth.

A weighted disjoint-set forest: every node knows a root and its offset to it.
Links are first combined inside blocks of the delivery order, where replies
mostly lie; what remains are links between the tops of blocks. Those merge
hierarchically, in groups of neighbouring blocks for as long as a group stays
within ``BLOCK_ROWS``, and then by pointer doubling between groups, which has
no limit of size. A round that resolves nothing new leaves only cycles: along
an unfinished path every distance to its end occurs, so some node always ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions.ids import identifier, parent_identifier
from threadloom.operators import ordered
from threadloom.session import broadcast_if_small, materialise

BLOCK_ROWS = 16384
"""Most rows that one task contracts at once."""
TREE_ROWS = 32768
"""Nodes of a tree that one task indexes; larger trees are walked by the contraction itself."""
SLICE_ENTRIES = 1 << 20
"""Entries of paths that a task holds at once."""
ROOT, ORPHAN, CYCLE = "root", "orphan", "cycle"
LOWEST = -(1 << 62)
"""Carried value of a node that has none; below all others."""


def messages(events: DataFrame, id_col: str = "msg_id", parent_col: str = "parent_id", order_col: str = "row_id", **extra: Column) -> DataFrame:
    """(id, parent, pos, extra...): per identifier its row with the smallest order.

    Rows without identifier take no part. Ties of order go to the smallest
    remaining values. Rows without order come first; as they have no place in
    the delivery, they are spread over blocks of their own by their identifier.
    """
    names = list(extra)
    rows = events.select(
        identifier(F.col(id_col)).alias("id"),
        F.struct(F.col(order_col).alias("pos"), parent_identifier(F.col(parent_col)).alias("parent"), *(c.alias(n) for n, c in extra.items())).alias("r"),
    ).where("id is not null")
    first = rows.groupBy("id").agg(F.min("r").alias("r"))
    return first.select("id", "r.parent", F.coalesce(F.col("r.pos").cast("bigint"), -1 - F.pmod(F.xxhash64("id"), F.lit(1 << 30))).alias("pos"), *(f"r.{n}" for n in names))


def _contract(ids: np.ndarray, targets: np.ndarray, kinds: np.ndarray, hops: np.ndarray, best: np.ndarray, paths: list | None) -> tuple:
    """Follows pointers inside one block.

    ``kinds`` is null where a pointer still leads on. Gives for each node the
    last node or target it reaches, and what lies on the way: hops, the largest
    carried value, and with ``paths`` the nodes themselves.
    """
    n = len(ids)
    index = pd.Index(ids)
    open_ = pd.isna(kinds)
    at = np.full(n, -1, dtype=np.int64)
    if open_.any():
        wanted = targets[open_]
        at[open_] = np.where(pd.isna(wanted), -1, index.get_indexer(wanted))
    ends = at < 0
    pointer = np.where(ends, np.arange(n), at)
    # A node that ends keeps its own hops for the caller; it adds none to others.
    step, most = np.where(ends, 0, hops), np.where(ends, LOWEST, best)
    segment = None if paths is None else [[] if e else p for e, p in zip(ends, paths, strict=True)]
    done = ends[pointer]
    count = -1
    while not done.all() and int(done.sum()) != count:
        count = int(done.sum())
        if segment is not None:
            segment = [segment[p] + s if p != i else s for i, (p, s) in enumerate(zip(pointer, segment, strict=True))]
        most = np.maximum(most, most[pointer])
        step = step + step[pointer]
        pointer = pointer[pointer]
        done = ends[pointer]
    return pointer, step, most, segment, ~done


def _first_level(with_path: bool, keep: tuple[str, ...] = ()):
    def run(block: pa.Table) -> pa.Table:
        ids = block["id"].to_numpy(zero_copy_only=False)
        parents = block["parent"].to_numpy(zero_copy_only=False)
        value = block["value"].to_numpy(zero_copy_only=False).astype(np.int64)
        n = len(ids)
        kinds = np.where(pd.isna(parents), ROOT, None).astype(object)
        pointer, hops, most, segment, cyclic = _contract(
            ids, parents, kinds, np.ones(n, np.int64), value, [[i] for i in ids] if with_path else None
        )
        top = pointer
        out = {
            "id": pa.array(ids, pa.string()),
            "top": pa.array(ids[top], pa.string()),
            "hops": pa.array(hops),
            # The top's own value was not on anybody's way yet.
            "most": pa.array(np.maximum(most, value[top])),
            "link": pa.array(np.where(cyclic, None, parents[top]), pa.string()),
            "kind": pa.array(np.where(cyclic, CYCLE, kinds[top]), pa.string()),
            "pos": block["pos"].cast(pa.int64()).combine_chunks(),
        }
        for name in keep:
            out[name] = block[name].combine_chunks()
        if with_path:
            out["path"] = pa.array([[ids[t], *s] for t, s in zip(top, segment, strict=True)], pa.list_(pa.string()))
        return pa.table(out)

    return run


def _next_level(with_path: bool):
    def run(block: pa.Table) -> pa.Table:
        ids = block["top"].to_numpy(zero_copy_only=False)
        to = block["to"].to_numpy(zero_copy_only=False)
        kinds = block["kind"].to_numpy(zero_copy_only=False)
        hops = block["hops"].to_numpy(zero_copy_only=False).astype(np.int64)
        most = block["most"].to_numpy(zero_copy_only=False).astype(np.int64)
        paths = block["path"].to_pylist() if with_path else None
        pointer, step, best, segment, cyclic = _contract(ids, to, kinds, hops, most, paths)
        out = {
            "top": pa.array(ids, pa.string()),
            "to": pa.array(to[pointer], pa.string()),
            "hops": pa.array(step + hops[pointer]),
            "most": pa.array(np.maximum(best, most[pointer])),
            "kind": pa.array(np.where(cyclic, CYCLE, kinds[pointer]), pa.string()),
            "pos": block["pos"].combine_chunks(),
        }
        if with_path:
            out["path"] = pa.array([paths[p] + s for p, s in zip(pointer, segment, strict=True)], pa.list_(pa.string()))
        return pa.table(out)

    return run


def _by_block(df: DataFrame, width: int, run, schema: str) -> DataFrame:
    return df.withColumn("__block", F.floor(F.col("pos") / width)).groupBy("__block").applyInArrow(run, schema)


def _double(links: DataFrame, with_path: bool) -> DataFrame:
    """One round of pointer doubling over all links, by a shuffle join."""
    ahead = links.select(
        F.col("top").alias("a_top"), F.col("to").alias("a_to"), F.col("hops").alias("a_hops"), F.col("most").alias("a_most"), F.col("kind").alias("a_kind"),
        *([F.col("path").alias("a_path")] if with_path else []),
    )
    waiting = links.where("kind is null").join(ahead, F.col("to") == F.col("a_top"))
    moved = waiting.select(
        "top", F.col("a_to").alias("to"), (F.col("hops") + F.col("a_hops")).alias("hops"), F.greatest("most", "a_most").alias("most"), F.col("a_kind").alias("kind"), "pos",
        *([F.concat("a_path", "path").alias("path")] if with_path else []),
    )
    return links.where("kind is not null").unionByName(moved)


def resolve(nodes: DataFrame, with_path: bool = False, block_rows: int = BLOCK_ROWS, keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, root, depth, most, kind[, path], keep...) of each node of ``nodes``.

    ``nodes`` has unique ``id``, ``parent`` (null: none), ``pos`` (whose blocks
    hold at most ``block_rows`` rows where it is unique) and may have ``value``,
    of which ``most`` is the largest on the way from the root. ``kind`` is
    root, orphan (the root's own parent does not exist) or cycle, where root
    is null and depth -1. Paths run from the root to the node. Columns named
    in ``keep`` come along unchanged.
    """
    if "value" not in nodes.columns:
        nodes = nodes.withColumn("value", F.lit(LOWEST))
    kept = "".join(f", `{n}` {nodes.schema[n].dataType.simpleString()}" for n in keep)
    nodes = nodes.select("id", "parent", "pos", F.coalesce(F.col("value").cast("bigint"), F.lit(LOWEST)).alias("value"), *keep)
    tail = ", path array<string>" if with_path else ""
    local = _by_block(nodes, block_rows, _first_level(with_path, keep), f"id string, top string, hops bigint, most bigint, link string, kind string, pos bigint{kept}{tail}")
    local = materialise(local, "local")

    tops = local.where("kind is null and id = top").select("top", "link", "pos", F.col("most").alias("own"))
    target = local.select(
        F.col("id").alias("t_id"), F.col("top").alias("t_top"), F.col("hops").alias("t_hops"), F.col("most").alias("t_most"), F.col("kind").alias("t_kind"),
        *([F.col("path").alias("t_path")] if with_path else []),
    )
    found = tops.join(target, F.col("link") == F.col("t_id"), "left")
    missing = F.col("t_id").isNull()
    links = found.select(
        "top",
        F.when(missing, F.col("top")).otherwise(F.col("t_top")).alias("to"),
        F.when(missing, F.lit(0)).otherwise(F.col("t_hops") + 1).cast("bigint").alias("hops"),
        F.coalesce("t_most", F.lit(LOWEST)).alias("most"),
        F.when(missing, F.lit(ORPHAN)).otherwise(F.col("t_kind")).alias("kind"),
        "pos",
        *([F.coalesce("t_path", F.array().cast("array<string>")).alias("path")] if with_path else []),
    )
    links = materialise(links, "links")
    schema = f"top string, to string, hops bigint, most bigint, kind string, pos bigint{tail}"
    width, left = block_rows, links.where("kind is null").count()
    while left:
        per = links.groupBy(F.floor(F.col("pos") / width).alias("b")).count().agg(F.max("count").alias("m"), F.count("*").alias("n")).first()
        factor = block_rows // max(1, per["m"])
        if per["n"] < 2 or factor < 2:
            break
        width *= min(factor, per["n"])
        links = materialise(_by_block(links, width, _next_level(with_path), schema), "links")
        left = links.where("kind is null").count()
    while left:
        links = materialise(_double(links, with_path), "links")
        now = links.where("kind is null").count()
        if now == left:
            break
        left = now
    links = links.withColumn("kind", F.coalesce("kind", F.lit(CYCLE)))

    ended = local.where("kind is not null").select(
        "id", F.col("top").alias("root"), F.col("hops").alias("depth"), "most", "kind", *keep, *(["path"] if with_path else [])
    )
    up = links.select(
        F.col("top").alias("l_top"), F.col("to").alias("root"), F.col("hops").alias("l_hops"), F.col("most").alias("l_most"), F.col("kind").alias("l_kind"),
        *([F.col("path").alias("l_path")] if with_path else []),
    )
    waiting = local.where("kind is null").join(up, F.col("top") == F.col("l_top")).select(
        "id", "root", (F.col("hops") + F.col("l_hops")).alias("depth"), F.greatest("most", "l_most").alias("most"), F.col("l_kind").alias("kind"), *keep,
        *([F.concat("l_path", "path").alias("path")] if with_path else []),
    )
    out = ended.unionByName(waiting)
    cyclic = F.col("kind") == CYCLE
    changes = {"root": F.when(~cyclic, F.col("root")), "depth": F.when(cyclic, F.lit(-1)).otherwise(F.col("depth")).cast("bigint")}
    if with_path:
        changes["path"] = F.when(~cyclic, F.col("path"))
    return out.withColumns(changes)


def hierarchy(events: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(msg_id, root_id, depth) per message; ``cycle`` and -1 on or below a cycle.

    A message whose parent never arrived is a root. Blank identifiers take no
    part, a message that is its own parent is a cycle, and an empty table gives
    no rows.
    """
    out = resolve(messages(events), block_rows=block_rows)
    return out.select(F.col("id").alias("msg_id"), F.coalesce("root", F.lit(CYCLE)).alias("root_id"), "depth")


def _tree(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(parent position or -1, depth) of the nodes of whole trees, by an index on identifiers."""
    ids = pd.Index(table["id"].to_numpy(zero_copy_only=False))
    depth = table["depth"].to_numpy(zero_copy_only=False)
    above = ids.get_indexer(table["up"].to_numpy(zero_copy_only=False))
    return np.where(depth > 0, above, -1), depth


def _walk_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``path``: each node's parents, followed through the index, some nodes at a time."""
    held = list(batches)
    if not held:
        return
    table = pa.Table.from_batches(held)
    parent, depth = _tree(table)
    ids = table["id"].combine_chunks()
    order = np.argsort(depth, kind="stable")
    ends = np.cumsum(depth[order] + 1)
    first = 0
    while first < len(order):
        last = max(first + 1, int(np.searchsorted(ends, (ends[first - 1] if first else 0) + SLICE_ENTRIES, side="right")))
        nodes = order[first:last]
        offsets = np.concatenate([[0], np.cumsum(depth[nodes] + 1)])
        entries = np.empty(offsets[-1], np.int64)
        at, place = nodes, offsets[1:] - 1
        while len(at):
            entries[place] = at
            at, place = parent[at], place - 1
            more = at >= 0
            at, place = at[more], place[more]
        paths_ = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), ids.take(pa.array(entries)))
        some = table.take(pa.array(nodes))
        yield pa.RecordBatch.from_arrays([some["id"].combine_chunks(), some["root"].combine_chunks(), some["depth"].combine_chunks(), paths_], ["id", "root", "depth", "path"])
        first = last


def _number_down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``first``, a node's number in its tree with parents before children, and ``last``, that of its last descendant."""
    held = list(batches)
    if not held:
        return
    table = pa.Table.from_batches(held)
    parent, depth = _tree(table)
    n = len(parent)
    order = np.argsort(depth, kind="stable")
    levels = np.split(order, np.flatnonzero(np.diff(depth[order])) + 1)
    size = np.ones(n, np.int64)
    for nodes in reversed(levels[1:]):
        np.add.at(size, parent[nodes], size[nodes])
    name = np.argsort(np.argsort(table["id"].to_numpy(zero_copy_only=False), kind="stable"), kind="stable")
    siblings = np.lexsort((name, parent))
    before = np.cumsum(size[siblings]) - size[siblings]
    new = np.append(True, np.diff(parent[siblings]) != 0)
    offset = np.empty(n, np.int64)
    offset[siblings] = before - before[np.maximum.accumulate(np.where(new, np.arange(n), 0))]
    first = np.ones(n, np.int64)
    for nodes in levels[1:]:
        first[nodes] = first[parent[nodes]] + 1 + offset[nodes]
    columns = [table["id"].combine_chunks(), table["root"].combine_chunks(), pa.array(first), pa.array(first + size - 1)]
    yield pa.RecordBatch.from_arrays(columns, ["id", "root", "first", "last"])


def _by_size(events: DataFrame, block_rows: int, tree_rows: int) -> tuple[DataFrame, DataFrame, DataFrame | None, int]:
    """(resolved nodes without cycles, those on cycles, paths of trees too large to index or None, tasks for the others)."""
    nodes = messages(events).withColumns({"up": F.col("parent"), "place": F.col("pos")})
    rows = materialise(resolve(nodes, block_rows=block_rows, keep=("up", "place")), "resolved")
    sound = rows.where("root is not null")
    sizes = materialise(sound.groupBy("root").agg(F.count("*").alias("n")), "trees")
    total = sizes.agg(F.sum("n").alias("n"), F.count_if(F.col("n") > tree_rows).alias("large")).first()
    tasks = max(1, -(-2 * (total["n"] or 0) // tree_rows))
    if not total["large"]:
        return sound, rows.where("root is null"), None, tasks
    large = broadcast_if_small(sizes.where(F.col("n") > tree_rows).select("root"), total["large"] * 128)
    wide = resolve(sound.join(large, "root", "left_semi").select("id", F.col("up").alias("parent"), F.col("place").alias("pos")), with_path=True, block_rows=block_rows)
    return sound.join(large, "root", "left_anti"), rows.where("root is null"), wide.select("id", "root", "depth", "path"), tasks


def paths(events: DataFrame, block_rows: int = BLOCK_ROWS, tree_rows: int = TREE_ROWS) -> DataFrame:
    """(msg_id, root_id, depth, path): the identifiers from the root to the message.

    Trees go whole to tasks, which follow parents through an index and hold
    the paths of some nodes at a time. Trees of more than ``tree_rows`` nodes
    get theirs from the contraction. On or below a cycle the path is null.
    """
    sound, cyclic, wide, tasks = _by_size(events, block_rows, tree_rows)
    out = sound.select("id", "root", "depth", "up").repartition(tasks, "root").mapInArrow(_walk_up, "id string, root string, depth bigint, path array<string>")
    if wide is not None:
        out = out.unionByName(wide)
    out = out.unionByName(cyclic.select("id", "root", "depth", F.lit(None).cast("array<string>").alias("path")))
    return out.select(F.col("id").alias("msg_id"), F.coalesce("root", F.lit(CYCLE)).alias("root_id"), "depth", "path")


def descendants(events: DataFrame, block_rows: int = BLOCK_ROWS, tree_rows: int = TREE_ROWS) -> DataFrame:
    """(msg_id, root_id, first, last): the descendants of a message are those of its root with ``first`` in (first, last].

    One row per message names them all, where the pairs of a chain grow with
    the square of its length. Messages are numbered within their tree from 1,
    parents before children, siblings by identifier. Both numbers are null on
    or below a cycle.
    """
    sound, cyclic, wide, tasks = _by_size(events, block_rows, tree_rows)
    out = sound.select("id", "root", "depth", "up").repartition(tasks, "root").mapInArrow(_number_down, "id string, root string, first bigint, last bigint")
    if wide is not None:
        wide = materialise(wide, "large-paths")
        sizes = wide.select("root", F.explode("path").alias("id")).groupBy("root", "id").agg(F.count("*").alias("n"))
        placed = ordered.numbered(wide.select("id", "root", "path"), ["root"], ["path"], "first").drop("path")
        out = out.unionByName(placed.join(sizes, ["root", "id"]).select("id", "root", "first", (F.col("first") + F.col("n") - 1).alias("last")))
    none = F.lit(None).cast("bigint")
    out = out.unionByName(cyclic.select("id", "root", none.alias("first"), none.alias("last")))
    return out.select(F.col("id").alias("msg_id"), F.coalesce("root", F.lit(CYCLE)).alias("root_id"), "first", "last")
