"""Reply edges and what follows from them: agreement, chains, lanes, components."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.operators import forest
from threadloom.session import materialise


def edges(messages: DataFrame) -> DataFrame:
    """(child, parent) of replies whose parent exists."""
    c, p = messages.select(F.col("id").alias("child"), F.col("parent").alias("up")), messages.select(F.col("id").alias("parent"))
    return c.join(p, F.col("up") == F.col("parent")).select("child", "parent")


def edge_agreement(edges_: DataFrame, assignment: DataFrame) -> DataFrame:
    """How far an assignment (id, label) keeps replies together; a null on either side is unknown."""
    a = assignment.select(F.col("id").alias("a_id"), F.col("label").alias("child_label"))
    b = assignment.select(F.col("id").alias("b_id"), F.col("label").alias("parent_label"))
    j = edges_.join(a, F.col("child") == F.col("a_id"), "left").join(b, F.col("parent") == F.col("b_id"), "left")
    unknown = F.col("child_label").isNull() | F.col("parent_label").isNull()
    return j.agg(
        F.count("*").alias("n_edges"), F.count_if(unknown).alias("n_unknown"), F.count_if(F.col("child_label") == F.col("parent_label")).alias("n_same"),
        F.count_if(F.col("child_label") != F.col("parent_label")).alias("n_split"),
    )


def components(edges_: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """(id, component): the smallest identifier that can be reached, either way.

    Minimum labels with shortcuts: each round every node takes the smallest
    label around it and then that label's own label. Rounds grow with the
    logarithm of the longest chain, and the state is a table after each.
    """
    both = edges_.select(F.col("child").alias("a"), F.col("parent").alias("b")).unionByName(edges_.select(F.col("parent").alias("a"), F.col("child").alias("b")))
    both = materialise(both.where("a <> b").distinct(), "edges")
    ids = both.select(F.col("a").alias("id")) if nodes is None else nodes.select("id").unionByName(both.select(F.col("a").alias("id")))
    labels = materialise(ids.distinct().withColumn("label", F.col("id")), "labels")
    while True:
        around = both.join(labels, F.col("b") == F.col("id")).groupBy("a").agg(F.min("label").alias("near"))
        near = labels.join(around, F.col("id") == F.col("a"), "left").select("id", "label", F.least("label", "near").alias("next"))
        # Tell the old label of the smaller one too, so that whole trees move.
        hooks = near.where("next < label").groupBy(F.col("label").alias("h")).agg(F.min("next").alias("hook"))
        moved = near.join(hooks, F.col("next") == F.col("h"), "left").select("id", F.col("label").alias("old"), F.least("next", "hook").alias("next"))
        jump = moved.select(F.col("id").alias("j"), F.col("next").alias("far"))
        new = moved.join(jump, F.col("next") == F.col("j"), "left").select("id", F.least("next", "far").alias("label"), "old")
        new = materialise(new, "labels")
        changed = new.where("label <> old").limit(1).count()
        labels = new.select("id", "label")
        if not changed:
            return labels.withColumnRenamed("label", "component")


def chains(messages: DataFrame, max_depth: int = 16) -> DataFrame:
    """(id, ancestor, distance) for up to ``max_depth`` ancestors that exist."""
    up = materialise(edges(messages), "up")
    level = up.select(F.col("child").alias("id"), F.col("parent").alias("ancestor")).withColumn("distance", F.lit(1))
    out = level
    for k in range(2, max_depth + 1):
        level = materialise(level.join(up.select(F.col("child").alias("c"), F.col("parent").alias("p")), F.col("ancestor") == F.col("c")).select("id", F.col("p").alias("ancestor"), F.lit(k).alias("distance")), "chain")
        if not level.limit(1).count():
            break
        out = out.unionByName(level)
    return out


def roots(messages: DataFrame) -> DataFrame:
    """(id, root): the last known ancestor; null on and below cycles."""
    return forest.resolve(messages.select("id", "parent", F.col("row_id").alias("pos"))).select("id", "root", "depth", "kind")


def root_completeness(messages: DataFrame) -> DataFrame:
    """(id, root, complete): a missing parent is itself the root and marks the chain incomplete."""
    r = roots(messages)
    top = messages.select(F.col("id").alias("t"), F.col("parent").alias("t_parent"))
    j = r.join(top, r["root"] == top["t"], "left")
    missing = F.col("kind") == forest.ORPHAN
    return j.select("id", F.when(missing, F.col("t_parent")).otherwise(F.col("root")).alias("root"), (F.col("kind") == forest.ROOT).alias("complete"))


def lanes(messages: DataFrame, real: DataFrame, main: str = "main") -> DataFrame:
    """(id, lane, provenance): the own lane, else for replies that of the root if it is not the main one, else main."""
    own = real.select(F.col("id").alias("o"), F.col("lane").alias("own_lane"))
    of_root = real.select(F.col("id").alias("q"), F.col("lane").alias("root_lane"))
    r = roots(messages).join(messages.select(F.col("id").alias("m"), "parent"), F.col("id") == F.col("m"))
    j = r.join(own, F.col("id") == F.col("o"), "left").join(of_root, F.col("root") == F.col("q"), "left")
    inherited = F.col("parent").isNotNull() & F.col("root_lane").isNotNull() & (F.col("root_lane") != main)
    return j.select(
        "id",
        F.when(F.col("own_lane").isNotNull(), F.col("own_lane")).when(inherited, F.col("root_lane")).otherwise(F.lit(main)).alias("lane"),
        F.when(F.col("own_lane").isNotNull(), F.lit("real")).when(inherited, F.lit("root")).otherwise(F.lit("main")).alias("provenance"),
    )


def upsert_edges(edges_: DataFrame, child: str = "child", order: str = "row_id") -> DataFrame:
    """One parent per child: the last write wins."""
    last = edges_.groupBy(child).agg(F.max(F.struct(order, *(c for c in edges_.columns if c not in (child, order)))).alias("r"))
    return last.select(child, "r.*")


def with_status(edges_: DataFrame, updates: DataFrame, child: str = "child", order: str = "row_id") -> DataFrame:
    """Edges with the last status that ``updates`` (child, status, order) gives; unknown children change nothing."""
    last = updates.groupBy(F.col(child).alias("__c")).agg(F.max(F.struct(order, "status"))["status"].alias("__status"))
    j = edges_.join(last, F.col(child) == F.col("__c"), "left")
    return j.withColumn("status", F.coalesce("__status", "status")).drop("__c", "__status")


def descendants(spawn: DataFrame, top: DataFrame, status: str | None = None) -> DataFrame:
    """(top, id, depth) breadth first, to the last level; a status filter holds for every edge passed.

    Each path carries the node it held at the last depth that is a power of
    two. A path that comes back to it runs in a cycle, which is an error.
    """
    use = spawn if status is None else spawn.where(F.col("status") == status)
    use = materialise(use.select("parent", "child"), "spawn")
    level = materialise(top.select(F.col("id").alias("top"), F.col("id"), F.lit(0).alias("depth"), F.col("id").alias("mark")), "level")
    out, k = None, 0
    while True:
        k += 1
        mark = F.col("id") if k > 1 and (k - 1) & (k - 2) == 0 else F.col("mark")
        level = level.withColumn("mark", mark).join(use, F.col("id") == F.col("parent")).select("top", F.col("child").alias("id"), F.lit(k).alias("depth"), "mark")
        level = materialise(level, "level")
        met = level.select((F.col("id") == F.col("mark")).alias("c")).agg(F.count("*").alias("n"), F.count_if("c").alias("n_cyclic")).first()
        if met.n_cyclic:
            raise ValueError(f"the edges hold a cycle: {met.n_cyclic} paths come back to a node by depth {k}")
        if not met.n:
            break
        found = level.drop("mark")
        out = found if out is None else out.unionByName(found)
    return level.drop("mark") if out is None else out


def reopened(frozen: DataFrame, new_events: DataFrame) -> DataFrame:
    """(task) frozen tasks that a new event replies to; of tasks that share a message the last counts."""
    owner = frozen.groupBy("id").agg(F.max_by("task", "task_pos").alias("task"))
    return new_events.join(owner, new_events["parent"] == owner["id"], "inner").select("task").distinct()


def tree_components(messages: DataFrame) -> DataFrame:
    """As ``components`` of the reply edges. A tree is a component, labelled by its smallest identifier.

    Only what hangs on a cycle goes through label rounds. Messages without any
    reply edge are left out.
    """
    r = materialise(roots(messages), "roots")
    smallest = r.where("root is not null").groupBy("root").agg(F.min("id").alias("component"), F.count("*").alias("n")).where("n > 1")
    trees = r.where("root is not null").join(smallest, "root").select("id", "component")
    cyclic = messages.join(r.where("root is null").select("id"), "id", "left_semi")
    return trees.unionByName(components(edges(cyclic).where("child <> parent")))
