"""Comparing results with gold rows, votes, distributions and audits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CLASSES = ("exact", "t0_mismatch", "bot_error_without_corrector", "corrector_with_wrong_bot_error", "same_t0_wrong_pair", "candidate_pool_only", "missed")


def gold_classes(gold: DataFrame, found: DataFrame, pool: DataFrame) -> DataFrame:
    """(card, class): the best way in which a gold triple (t0, b, c) was found.

    One equi-join per class and the smallest priority, in place of a join on
    alternatives. Gold rows with a missing id cannot be evaluated.
    """
    g = gold.select("card", "t0", "b", "c")
    keys = [(["t0", "b", "c"], 0), (["b", "c"], 1), (["b"], 2), (["c"], 3), (["t0"], 4)]
    hits = None
    for on, rank in keys:
        f = found.select(*on).where(" and ".join(f"{k} is not null" for k in on)).distinct()
        h = g.join(f, on, "left_semi").select("card", F.lit(rank).alias("rank"))
        hits = h if hits is None else hits.unionByName(h)
    in_pool = g.join(pool.select(F.col("corrector").alias("c")).distinct(), "c", "left_semi").select("card", F.lit(5).alias("rank"))
    best = hits.unionByName(in_pool).groupBy("card").agg(F.min("rank").alias("rank"))
    name = F.when(F.col("t0").isNull() | F.col("b").isNull() | F.col("c").isNull(), "not_evaluable")
    for i, c in enumerate(CLASSES[:-1]):
        name = name.when(F.col("rank") == i, c)
    return g.join(best, "card", "left").select("card", name.otherwise(CLASSES[-1]).alias("class"))


def lineage(gold: DataFrame, stages: list[tuple[str, DataFrame]]) -> DataFrame:
    """(card, stage, label): how each stage still holds a gold row, and per card the last strong stage."""
    rows = None
    for at, (name, df) in enumerate(stages):
        g = gold.select("card", "t0", "b", "c")
        label = None
        for text, on, rank in (("exact_t0_b_c", ["t0", "b", "c"], 0), ("exact_b_c", ["b", "c"], 1), ("b_only", ["b"], 3), ("c_only", ["c"], 4), ("t0_only", ["t0"], 5)):
            h = g.join(df.select(*on).distinct(), on, "left_semi").select("card", F.struct(F.lit(rank).alias("rank"), F.lit(text).alias("label")).alias("m"))
            label = h if label is None else label.unionByName(h)
        best = label.groupBy("card").agg(
            F.min("m").alias("m"), F.max(F.col("m.rank") == 3).alias("has_b"), F.max(F.col("m.rank") == 4).alias("has_c")
        )
        named = g.select("card").join(best, "card", "left").select(
            "card", F.lit(at).alias("stage_no"), F.lit(name).alias("stage"),
            F.when(F.col("m.rank") < 2, F.col("m.label")).when(F.col("has_b") & F.col("has_c"), "b_and_c_separate").otherwise(F.coalesce("m.label", F.lit("absent"))).alias("label"),
        )
        rows = named if rows is None else rows.unionByName(named)
    return rows


def last_strong_stage(lineage_: DataFrame) -> DataFrame:
    strong = F.col("label").isin("exact_t0_b_c", "exact_b_c")
    per = lineage_.groupBy("card").agg(F.max(F.when(strong, F.struct("stage_no", "stage")))["stage"].alias("stage"))
    return per.groupBy(F.coalesce("stage", F.lit("none")).alias("stage")).agg(F.count("*").alias("n"))


def distribution(rows: DataFrame, value: str, threshold: int) -> DataFrame:
    """Exact percentiles, cut to whole numbers, and the share beyond a threshold."""
    p = F.percentile(value, [0.5, 0.75, 0.9, 0.95, 0.99])
    cut = lambda i: F.floor(F.round(F.col("p")[i], 6)).cast("bigint")
    over = F.count_if(F.col(value) > threshold)
    agg = rows.agg(F.count(value).alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi"), F.round(F.avg(value), 3).alias("mean"), p.alias("p"), over.alias("n_over"))
    names = ("p50", "p75", "p90", "p95", "p99")
    return agg.select("n", "lo", "hi", "mean", *(cut(i).alias(n) for i, n in enumerate(names)), "n_over", F.round(100 * F.col("n_over") / F.col("n"), 3).alias("percent_over"))


def strict_majority(votes: DataFrame, by: list[str], yes: Column) -> DataFrame:
    """Passes only with more than half of the votes; a tie keeps."""
    return votes.groupBy(*by).agg(F.count_if(yes).alias("n_yes"), F.count("*").alias("n")).withColumn("passes", F.col("n_yes") > F.floor(F.col("n") / 2))


def three_valued_vote(votes: DataFrame, by: list[str], failed: Column) -> DataFrame:
    """True, false, or null on a tie or without valid votes; invalid votes are ignored."""
    n = votes.groupBy(*by).agg(F.count_if(failed).alias("n_failed"), F.count_if(failed.isNotNull()).alias("n_valid"))
    return n.withColumn("failed", F.when(2 * F.col("n_failed") > F.col("n_valid"), True).when(2 * F.col("n_failed") < F.col("n_valid"), False))


def set_compare(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Sizes of the intersection and both differences of two sets of keys."""
    a, b = left.select(F.col(on).alias("a")).distinct(), right.select(F.col(on).alias("b")).distinct()
    return a.join(b, F.col("a") == F.col("b"), "full").agg(
        F.count_if(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("both"), F.count_if(F.col("b").isNull()).alias("only_left"), F.count_if(F.col("a").isNull()).alias("only_right")
    )


def membership_audit(members: DataFrame, everyone: DataFrame) -> DataFrame:
    """(id, fault): ids in several tasks, and ids in none."""
    many = members.groupBy("id").agg(F.count_distinct("task").alias("n")).where("n > 1").select("id", F.lit("several").alias("fault"))
    none = everyone.join(members.select("id").distinct(), "id", "left_anti").select("id", F.lit("none").alias("fault"))
    return many.unionByName(none)


def assembled(members: DataFrame, everyone: DataFrame) -> DataFrame:
    """(id, task): doubled ids go to their first task, missing ones form tasks of their own."""
    first = members.groupBy("id").agg(F.min(F.struct("task_pos", "task"))["task"].alias("task"))
    orphans = everyone.join(first.select("id"), "id", "left_anti").select("id", F.concat(F.lit("orphan-"), "id").alias("task"))
    return first.unionByName(orphans)


def containment(old: DataFrame, new: DataFrame) -> DataFrame:
    """(old, new, shared, containment): the share of an old cluster's ids in a new one."""
    size = old.groupBy("old").agg(F.count_distinct("id").alias("size"))
    shared = old.distinct().join(new.distinct(), "id").groupBy("old", "new").agg(F.count("*").alias("shared"))
    return shared.join(size, "old").select("old", "new", "shared", F.round(F.col("shared") / F.col("size"), 6).alias("containment"))


def majority_labels(rows: DataFrame, by: list[str], label: str, order: str) -> DataFrame:
    """The most frequent label of each group; the one seen first wins a tie."""
    counts = rows.where(F.col(label).isNotNull()).groupBy(*by, label).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    best = counts.groupBy(*by).agg(F.min(F.struct((-F.col("n")).alias("m"), "first", label)).alias("b"))
    return best.select(*by, F.col(f"b.{label}").alias(label), (-F.col("b.m")).alias("n"))


def carried_titles(old: DataFrame, new: DataFrame, least: float = 0.6) -> DataFrame:
    """(new, title, containment): the title that each new cluster takes over, if any.

    ``old`` has old, pos, title and id, ``new`` new and id, both a row per
    member. A cluster takes the title of the old one that it holds the largest
    share of, at least ``least``, the earliest of equals. Clusters share no
    member, so above one half an old cluster can only go to one new one and
    none is used twice. Old clusters without title carry nothing.
    """
    if least <= 0.5:
        raise ValueError("below one half an old cluster could go to two new ones")
    titled = old.where(F.trim(F.coalesce("title", F.lit(""))) != "")
    shares = containment(titled.select("old", "id"), new).where(F.col("containment") >= least)
    named = titled.groupBy("old").agg(F.min(F.struct("pos", "title")).alias("t"))
    best = shares.join(named, "old").groupBy("new").agg(F.max(F.struct("containment", (-F.col("t.pos")).alias("p"), "t.title")).alias("b"))
    return best.select("new", "b.title", "b.containment")
