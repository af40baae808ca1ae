"""Which message an instruction, an error or a correction goes back to."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.operators import context, replies


def instruction_before(rows: DataFrame, keys: list[str], is_instruction: Column) -> DataFrame:
    """Adds ``instruction_pos``: the nearest earlier row that gives an instruction."""
    return context.last_before(rows, keys, is_instruction).withColumnRenamed("found_pos", "instruction_pos")


def reanchored(rows: DataFrame, pairs: DataFrame, keys: list[str], is_human: Column) -> DataFrame:
    """(corrector, anchor, human): who really corrected, for pairs of positions.

    Strictly between anchor and corrector: the last reply to the anchor by a
    human, else the last human row; null when there is none.
    """
    near = context.last_before(rows, keys, is_human)
    place = near.select(F.col("id").alias("n_id"), F.col("found_pos"), F.col("pos").alias("c_pos"), *(F.col(k).alias(f"c_{k}") for k in keys))
    p = pairs.join(place, F.col("corrector") == F.col("n_id")).join(rows.select(F.col("id").alias("a_id"), F.col("pos").alias("a_pos")), F.col("anchor") == F.col("a_id"))
    by_pos = rows.select(*(F.col(k).alias(f"h_{k}") for k in keys), F.col("pos").alias("h_pos"), F.col("id").alias("nearest"))
    on = [F.col(f"c_{k}") == F.col(f"h_{k}") for k in keys]
    p = p.join(by_pos, [*on, F.col("found_pos") == F.col("h_pos")], "left")
    said = rows.where(is_human).select(F.col("parent").alias("r_parent"), F.col("pos").alias("r_pos"), F.col("id").alias("r_id"), *(F.col(k).alias(f"r_{k}") for k in keys))
    session = [F.col(f"c_{k}") == F.col(f"r_{k}") for k in keys]
    hits = p.join(said, reduce(lambda a, b: a & b, session) & (F.col("anchor") == F.col("r_parent")) & (F.col("r_pos") > F.col("a_pos")) & (F.col("r_pos") < F.col("c_pos")), "left")
    last = hits.groupBy("corrector", "anchor").agg(F.max(F.struct("r_pos", "r_id"))["r_id"].alias("reply"), F.max(F.when(F.col("found_pos") > F.col("a_pos"), F.col("nearest"))).alias("nearest"))
    return last.select("corrector", "anchor", F.coalesce("reply", "nearest").alias("human"))


def in_parent_chain(messages: DataFrame, good: Column, max_depth: int = 16) -> DataFrame:
    """(id, ancestor, distance): the nearest ancestor for which ``good`` holds."""
    chain = replies.chains(messages, max_depth)
    fit = messages.where(good).select(F.col("id").alias("g"))
    best = chain.join(fit, F.col("ancestor") == F.col("g")).groupBy("id").agg(F.min(F.struct("distance", "ancestor")).alias("b"))
    return best.select("id", "b.ancestor", "b.distance")


def chosen_context(rows: DataFrame, keys: list[str], limit: int = 80) -> DataFrame:
    """(id, quality, n_context) per message with a time: which rows before it a replay may see.

    Earlier rows of the same reply tree if the message has a parent, told apart
    by whether that chain is complete; else the rows before it in its session.
    ``rows`` has root, complete, and pos in the session.
    """
    from threadloom.operators.ordered import COUNT, running

    in_tree = running(rows, ["root"], ["ts_us", "row_id"], {"__n": (COUNT, F.lit(1))})
    same = running(in_tree, ["root", "ts_us"], ["row_id"], {"__same": (COUNT, F.lit(1))})
    earlier = F.col("__n") - F.col("__same")
    use_tree = F.col("parent").isNotNull() & F.col("root").isNotNull() & (earlier > 0)
    quality = F.when(use_tree & F.col("complete"), "exact_thread").when(use_tree, "recovered_by_parent").when(F.col("pos") > 1, "same_session_window").otherwise("missing_or_ambiguous")
    n = F.when(use_tree, earlier).otherwise(F.col("pos") - 1)
    return same.select("id", quality.alias("quality"), F.least(n, F.lit(limit)).cast("bigint").alias("n_context"))
