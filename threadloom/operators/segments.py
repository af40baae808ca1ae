"""Cutting ordered rows into segments, and labels and checks for them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.operators.ordered import COUNT, LAG, LAST, LEAD, MAX, SUM, ranged, running, whole
from threadloom.session import materialise

GAP_SECONDS = 1800


def smoothed_topics(rows: DataFrame, keys: list[str], order: list[str], topic: str, noise: Column) -> DataFrame:
    """Adds ``effective``: noise rows inherit the last valid topic, ``-`` before the first."""
    filled = running(rows, keys, order, {"effective": (LAST, F.when(~F.coalesce(noise, F.lit(False)), F.col(topic)))})
    return filled.withColumn("effective", F.coalesce("effective", F.lit("-")))


def gap_segments(rows: DataFrame, keys: list[str], order: list[str], seconds: Column, gap: int = GAP_SECONDS) -> DataFrame:
    """Adds ``segment`` from 0: a new one after a pause of ``gap`` seconds or more."""
    before = running(ranged(rows, keys, order), keys, order, {"__before": (LAG, seconds)})
    cut = F.coalesce((seconds - F.col("__before") >= gap).cast("int"), F.lit(0))
    return whole(running(before, keys, order, {"segment": (SUM, cut)})).drop("__before").withColumn("segment", F.col("segment").cast("bigint"))


def topic_segments(rows: DataFrame, keys: list[str], order: list[str], seconds: Column, effective: str, gap: int = GAP_SECONDS) -> DataFrame:
    """As ``gap_segments``, and a new segment where a topic changes and the next row confirms it.

    A change on the last row of a key always cuts. The row before stands for
    the running topic of the segment, confirmed or not.
    """
    rows = running(ranged(rows, keys, order), keys, order, {"__before": (LAG, seconds), "__topic": (LAG, F.col(effective)), "__next": (LEAD, F.col(effective))})
    changed = F.col("__topic").isNotNull() & (F.col(effective) != F.col("__topic")) & (F.col("__next").isNull() | (F.col("__next") == F.col(effective)))
    cut = F.coalesce((seconds - F.col("__before") >= gap), F.lit(False)) | F.coalesce(changed, F.lit(False))
    return whole(running(rows, keys, order, {"segment": (SUM, cut.cast("int"))})).drop("__before", "__topic", "__next").withColumn("segment", F.col("segment").cast("bigint"))


def labels(rows: DataFrame, keys: list[str], order: list[str], topic: str, noise: Column) -> DataFrame:
    """Per segment: dominant topic (first seen wins ties), size, first text that is no noise."""
    counts = rows.groupBy(*keys, "segment", topic).agg(F.count("*").alias("n"), F.min(F.struct(*order)).alias("seen"))
    best = counts.groupBy(*keys, "segment").agg(F.min(F.struct((-F.col("n")).alias("m"), "seen", F.col(topic).alias("t"))).alias("b"))
    first = rows.groupBy(*keys, "segment").agg(
        F.count("*").alias("n_rows"), F.min(F.when(~F.coalesce(noise, F.lit(False)) & F.col("text").isNotNull(), F.struct(*order, F.substring("text", 1, 40).alias("x")))).alias("f")
    )
    return first.join(best, [*keys, "segment"]).select(*keys, "segment", "n_rows", F.col("b.t").alias("dominant"), F.col("f.x").alias("first_text"))


def partition_faults(rows: DataFrame, segmented: DataFrame, keys: list[str], row_key: str, seconds: str) -> DataFrame:
    """Counts of what a segmentation may not have: lost, doubled and new rows, empty and unordered segments."""
    a, b = rows.select(F.col(row_key).alias("a")), segmented.groupBy(F.col(row_key).alias("b")).agg(F.count("*").alias("n"))
    cover = a.join(b, F.col("a") == F.col("b"), "full").agg(
        F.count_if(F.col("b").isNull()).alias("lost"), F.count_if(F.col("a").isNull()).alias("invented"), F.count_if(F.col("n") > 1).alias("doubled")
    )
    spans = segmented.groupBy(*keys, "segment").agg(F.min(seconds).alias("lo"), F.max(seconds).alias("hi"))
    w = Window.partitionBy(*keys).orderBy("segment")
    disorder = spans.withColumn("before", F.lag("hi").over(w)).agg(F.count_if(F.col("lo") < F.col("before")).alias("unordered"))
    names = ("lost", "invented", "doubled", "unordered")
    zero = lambda df: df.select(*(F.col(n) if n in df.columns else F.lit(0).cast("bigint").alias(n) for n in names))
    return zero(cover).unionByName(zero(disorder)).agg(*(F.sum(n).alias(n) for n in names))


def epochs(rows: DataFrame, keys: list[str], order: list[str], is_history: Column) -> DataFrame:
    """Adds ``epoch`` (history rows so far) and ``history_at``, the place of the latest one."""
    place = running(ranged(rows, keys, order), keys, order, {"epoch": (SUM, is_history.cast("int")), "turn": (COUNT, F.lit(1))})
    return whole(running(place, keys, order, {"history_at": (LAST, F.when(is_history, F.col("turn")))})).withColumns(
        {"epoch": F.coalesce("epoch", F.lit(0)).cast("bigint"), "turn": F.col("turn").cast("bigint"), "history_at": F.col("history_at").cast("bigint")}
    )


def increasing(rows: DataFrame, keys: list[str], order: list[str], base: str) -> DataFrame:
    """Adds ``unique_value``: at least ``base`` and above every earlier one."""
    n = running(ranged(rows, keys, order), keys, order, {"__n": (COUNT, F.lit(1))})
    top = running(n, keys, order, {"__top": (MAX, F.col(base) - F.col("__n"))})
    return whole(top).withColumn("unique_value", (F.col("__n") + F.col("__top")).cast("bigint")).drop("__n", "__top")


def intervals(starts: DataFrame, keys: list[str], start: str, last: str) -> DataFrame:
    """Distinct boundaries as intervals: each ends before the next begins, the final one at ``last``."""
    w = Window.partitionBy(*keys).orderBy(start)
    rows = starts.groupBy(*keys, start).agg(F.max(last).alias(last))
    return rows.select(*keys, F.col(start).alias("lo"), F.coalesce(F.lead(start).over(w) - 1, F.col(last)).alias("hi"))


def terminal_flags(clusters: DataFrame, keys: list[str], closing: Column) -> DataFrame:
    """Only the cluster touched last can be open, and it is unless its last user row closes it."""
    latest = clusters.groupBy(*keys).agg(F.max(F.struct("last_ts", "cluster")).alias("l"))
    j = clusters.join(latest, keys).withColumn("is_latest", F.col("cluster") == F.col("l.cluster"))
    return j.withColumn("terminal", ~F.col("is_latest") | F.coalesce(closing, F.lit(False))).drop("l")


def next_ordinals(known: DataFrame, new: DataFrame, key: str, ordinal: str, order: list[str]) -> DataFrame:
    """New rows numbered on from the last ordinal of their key; a known row without one is fatal."""
    known = known.withColumn(ordinal, F.coalesce(F.col(ordinal), F.raise_error(F.lit("a known row has no ordinal")).cast("bigint")))
    top = known.groupBy(F.col(key).alias("__k")).agg(F.max(ordinal).alias("__top"))
    n = running(new, [key], order, {"__n": (COUNT, F.lit(1))})
    return n.join(top, F.col(key) == F.col("__k"), "left").withColumn("ordinal", (F.coalesce(F.col("__top") + 1, F.lit(0)) + F.col("__n") - 1).cast("bigint")).drop("__k", "__top", "__n")


def unique_ids(rows: DataFrame, id_col: str, order: list[str]) -> DataFrame:
    """Adds ``unique_id``: in order, a repeat gets the next suffix from -2 that is free; blanks get row-<n>.

    Only where another id looks like a repeat's must what was given be looked
    up; such ids go to one task by what is left without their suffixes.
    """
    from threadloom.operators import folds

    n = running(rows.withColumn("__all", F.lit(0)), ["__all"], order, {"__row": (COUNT, F.lit(1))}).drop("__all")
    named = n.withColumn("__base", F.when(F.trim(F.coalesce(F.col(id_col), F.lit(""))) == "", F.concat(F.lit("row-"), F.col("__row").cast("bigint").cast("string"))).otherwise(F.col(id_col)))
    named = materialise(named.withColumns({"__row": F.col("__row").cast("bigint"), "__stem": F.regexp_replace("__base", r"(-[0-9]+)+$", "")}), "ids")
    per = named.groupBy("__stem", "__base").agg(F.count("*").alias("k")).groupBy("__stem").agg(F.max("k").alias("most"), F.count("*").alias("bases"))
    unsure = per.where("most > 1 and bases > 1").select("__stem")
    plain = named.join(unsure, "__stem", "left_anti")
    k = running(plain, ["__base"], ["__row"], {"__k": (COUNT, F.lit(1))})
    given = k.select("__row", F.when(F.col("__k") == 1, F.col("__base")).otherwise(F.concat("__base", F.lit("-"), F.col("__k").cast("bigint").cast("string"))).alias("unique_id"))

    def step(state, row):
        name, suffix = row["__base"], state["next"].get(row["__base"], 2)
        while name in state["seen"]:
            name = f"{row['__base']}-{suffix}"
            suffix += 1
        state["next"][row["__base"]] = suffix
        state["seen"].add(name)
        return [{"__row": row["__row"], "unique_id": name}]

    some = named.join(unsure, "__stem", "left_semi").select("__stem", "__row", "__base")
    looked = folds.fold(some, ["__stem"], ["__row"], lambda: {"seen": set(), "next": {}}, step, "__row bigint, unique_id string")
    return named.join(given.unionByName(looked), "__row").drop("__row", "__base", "__stem")


def atomic_segments(rows: DataFrame, keys: list[str], order: list[str], seconds: Column, topic: str, gap: int = GAP_SECONDS) -> DataFrame:
    """Adds ``settled`` and ``segment``: as ``topic_segments``, but a lone row of another topic changes nothing.

    A topic settles where two rows on end have it; until the next one settles
    all rows belong to it. The first row of a key settles its own.
    """
    placed = running(ranged(rows, keys, order), keys, order, {"__before": (LAG, seconds), "__n": (COUNT, F.lit(1)), "__next": (LEAD, F.col(topic))})
    sure = F.coalesce(F.col("__next") == F.col(topic), F.lit(False)) | (F.col("__n") == 1)
    filled = running(placed, keys, order, {"settled": (LAST, F.when(sure, F.col(topic)))})
    previous = running(filled, keys, order, {"__settled": (LAG, F.col("settled"))})
    cut = F.coalesce(seconds - F.col("__before") >= gap, F.lit(False)) | F.coalesce(F.col("settled") != F.col("__settled"), F.lit(False))
    return whole(running(previous, keys, order, {"segment": (SUM, cut.cast("int"))})).drop("__before", "__n", "__next", "__settled").withColumn("segment", F.col("segment").cast("bigint"))
