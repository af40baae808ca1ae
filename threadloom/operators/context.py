"""Rows around anchors, by position, without inequality joins.

Positions are cut into tiles as wide as the window, ``TILE`` rows at most. An
anchor asks only the tiles its window touches, so the join is on equal (key,
tile), a hot key spreads over its tiles, and few of the rows met lie outside.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TILE = 256


def window_around(rows: DataFrame, anchors: DataFrame, keys: list[str], before: int, after: int) -> DataFrame:
    """Each anchor (keys, at, ...) with the rows from ``before`` before it to ``after`` after it.

    Adds ``off``, the distance to the anchor. A negative ``after`` leaves the
    anchor itself out.
    """
    width = max(1, min(TILE, before + after + 1))
    tile = lambda c: F.floor(c / width).cast("bigint")
    lo, hi = F.col("at") - before, F.col("at") + after
    asked = anchors.withColumn("__tile", F.explode(F.sequence(tile(F.greatest(lo, F.lit(0))), F.greatest(tile(hi), tile(F.greatest(lo, F.lit(0)))))))
    renamed = asked.select(*(F.col(c).alias(f"__{c}") if c in keys else F.col(c) for c in asked.columns))
    tiled = rows.withColumn("__row_tile", tile(F.col("pos")))
    on = [tiled[k] == renamed[f"__{k}"] for k in keys]
    joined = tiled.join(renamed, [*on, tiled["__row_tile"] == renamed["__tile"]])
    inside = (F.col("pos") >= lo) & (F.col("pos") <= hi)
    return joined.where(inside).withColumn("off", (F.col("pos") - F.col("at")).cast("bigint")).drop("__tile", "__row_tile", *(f"__{k}" for k in keys))


def counted_before(anchors: DataFrame, keys: list[str], before: int) -> DataFrame:
    """Adds ``n_context`` and ``first_pos``: how many rows the window of ``before`` rows strictly before ``at`` holds, and its first.

    Positions run from 1 without gaps, so both follow from ``at`` and no row is
    expanded. A null key has no window.
    """
    known = reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))
    n = F.when(known, F.least(F.col("at") - 1, F.lit(before))).otherwise(0).cast("bigint")
    return anchors.withColumn("n_context", n).withColumn("first_pos", F.when(F.col("n_context") > 0, F.col("at") - F.col("n_context")))


def first_after(rows: DataFrame, keys: list[str], good: Column, span: int) -> DataFrame:
    """Adds ``found_pos``: the nearest later row within ``span`` rows for which ``good`` holds."""
    targets = rows.where(good).select(*keys, F.col("pos").alias("__p"))
    # The nearest good row after is the last one before in reverse order.
    from threadloom.operators.ordered import LAG, LAST, running

    marked = rows.join(targets.withColumnRenamed("__p", "pos").withColumn("__good", F.lit(True)), [*keys, "pos"], "left")
    back = marked.withColumn("__back", -F.col("pos"))
    upto = running(back, keys, ["__back"], {"__upto": (LAST, F.when(F.col("__good"), F.col("pos")))})
    later = running(upto, keys, ["__back"], {"__later": (LAG, F.col("__upto"))})
    near = F.when(F.col("__later") - F.col("pos") <= span, F.col("__later"))
    return later.withColumn("found_pos", near).drop("__good", "__back", "__upto", "__later")


def last_before(rows: DataFrame, keys: list[str], good: Column, span: int | None = None) -> DataFrame:
    """Adds ``found_pos``: the nearest earlier row for which ``good`` holds."""
    from threadloom.operators.ordered import LAG, LAST, running

    upto = running(rows, keys, ["pos"], {"__upto": (LAST, F.when(good, F.col("pos")))})
    earlier = running(upto, keys, ["pos"], {"__earlier": (LAG, F.col("__upto"))})
    near = F.col("__earlier") if span is None else F.when(F.col("pos") - F.col("__earlier") <= span, F.col("__earlier"))
    return earlier.withColumn("found_pos", near).drop("__upto", "__earlier")
