"""Running aggregates over ordered rows of a key, safe for hot keys.

Rows are range-partitioned by key and order, so a key that holds a third of
them spreads over many tasks. Each range keeps its own running values; what the
earlier ranges of the same key contribute comes from one summary row per key
and range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.session import materialise

SUM, MAX, LAST, LAG, LEAD, COUNT = "sum", "max", "last", "lag", "lead", "count"
_PART = "__part"


def ranged(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``df`` cut into ranges of keys and order once, for several calls of ``running``.

    Give it the columns that are needed, as all of them are written. ``whole``
    takes the mark of the ranges off again. Rows that are in ranges stay so.
    """
    if _PART in df.columns:
        return df
    return materialise(df.repartitionByRange(*keys, *order).withColumn(_PART, F.spark_partition_id()), "ordered")


def whole(df: DataFrame) -> DataFrame:
    return df.drop(_PART)


def running(df: DataFrame, keys: list[str], order: list[str], values: dict[str, tuple[str, Column]]) -> DataFrame:
    """Adds one column per entry of ``values``, in the order of ``order`` within ``keys``.

    ``sum``, ``max`` and ``count`` run up to and including the row, ``last`` is
    the last value that is not null up to and including it, ``lag`` the value
    of the row before, ``lead`` that of the row after. ``order`` must be total
    within a key for a defined result. Rows from ``ranged``, by the same keys
    and order, stay where they are.
    """
    named = df.withColumns({f"__{n}": c for n, (_, c) in values.items()})
    rows_ = named if _PART in df.columns else ranged(named, keys, order)
    inside = Window.partitionBy(*keys, _PART).orderBy(*order)
    upto = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    own, total = {}, {}
    for name, (kind, _) in values.items():
        c = F.col(f"__{name}")
        if kind == SUM:
            own[f"__o_{name}"], total[f"__w_{name}"] = F.sum(c).over(upto), F.sum(c)
        elif kind == COUNT:
            own[f"__o_{name}"], total[f"__w_{name}"] = F.count(c).over(upto), F.count(c)
        elif kind == MAX:
            own[f"__o_{name}"], total[f"__w_{name}"] = F.max(c).over(upto), F.max(c)
        elif kind == LAST:
            own[f"__o_{name}"] = F.last(c, ignorenulls=True).over(upto)
            total[f"__w_{name}"] = F.max_by(c, F.when(c.isNotNull(), F.struct(*order)))
        elif kind == LEAD:
            own[f"__o_{name}"] = F.lead(c).over(inside)
            total[f"__w_{name}"] = F.min_by(c, F.struct(*order))
        else:
            own[f"__o_{name}"] = F.lag(c).over(inside)
            total[f"__w_{name}"] = F.max_by(c, F.struct(*order))
    if any(kind == LEAD for kind, _ in values.values()):
        own["__last"] = F.lead(F.lit(True)).over(inside).isNull()
    rows = rows_.withColumns(own | {"__first": F.row_number().over(inside) == 1})
    per = rows_.groupBy(*keys, _PART).agg(*(c.alias(n) for n, c in total.items()))
    earlier = Window.partitionBy(*keys).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    nearest = Window.partitionBy(*keys).orderBy(_PART)
    before = {}
    for name, (kind, _) in values.items():
        c = F.col(f"__w_{name}")
        before[f"__b_{name}"] = (
            F.sum(c).over(earlier) if kind in (SUM, COUNT) else F.max(c).over(earlier) if kind == MAX
            else F.last(c, ignorenulls=True).over(earlier) if kind == LAST else F.lead(c).over(nearest) if kind == LEAD else F.lag(c).over(nearest)
        )
    offsets = per.select(*(F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)), F.col(_PART).alias("__p"), *(c.alias(n) for n, c in before.items()))
    same = [rows[k].eqNullSafe(offsets[f"__k{i}"]) for i, k in enumerate(keys)]
    joined = rows.join(offsets, [*same, rows[_PART] == offsets["__p"]], "left")
    out = {}
    for name, (kind, _) in values.items():
        o, b = F.col(f"__o_{name}"), F.col(f"__b_{name}")
        if kind in (SUM, COUNT):
            out[name] = F.coalesce(o + b, o, b)
        elif kind == MAX:
            out[name] = F.greatest(o, b)
        elif kind == LAST:
            out[name] = F.coalesce(o, b)
        elif kind == LEAD:
            out[name] = F.when(F.col("__last"), b).otherwise(o)
        else:
            out[name] = F.when(F.col("__first"), b).otherwise(o)
    return joined.withColumns(out).select(*(c for c in df.columns if c not in out), *out)


def numbered(df: DataFrame, keys: list[str], order: list[str], name: str = "pos") -> DataFrame:
    """Adds the position of each row within its key, from 1."""
    return running(df, keys, order, {name: (COUNT, F.lit(1))}).withColumn(name, F.col(name).cast("bigint"))


def as_of(left: DataFrame, right: DataFrame, keys: list[str], time: str, values: list[str], tie: str, strict: bool = False) -> DataFrame:
    """``left`` with the ``values`` of the last row of ``right`` at or before its ``time``.

    ``strict`` takes rows strictly before. Both sides are merged into one order
    and the values carried forward, so there is no inequality join. Of rows of
    ``right`` with equal time the one with the larger ``tie`` counts.
    """
    mark = F.lit(1 if not strict else -1)
    carried = F.struct(*(F.col(v) for v in values))
    a = left.select("*", F.lit(0).alias("__side"), F.lit(None).cast(right.select(carried.alias("c")).schema["c"].dataType).alias("__value"), F.col(tie).alias("__tie"))
    b = right.select(
        *(F.col(c) if c in (*keys, time) else F.lit(None).cast(left.schema[c].dataType).alias(c) for c in left.columns),
        (-mark).alias("__side"), carried.alias("__value"), F.col(tie).alias("__tie"),
    )
    both = running(a.unionByName(b), keys, [time, "__side", "__tie"], {"__found": (LAST, F.col("__value"))})
    rows = both.where("__side = 0")
    return rows.select(*left.columns, *(F.col(f"__found.{v}").alias(f"asof_{v}") for v in values))
