"""Event logs of starts and ends as entity tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def spans(starts: DataFrame, ends: DataFrame, key: str, order: str) -> DataFrame:
    """Each start with the first end of its key; ends without a start are left out."""
    first = ends.groupBy(F.col(key).alias("__k")).agg(F.min(F.struct(F.col(order).alias("end_at"), F.col("status").alias("end_status"))).alias("e"))
    return starts.join(first, F.col(key) == F.col("__k"), "left").select(*starts.columns, "e.end_at", "e.end_status")


def closed_by_turn(calls: DataFrame, turns: DataFrame) -> DataFrame:
    """Calls that never ended end with their turn: completed or cancelled turns cancel them, others pass their state on."""
    t = turns.select(F.col("turn").alias("__t"), F.col("end_at").alias("turn_end"), F.col("end_status").alias("turn_status"))
    j = calls.join(t, F.col("turn") == F.col("__t"), "left").drop("__t")
    passed = F.when(F.col("turn_status").isin("completed", "cancelled"), "cancelled").otherwise(F.col("turn_status"))
    still = F.col("end_at").isNull()
    return j.withColumns({"status": F.when(still, F.coalesce(passed, F.lit("running"))).otherwise(F.col("end_status")), "closed_at": F.coalesce("end_at", "turn_end")}).drop("turn_end", "turn_status")


def transitions(log: DataFrame, key: str, order: str, allowed: dict[str, tuple[str, ...]], initial: str = "pending") -> DataFrame:
    """The state of each item after guarded transitions; late and forbidden ones are counted.

    The fold runs on the item's own ordered log, an array.
    """
    arrows = F.create_map(*(x for k, v in allowed.items() for x in (F.lit(k), F.array(*map(F.lit, v)) if v else F.array().cast("array<string>"))))
    logged = log.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, "to"))).alias("x"))
    state = F.aggregate(
        "x",
        F.struct(F.lit(initial).alias("state"), F.lit(0).alias("attempts"), F.lit(0).alias("rejected")),
        lambda a, e: F.when(
            F.array_contains(F.element_at(arrows, a["state"]), e["to"]),
            F.struct(e["to"].alias("state"), (a["attempts"] + (e["to"] == "running").cast("int")).alias("attempts"), a["rejected"].alias("rejected")),
        ).otherwise(F.struct(a["state"].alias("state"), a["attempts"].alias("attempts"), (a["rejected"] + 1).alias("rejected"))),
    )
    return logged.select(key, state.alias("s")).select(key, "s.state", "s.attempts", "s.rejected")


def message_thread_ids(calls: DataFrame) -> DataFrame:
    """(call, thread, provisional): the hashed path of messages down to the first assistant's.

    ``calls`` has call and keys, the ordered ``role:fingerprint`` texts. It is a
    function of the call alone, so nothing is shuffled.
    """
    at = F.array_position(F.transform("keys", lambda k: F.startswith(k, F.lit("assistant:"))), True)
    cut = F.when(at > 0, F.slice("keys", 1, at.cast("int"))).otherwise(F.col("keys"))
    digest = F.substring(F.sha2(F.array_join(cut, "\x1f"), 256), 1, 12)
    return calls.select("call", F.concat(F.lit("t"), digest).alias("thread"), (at == 0).alias("provisional"))


def resolve_provisional(calls: DataFrame, threads: DataFrame) -> DataFrame:
    """The one anchored thread whose path begins with a provisional call's, else null."""
    j = calls.join(threads, "call")
    prefixes = j.where(~F.col("provisional")).select(F.col("thread").alias("anchored"), F.explode(F.transform(F.sequence(F.lit(1), F.size("keys")), lambda i: F.array_join(F.slice("keys", 1, i), "\x1f"))).alias("prefix"))
    per = prefixes.groupBy("prefix").agg(F.count_distinct("anchored").alias("n"), F.min("anchored").alias("anchored"))
    open_ = j.where("provisional").select("call", F.array_join("keys", "\x1f").alias("path"))
    return open_.join(per, F.col("path") == F.col("prefix"), "left").select("call", F.when(F.col("n") == 1, F.col("anchored")).alias("resolved"))
