"""CSV jobs fanned out to workers, and small joins and counts around sessions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions import text as T
from threadloom.operators import segments


def job_items(rows: DataFrame, id_col: str, order: str, template: str) -> DataFrame:
    """(row_index, item_id, prompt): the items of a job, ids made unique, the template filled per row."""
    named = segments.unique_ids(rows, id_col, [order])
    values = F.create_map(*(x for c in rows.columns if c != order for x in (F.lit(c), F.col(c).cast("string"))))
    return named.select(F.col(order).alias("row_index"), F.col("unique_id").alias("item_id"), T.rendered(F.lit(template), values).alias("prompt"))


def worked(items: DataFrame, worker: Callable[[str], str]) -> DataFrame:
    """(row_index, item_id, status, result, error): each item given to ``worker`` once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {"status": [], "result": [], "error": []}
            for prompt in batch["prompt"].to_pylist():
                try:
                    values = ("completed", worker(prompt), None)
                except Exception as e:  # noqa: BLE001 - a worker may fail in any way
                    values = ("failed", None, type(e).__name__)
                for name, value in zip(out, values, strict=True):
                    out[name].append(value)
            yield pa.RecordBatch.from_arrays([batch["row_index"], batch["item_id"], *(pa.array(v, pa.string()) for v in out.values())], ["row_index", "item_id", *out])

    kind = items.schema["row_index"].dataType.simpleString()
    return items.mapInArrow(run, f"row_index {kind}, item_id string, status string, result string, error string")


def stale(items: DataFrame, started_us: str, now_us: int, timeout_s: int) -> DataFrame:
    """Running items whose time is up."""
    return items.where((F.col("status") == "running") & (F.lit(now_us) - F.col(started_us) >= timeout_s * 1_000_000))


def with_transcript(sessions: DataFrame, files: DataFrame) -> DataFrame:
    """Sessions with the first transcript file of their id."""
    first = files.groupBy("session").agg(F.min("path").alias("path"))
    return sessions.join(first, "session", "left")


def with_captures(sessions: DataFrame, captures: DataFrame) -> DataFrame:
    """Sessions with the first captured prompt, and all of them only where there are several."""
    g = captures.groupBy("session").agg(F.min_by("prompt", "ts").alias("prompt"), F.array_sort(F.collect_list(F.struct("ts", "prompt"))).alias("x"), F.count_distinct("prompt").alias("n"))
    return sessions.join(g.select("session", "prompt", F.when(F.col("n") > 1, F.transform("x", lambda r: r["prompt"])).alias("variants")), "session", "left")


def control_target(text: Column) -> Column:
    """The number that a command such as ``/stop q3`` aims at; null for other texts."""
    found = F.regexp_extract(text, r"(?i)^\s*/(?:stop|cancel|retry|status)\s+q(\d+)", 1)
    return F.when(found != "", found.cast("int"))


EVIDENCE = r"(?i)(fail|broke|error|lost|result|finished|失败|结果)"


def late_evidence(corrections: DataFrame, anchors: DataFrame, limit_us: str, words: str = EVIDENCE) -> DataFrame:
    """Corrections whose anchor lies at or after the limit and whose text tells of a result or a failure."""
    j = corrections.join(anchors.select(F.col("id").alias("__a"), F.col("ts_us").alias("anchor_us")), F.col("anchor") == F.col("__a")).drop("__a")
    return j.where((F.col("anchor_us") >= F.col(limit_us)) & F.col("text").rlike(words))


def with_content(rows: DataFrame, steps: str) -> DataFrame:
    """Trajectories that have any step with content."""
    return rows.where(F.exists(steps, lambda s: s.isNotNull() & (F.coalesce(s["output_messages"], s["tool_outputs"], s["error"]).isNotNull())))


def persisted(kind: Column, allowed: tuple[str, ...]) -> Column:
    """Whether an item of a type is kept; unknown types are not."""
    return F.coalesce(kind.isin(*allowed), F.lit(False))


def cleaned_roles(messages: Column) -> Column:
    """Messages as (role, content) for counting; unknown roles become user."""
    role = lambda m: F.when(m["role"].isin("system", "user", "assistant", "tool"), m["role"]).otherwise("user")
    return F.transform(F.filter(messages, lambda m: m.isNotNull()), lambda m: F.struct(role(m).alias("role"), F.coalesce(m["content"], F.lit("")).alias("content")))


def rough_tokens(text: Column) -> Column:
    """Without a tokenizer: words and marks of spaced scripts, characters of others."""
    return F.regexp_count(text, F.lit(r"[⺀-￿]|[^\s⺀-￿\p{Punct}]+|\p{Punct}"))


def group_sizes(rows: DataFrame, by: list[str]) -> DataFrame:
    """Groups with their sizes."""
    return rows.groupBy(*by).agg(F.count("*").alias("n"))


def largest_groups(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    """The ``k`` largest groups, those of one size by their keys: a top-k report."""
    return group_sizes(rows, by).orderBy(F.col("n").desc(), *by).limit(k)


def outcome_stats(rows: DataFrame, outcome: str, tokens: str, states: tuple[str, ...]) -> DataFrame:
    """Counts by outcome and the tokens used, null where nobody reported any."""
    return rows.agg(*(F.count_if(F.col(outcome) == s).alias(f"n_{s.lower()}") for s in states), F.sum(tokens).alias("tokens"))


def merged_clusters(clusters: DataFrame, merge_map: DataFrame, least: int) -> DataFrame:
    """(task, n): clusters put together as a map says; those not in it need ``least`` messages."""
    j = clusters.join(merge_map, "cluster", "left")
    mapped = F.col("task").isNotNull()
    return j.where(mapped | (F.col("n") >= least)).groupBy(F.coalesce("task", F.concat(F.lit("cluster-"), F.col("cluster").cast("string"))).alias("task")).agg(F.sum("n").alias("n"))


def interaction_edges(spawns: DataFrame, items: DataFrame) -> DataFrame:
    """(parent, child, target): an edge leads to the first item its thread received, else to the thread itself."""
    first = items.groupBy(F.col("thread").alias("__t")).agg(F.min_by("item", "pos").alias("item"))
    return spawns.join(first, F.col("child") == F.col("__t"), "left").select("parent", "child", F.coalesce("item", F.concat(F.lit("thread:"), "child")).alias("target"))
