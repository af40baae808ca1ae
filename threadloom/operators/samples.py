"""Normalised conversations, sub-tasks and correction samples built from rows."""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions import text as T


def without_prefixed(blocks: Column, prefix: str) -> Column:
    """Text blocks that do not begin with a volatile prefix."""
    return F.filter(blocks, lambda b: ~F.coalesce(F.startswith(b, F.lit(prefix)), F.lit(False)))


def flattened(blocks: Column) -> Column:
    return F.coalesce(F.array_join(F.filter(blocks, lambda b: b.isNotNull()), "\n"), F.lit(""))


def fingerprint_of(*parts: Column) -> Column:
    """Of the parts of a prompt, null apart from empty."""
    return F.sha2(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}).cast("binary"), 256)


def identities(payloads: DataFrame, id_col: str, prefix: str) -> DataFrame:
    """(id, identity): the SHA-256 of what stays the same from call to call, system and tools as canonical JSON.

    ``payloads`` has system and tools as JSON text. Blocks of the system whose
    text begins with the volatile ``prefix`` are left out. Canonical is what
    Python writes with sorted keys. Text that is no JSON counts as a string.
    """

    def parsed(text):
        try:
            return None if text is None else json.loads(text)
        except ValueError:
            return text

    def run(batches):
        for batch in batches:
            out = []
            for system, tools in zip(batch["system"].to_pylist(), batch["tools"].to_pylist(), strict=True):
                system = parsed(system)
                if isinstance(system, list):
                    system = [b for b in system if not (isinstance(b, dict) and str(b.get("text") or "").startswith(prefix))]
                text = json.dumps({"system": system, "tools": parsed(tools)}, ensure_ascii=False, sort_keys=True)
                out.append(hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest())
            yield pa.RecordBatch.from_arrays([batch[id_col], pa.array(out, pa.string())], [id_col, "identity"])

    return payloads.select(id_col, "system", "tools").mapInArrow(run, f"`{id_col}` {payloads.schema[id_col].dataType.simpleString()}, identity string")


def rendered_context(rows: DataFrame, keys: list[str], order: list[str], cap: int = 80) -> DataFrame:
    """One text per key: its last ``cap`` rows as ``M<i> [role/name] text``, numbered in order.

    Rows without text are numbered too but not shown. ``cap`` bounds what a
    replay may see; the rows are those nearest the end. The rank is only asked
    for its first ``cap`` rows, so each task passes on no more of a key.
    """
    last = Window.partitionBy(*keys).orderBy(*(F.col(o).desc() for o in order))
    kept = rows.withColumn("__k", F.row_number().over(last)).where(F.col("__k") <= cap)
    line = F.struct(*order, F.concat_ws("/", F.coalesce("role", F.lit("")), F.coalesce("name", F.lit(""))).alias("who"), F.coalesce("text", F.lit("")).alias("t"))
    listed = kept.groupBy(*keys).agg(F.array_sort(F.collect_list(line)).alias("x"))
    texts = F.transform("x", lambda r, i: F.when(r["t"] != "", F.concat(F.lit("M"), (i + 1).cast("string"), F.lit(" ["), r["who"], F.lit("] "), r["t"])))
    return listed.select(*keys, F.array_join(F.filter(texts, lambda s: s.isNotNull()), "\n").alias("context"), F.size("x").alias("n_rows"))


def prompt_pair(context: Column, original: Column, comment: Column) -> Column:
    """The same scene with the original request and with the corrected one."""
    scene = F.concat(F.lit("Context:\n"), F.coalesce(context, F.lit("")), F.lit("\n\nRequest:\n"))
    return F.struct(F.concat(scene, F.coalesce(original, F.lit(""))).alias("base"), F.concat(scene, F.coalesce(original, F.lit("")), F.lit("\n"), F.coalesce(comment, F.lit(""))).alias("treated"))


def resolved_list(lists: DataFrame, rows: DataFrame, key: str, ids: str) -> DataFrame:
    """(key, pos, id, ...): an ordered list of ids as rows; missing ones are left out, order stays."""
    flat = lists.select(key, F.posexplode(ids).alias("pos", "id"))
    return flat.join(rows, "id").select(key, "pos", *rows.columns)


def first_lookup(rows: DataFrame, keys: list[str], value: str, order: str) -> DataFrame:
    """The value of the first row per key, for each of several keys, tried in turn by ``looked_up``."""
    parts = [rows.where(F.col(k).isNotNull()).groupBy(F.lit(i).alias("level"), F.col(k).alias("k")).agg(F.min(F.struct(order, value))[value].alias("v")) for i, k in enumerate(keys)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def looked_up(rows: DataFrame, lookup: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Adds ``name``: what the first of ``keys`` that is known leads to."""
    out, found = rows, []
    for i, k in enumerate(keys):
        side = lookup.where(F.col("level") == i).select(F.col("k").alias(f"__k{i}"), F.col("v").alias(f"__v{i}"))
        out = out.join(side, F.col(k) == F.col(f"__k{i}"), "left").drop(f"__k{i}")
        found.append(f"__v{i}")
    return out.withColumn(name, F.coalesce(*found)).drop(*found)


def corrector_pool(corrections: DataFrame) -> DataFrame:
    """Per corrector: number, distinct texts in order of first sight, first name that is given."""
    texts = corrections.groupBy("corrector", "text").agg(F.min("row_id").alias("at"), F.min_by("name", F.when(F.col("name").isNotNull(), F.col("row_id"))).alias("name"))
    g = texts.groupBy("corrector").agg(F.array_sort(F.collect_list(F.struct("at", "text"))).alias("x"), F.min_by("name", F.when(F.col("name").isNotNull(), F.col("at"))).alias("first_name"))
    return g.select("corrector", F.size("x").alias("n_texts"), "first_name", F.substring(F.element_at("x", 1)["text"], 1, 60).alias("first_text"))


def merged_snapshots(snapshots: DataFrame) -> DataFrame:
    """Snapshots of one instruction put together; those without one stay apart."""
    key = F.coalesce("t0", F.concat(F.lit("row:"), F.col("row_id").cast("string")))
    g = snapshots.withColumn("key", key).groupBy("key").agg(F.array_sort(F.collect_list(F.struct("row_id", "id"))).alias("x"), F.count("*").alias("n"))
    return g.select("key", "n", F.array_join(F.transform("x", lambda r: r["id"]), ",").alias("members"))


def interaction_cost(rows: DataFrame, by: list[str]) -> DataFrame:
    user = T.is_user(F.col("role"))
    return rows.groupBy(*by).agg(F.count_if(user).alias("user_turns"), F.greatest(F.count_if(user) - 1, F.lit(0)).alias("retries"))


def subtasks(rows: DataFrame, by: str) -> DataFrame:
    """Per task: span, participants, whether several bots took part, cost, quality tier."""
    bot, user = T.is_bot(F.col("role")), T.is_user(F.col("role"))
    bots = F.count_distinct(F.when(bot, F.col("who")))
    return rows.groupBy(by).agg(
        F.min("ts_us").alias("first_us"), F.max("ts_us").alias("last_us"), F.count_distinct("who").alias("n_participants"), (bots > 1).alias("multi_agent"),
        F.count_if(user).alias("user_turns"), F.when(F.count_if(bot) > 0, F.when(F.count_if(user) > 0, "dialogue").otherwise("monologue")).otherwise("chat_only").alias("tier"),
    )


def truncated_marks(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """The input with, per key, whether the last row is a bot's: else the sample is cut off."""
    last = rows.groupBy(*by).agg(F.max_by(T.is_bot(F.col("role")), F.struct(*order)).alias("ends_with_bot"))
    return last


def outlier_ids(text: Column) -> Column:
    """Ids written in mixed forms, ``1``, ``#3`` or ``#4,5``, in order, without leading zeros and of any length."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"(\d+)"), 1), lambda x: F.regexp_replace(x, r"^0+(\d)", "$1"))


def diff_lines(diffs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, path, added, deleted, fingerprint): accepted lines of unified diffs by file.

    A line counts only inside a hunk; its fingerprint is the hash of path and
    line without outer white space, blank lines have none.
    """
    lines = diffs.select(id_col, F.posexplode(F.split(text_col, "\n", -1)).alias("at", "line"))
    w = Window.partitionBy(id_col).orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    path = F.last(F.when(F.col("line").startswith("+++ "), F.regexp_replace(F.substring("line", 5, 4096), "^[ab]/", "")), ignorenulls=True).over(w)
    hunk = F.last(F.when(F.col("line").startswith("@@"), F.lit(True)).when(F.col("line").startswith("diff "), F.lit(False)), ignorenulls=True).over(w)
    rows = lines.withColumns({"path": path, "hunk": F.coalesce(hunk, F.lit(False))}).where("hunk and (line like '+%' or line like '-%') and not line like '+++ %' and not line like '--- %'")
    body = F.trim(F.expr("substring(line, 2)"))
    added = F.col("line").startswith("+")
    return rows.groupBy(id_col, "path").agg(
        F.count_if(added).alias("n_added"), F.count_if(~added).alias("n_deleted"),
        F.array_sort(F.array_compact(F.collect_list(F.when(added & (body != ""), F.sha1(F.concat_ws("\x00", "path", body).cast("binary")))))).alias("fingerprints"),
    )


def read_verdict(target: Column, n_refs: Column) -> Column:
    """Whether a replay could read again what the original read."""
    return F.when(target == "none", "no_read").when(target == "code", F.when(n_refs > 0, "reproducible").otherwise("needs_refs")).when(target == "chat", "reproducible").otherwise("not_reproducible")


def item_sizes(items: DataFrame, kind: Column) -> DataFrame:
    """Bytes and number of items by type."""
    return items.groupBy(kind.alias("item_type")).agg(F.count("*").alias("n"), F.sum(F.octet_length("item_json")).alias("n_bytes"))


def fnv_sampled(ids: DataFrame, id_col: str, every: int = 100) -> DataFrame:
    """The sample of ids whose 64-bit FNV-1a hash is divisible by ``every``: a sampling operator."""
    def run(batches):
        for batch in batches:
            texts = batch[id_col].cast(pa.binary())
            raw, sizes = texts.to_pylist(), pc.fill_null(pc.binary_length(texts), 0).to_numpy()
            joined = np.frombuffer(b"".join(x for x in raw if x), np.uint8)
            begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
            h = np.full(len(sizes), 0xCBF29CE484222325, np.uint64)
            for k in range(int(sizes.max(initial=0))):
                at = np.flatnonzero(sizes > k)
                h[at] = (h[at] ^ joined[begins[at] + k]) * np.uint64(0x100000001B3)
            yield batch.filter(pa.array(texts.is_valid().to_numpy(zero_copy_only=False) & (h % np.uint64(every) == 0)))

    return ids.select(id_col).mapInArrow(run, f"`{id_col}` string")


def review_page(cards: DataFrame, dedupe: str, score: str, order: str, offset: int, size: int) -> DataFrame:
    """A page of cards by score, one per root pair, those seen first ahead among equals."""
    best = cards.groupBy(dedupe).agg(F.max(F.struct(score, (-F.col(order)).alias("o"), *(c for c in cards.columns if c not in (dedupe, score, order)))).alias("r"))
    rows = best.select(dedupe, F.col(f"r.{score}").alias(score), (-F.col("r.o")).alias(order), *(F.col(f"r.{c}") for c in cards.columns if c not in (dedupe, score, order)))
    return rows.orderBy(F.col(score).desc(), F.col(order)).offset(offset).limit(size)


def overlap_reason(cards: DataFrame, reviewed: DataFrame) -> DataFrame:
    """Why a card was seen before: by id, by root, or by text; null if it was not."""
    out = cards
    for k in ("id", "root", "fp"):
        side = reviewed.where(F.col(k).isNotNull() & (F.col(k) != "")).select(F.col(k).alias(f"__{k}")).distinct()
        out = out.join(side, F.col(k) == F.col(f"__{k}"), "left")
    return out.withColumn("overlap", F.when(F.col("__id").isNotNull(), "id").when(F.col("__root").isNotNull(), "root").when(F.col("__fp").isNotNull(), "text")).drop("__id", "__root", "__fp")


def aligned(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """A join that fails unless both sides hold the same keys."""
    r = right.withColumnRenamed(key, "__key")
    j = left.join(r, F.col(key) == F.col("__key"), "full")
    ok = F.assert_true(F.col(key).isNotNull() & F.col("__key").isNotNull(), F.lit(f"the two sides differ in {key}"))
    return j.withColumn("__ok", ok).where("__ok is null").drop("__ok", "__key")
