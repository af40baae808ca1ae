"""Rollout folders, trace bundles, foreign sessions and answer formats as rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.sources import logs

PART = "array<struct<type:string,text:string>>"


def session_id(user: Column) -> Column:
    """From a JSON member, else from ``session_<uuid>`` in the text."""
    found = F.regexp_extract(user, r"session_([0-9a-fA-F-]{36})", 1)
    return F.coalesce(F.get_json_object(F.when(user.startswith("{"), user), "$.session_id"), F.when(found != "", found))


def content_text(content: Column) -> Column:
    """The text of a message whose JSON content is a string or a list of typed parts."""
    parts = F.from_json(F.when(content.startswith("["), content), PART)
    texts = F.filter(F.transform(parts, lambda p: p["text"]), lambda t: t.isNotNull())
    plain = F.when(content.startswith('"'), F.from_json(F.concat(F.lit('{"v":'), content, F.lit("}")), "v string")["v"])
    return F.coalesce(F.array_join(texts, "\n"), plain, F.when(~content.startswith("[") & ~content.startswith('"'), content))


def response_items(items: DataFrame) -> DataFrame:
    """(call, pos, role, name, content): items of an answer as messages; reasoning is counted, unknown kinds kept as system rows.

    ``items`` has call, pos and item, JSON text.
    """
    v = F.try_parse_json("item")
    get = lambda p: F.try_variant_get(v, p, "string")
    kind = get("$.type")
    rows = items.select("call", "pos", kind.alias("kind"), get("$.role").alias("item_role"), get("$.name").alias("name"), get("$.content").alias("c"), get("$.arguments").alias("a"), get("$.output").alias("o"), "item")
    role = F.when(F.col("kind") == "message", F.col("item_role")).when(F.col("kind") == "function_call", "assistant").when(F.col("kind") == "function_call_output", "tool").otherwise("system")
    content = F.when(F.col("kind") == "message", content_text(F.col("c"))).when(F.col("kind") == "function_call", F.col("a")).when(F.col("kind") == "function_call_output", F.col("o")).otherwise(F.col("item"))
    return rows.where(~F.coalesce(F.col("kind") == "reasoning", F.lit(False))).select("call", "pos", role.alias("role"), "name", content.alias("content"))


def read_rollouts(spark: SparkSession, root: str) -> DataFrame:
    """Per rollout file below ``root``: its thread, counts, bad lines, first user text, last model, by the order of lines."""
    text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.jsonl").text(root)
    text = text.select("value", F.col("_metadata.file_path").alias("file"), F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id()).alias("at"))
    v = F.try_parse_json("value")
    get = lambda p: F.try_variant_get(v, p, "string")
    rows = text.where(F.trim("value") != "").select("file", "at", v.isNull().alias("bad"), get("$.type").alias("kind"), get("$.payload.id").alias("id"), get("$.payload.model").alias("model"), get("$.payload.message").alias("message"))
    said = (F.col("kind") == "user_message") & F.col("message").isNotNull()
    return rows.groupBy("file").agg(
        F.min_by("id", F.when((F.col("kind") == "session_meta") & F.col("id").isNotNull(), F.col("at"))).alias("thread_id"), F.count("*").alias("n_lines"), F.count_if("bad").alias("n_bad"),
        F.min_by("message", F.when(said, F.col("at"))).alias("first_user_message"), F.max_by("model", F.when(F.col("model").isNotNull(), F.col("at"))).alias("last_model"),
    )


def read_bundle(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(manifest, events with payload text) of a trace bundle; a malformed event line fails."""
    manifest = spark.read.option("multiLine", True).json(f"{root}/manifest.json")
    events = spark.read.schema("seq bigint, wall_time_unix_ms bigint, kind string, thread_id string, payload_ref string").option("mode", "FAILFAST").json(f"{root}/trace.jsonl")
    payloads = spark.read.text(f"{root}/payloads/*.json", wholetext=True).select(F.regexp_extract("_metadata.file_path", r"([^/]+)\.json$", 1).alias("ref"), F.col("value").alias("payload"))
    return manifest, events.join(payloads, F.col("payload_ref") == F.col("ref"), "left").drop("ref")


def summarised_sessions(spark: SparkSession, path: str) -> DataFrame:
    """Foreign session files: folder, title (own, then generated, then first user text), last time; those lacking any are left out."""
    rows, _ = logs.read_lines(spark, path, "type string, cwd string, timestamp string, customTitle string, aiTitle string, message struct<role:string,content:string>")
    used = (F.col("message.role") == "user") & (F.trim(F.coalesce("message.content", F.lit(""))) != "")
    s = rows.groupBy("file").agg(
        F.min_by("cwd", F.when(F.col("cwd").isNotNull(), F.col("timestamp"))).alias("cwd"), F.max_by("customTitle", F.when(F.col("customTitle").isNotNull(), F.col("timestamp"))).alias("own"),
        F.max_by("aiTitle", F.when(F.col("aiTitle").isNotNull(), F.col("timestamp"))).alias("made"), F.min_by(F.col("message.content"), F.when(used, F.col("timestamp"))).alias("first"), F.max("timestamp").alias("last_at"),
    )
    return s.where("cwd is not null and first is not null and last_at is not null").select("file", "cwd", F.coalesce("own", "made", F.substring("first", 1, 60)).alias("title"), "last_at")


def adjudication_sections(notes: DataFrame, text_col: str) -> DataFrame:
    """(card, note): a text of many notes cut at its headings ``## Card n``; what stands before the first is left out."""
    cut = notes.select(F.explode(F.split(text_col, r"(?m)^(?=## Card \d+)")).alias("s")).where(F.col("s").startswith("## Card "))
    return cut.select(F.regexp_extract("s", r"^## Card (\d+)", 1).cast("int").alias("card"), F.regexp_replace("s", r"^## Card \d+[^\n]*\n?", "").alias("note"))


def adjudications(notes: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, accepted, labels): label pairs like ``T0: m1`` of a note, and whether it says accept."""
    pairs = F.regexp_extract_all(text_col, F.lit(r"(T0|B|C)\s*[:：]\s*(\S+)"), 0)
    labels = F.map_from_entries(F.array_distinct(F.transform(pairs, lambda p: F.struct(F.regexp_extract(p, r"^(T0|B|C)", 1), F.regexp_extract(p, r"[:：]\s*(\S+)", 1)))))
    return notes.select(id_col, F.col(text_col).rlike(r"(?i)\baccept(ed)?\b").alias("accepted"), labels.alias("labels"))


def sections(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, section, heading, body): a document cut before each heading."""
    cut = F.split(text_col, r"(?m)(?=^#{1,6} )")
    rows = documents.select(id_col, F.posexplode(F.filter(cut, lambda s: F.trim(s) != "")).alias("section", "s"))
    heading = F.regexp_extract("s", r"^#{1,6} ([^\r\n]*)", 1)
    return rows.select(id_col, "section", heading.alias("heading"), F.regexp_replace("s", r"^#{1,6} [^\r\n]*\r?\n?", "").alias("body"))
