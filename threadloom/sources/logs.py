"""Readers of JSON-lines logs, captures, transcripts and CSV jobs, and their writers."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.operators import ordered
from threadloom.session import names_in, path_exists

SPAN = "trace_id string, span_id string, parent_span_id string, name string, start_ns bigint, end_ns bigint, attributes map<string,string>, events array<struct<name:string,time_ns:bigint>>"
LOG = "time_ns bigint, severity string, body string, attributes map<string,string>"
CALL = "ts double, session_id string, sha string, status int, request string, response string"


def read_dated(spark: SparkSession, root: str, schema: str, date: str | None = None, strict: bool = True) -> DataFrame:
    """Files ``<date>.jsonl`` under ``root``; the date prunes by file name. A malformed line fails when strict."""
    mode = "FAILFAST" if strict else "DROPMALFORMED"
    return spark.read.schema(schema).option("mode", mode).json(f"{root}/{date or '*'}.jsonl")


def read_calls(spark: SparkSession, root: str, tasks: int | None = None) -> DataFrame:
    """Gzipped call logs of several members each; a file is one task until dealt out."""
    df = spark.read.schema(CALL).json(f"{root}/*.jsonl.gz")
    return df.repartition(tasks) if tasks else df


def grouped_captures(calls: DataFrame) -> DataFrame:
    """Per session its calls in order of time, and the first of the distinct versions."""
    return calls.groupBy("session_id").agg(F.sort_array(F.collect_list(F.struct("ts", "sha", "status"))).alias("calls"), F.min_by("sha", "ts").alias("first_sha"), F.count_distinct("sha").alias("n_versions"))


def read_lines(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, bad lines per file) of JSON lines in which some may not parse."""
    text = spark.read.text(path).where(F.trim("value") != "").select("value", F.col("_metadata.file_path").alias("file"))
    parsed = text.withColumn("r", F.from_json("value", schema, {"mode": "PERMISSIVE"})).withColumn("ok", F.try_parse_json("value").isNotNull())
    good = parsed.where("ok").select("file", "r.*")
    return good, parsed.groupBy("file").agg(F.count_if(~F.col("ok")).alias("n_bad_lines"), F.count("*").alias("n_lines"))


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """(session, role, content, timestamp) of user and assistant lines; the session is the file's name."""
    rows, _ = read_lines(spark, path, "type string, timestamp string, message struct<role:string,content:string>")
    kept = rows.where("type in ('user', 'assistant') and message is not null")
    return kept.select(F.regexp_extract("file", r"([^/]+?)(?:\.jsonl)?$", 1).alias("session"), "message.role", "message.content", "timestamp")


def placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, at, value): lines with their place, whose order is that of the file.

    Files are split as ever; a place is the split's and the line's within it.
    """
    text = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), "value")
    return text.select("file", F.struct("block", F.monotonically_increasing_id().alias("line")).alias("at"), F.regexp_replace("value", "\r$", "").alias("value"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value): lines of each file numbered from 1; blank ones are counted and left out."""
    numbered = ordered.numbered(placed_lines(spark, path), ["file"], ["at"], "line_no")
    return numbered.where(F.trim("value") != "").select("file", "line_no", "value")


def last_records(spark: SparkSession, path: str, schema: str, keep: F.Column | None = None) -> DataFrame:
    """Of each file the last record that parses, and fulfils ``keep`` if given, with how many lines after it did not parse.

    What a scan from the end would find first; it goes on past bad lines.
    """
    rows = placed_lines(spark, path).where(F.trim("value") != "").withColumn("ok", F.try_parse_json("value").isNotNull()).withColumn("r", F.from_json("value", schema, {"mode": "PERMISSIVE"}))
    good = rows.where("ok").select("file", "at", "r.*")
    good = good if keep is None else good.where(keep)
    names = [c for c in good.columns if c not in ("file", "at")]
    last = good.groupBy("file").agg(F.max(F.struct("at", *names)).alias("l"))
    bad = rows.where(~F.col("ok")).select(F.col("file").alias("f"), F.col("at").alias("bad_at"))
    j = last.join(bad, (F.col("file") == F.col("f")) & (F.col("bad_at") > F.col("l.at")), "left")
    return j.groupBy("file", "l").agg(F.count("bad_at").alias("n_bad_after")).select("file", *(F.col(f"l.{n}").alias(n) for n in names), "n_bad_after")


def first_wins(sources: list[DataFrame], key: str, order: str) -> DataFrame:
    """The sources on end; of rows with one key the first source's first row."""
    ranked = [s.withColumn("__rank", F.struct(F.lit(i).alias("s"), F.col(order).alias("o"))) for i, s in enumerate(sources)]
    both = ranked[0]
    for r in ranked[1:]:
        both = both.unionByName(r)
    columns = [c for c in both.columns if c not in ("__rank", key)]
    best = both.groupBy(key).agg(F.min(F.struct("__rank", *columns)).alias("r"))
    return best.select(key, *(F.col(f"r.{c}") for c in columns))


def last_wins(rows: DataFrame, key: str, order: str) -> DataFrame:
    """The last row of each key; rows without one keep a key made of their order."""
    named = rows.withColumn(key, F.coalesce(F.col(key), F.concat(F.lit("ts:"), F.col(order).cast("string"))))
    columns = [c for c in named.columns if c not in (key, order)]
    best = named.groupBy(key).agg(F.max(F.struct(order, *columns)).alias("r"))
    return best.select(key, F.col(f"r.{order}"), *(F.col(f"r.{c}") for c in columns))


def refreshed(cache: DataFrame, fetched: DataFrame, key: str, order: str) -> DataFrame:
    """An upsert: fetched rows replace cached ones. The result is written as a new version."""
    return first_wins([fetched, cache.select(*fetched.columns)], key, order)


def objects_in_text(col: F.Column) -> F.Column:
    """The first JSON object in free text, as VARIANT, code fences aside; null when none parses.

    From the first brace to the last, else what the first line with an object
    holds up to a closing brace, the longest that parses.
    """
    bare = F.regexp_replace(col, "```(?:json)?", "")
    whole = F.try_parse_json(F.regexp_extract(bare, r"(?s)(\{.*\})", 1))
    lines = F.transform(F.split(bare, "\n"), lambda x: F.regexp_extract(x, r"(\{.*\})", 1))
    short = F.transform(F.split(bare, "\n"), lambda x: F.regexp_extract(x, r"(\{.*?\})(?:[^}]|$)", 1))
    found = F.filter(F.transform(F.concat(lines, short), lambda x: F.try_parse_json(F.when(x != "", x))), lambda v: v.isNotNull())
    return F.coalesce(whole, F.try_element_at(found, F.lit(1)))


def _assembled(text: str) -> dict:
    blocks: dict[int, dict] = {}
    out: dict = {}
    for line in text.splitlines():
        if not line.startswith("data:"):
            continue
        try:
            e = json.loads(line[5:])
        except ValueError:
            continue
        kind = e.get("type")
        if kind == "message_start":
            out.update({k: v for k, v in (e.get("message") or {}).items() if k != "content"})
        elif kind == "content_block_start":
            blocks[e.get("index", len(blocks))] = dict(e.get("content_block") or {})
        elif kind == "content_block_delta":
            block, delta = blocks.setdefault(e.get("index", 0), {}), e.get("delta") or {}
            for name, target in (("text", "text"), ("thinking", "thinking"), ("partial_json", "input_json")):
                if name in delta:
                    block[target] = block.get(target, "") + delta[name]
        elif kind == "message_delta":
            out.update(e.get("delta") or {})
        elif kind == "response.output_item.done":
            blocks[len(blocks)] = e.get("item") or {}
        elif kind == "response.completed":
            out.update({k: v for k, v in (e.get("response") or {}).items() if v not in (None, [], "")})
    out["content"] = [blocks[i] for i in sorted(blocks)]
    return out


def assembled_streams(rows: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, message): server-sent events of a model's answer put together as JSON; broken lines are skipped."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [None if t is None else json.dumps(_assembled(t), sort_keys=True, ensure_ascii=False) for t in batch[text_col].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch[id_col], pa.array(made, pa.string())], [id_col, "message"])

    kind = rows.schema[id_col].dataType.simpleString()
    return rows.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, message string")


def read_job_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV job: unique headers, rows as wide as the header; a byte-order mark is dropped."""
    head = spark.read.text(path, wholetext=True).select(F.substring_index("value", "\n", 1).alias("h")).first()
    names = [n.strip().strip('"') for n in (head["h"] if head else "").lstrip("﻿").rstrip("\r").split(",")]
    doubled = {n for n in names if names.count(n) > 1}
    if doubled:
        raise ValueError(f"duplicate headers: {sorted(doubled)}")
    schema = ", ".join(f"`{n}` string" for n in names)
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").option("multiLine", True).option("escape", '"').option("enforceSchema", True).csv(path).dropna(how="all")


# What a job adds to the columns of its input.
JOB_COLUMNS = ("job_id", "item_id", "row_index", "source_id", "status", "attempt_count", "last_error", "result_json", "reported_at", "completed_at")


def job_rows(rows: DataFrame, items: DataFrame, order: str = "row_index") -> DataFrame:
    """The input columns and the ten of the job; times as in RFC 3339, in UTC.

    ``items`` has the job columns, ``rows`` the input under the same
    ``order``. Times are microseconds since 1970; what is null stays empty.
    """
    time = lambda c: F.date_format(F.timestamp_micros(F.col(c)), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    job = items.select(F.col(order).alias("__o"), *(time(c).alias(f"job_{c}") if c.endswith("_at") else F.col(c).alias(f"job_{c}") for c in JOB_COLUMNS))
    j = rows.join(job, F.col(order) == F.col("__o"))
    return j.select(order, *(c for c in rows.columns if c != order), *(F.col(f"job_{c}").alias(c if c not in rows.columns else f"job_{c}") for c in JOB_COLUMNS if c != order))


def write_job_csv(rows: DataFrame, path: str, order: str) -> None:
    """In the order of ``order``, quoted by the usual rules."""
    rows.orderBy(order).drop(order).write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def write_guarded(rows: DataFrame, path: str, max_chars: int) -> None:
    """JSON lines, refused as a whole if any line is longer than ``max_chars``."""
    line = F.to_json(F.struct(*rows.columns))
    checked = rows.withColumn("__ok", F.assert_true(F.length(line) <= max_chars, F.lit("a line is too long"))).where("__ok is null").drop("__ok")
    checked.write.mode("overwrite").json(path)


def append_daily(rows: DataFrame, path: str, ts_us: str) -> None:
    day = F.date_format(F.timestamp_micros(F.col(ts_us)), "yyyy-MM-dd")
    rows.withColumn("day", day).write.mode("append").partitionBy("day").json(path)


def publish(rows: DataFrame, path: str) -> None:
    """By source, role and date; rows without a role are not published."""
    rows.where(F.trim(F.coalesce("role", F.lit(""))) != "").write.mode("append").partitionBy("source", "role", "date").json(path)


def read_tolerant(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines without those that do not parse; a path that is not there is empty."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return read_lines(spark, path, schema)[0].drop("file")


def read_wire(spark: SparkSession, path: str, schema: str, id_pattern: str = r"([^/]+)/[^/]+$") -> tuple[DataFrame, DataFrame]:
    """(rows with ``source_id``, bad lines per source) of plain or gzipped logs; the id is the folder's name.

    Bytes that are no UTF-8 become replacement characters.
    """
    rows, bad = read_lines(spark, path, schema)
    named = F.regexp_extract("file", id_pattern, 1)
    return rows.withColumn("source_id", named).drop("file"), bad.withColumn("source_id", named).drop("file")


def history_at(history: DataFrame, log_id: int, offset: int) -> DataFrame:
    """The entry at a place of a history; none for another log or a place beyond its end."""
    return history.where((F.col("log_id") == log_id) & (F.col("pos") == offset))


def write_state(state: DataFrame, path: str) -> int:
    """Writes the next version of a state; it counts once all of it is there. Gives its number."""
    spark = state.sparkSession
    number = max((int(n) for n in names_in(spark, path) if n.isdigit()), default=-1) + 1
    state.select(*sorted(state.columns)).write.json(f"{path}/{number}")
    return number


def read_state(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The last version that was written to its end; empty when there is none."""
    done = [int(n) for n in names_in(spark, path) if n.isdigit() and "_SUCCESS" in names_in(spark, f"{path}/{n}")]
    return spark.read.schema(schema).json(f"{path}/{max(done)}") if done else spark.createDataFrame([], schema)


def export_tasks(tasks: DataFrame, members: DataFrame, path: str) -> None:
    """Tasks for people: a text per task, their members as JSON lines by task, and an index.

    ``tasks`` has task, title, status; ``members`` task, pos, role, text.
    """
    line = F.concat(F.lit("- ["), F.coalesce("role", F.lit("")), F.lit("] "), F.regexp_replace(F.coalesce("text", F.lit("")), r"\s+", " "))
    body = members.groupBy("task").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", line.alias("line")))), lambda r: r["line"]), "\n").alias("body"))
    j = tasks.join(body, "task", "left")
    text = F.concat(F.lit("# "), F.coalesce("title", F.lit("untitled")), F.lit("\n\n"), F.coalesce("body", F.lit("")))
    j.select("task", text.alias("value")).write.mode("overwrite").partitionBy("task").text(f"{path}/texts")
    members.write.mode("overwrite").partitionBy("task").json(f"{path}/members")
    n = members.groupBy("task").agg(F.count("*").alias("n_members"))
    tasks.join(n, "task", "left").withColumn("n_members", F.coalesce("n_members", F.lit(0))).coalesce(1).write.mode("overwrite").json(f"{path}/index")


def task_messages(messages: DataFrame, task: str) -> DataFrame:
    """What a message source gives for one task: (ts, role, who, text, msg_id) in order of time."""
    return messages.where(F.col("task_id") == task).select("ts", "role", "who", "text", "msg_id").orderBy("ts", "msg_id")
