"""Queries over jobs, answers and small counts."""

from __future__ import annotations

import gzip

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.operators import jobs, reduction, segments
from threadloom.plans.core import query
from threadloom.session import table
from threadloom.sources import receivers
from threadloom.sources import sessions as S
from threadloom.streaming import landing


@query(
    "csv_job",
    "SELECT c_custkey AS row_index, 'completed' AS status, upper('Check ' || c_name || ' in ' || c_mktsegment) AS result FROM customer",
)
def csv_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as a job; the worker writes the prompt in capitals."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    items = jobs.job_items(rows, "c_name", "c_custkey", "Check {c_name} in {c_mktsegment}")
    return jobs.worked(items, str.upper).select("row_index", "status", "result")


@query(
    "content_traces",
    "SELECT trace_id FROM trajectory WHERE len(list_filter(steps, lambda s: s IS NOT NULL AND coalesce(s.output_messages, s.tool_outputs, s.error) IS NOT NULL)) > 0",
)
def content_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.with_content(table(spark, sf_dir, "trajectory"), "steps").select("trace_id")


@query(
    "role_counters",
    "SELECT CASE WHEN m.role IN ('system', 'user', 'assistant', 'tool') THEN m.role ELSE 'user' END AS role, count(*) AS n FROM (SELECT unnest(messages) AS m FROM trajectory) x WHERE m IS NOT NULL GROUP BY 1",
)
def role_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "trajectory").select(F.explode(jobs.cleaned_roles(F.col("messages"))).alias("m"))
    return jobs.group_sizes(rows.select("m.role"), ["role"])


@query("outcome_stats", "SELECT count(*) FILTER (WHERE o_orderstatus = 'O') AS n_o, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_f, CAST(sum(o_orderkey) AS BIGINT) AS tokens FROM orders")
def outcome_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.outcome_stats(table(spark, sf_dir, "orders"), "o_orderstatus", "o_orderkey", ("O", "F"))


@query(
    "merged_clusters",
    "WITH c AS (SELECT o_custkey AS cluster, count(*) AS n FROM orders GROUP BY 1), k AS (SELECT c_custkey AS cluster, c_mktsegment AS task FROM customer WHERE c_custkey % 2 = 0) SELECT coalesce(task, 'cluster-' || c.cluster) AS task, CAST(sum(n) AS BIGINT) AS n FROM c LEFT JOIN k ON k.cluster = c.cluster WHERE task IS NOT NULL OR n >= 12 GROUP BY 1",
)
def merged_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    clusters = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("cluster")).agg(F.count("*").alias("n"))
    merge_map = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("cluster"), F.col("c_mktsegment").alias("task"))
    return jobs.merged_clusters(clusters, merge_map, 12)


@query(
    "answer_messages",
    r"""WITH v AS (SELECT thread_id AS call, rollout_ordinal AS pos, item_json, CASE WHEN json_valid(item_json) THEN CAST(item_json AS JSON) END AS j FROM thread_items), k AS (SELECT *, CASE WHEN json_type(j) = 'OBJECT' THEN j ->> '$.type' END AS kind FROM v)
    SELECT call, pos, 'system' AS role, CASE WHEN json_type(j) = 'OBJECT' THEN j ->> '$.name' END AS name, item_json AS content FROM k WHERE kind IS DISTINCT FROM 'reasoning'""",
)
def answer_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thread items read as items of an answer."""
    items = table(spark, sf_dir, "thread_items").select(F.col("thread_id").alias("call"), F.col("rollout_ordinal").alias("pos"), F.col("item_json").alias("item"))
    return S.response_items(items)


@query(
    "document_sections",
    r"""WITH p AS (SELECT doc_id, list_filter(string_split(regexp_replace(text, '(?m)^(#{1,6} )', chr(1) || '\1', 'g'), chr(1)), lambda x: trim(x, ' ') <> '') AS x FROM documents WHERE text IS NOT NULL),
    s AS (SELECT doc_id, unnest(x) AS s, generate_subscripts(x, 1) - 1 AS section FROM p) SELECT doc_id, CAST(section AS INT) AS section, regexp_extract(s, '^#{1,6} ([^\r\n]*)', 1) AS heading FROM s""",
)
def document_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.sections(table(spark, sf_dir, "documents").where("text is not null"), "doc_id", "text").select("doc_id", "section", "heading")


@query(
    "rough_token_counts",
    r"""SELECT doc_id, CAST(len(regexp_extract_all(text, '[\x{2E80}-\x{FFFF}]|[^ \t\n\x0B\f\r\x{2E80}-\x{FFFF}!-/:-@\[-`{-~]+|[!-/:-@\[-`{-~]')) AS INT) AS n FROM documents""",
)
def rough_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", jobs.rough_tokens(F.col("text")).alias("n"))


@query("newest_traces", "SELECT trace_id AS path, start_ns AS mtime FROM trajectory ORDER BY start_ns DESC, trace_id DESC LIMIT 10")
def newest_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten traces begun last, as files by their time."""
    return landing.newest_files(table(spark, sf_dir, "trajectory").select(F.col("trace_id").alias("path"), F.col("start_ns").alias("mtime")), 10)


@query("last_samples", "SELECT trace_id, start_ns FROM (SELECT trace_id, start_ns FROM trajectory ORDER BY start_ns DESC LIMIT 5) x")
def last_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last five traces, oldest first, as a report shows them."""
    return landing.newest(table(spark, sf_dir, "trajectory").select("trace_id", "start_ns"), 5, "start_ns")


@query("bounded_ingest", "SELECT event_id, event_type FROM events ORDER BY event_id LIMIT 512")
def bounded_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a queue of 512 takes when all events come at once."""
    return landing.accepted(table(spark, sf_dir, "events").select("event_id", "event_type"), 512, "event_id")


@query("unique_job_ids")
def unique_job_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of a job named by their segment, every fifth as if it were a repeat, every seventh without a name."""
    c = table(spark, sf_dir, "customer")
    named = F.when(F.col("c_custkey") % 7 == 0, F.lit("")).when(F.col("c_custkey") % 5 == 0, F.concat("c_mktsegment", F.lit("-2"))).otherwise(F.col("c_mktsegment"))
    return segments.unique_ids(c.select("c_custkey", named.alias("name")), "name", ["c_custkey"]).select("c_custkey", "unique_id")


_SPAN_STEPS = "(SELECT trace_id, source, start_ns AS t_start, unnest(steps) AS s, generate_subscripts(steps, 1) - 1 AS i FROM trajectory)"


@query(
    "telemetry_spans",
    f"SELECT md5(trace_id) AS trace_id, lpad(printf('%x', i + 1), 16, '0') AS span_id, coalesce(s.type, '') AS name, s.start_ns AS start_ns, s.error IS NOT NULL AS failed, nullif(s.error, '') AS message, coalesce(source, '') AS service FROM {_SPAN_STEPS} x WHERE s IS NOT NULL AND s.start_ns IS NOT NULL",
)
def telemetry_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps of traces sent as requests, gzipped and in chunks by turns, and received again as spans."""
    rows = table(spark, sf_dir, "trajectory").select("trace_id", "source", F.posexplode("steps").alias("i", "s")).where("s is not null and s.start_ns is not null")
    rows = rows.select(F.md5(F.col("trace_id").cast("binary")).alias("trace_id"), "source", "i", F.coalesce("s.type", F.lit("")).alias("name"), F.col("s.start_ns").alias("start_ns"), F.col("s.error").alias("error"))

    def send(batches):
        for batch in batches:
            bodies, encodings, chunked = [], [], []
            for k, r in enumerate(batch.to_pylist()):
                one = {"trace_id": r["trace_id"], "span_id": f"{r['i'] + 1:016x}", "name": r["name"], "start_ns": r["start_ns"], "end_ns": r["start_ns"], "status_code": 2 if r["error"] is not None else 0, "status_message": r["error"]}
                body = receivers.written_spans([one], {"service": r["source"] or ""})
                body = gzip.compress(body) if k % 2 else body
                encodings.append("gzip" if k % 2 else None)
                chunked.append(k % 3 == 0)
                bodies.append(b"%x\r\n" % len(body) + body + b"\r\n0\r\n\r\n" if k % 3 == 0 else body)
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays([pa.array([receivers.TRACES] * n), pa.array(encodings, pa.string()), pa.array(chunked), pa.array(bodies, pa.binary())], ["path", "encoding", "chunked", "body"])

    requests = rows.mapInArrow(send, "path string, encoding string, chunked boolean, body binary")
    found = receivers.spans(requests)
    return found.select("trace_id", "span_id", "name", "start_ns", (F.col("status_code") == 2).alias("failed"), F.col("status_message").alias("message"), F.get_json_object("resource", "$.service").alias("service"))


def _raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traces as raw event logs: a rollout, its model steps as inferences, its tool steps as calls; every ninth step never ends."""
    t = table(spark, sf_dir, "trajectory")
    none = F.lit(None).cast("string")
    event = lambda df, seq, kind, ref, status=none, call=none: df.select(F.col("trace_id").alias("rollout_id"), seq.cast("bigint").alias("seq"), F.lit(1).alias("schema_version"), kind.alias("kind"), ref.alias("ref"), F.col("thread_id"), none.alias("turn_id"), status.alias("status"), call.alias("call"))
    steps = t.select("trace_id", "thread_id", F.posexplode("steps").alias("i", "s")).where("s is not null and s.type in ('model', 'tool')")
    ref = F.concat(F.lit("c"), F.col("i").cast("string"))
    model, failed = F.col("s.type") == "model", F.col("s.error").isNotNull() & (F.col("s.error") != "")
    ended = steps.where("i % 9 <> 8")
    return (
        event(t, F.lit(0), F.lit("rollout_started"), F.lit("r"))
        .unionByName(event(t, F.lit(1_000_000), F.lit("rollout_ended"), F.lit("r"), F.lit("completed")))
        .unionByName(event(steps, F.col("i") * 2 + 1, F.when(model, "inference_started").otherwise("tool_call_started"), ref))
        .unionByName(event(ended, F.col("i") * 2 + 2, F.when(model & failed, "inference_failed").when(model, "inference_completed").otherwise("tool_call_ended"), ref, F.when(~model, F.when(failed, "failed").otherwise("completed"))))
    )


@query(
    "trace_entities",
    """WITH x AS (SELECT trace_id, thread_id, unnest(steps) AS s, generate_subscripts(steps, 1) - 1 AS i FROM trajectory), y AS (SELECT * FROM x WHERE s IS NOT NULL AND s.type IN ('model', 'tool'))
    SELECT trace_id AS rollout_id, 'rollout' AS entity, 'r' AS ref, thread_id, 0::BIGINT AS started_seq, 1000000::BIGINT AS ended_seq, 'completed' AS status FROM trajectory
    UNION ALL SELECT trace_id, CASE WHEN s.type = 'model' THEN 'inference' ELSE 'tool_call' END, 'c' || i, thread_id, i * 2 + 1, CASE WHEN i % 9 <> 8 THEN i * 2 + 2 END, CASE WHEN i % 9 = 8 THEN 'running' WHEN s.error IS NOT NULL AND s.error <> '' THEN 'failed' ELSE 'completed' END FROM y""",
)
def trace_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reduction.reduced(_raw_events(spark, sf_dir)).drop("turn_id")


@query("trace_faults", "SELECT 'never_started' AS fault, count(*) AS n FROM trajectory UNION ALL SELECT 'unknown_kind', count(*) FROM trajectory")
def trace_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log without its starts of rollouts, and with a kind that nobody knows."""
    e = _raw_events(spark, sf_dir).where("kind <> 'rollout_started'")
    odd = table(spark, sf_dir, "trajectory").select(F.col("trace_id").alias("rollout_id"), F.lit(-1).cast("bigint").alias("seq"), F.lit(1).alias("schema_version"), F.lit("reboot").alias("kind"), *(F.lit(None).cast("string").alias(c) for c in ("ref", "thread_id", "turn_id", "status", "call")))
    return reduction.faults(e.unionByName(odd))
