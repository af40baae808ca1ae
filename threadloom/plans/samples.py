"""Queries over samples, contexts and look-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions import text as T
from threadloom.operators import samples, trajectories
from threadloom.plans.core import query
from threadloom.plans.views import SQL_BOT, SQL_MESSAGES, SQL_USER, messages, threaded
from threadloom.session import table

_W = "WITH RECURSIVE " + SQL_MESSAGES


@query(
    "rendered_context",
    _W + """, k AS (SELECT *, row_number() OVER (PARTITION BY thread ORDER BY ts_us DESC, row_id DESC) AS k FROM t), l AS (SELECT thread, row_number() OVER (PARTITION BY thread ORDER BY ts_us, row_id) AS i, coalesce(role, '') || '/' || coalesce(name, '') AS who, coalesce(text, '') AS x FROM k WHERE k <= 80)
    SELECT thread, coalesce(string_agg('M' || i || ' [' || who || '] ' || x, chr(10) ORDER BY i) FILTER (WHERE x <> ''), '') AS context, CAST(count(*) AS INT) AS n_rows FROM l GROUP BY 1""",
)
def rendered_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a replay of the end of each thread may see, up to the operator's own limit of 80 rows."""
    return samples.rendered_context(threaded(spark, sf_dir), ["thread"], ["ts_us", "row_id"])


@query(
    "ordered_id_lists",
    _W + ", l AS (SELECT parent AS k, list(id ORDER BY row_id) AS ids FROM m WHERE parent IS NOT NULL GROUP BY 1), f AS (SELECT k, unnest(ids) AS id, generate_subscripts(ids, 1) - 1 AS pos FROM l) SELECT k, CAST(pos AS INT) AS pos, f.id, m.row_id FROM f JOIN m ON m.id = f.id",
)
def ordered_id_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of replies back to their rows, in the order of the list."""
    m = messages(spark, sf_dir)
    lists = m.where("parent is not null").groupBy(F.col("parent").alias("k")).agg(F.transform(F.array_sort(F.collect_list(F.struct("row_id", "id"))), lambda r: r["id"]).alias("ids"))
    return samples.resolved_list(lists, m.select("id", "row_id"), "k", "ids")


@query(
    "first_wins_lookup",
    _W + """, a AS (SELECT thread_id AS k, arg_min(id, row_id) AS v FROM m WHERE thread_id IS NOT NULL GROUP BY 1), b AS (SELECT task_id AS k, arg_min(id, row_id) AS v FROM m WHERE task_id IS NOT NULL GROUP BY 1)
    SELECT m.id, coalesce(a.v, b.v) AS first FROM m LEFT JOIN a ON a.k = thread_id LEFT JOIN b ON b.k = task_id""",
)
def first_wins_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = messages(spark, sf_dir)
    lookup = samples.first_lookup(m, ["thread_id", "task_id"], "id", "row_id")
    return samples.looked_up(m, lookup, ["thread_id", "task_id"], "first").select("id", "first")


@query(
    "corrector_pool",
    _W + f""", c AS (SELECT who AS corrector, text, name, row_id FROM m WHERE {SQL_USER} AND text IS NOT NULL AND who IS NOT NULL), x AS (SELECT corrector, text, min(row_id) AS seen, arg_min(name, row_id) AS name FROM c GROUP BY 1, 2)
    SELECT corrector, CAST(count(*) AS INT) AS n_texts, arg_min(name, seen) AS first_name, substr(arg_min(text, seen), 1, 60) AS first_text FROM x GROUP BY 1""",
)
def corrector_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = messages(spark, sf_dir).where(T.is_user(F.col("role")) & F.col("text").isNotNull() & F.col("who").isNotNull())
    return samples.corrector_pool(rows.select(F.col("who").alias("corrector"), "text", "name", "row_id"))


@query(
    "merged_snapshots",
    _W + " SELECT coalesce(parent, 'row:' || row_id) AS key, count(*) AS n, string_agg(id, ',' ORDER BY row_id) AS members FROM m GROUP BY 1",
)
def merged_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.merged_snapshots(messages(spark, sf_dir).select(F.col("parent").alias("t0"), "row_id", "id"))


@query(
    "interaction_cost",
    _W + f" SELECT task_id, count(*) FILTER (WHERE {SQL_USER}) AS user_turns, greatest(count(*) FILTER (WHERE {SQL_USER}) - 1, 0) AS retries FROM m GROUP BY 1",
)
def interaction_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.interaction_cost(messages(spark, sf_dir), ["task_id"])


@query(
    "subtask_samples",
    _W + f""" SELECT task_id, min(ts_us) AS first_us, max(ts_us) AS last_us, count(DISTINCT who) AS n_participants, count(DISTINCT CASE WHEN {SQL_BOT} THEN who END) > 1 AS multi_agent, count(*) FILTER (WHERE {SQL_USER}) AS user_turns,
    CASE WHEN count(*) FILTER (WHERE {SQL_BOT}) > 0 THEN CASE WHEN count(*) FILTER (WHERE {SQL_USER}) > 0 THEN 'dialogue' ELSE 'monologue' END ELSE 'chat_only' END AS tier FROM m GROUP BY 1""",
)
def subtask_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.subtasks(messages(spark, sf_dir), "task_id")


@query(
    "id_lists_in_text",
    r"SELECT row_id, array_to_string(list_transform(regexp_extract_all(text, '(\d+)', 1), lambda x: regexp_replace(x, '^0+(\d)', '\1')), ',') AS ids FROM chat_events WHERE text IS NOT NULL AND len(regexp_extract_all(text, '(\d+)', 1)) > 0",
)
def id_lists_in_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbers in texts, in whatever form, in their order and as often as they stand there."""
    rows = table(spark, sf_dir, "chat_events").where("text is not null").select("row_id", samples.outlier_ids(F.col("text")).alias("x")).where("size(x) > 0")
    return rows.select("row_id", F.array_join("x", ",").alias("ids"))


@query(
    "item_sizes",
    "SELECT left(item_id, 4) AS item_type, count(*) AS n, CAST(sum(strlen(item_json)) AS BIGINT) AS n_bytes FROM thread_items GROUP BY 1",
)
def item_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.item_sizes(table(spark, sf_dir, "thread_items"), F.substring("item_id", 1, 4))


@query(
    "fnv_sample",
    "SELECT c_name FROM (SELECT c_name, list_reduce(list_transform(range(strlen(c_name)), lambda i: CAST(ascii(substr(c_name, CAST(i + 1 AS INT), 1)) AS HUGEINT)), lambda h, b: (xor(h, b) * 1099511628211) % 18446744073709551616, 14695981039346656037::HUGEINT) AS h FROM customer) x WHERE h % 100 = 0",
)
def fnv_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One in a hundred customers by the hash of their name: a sampling operator."""
    return samples.fnv_sampled(table(spark, sf_dir, "customer"), "c_name")


@query(
    "review_page",
    "WITH b AS (SELECT o_custkey, max((o_totalprice, -o_orderkey)) AS x FROM orders GROUP BY 1) SELECT o_custkey, x[1] AS o_totalprice, -x[2] AS o_orderkey FROM b ORDER BY x[1] DESC, -x[2] LIMIT 20 OFFSET 10",
)
def review_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return samples.review_page(table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderkey"), "o_custkey", "o_totalprice", "o_orderkey", 10, 20)


def _overlap(rows: DataFrame) -> DataFrame:
    cards = rows.select("id", F.col("parent").alias("root"), F.when(F.col("text").isNotNull(), T.fingerprint(F.col("text"))).alias("fp"), "row_id")
    return samples.overlap_reason(cards, cards.where("row_id % 4 = 0")).select("id", "overlap")


@query(
    "reviewed_overlap",
    _W + r""", f AS (SELECT id, parent AS root, row_id, CASE WHEN length(regexp_replace(lower(text), '[^\p{L}\p{N}]+', '', 'g')) >= 20 THEN substr(regexp_replace(lower(text), '[^\p{L}\p{N}]+', '', 'g'), 1, 180) WHEN text IS NOT NULL THEN '' END AS fp FROM m),
    r AS (SELECT * FROM f WHERE row_id % 4 = 0) SELECT f.id, CASE WHEN id IN (SELECT id FROM r) THEN 'id' WHEN root IN (SELECT root FROM r WHERE root IS NOT NULL) THEN 'root' WHEN fp <> '' AND fp IN (SELECT fp FROM r WHERE fp IS NOT NULL) THEN 'text' END AS overlap FROM f""",
)
def reviewed_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages in any script against the reviewed quarter."""
    return _overlap(messages(spark, sf_dir))


@query(
    "aligned_join",
    "SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders",
)
def aligned_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return samples.aligned(o.select("o_orderkey", "o_totalprice"), o.select("o_orderkey", "o_orderstatus"), "o_orderkey")


@query(
    "read_verdicts",
    "SELECT l_returnflag, l_linestatus, CASE WHEN l_returnflag = 'N' THEN 'no_read' WHEN l_returnflag = 'R' THEN CASE WHEN l_linenumber % 2 > 0 THEN 'reproducible' ELSE 'needs_refs' END WHEN l_returnflag = 'A' THEN 'reproducible' ELSE 'not_reproducible' END AS verdict, count(*) AS n FROM lineitem GROUP BY ALL",
)
def read_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    target = F.when(flag == "N", "none").when(flag == "R", "code").when(flag == "A", "chat").otherwise("other")
    v = samples.read_verdict(target, F.col("l_linenumber") % 2)
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_linestatus", v.alias("verdict")).agg(F.count("*").alias("n"))


@query(
    "prompt_fingerprints",
    """WITH u AS (SELECT trace_id, unnest(messages) AS m, generate_subscripts(messages, 1) AS pos FROM trajectory), s AS (SELECT trace_id, list(m.content ORDER BY pos) AS blocks FROM u WHERE m.role = 'system' GROUP BY 1),
    k AS (SELECT trace_id, list_filter(blocks, lambda b: NOT coalesce(starts_with(b, 'After '), false)) AS kept FROM s)
    SELECT trace_id, coalesce(array_to_string(list_filter(kept, lambda b: b IS NOT NULL), chr(10)), '') AS prompt, sha256('{"col1":' || CAST(to_json(kept) AS VARCHAR) || '}') AS fingerprint FROM k""",
)
def prompt_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions of the prompts of traces: their system texts, volatile ones aside."""
    m = trajectories.message_rows(table(spark, sf_dir, "trajectory"))
    system = m.where("role = 'system'").groupBy("trace_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "content"))), lambda r: r["content"]).alias("blocks"))
    kept = samples.without_prefixed(F.col("blocks"), "After ")
    return system.select("trace_id", samples.flattened(kept).alias("prompt"), samples.fingerprint_of(kept).alias("fingerprint"))


@query(
    "prompt_pairs",
    _W + f""" SELECT c.id, 'Context:' || chr(10) || coalesce(b.text, '') || chr(10) || chr(10) || 'Request:' || chr(10) || coalesce(t.text, '') AS base,
      'Context:' || chr(10) || coalesce(b.text, '') || chr(10) || chr(10) || 'Request:' || chr(10) || coalesce(t.text, '') || chr(10) || coalesce(c.text, '') AS treated
    FROM (SELECT * FROM m WHERE {SQL_USER}) c JOIN (SELECT * FROM m WHERE {SQL_BOT}) b ON c.parent = b.id JOIN m t ON b.parent = t.id""",
)
def prompt_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each reply of a user to a bot as a pair of prompts over what both replied to."""
    m = messages(spark, sf_dir)
    c = m.where(T.is_user(F.col("role"))).select("id", "parent", F.col("text").alias("comment"))
    b = m.where(T.is_bot(F.col("role"))).select(F.col("id").alias("b"), F.col("parent").alias("t0"), F.col("text").alias("answer"))
    t = m.select(F.col("id").alias("t"), F.col("text").alias("request"))
    j = c.join(b, F.col("parent") == F.col("b")).join(t, F.col("t0") == F.col("t"))
    pair = samples.prompt_pair(F.col("answer"), F.col("request"), F.col("comment"))
    return j.select("id", pair["base"].alias("base"), pair["treated"].alias("treated"))


@query(
    "prompt_identities",
    """WITH u AS (SELECT trace_id, unnest(messages) AS m, generate_subscripts(messages, 1) AS pos FROM trajectory), s AS (SELECT trace_id, list('{"text": ' || CASE WHEN m.content IS NULL THEN 'null' ELSE CAST(to_json(m.content) AS VARCHAR) END || '}' ORDER BY pos) FILTER (WHERE NOT coalesce(starts_with(m.content, 'After '), false)) AS b FROM u WHERE m.role = 'system' GROUP BY 1)
    SELECT trace_id, sha256('{"system": [' || coalesce(array_to_string(b, ', '), '') || '], "tools": null}') AS identity FROM s""",
)
def prompt_identities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """System texts of traces as a payload of blocks, hashed as canonical JSON without the volatile ones."""
    m = trajectories.message_rows(table(spark, sf_dir, "trajectory"))
    blocks = m.where("role = 'system'").groupBy("trace_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "content"))), lambda r: F.struct(r["content"].alias("text"))).alias("b"))
    payloads = blocks.select("trace_id", F.to_json("b", {"ignoreNullFields": "false"}).alias("system"), F.lit(None).cast("string").alias("tools"))
    return samples.identities(payloads, "trace_id", "After ")
