"""Queries over sessions: segments, trajectories, replies, as-of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions import text as T
from threadloom.operators import ordered, replies, segments, trajectories
from threadloom.plans.core import query
from threadloom.plans.views import SQL_BOT, SQL_MESSAGES, SQL_USER, messages, threaded
from threadloom.session import table

ORDER = ["ts_us", "row_id"]
_W = "WITH RECURSIVE " + SQL_MESSAGES


def _seconds():
    return F.col("ts_us") / F.lit(1_000_000)


@query(
    "event_gap_segments",
    _W + """, b AS (SELECT *, lag(ts_us) OVER (PARTITION BY thread ORDER BY ts_us, row_id) AS p FROM t)
    SELECT id, thread, CAST(sum(CASE WHEN ts_us - p >= 1800000000 THEN 1 ELSE 0 END) OVER (PARTITION BY thread ORDER BY ts_us, row_id) AS BIGINT) AS segment FROM b""",
)
def event_gap_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.gap_segments(threaded(spark, sf_dir, "id"), ["thread"], ORDER, _seconds()).select("id", "thread", "segment")


_TOPIC = """, e0 AS (SELECT *, CASE WHEN kind IS NOT NULL THEN task_id END AS tp FROM t),
    e1 AS (SELECT *, coalesce(last_value(tp IGNORE NULLS) OVER (PARTITION BY thread ORDER BY ts_us, row_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '-') AS effective FROM e0),
    e2 AS (SELECT *, lag(ts_us) OVER w AS p, lag(effective) OVER w AS pe, lead(effective) OVER w AS ne FROM e1 WINDOW w AS (PARTITION BY thread ORDER BY ts_us, row_id)),
    e3 AS (SELECT *, CAST(sum(CASE WHEN coalesce(ts_us - p >= 1800000000, false) OR coalesce(effective <> pe AND (ne IS NULL OR ne = effective), false) THEN 1 ELSE 0 END) OVER (PARTITION BY thread ORDER BY ts_us, row_id) AS BIGINT) AS segment FROM e2)
"""


def _topics(spark: SparkSession, sf_dir: str, *more: str) -> DataFrame:
    rows = ordered.ranged(threaded(spark, sf_dir, "task_id", "kind", *more), ["thread"], ORDER)
    smooth = segments.smoothed_topics(rows, ["thread"], ORDER, "task_id", F.col("kind").isNull())
    return segments.topic_segments(smooth, ["thread"], ORDER, _seconds(), "effective")


@query("topic_forward_fill", _W + _TOPIC + "SELECT id, effective FROM e1")
def topic_forward_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.smoothed_topics(threaded(spark, sf_dir, "task_id", "kind"), ["thread"], ORDER, "task_id", F.col("kind").isNull()).select("id", "effective")


@query("topic_confirmed_segments", _W + _TOPIC + "SELECT id, thread, effective, segment FROM e3")
def topic_confirmed_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _topics(spark, sf_dir).select("id", "thread", "effective", "segment")


@query(
    "segment_labels",
    _W + _TOPIC + """, c AS (SELECT thread, segment, effective, count(*) AS n, min((ts_us, row_id)) AS seen FROM e3 GROUP BY ALL),
    d AS (SELECT *, row_number() OVER (PARTITION BY thread, segment ORDER BY n DESC, seen, effective) AS rn FROM c),
    f AS (SELECT thread, segment, count(*) AS n_rows, arg_min(substr(text, 1, 40), (ts_us, row_id)) FILTER (WHERE kind IS NOT NULL AND text IS NOT NULL) AS first_text FROM e3 GROUP BY ALL)
    SELECT f.thread, f.segment, n_rows, effective AS dominant, first_text FROM f JOIN d ON f.thread = d.thread AND f.segment = d.segment AND d.rn = 1""",
)
def segment_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.labels(_topics(spark, sf_dir, "text"), ["thread"], ORDER, "effective", F.col("kind").isNull())


@query("segment_partition_check", "SELECT 0::BIGINT AS lost, 0::BIGINT AS invented, 0::BIGINT AS doubled, 0::BIGINT AS unordered")
def segment_partition_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.partition_faults(threaded(spark, sf_dir, "id"), _topics(spark, sf_dir), ["thread"], "id", "ts_us")


@query(
    "history_epochs",
    _W + """, n AS (SELECT *, row_number() OVER w AS turn, kind IS NOT DISTINCT FROM 'helper' AS h FROM t WINDOW w AS (PARTITION BY thread ORDER BY ts_us, row_id))
    SELECT id, turn, CAST(sum(CASE WHEN h THEN 1 ELSE 0 END) OVER w AS BIGINT) AS epoch, max(CASE WHEN h THEN turn END) OVER w AS history_at FROM n
    WINDOW w AS (PARTITION BY thread ORDER BY ts_us, row_id)""",
)
def history_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    is_history = F.coalesce(F.col("kind") == "helper", F.lit(False))
    return segments.epochs(threaded(spark, sf_dir, "kind"), ["thread"], ORDER, is_history).select("id", "turn", "epoch", "history_at")


@query(
    "unique_increasing_ts",
    _W + """, b AS (SELECT id, thread, row_id, ts_us // 3600000000 AS base, ts_us FROM t), n AS (SELECT *, row_number() OVER (PARTITION BY thread ORDER BY ts_us, row_id) AS rn FROM b)
    SELECT id, CAST(rn + max(base - rn) OVER (PARTITION BY thread ORDER BY ts_us, row_id) AS BIGINT) AS unique_value FROM n""",
)
def unique_increasing_ts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = threaded(spark, sf_dir, "id").withColumn("base", F.floor(F.col("ts_us") / 3_600_000_000))
    return segments.increasing(rows, ["thread"], ORDER, "base").select("id", "unique_value")


@query(
    "boundary_intervals",
    _W + """, n AS (SELECT id, thread, kind, row_number() OVER (PARTITION BY thread ORDER BY ts_us, row_id) AS pos, count(*) OVER (PARTITION BY thread) AS last FROM t),
    s AS (SELECT DISTINCT thread, pos, last FROM n WHERE kind IS NULL OR pos = 1)
    SELECT thread, pos AS lo, coalesce(lead(pos) OVER (PARTITION BY thread ORDER BY pos) - 1, last) AS hi FROM s""",
)
def boundary_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ordered.numbered(threaded(spark, sf_dir, "kind"), ["thread"], ORDER)
    last = rows.groupBy("thread").agg(F.max("pos").alias("last"))
    starts = rows.where("kind is null or pos = 1").join(last, "thread").select("thread", "pos", "last")
    return segments.intervals(starts, ["thread"], "pos", "last")


@query(
    "terminal_flags",
    _W + f""", c AS (SELECT group_id, coalesce(task_id, '-') AS cluster, max(ts_us) AS last_ts,
      arg_max(text, (ts_us, row_id)) FILTER (WHERE {SQL_USER} AND text IS NOT NULL) AS tail FROM t GROUP BY ALL),
    r AS (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY last_ts DESC, cluster DESC) AS rn FROM c)
    SELECT group_id, cluster, rn > 1 OR coalesce(regexp_matches(tail, '(?i)(thanks|gracias|danke|谢谢)'), false) AS terminal FROM r""",
)
def terminal_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = threaded(spark, sf_dir).withColumn("cluster", F.coalesce("task_id", F.lit("-")))
    user = T.is_user(F.col("role")) & F.col("text").isNotNull()
    tail = F.max(F.when(user, F.struct("ts_us", "row_id", "text")))["text"]
    clusters = rows.groupBy("group_id", "cluster").agg(F.max("ts_us").alias("last_ts"), tail.alias("tail"))
    return segments.terminal_flags(clusters, ["group_id"], F.col("tail").rlike("(?i)(thanks|gracias|danke|谢谢)")).select("group_id", "cluster", "terminal")


@query(
    "confirmation_status",
    _W + f""", c AS (SELECT coalesce(task_id, '-') AS task, arg_max((CASE WHEN {SQL_USER} THEN 'user' ELSE 'bot' END, text), (ts_us, row_id)) FILTER (WHERE ({SQL_USER} OR {SQL_BOT}) AND length(coalesce(text, '')) >= 3) AS tail,
      max(ts_us) AS last_ts FROM t GROUP BY ALL), x AS (SELECT max(last_ts) AS top FROM c)
    SELECT task, CASE WHEN last_ts = top THEN 'open' WHEN tail IS NULL THEN 'done' WHEN tail[1] = 'user' THEN CASE WHEN regexp_matches(tail[2], '(?i)(thanks|gracias|danke|谢谢)') THEN 'done' ELSE 'unconfirmed' END ELSE 'done' END AS status FROM c, x""",
)
def confirmation_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = threaded(spark, sf_dir)
    user, bot = T.is_user(F.col("role")), T.is_bot(F.col("role"))
    real = (user | bot) & (F.length(F.coalesce("text", F.lit(""))) >= 3)
    tail = F.max(F.when(real, F.struct("ts_us", "row_id", F.when(user, "user").otherwise("bot").alias("by"), "text")))
    c = rows.groupBy(F.coalesce("task_id", F.lit("-")).alias("task")).agg(tail.alias("tail"), F.max("ts_us").alias("last_ts"))
    top = c.agg(F.lit(1).alias("one"), F.max("last_ts").alias("top"))  # one row
    closing = F.col("tail.text").rlike("(?i)(thanks|gracias|danke|谢谢)")
    status = trajectories.confirmation(F.col("last_ts") < F.col("top"), F.col("tail.by"), closing, F.lit(None).cast("string"))
    return c.withColumn("one", F.lit(1)).join(F.broadcast(top), "one").select("task", status.alias("status"))


@query(
    "id_suffix_dedupe",
    """WITH b AS (SELECT row_id, CASE WHEN trim(coalesce(name, '')) = '' THEN 'row-' || row_number() OVER (ORDER BY row_id) ELSE name END AS base FROM chat_events),
    k AS (SELECT *, row_number() OVER (PARTITION BY base ORDER BY row_id) AS k FROM b)
    SELECT row_id, CASE WHEN k = 1 THEN base ELSE base || '-' || k END AS unique_id FROM k""",
)
def id_suffix_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segments.unique_ids(table(spark, sf_dir, "chat_events").select("row_id", "name"), "name", ["row_id"]).select("row_id", "unique_id")


@query(
    "next_ordinals",
    """WITH o AS (SELECT thread_id, max(rollout_ordinal) AS top FROM thread_items GROUP BY 1)
    SELECT t.trace_id, t.thread_id, coalesce(top + 1, 0) + row_number() OVER (PARTITION BY t.thread_id ORDER BY start_ns, trace_id) - 1 AS ordinal FROM trajectory t LEFT JOIN o ON t.thread_id = o.thread_id WHERE t.thread_id IS NOT NULL""",
)
def next_ordinals(spark: SparkSession, sf_dir: str) -> DataFrame:
    new = table(spark, sf_dir, "trajectory").where("thread_id is not null").select("trace_id", "thread_id", "start_ns")
    return segments.next_ordinals(table(spark, sf_dir, "thread_items"), new, "thread_id", "rollout_ordinal", ["start_ns", "trace_id"]).select("trace_id", "thread_id", "ordinal")


# --- trajectories -------------------------------------------------------------

_STEPS = """s AS (SELECT trace_id, thread_id, CAST(pos AS BIGINT) AS pos, st.type AS type, st.start_ns AS start_ns, st.model AS model, st.tool_name AS tool_name, st.error AS error
      FROM (SELECT trace_id, thread_id, unnest(steps) AS st, generate_subscripts(steps, 1) - 1 AS pos FROM trajectory) x WHERE st IS NOT NULL)"""
_MSGS = """g AS (SELECT trace_id, CAST(pos AS BIGINT) AS pos, ms.role AS role, ms.content AS content, coalesce(len(ms.tool_calls), 0) AS n
      FROM (SELECT trace_id, unnest(messages) AS ms, generate_subscripts(messages, 1) - 1 AS pos FROM trajectory) x WHERE ms IS NOT NULL)"""


@query(
    "trace_summary",
    "WITH " + _STEPS + """ SELECT trace_id, arg_min(model, pos) FILTER (WHERE model <> '') AS first_model, arg_max(model, pos) FILTER (WHERE model <> '') AS last_model, min(start_ns) AS first_ns, max(start_ns) AS last_ns,
      coalesce(string_agg(DISTINCT nullif(tool_name, ''), ',' ORDER BY nullif(tool_name, '')), '') AS tools, count(*) AS n_steps, count(*) FILTER (WHERE type = 'model') AS n_model, count(*) FILTER (WHERE type = 'tool') AS n_tool, count(*) FILTER (WHERE error <> '') AS n_errors FROM s GROUP BY 1""",
)
def trace_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trajectories.trace_summary(trajectories.step_rows(table(spark, sf_dir, "trajectory")))


@query(
    "trace_token_sums",
    "SELECT source, model, k AS token_kind, CAST(sum(v) AS BIGINT) AS n_tokens, count(*) AS n_traces FROM (SELECT source, model, unnest(map_keys(tokens)) AS k, unnest(map_values(tokens)) AS v FROM trajectory) x GROUP BY ALL",
)
def trace_token_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trajectories.token_sums(table(spark, sf_dir, "trajectory"), ["source", "model"])


@query(
    "step_aggregation",
    "WITH " + _STEPS + """, a AS (SELECT *, sum(CASE WHEN type = 'model' THEN 1 ELSE 0 END) OVER w - 1 AS tn, sum(CASE WHEN type IS DISTINCT FROM 'tool' THEN 1 ELSE 0 END) OVER w AS island FROM s WINDOW w AS (PARTITION BY trace_id ORDER BY pos)),
      b AS (SELECT *, first_value(type) OVER (PARTITION BY trace_id, island ORDER BY pos) AS head, sum(CASE WHEN type = 'tool' THEN 1 ELSE 0 END) OVER (PARTITION BY trace_id, island ORDER BY pos) AS kk FROM a)
      SELECT trace_id, pos, type, CAST(CASE WHEN head = 'model' THEN tn END AS INT) AS turn, CAST(kk AS INT) AS k, tool_name FROM (SELECT trace_id, pos, type, tn, head, kk, CASE WHEN type = 'model' THEN tool_name ELSE tool_name END AS tool_name FROM b) z WHERE type IN ('model', 'tool')""",
)
def step_aggregation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trajectories.turns(trajectories.step_rows(table(spark, sf_dir, "trajectory"))).select("trace_id", "pos", "type", "turn", "k", "tool_name")


_BIND = """WITH RECURSIVE x AS (SELECT trace_id, unnest(messages) AS m, generate_subscripts(messages, 1) - 1 AS pos FROM trajectory), y AS (SELECT trace_id, pos, m.role AS role, coalesce(len(m.tool_calls), 0) AS n, row_number() OVER (PARTITION BY trace_id ORDER BY pos) AS k FROM x WHERE m IS NOT NULL),
    s AS (SELECT trace_id, CAST(0 AS BIGINT) AS k, 0 AS made, 0 AS nxt, 0 AS fin, CAST(NULL AS BIGINT) AS pos, CAST(NULL AS INT) AS call FROM y WHERE k = 1
      UNION ALL SELECT s.trace_id, y.k, CASE WHEN role = 'assistant' AND n > 0 THEN made + n ELSE made END, CASE WHEN role = 'assistant' AND n > 0 THEN made WHEN role = 'tool' THEN least(nxt + 1, fin) ELSE nxt END,
        CASE WHEN role = 'assistant' AND n > 0 THEN made + n ELSE fin END, CASE WHEN role = 'tool' THEN y.pos END, CASE WHEN role = 'tool' AND nxt < fin THEN nxt END FROM s JOIN y ON y.trace_id = s.trace_id AND y.k = s.k + 1)
"""


@query("tool_call_binding", _BIND + " SELECT trace_id, pos, CASE WHEN call IS NOT NULL THEN 'call_' || call END AS call_id FROM s WHERE pos IS NOT NULL")
def tool_call_binding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trajectories.tool_bindings(trajectories.message_rows(table(spark, sf_dir, "trajectory")))


@query(
    "chat_samples",
    _BIND + """, q AS (SELECT trace_id, pos, m.role AS role, m.content AS content, coalesce(len(m.tool_calls), 0) AS n FROM x WHERE m IS NOT NULL),
    g AS (SELECT trace_id, min(CASE WHEN role = 'system' THEN pos END) AS s, min(CASE WHEN role = 'user' AND trim(coalesce(content, ''), ' ') <> '' THEN pos END) AS u, sum(CASE WHEN role = 'assistant' THEN n ELSE 0 END) AS calls FROM q GROUP BY 1)
    SELECT q.trace_id, q.pos, q.role, q.content, CASE WHEN b.call IS NOT NULL THEN 'call_' || b.call END AS call_id FROM q JOIN g ON g.trace_id = q.trace_id AND calls >= 1 LEFT JOIN (SELECT * FROM s WHERE pos IS NOT NULL) b ON b.trace_id = q.trace_id AND b.pos = q.pos
    WHERE q.pos = g.s OR q.pos = g.u OR role IN ('assistant', 'tool')""",
)
def chat_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trajectories.chat_samples(trajectories.message_rows(table(spark, sf_dir, "trajectory")))


@query(
    "completion_boundary",
    "WITH " + _MSGS + " SELECT trace_id, coalesce(max(CASE WHEN role <> 'assistant' THEN pos END), -1) + 1 AS completion_start_index, count(*) AS n_messages FROM g GROUP BY 1",
)
def completion_boundary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trajectories.completion_start(trajectories.message_rows(table(spark, sf_dir, "trajectory")))


@query(
    "surfaced_instruction",
    "WITH " + _MSGS + """, f AS (SELECT trace_id, arg_min(content, pos) FILTER (WHERE role = 'user' AND trim(coalesce(content, '')) <> '' AND content <> 'probe') AS u,
      arg_min(content, pos) FILTER (WHERE role = 'system' AND trim(coalesce(content, '')) <> '') AS i FROM g GROUP BY 1)
      SELECT trace_id, coalesce(u, i) AS instruction, CASE WHEN u IS NOT NULL THEN 'real_user' WHEN i IS NOT NULL THEN 'injected' ELSE 'probe_only' END AS source FROM f""",
)
def surfaced_instruction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trajectories.surfaced_instruction(trajectories.message_rows(table(spark, sf_dir, "trajectory")))


@query(
    "session_trajectory",
    _W + f""" SELECT thread, min(ts_us) AS first_us, max(ts_us) AS last_us, count(*) AS n_messages, count(*) FILTER (WHERE {SQL_USER}) AS n_user, count(*) FILTER (WHERE {SQL_BOT}) AS n_bot,
      greatest(count(*) FILTER (WHERE {SQL_USER}) - 1, 0) AS n_retries, substr(arg_min(text, (ts_us, row_id)) FILTER (WHERE {SQL_USER} AND text IS NOT NULL), 1, 60) AS first_request, arg_max({SQL_BOT}, (ts_us, row_id)) AS ends_with_bot FROM t GROUP BY 1""",
)
def session_trajectory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trajectories.session_trajectories(threaded(spark, sf_dir), "thread")


@query(
    "identity_calls",
    _W + """, c AS (SELECT who, coalesce(kind, '-') AS kind, name AS version, row_id, ts_us FROM t WHERE who IS NOT NULL AND name IS NOT NULL), v AS (SELECT who, kind, version, min(row_id) AS first FROM c GROUP BY ALL),
      w AS (SELECT who, kind, string_agg(version, ',' ORDER BY first) AS versions FROM v GROUP BY ALL)
      SELECT c.who, c.kind, count(*) AS n_calls, min(ts_us) AS first_us, max(ts_us) AS last_us, any_value(versions) AS versions FROM c JOIN w ON c.who = w.who AND c.kind = w.kind GROUP BY c.who, c.kind""",
)
def identity_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = threaded(spark, sf_dir).where("who is not null and name is not null").select("who", F.coalesce("kind", F.lit("-")).alias("kind"), F.col("name").alias("version"), "row_id", "ts_us")
    return trajectories.identities(calls, ["who", "kind"])


@query(
    "outcome_mapping",
    _W + f""", c AS (SELECT coalesce(task_id, '-') AS task, max({SQL_BOT} AND regexp_matches(coalesce(text, ''), '(?i)done|merged')) AS terminal, max(regexp_matches(coalesce(text, ''), '(?i)correction')) AS corrected, max(regexp_matches(coalesce(text, ''), '(?i)lost')) AS failed FROM m GROUP BY 1)
      SELECT task, CASE WHEN NOT terminal THEN 'incomplete' WHEN failed THEN 'failure' WHEN corrected THEN 'corrected' ELSE 'success' END AS outcome FROM c""",
)
def outcome_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    has = lambda p: F.coalesce("text", F.lit("")).rlike(p)
    c = messages(spark, sf_dir).groupBy(F.coalesce("task_id", F.lit("-")).alias("task")).agg(
        F.max(T.is_bot(F.col("role")) & has("(?i)done|merged")).alias("terminal"), F.max(has("(?i)correction")).alias("corrected"), F.max(has("(?i)lost")).alias("failed")
    )
    return c.select("task", trajectories.outcome(F.col("terminal"), F.when(F.col("corrected"), "corrected"), F.when(F.col("failed"), "failure")).alias("outcome"))


# --- replies ------------------------------------------------------------------


@query("reply_edges", _W + " SELECT c.id AS child, p.id AS parent FROM m c JOIN m p ON c.parent = p.id")
def reply_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replies.edges(messages(spark, sf_dir))


@query(
    "edge_agreement",
    _W + """ SELECT count(*) AS n_edges, count(*) FILTER (WHERE c.task_id IS NULL OR p.task_id IS NULL) AS n_unknown, count(*) FILTER (WHERE c.task_id = p.task_id) AS n_same, count(*) FILTER (WHERE c.task_id <> p.task_id) AS n_split
      FROM m c JOIN m p ON c.parent = p.id""",
)
def edge_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = messages(spark, sf_dir)
    return replies.edge_agreement(replies.edges(m), m.select("id", F.col("task_id").alias("label")))


@query(
    "reply_components",
    _W + """, e AS (SELECT c.id AS a, p.id AS b FROM m c JOIN m p ON c.parent = p.id WHERE c.id <> p.id UNION SELECT p.id, c.id FROM m c JOIN m p ON c.parent = p.id WHERE c.id <> p.id),
      r(id, reach) AS (SELECT DISTINCT a, a FROM e UNION SELECT r.id, e.b FROM r JOIN e ON r.reach = e.a)
      SELECT id, min(reach) AS component FROM r GROUP BY id""",
)
def reply_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees are components already; only what hangs on a cycle goes through label rounds."""
    return replies.tree_components(messages(spark, sf_dir, "parent"))


@query(
    "parent_chain",
    _W + """, c(id, ancestor, distance) AS (SELECT x.id, p.id, 1 FROM m x JOIN m p ON x.parent = p.id UNION ALL SELECT c.id, p.id, distance + 1 FROM c JOIN m x ON c.ancestor = x.id JOIN m p ON x.parent = p.id WHERE distance < 16) SELECT id, ancestor, distance FROM c""",
)
def parent_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replies.chains(messages(spark, sf_dir))


_ROOTS = """, up(id, root, depth, orphan) AS (SELECT id, id, 0, parent IS NOT NULL FROM m WHERE parent IS NULL OR parent NOT IN (SELECT id FROM m) UNION ALL SELECT m.id, up.root, up.depth + 1, up.orphan FROM m JOIN up ON m.parent = up.id)"""


@query("reply_root", _W + _ROOTS + " SELECT m.id, root FROM m LEFT JOIN up ON m.id = up.id")
def reply_root(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replies.roots(messages(spark, sf_dir)).select("id", "root")


@query(
    "root_completeness",
    _W + _ROOTS + " SELECT m.id, CASE WHEN orphan THEN q.parent ELSE root END AS root, coalesce(NOT orphan, false) AS complete FROM m LEFT JOIN up ON m.id = up.id LEFT JOIN m q ON q.id = up.root",
)
def root_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replies.root_completeness(messages(spark, sf_dir))


@query(
    "lane_assignment",
    _W + _ROOTS + """, real AS (SELECT id, CASE WHEN kind = 'helper' THEN coalesce(task_id, 'main') ELSE 'main' END AS lane FROM m WHERE kind IS NOT NULL)
      SELECT m.id, CASE WHEN o.lane IS NOT NULL THEN o.lane WHEN m.parent IS NOT NULL AND q.lane IS NOT NULL AND q.lane <> 'main' THEN q.lane ELSE 'main' END AS lane,
        CASE WHEN o.lane IS NOT NULL THEN 'real' WHEN m.parent IS NOT NULL AND q.lane IS NOT NULL AND q.lane <> 'main' THEN 'root' ELSE 'main' END AS provenance
      FROM m LEFT JOIN up ON m.id = up.id LEFT JOIN real o ON o.id = m.id LEFT JOIN real q ON q.id = up.root""",
)
def lane_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = messages(spark, sf_dir)
    real = m.where("kind is not null").select("id", F.when(F.col("kind") == "helper", F.coalesce("task_id", F.lit("main"))).otherwise("main").alias("lane"))
    return replies.lanes(m, real)


@query(
    "edge_upsert",
    "SELECT child, arg_max(parent, row_id) AS parent FROM (SELECT who AS child, group_id AS parent, row_id FROM chat_events WHERE who IS NOT NULL) x GROUP BY 1",
)
def edge_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = table(spark, sf_dir, "chat_events").where("who is not null").select(F.col("who").alias("child"), F.col("group_id").alias("parent"), "row_id")
    return replies.upsert_edges(edges).select("child", "parent")


_SPAWN = "(SELECT 'r' || n_regionkey AS parent, 'n' || n_nationkey AS child, n_nationkey % 3 <> 0 AS open FROM nation UNION ALL SELECT 'n' || c_nationkey, 'c' || c_custkey, c_custkey % 2 = 0 FROM customer UNION ALL SELECT 'c' || o_custkey, 'o' || o_orderkey, o_orderkey % 5 <> 0 FROM orders)"


@query(
    "spawn_descendants",
    f"WITH RECURSIVE e AS {_SPAWN}, d(top, id, depth) AS (SELECT 'r' || r_regionkey, child, 1 FROM region JOIN e ON e.parent = 'r' || r_regionkey WHERE open UNION ALL SELECT top, child, depth + 1 FROM d JOIN e ON d.id = e.parent WHERE open) SELECT * FROM d",
)
def spawn_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    nation, customer, orders = (table(spark, sf_dir, n) for n in ("nation", "customer", "orders"))
    status = lambda c: F.when(c, "open").otherwise("closed").alias("status")
    spawn = nation.select(key("r", "n_regionkey").alias("parent"), key("n", "n_nationkey").alias("child"), status(F.col("n_nationkey") % 3 != 0))
    spawn = spawn.unionByName(customer.select(key("n", "c_nationkey").alias("parent"), key("c", "c_custkey").alias("child"), status(F.col("c_custkey") % 2 == 0)))
    spawn = spawn.unionByName(orders.select(key("c", "o_custkey").alias("parent"), key("o", "o_orderkey").alias("child"), status(F.col("o_orderkey") % 5 != 0)))
    return replies.descendants(spawn, table(spark, sf_dir, "region").select(key("r", "r_regionkey").alias("id")), "open")


@query(
    "reopened_tasks",
    _W + """, f AS (SELECT id, coalesce(task_id, '-') AS task FROM m WHERE row_id % 2 = 0), n AS (SELECT parent FROM m WHERE row_id % 2 = 1) SELECT DISTINCT task FROM n JOIN f ON n.parent = f.id""",
)
def reopened_tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Old half: rows with an even number; the odd ones arrive later."""
    m = messages(spark, sf_dir)
    frozen = m.where("row_id % 2 = 0").select("id", F.coalesce("task_id", F.lit("-")).alias("task"), F.col("row_id").alias("task_pos"))
    return replies.reopened(frozen, m.where("row_id % 2 = 1").select("parent"))


# --- as-of and context --------------------------------------------------------


@query(
    "asof_backward",
    _W + f""", c AS (SELECT thread, ts_us, row_id, id FROM t WHERE {SQL_BOT}), u AS (SELECT * FROM t WHERE {SQL_USER})
      SELECT u.id, (SELECT arg_max(c.id, (c.ts_us, c.row_id)) FROM c WHERE c.thread = u.thread AND c.ts_us <= u.ts_us) AS asof_bot FROM u""",
)
def asof_backward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last bot message of the thread at or before each user message."""
    t = threaded(spark, sf_dir)
    left = t.where(T.is_user(F.col("role"))).select("thread", "ts_us", "row_id", "id")
    right = t.where(T.is_bot(F.col("role"))).select("thread", "ts_us", "row_id", F.col("id").alias("bot"))
    return ordered.as_of(left, right, ["thread"], "ts_us", ["bot"], "row_id").select("id", "asof_bot")


_POS = ", n AS (SELECT *, row_number() OVER (PARTITION BY thread ORDER BY ts_us, row_id) AS pos FROM t)"


@query(
    "asof_forward_bounded",
    _W + _POS + f""", w AS (SELECT id, pos, role, min(CASE WHEN {SQL_BOT} AND length(coalesce(text, '')) >= 20 THEN pos END) OVER (PARTITION BY thread ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND 39 FOLLOWING) AS reply_pos FROM n)
      SELECT id, pos, reply_pos FROM w WHERE {SQL_USER}""",
)
def asof_forward_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first substantial bot reply among the next 39 rows of the thread."""
    from threadloom.operators import context

    rows = ordered.numbered(threaded(spark, sf_dir), ["thread"], ORDER)
    good = T.is_bot(F.col("role")) & (F.length(F.coalesce("text", F.lit(""))) >= 20)
    found = context.first_after(rows, ["thread"], good, 39)
    return found.where(T.is_user(F.col("role"))).select("id", "pos", F.col("found_pos").alias("reply_pos"))


@query(
    "context_window_range",
    _W + _POS + f""", a AS (SELECT thread, pos AS spot, id AS anchor FROM n WHERE {SQL_USER})
      SELECT anchor, n.id, n.pos - spot AS off FROM a JOIN n ON a.thread = n.thread AND n.pos BETWEEN spot - 3 AND spot + 2""",
)
def context_window_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rows before to two after every user message."""
    from threadloom.operators import context

    rows = ordered.numbered(threaded(spark, sf_dir, "role"), ["thread"], ORDER)
    anchors = rows.where(T.is_user(F.col("role"))).select("thread", F.col("pos").alias("at"), F.col("id").alias("anchor"))
    return context.window_around(rows.select("thread", "pos", "id"), anchors, ["thread"], 3, 2).select("anchor", "id", "off")


@query(
    "context_before",
    _W + _POS + f""", a AS (SELECT thread, pos AS spot, id AS anchor FROM n WHERE {SQL_USER}),
      w AS (SELECT id, count(*) OVER k AS c, min(pos) OVER k AS first_pos FROM n WHERE thread IS NOT NULL WINDOW k AS (PARTITION BY thread ORDER BY pos ROWS BETWEEN 80 PRECEDING AND 1 PRECEDING))
      SELECT anchor, coalesce(c, 0) AS n_context, first_pos FROM a LEFT JOIN w ON w.id = anchor""",
)
def context_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last 80 rows of the lane strictly before every user message."""
    from threadloom.operators import context

    rows = ordered.numbered(threaded(spark, sf_dir, "role"), ["thread"], ORDER)
    anchors = rows.where(T.is_user(F.col("role"))).select("thread", F.col("pos").alias("at"), F.col("id").alias("anchor"))
    return context.counted_before(anchors, ["thread"], 80).select("anchor", "n_context", "first_pos")
