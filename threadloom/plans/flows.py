"""Queries over folds, anchors, sources, providers and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions import text as T
from threadloom.operators import anchors, evaluation, folds, guards, ordered, providers, replies, segments, trajectories
from threadloom.plans.core import query
from threadloom.plans.views import SQL_BOT, SQL_MESSAGES, SQL_USER, messages, threaded
from threadloom.session import scratch_path, table
from threadloom.sources import logs
from threadloom.streaming import landing
from threadloom.streaming.incremental import IncrementalSegments

_W = "WITH RECURSIVE " + SQL_MESSAGES
_POS = ", n AS (SELECT *, row_number() OVER (PARTITION BY thread ORDER BY ts_us, row_id) AS pos FROM t)"
_ASKS = "(?i)(please|could you|bitte|por favor|麻烦)"


def _placed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ordered.numbered(threaded(spark, sf_dir), ["thread"], ["ts_us", "row_id"])


@query(
    "instruction_before",
    _W + _POS + f""" SELECT id, max(CASE WHEN {SQL_USER} AND regexp_matches(text, '{_ASKS}') THEN pos END) OVER (PARTITION BY thread ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS instruction_pos FROM n""",
)
def instruction_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    good = T.is_user(F.col("role")) & F.coalesce(F.col("text").rlike(_ASKS), F.lit(False))
    return anchors.instruction_before(_placed(spark, sf_dir), ["thread"], good).select("id", "instruction_pos")


@query(
    "corrector_reanchor",
    _W + _POS + f""", p AS (SELECT c.id AS corrector, a.id AS anchor, c.thread, a.pos AS apos, c.pos AS cpos FROM n c JOIN n a ON c.parent = a.id AND a.thread = c.thread AND a.pos < c.pos),
    h AS (SELECT * FROM n WHERE {SQL_USER})
    SELECT corrector, anchor, coalesce((SELECT arg_max(h.id, h.pos) FROM h WHERE h.parent = p.anchor AND h.pos > p.apos AND h.pos < p.cpos AND h.thread = p.thread), (SELECT arg_max(h.id, h.pos) FROM h WHERE h.thread = p.thread AND h.pos > p.apos AND h.pos < p.cpos)) AS human FROM p""",
)
def corrector_reanchor(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _placed(spark, sf_dir)
    c = rows.select(F.col("id").alias("corrector"), F.col("parent").alias("up"), F.col("thread").alias("ct"), F.col("pos").alias("cp"))
    a = rows.select(F.col("id").alias("anchor"), F.col("thread").alias("at"), F.col("pos").alias("ap"))
    pairs = c.join(a, (F.col("up") == F.col("anchor")) & (F.col("ct") == F.col("at")) & (F.col("ap") < F.col("cp"))).select("corrector", "anchor")
    return anchors.reanchored(rows, pairs, ["thread"], T.is_user(F.col("role")))


@query(
    "bot_in_parent_chain",
    _W + f""", c(id, ancestor, distance) AS (SELECT x.id, p.id, 1 FROM m x JOIN m p ON x.parent = p.id UNION ALL SELECT c.id, p.id, distance + 1 FROM c JOIN m x ON c.ancestor = x.id JOIN m p ON x.parent = p.id WHERE distance < 16),
    g AS (SELECT id AS g FROM m WHERE {SQL_BOT}) SELECT id, arg_min(ancestor, (distance, ancestor)) AS ancestor, min(distance) AS distance FROM c JOIN g ON ancestor = g GROUP BY id""",
)
def bot_in_parent_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return anchors.in_parent_chain(messages(spark, sf_dir), T.is_bot(F.col("role")))


@query(
    "context_choice",
    _W + """, up(id, root, orphan) AS (SELECT id, id, parent IS NOT NULL FROM m WHERE parent IS NULL OR parent NOT IN (SELECT id FROM m) UNION ALL SELECT m.id, up.root, up.orphan FROM m JOIN up ON m.parent = up.id)"""
    + _POS + """, r AS (SELECT n.id, n.parent, n.pos, n.ts_us, up.root, NOT up.orphan AS complete FROM n LEFT JOIN up ON up.id = n.id),
    e AS (SELECT *, (CASE WHEN root IS NULL THEN 0 ELSE coalesce(count(*) OVER (PARTITION BY root ORDER BY ts_us RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) END) AS earlier FROM r)
    SELECT id, CASE WHEN parent IS NOT NULL AND earlier > 0 AND complete THEN 'exact_thread' WHEN parent IS NOT NULL AND earlier > 0 THEN 'recovered_by_parent' WHEN pos > 1 THEN 'same_session_window' ELSE 'missing_or_ambiguous' END AS quality,
      CAST(least(CASE WHEN parent IS NOT NULL AND earlier > 0 THEN earlier ELSE pos - 1 END, 80) AS BIGINT) AS n_context FROM e""",
)
def context_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    roots = replies.roots(messages(spark, sf_dir)).select(F.col("id").alias("r"), "root", (F.col("kind") == "root").alias("complete"))
    rows = _placed(spark, sf_dir)
    return anchors.chosen_context(rows.join(roots, F.col("id") == F.col("r"), "left").drop("r"), ["thread"])


@query(
    "char_windows",
    _W + """, n AS (SELECT thread, row_number() OVER (PARTITION BY thread ORDER BY ts_us, row_id) - 1 AS pos, length(coalesce(text, '')) AS c FROM t),
    s AS (SELECT thread, pos, CAST(0 AS BIGINT) AS win, [{'p': pos, 'c': c}] AS held, [pos] AS shown FROM n WHERE pos = 0
      UNION ALL SELECT n.thread, n.pos, CASE WHEN cut THEN win + 1 ELSE win END, list_append(CASE WHEN cut THEN held[-8:] ELSE held END, {'p': n.pos, 'c': n.c}), CASE WHEN cut THEN list_append(list_transform(held[-8:], lambda h: h.p), n.pos) ELSE [n.pos] END
      FROM s JOIN n ON n.thread IS NOT DISTINCT FROM s.thread AND n.pos = s.pos + 1, LATERAL (SELECT list_sum(list_transform(held, lambda h: h.c)) + n.c > 20000 AS cut) x)
    SELECT thread, unnest(shown) AS pos, win AS "window" FROM s""",
)
def char_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = threaded(spark, sf_dir).select("thread", "ts_us", "row_id", F.length(F.coalesce("text", F.lit(""))).alias("n_chars"))
    return folds.char_windows(rows, "thread", ["ts_us", "row_id"], "n_chars")


@query(
    "session_routing",
    _W + f""", r AS (SELECT group_id, id, parent, {SQL_USER} AS is_request, row_number() OVER (PARTITION BY group_id ORDER BY ts_us, row_id) AS pos FROM t),
    f AS (SELECT group_id, min(pos) AS first FROM r WHERE is_request GROUP BY 1), a AS (SELECT r.*, first FROM r JOIN f ON f.group_id IS NOT DISTINCT FROM r.group_id AND r.pos >= first),
    p AS (SELECT a.*, q.id AS up FROM a LEFT JOIN a q ON q.group_id IS NOT DISTINCT FROM a.group_id AND q.id = a.parent AND q.pos < a.pos),
    o AS (SELECT *, CASE WHEN NOT is_request THEN 'inherited' WHEN up IS NOT NULL THEN 'reply' WHEN pos = first THEN 'opener' ELSE 'new' END AS reason, max(CASE WHEN is_request THEN (pos, id) END) OVER (PARTITION BY group_id ORDER BY pos) AS lastr FROM p),
    k AS (SELECT *, CASE WHEN reason = 'inherited' THEN lastr[2] WHEN reason = 'reply' THEN up END AS target, sum(CASE WHEN reason IN ('opener', 'new') THEN 1 ELSE 0 END) OVER (PARTITION BY group_id ORDER BY pos) - 1 AS own FROM o),
    z(group_id, id, session) AS (SELECT group_id, id, CAST(own AS BIGINT) FROM k WHERE target IS NULL UNION ALL SELECT k.group_id, k.id, z.session FROM k JOIN z ON z.group_id IS NOT DISTINCT FROM k.group_id AND z.id = k.target)
    SELECT z.group_id, z.id, z.session, k.reason FROM z JOIN k ON k.group_id IS NOT DISTINCT FROM z.group_id AND k.id = z.id""",
)
def session_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a judge: requests that reply to nothing open a session."""
    rows = threaded(spark, sf_dir, "role", "parent", "group_id").withColumn("is_request", T.is_user(F.col("role")))
    return folds.routed_plainly(rows, "group_id", ["ts_us", "row_id"])


@query("snapshot_reconcile")
def snapshot_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message lists of the traces of a thread as snapshots of one conversation."""
    t = table(spark, sf_dir, "trajectory").where("thread_id is not null")
    rows = t.select("thread_id", F.col("start_ns").alias("snapshot"), F.posexplode("messages").alias("idx", "m")).where("m is not null")
    item = F.concat_ws(":", F.coalesce("m.role", F.lit("")), F.coalesce("m.content", F.lit("")))
    return folds.reconciled_items(rows.select("thread_id", "snapshot", F.col("idx").cast("bigint").alias("idx"), item.alias("item")), "thread_id")


_ID = "nullif(lower(trim(msg_id)), '')"


@query(
    "first_wins_dedupe",
    f"""WITH s AS (SELECT {_ID} AS k, CASE WHEN kind IS NOT NULL THEN 0 ELSE 1 END AS src, row_id, group_id FROM chat_events WHERE {_ID} IS NOT NULL), r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY src, row_id) AS rn FROM s) SELECT k, row_id, group_id FROM r WHERE rn = 1""",
)
def first_wins_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources, the rows with a kind before those without."""
    k = F.lower(F.trim("msg_id"))
    e = table(spark, sf_dir, "chat_events").select(F.when(k != "", k).alias("k"), "row_id", "group_id", "kind").where("k is not null")
    return logs.first_wins([e.where("kind is not null").drop("kind"), e.where("kind is null").drop("kind")], "k", "row_id")


@query(
    "last_wins_dedupe",
    f"WITH s AS (SELECT coalesce({_ID}, 'ts:' || row_id) AS k, row_id, group_id FROM chat_events) SELECT k, max(row_id) AS row_id, arg_max(group_id, row_id) AS group_id FROM s GROUP BY 1",
)
def last_wins_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.lower(F.trim("msg_id"))
    return logs.last_wins(table(spark, sf_dir, "chat_events").select(F.when(k != "", k).alias("k"), "row_id", "group_id"), "k", "row_id")


@query("incremental_equals_batch", "SELECT 0::BIGINT AS missing, 0::BIGINT AS different")
def incremental_equals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of three batches in turn against those of one pass."""
    rows = threaded(spark, sf_dir, "parent")
    state = IncrementalSegments(spark)
    for k in range(3):
        state.update(rows.where(F.col("row_id") % 3 == k))
        state = IncrementalSegments(spark, state.path)  # a new process goes on from what was committed
    once = segments.gap_segments(rows, ["thread"], ["ts_us", "row_id"], F.col("ts_us") / F.lit(1_000_000)).select(F.col("id").alias("o"), F.col("segment").alias("s"))
    both = once.join(state.read().select("id", "segment"), F.col("id") == F.col("o"), "full")
    return both.agg(F.count_if(F.col("id").isNull() | F.col("o").isNull()).alias("missing"), F.count_if(F.col("segment") != F.col("s")).alias("different"))


@query("stream_landing", "SELECT kind, count(*) AS n FROM chat_events GROUP BY 1")
def stream_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log read as a stream of files, landed, and counted."""
    path = scratch_path(spark, "landed")
    source = spark.read.parquet(f"{sf_dir}/chat_events.parquet").select("row_id", "kind")
    staged = scratch_path(spark, "staged")
    source.write.parquet(staged)
    for _ in range(2):  # the second call finds nothing new
        landing.land(landing.parquet_stream(spark, staged, 1), path)
    return spark.read.parquet(path).groupBy("kind").agg(F.count("*").alias("n"))


@query(
    "name_index",
    "WITH e AS (SELECT who AS id, arg_max((coalesce(name, ''), row_id), row_id) AS x FROM chat_events WHERE who IS NOT NULL GROUP BY 1) SELECT id, x[1] AS name, x[2] AS pos FROM e WHERE trim(x[1]) <> ''",
)
def name_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = table(spark, sf_dir, "chat_events").where("who is not null").select(F.col("who").alias("id"), F.col("row_id").alias("pos"), F.coalesce("name", F.lit("")).alias("name"), F.lit(False).alias("removed"))
    return landing.name_index(entries)


@query(
    "log_backfill",
    "SELECT row_id, kind FROM (SELECT row_id, kind FROM chat_events ORDER BY row_id DESC LIMIT 200) x",
)
def log_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landing.newest(table(spark, sf_dir, "chat_events").select("row_id", "kind"), 200, "row_id")


@query(
    "judged_requests",
    _W + f" SELECT id, CASE WHEN text IS NULL THEN NULL WHEN regexp_matches(text, '(?i)(^|[^\\p{{L}}\\p{{N}}_])(why|what|warum|por qué)|为什么') THEN 'qa' WHEN regexp_matches(text, '{_ASKS}') THEN 'exec' ELSE 'unknown' END AS verdict FROM m WHERE {SQL_USER}",
)
def judged_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User messages in any language, judged by keywords; each distinct text once.

    Chinese has no word boundaries, so its keyword counts anywhere.
    """
    judge = providers.KeywordJudge([(r"(?i)\b(why|what|warum|por qué)|为什么", "qa"), (_ASKS, "exec")])
    rows = messages(spark, sf_dir).where(T.is_user(F.col("role")))
    return providers.judged(rows.select("id", "text"), "text", judge, ("qa", "exec")).select("id", "verdict")


@query("reply_similarity")
def reply_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cosine of each reply and what it replies to, by hashed words."""
    m = messages(spark, sf_dir)
    vectors = providers.embedded(m.select("id", "parent", "text"), "text", providers.HashEmbedder())
    up = vectors.select(F.col("id").alias("p"), F.col("embedding").alias("up"))
    j = vectors.join(up, F.col("parent") == F.col("p")).where("embedding is not null and up is not null")
    return j.select("id", F.round(providers.cosine(F.col("embedding"), F.col("up")), 4).alias("similarity"))


@query(
    "atomic_segments",
    _W + """, e0 AS (SELECT *, coalesce(task_id, '-') AS tp FROM t), e1 AS (SELECT *, lag(ts_us) OVER w AS p, lead(tp) OVER w AS nx, row_number() OVER w AS n FROM e0 WINDOW w AS (PARTITION BY thread ORDER BY ts_us, row_id)),
    e2 AS (SELECT *, last_value(CASE WHEN nx = tp OR n = 1 THEN tp END IGNORE NULLS) OVER (PARTITION BY thread ORDER BY ts_us, row_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS settled FROM e1),
    e3 AS (SELECT *, lag(settled) OVER (PARTITION BY thread ORDER BY ts_us, row_id) AS ps FROM e2)
    SELECT id, settled, CAST(sum(CASE WHEN coalesce(ts_us - p >= 1800000000, false) OR coalesce(settled <> ps, false) THEN 1 ELSE 0 END) OVER (PARTITION BY thread ORDER BY ts_us, row_id) AS BIGINT) AS segment FROM e3""",
)
def atomic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = threaded(spark, sf_dir, "task_id").withColumn("topic", F.coalesce("task_id", F.lit("-")))
    cut = segments.atomic_segments(rows, ["thread"], ["ts_us", "row_id"], F.col("ts_us") / F.lit(1_000_000), "topic")
    return cut.select("id", "settled", "segment")


@query(
    "troubleshooting_feedback",
    _W + _POS + f""", w AS (SELECT id, role, text, max(CASE WHEN {SQL_BOT} AND regexp_matches(text, '(?i)could you|please') THEN pos END) OVER (PARTITION BY thread ORDER BY pos ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS f FROM n)
    SELECT id, coalesce({SQL_USER} AND regexp_matches(text, '(?i)exit|ran|checked'), false) AND f IS NOT NULL AS is_feedback FROM w""",
)
def troubleshooting_feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    asked = T.is_bot(F.col("role")) & F.coalesce(F.col("text").rlike("(?i)could you|please"), F.lit(False))
    feedback = T.is_user(F.col("role")) & F.col("text").rlike("(?i)exit|ran|checked")
    return guards.troubleshooting(_placed(spark, sf_dir), ["thread"], feedback, asked).select("id", "is_feedback")


@query(
    "pick_validation",
    _W + rf""", n AS (SELECT *, row_id AS pos FROM m), pk AS (SELECT CASE WHEN c.row_id % 19 = 0 THEN 'gone' ELSE b.parent END AS t0, b.id AS b, c.id AS c, substr(b.text, 1, CASE WHEN c.row_id % 6 = 0 THEN 2 ELSE 12 END) AS quote, CASE WHEN c.row_id % 9 = 0 THEN 'REJECT' ELSE 'ACCEPT' END AS verdict FROM m c JOIN m b ON c.parent = b.id),
    ms AS (SELECT *, {SQL_BOT} AS is_bot, {SQL_USER} AS is_user FROM n),
    v AS (SELECT pk.*, x.id AS xi, x.is_user AS xu, x.pos AS xp, y.is_bot AS yb, y.pos AS yp, y.text AS yt, z.is_user AS zu, z.pos AS zp, regexp_replace(quote, '[\s\x0B\x{{85}}\p{{Z}}]+', '', 'g') AS q FROM pk LEFT JOIN ms x ON x.id = pk.t0 LEFT JOIN ms y ON y.id = pk.b LEFT JOIN ms z ON z.id = pk.c)
    SELECT b, c, CASE WHEN verdict <> 'ACCEPT' THEN 'not_accepted' WHEN xi IS NULL THEN 'missing(t0)' WHEN NOT xu THEN 't0_not_user' WHEN NOT yb THEN 'b_not_bot' WHEN NOT zu THEN 'c_not_user' WHEN NOT (xp < yp AND yp < zp) THEN 'order'
      WHEN q IS NULL OR length(q) < 4 THEN 'quote_short' WHEN NOT coalesce(contains(regexp_replace(yt, '[\s\x0B\x{{85}}\p{{Z}}]+', '', 'g'), q), false) THEN 'quote_absent' END AS drop_reason FROM v""",
)
def pick_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = messages(spark, sf_dir)
    r = F.col("row_id")
    c = m.select(F.col("id").alias("c"), F.col("parent").alias("up"), "row_id")
    b = m.select(F.col("id").alias("b"), F.col("parent").alias("b_up"), F.col("text").alias("b_text"))
    quote = F.when(r % 6 == 0, F.substring("b_text", 1, 2)).otherwise(F.substring("b_text", 1, 12))
    picks = c.join(b, F.col("up") == F.col("b")).select(
        F.when(r % 19 == 0, "gone").otherwise(F.col("b_up")).alias("t0"), "b", "c", quote.alias("quote"), F.when(r % 9 == 0, "REJECT").otherwise("ACCEPT").alias("verdict")
    )
    return guards.validate_picks(picks, m.select("id", "role", "text", F.col("row_id").alias("pos"))).select("b", "c", "drop_reason")


@query(
    "majority_labels",
    "WITH c AS (SELECT thread_id, kind, count(*) AS n, min(row_id) AS first FROM chat_events WHERE kind IS NOT NULL GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY thread_id ORDER BY n DESC, first) AS k FROM c) SELECT thread_id, kind, n FROM r WHERE k = 1",
)
def majority_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.majority_labels(table(spark, sf_dir, "chat_events"), ["thread_id"], "kind", "row_id")


@query(
    "chat_steps",
    _W + f" SELECT thread, id, row_number() OVER (PARTITION BY thread ORDER BY ts_us, row_id) - 1 AS step, CASE WHEN {SQL_USER} THEN 0 ELSE 1 END AS loss FROM t",
)
def chat_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trajectories.chat_steps(threaded(spark, sf_dir, "role"), ["thread"], ["ts_us", "row_id"])


@query(
    "assistant_texts",
    """WITH s AS (SELECT trace_id, unnest(steps) AS s, generate_subscripts(steps, 1) - 1 AS pos FROM trajectory), o AS (SELECT trace_id, pos, s.output_messages AS o FROM s WHERE s.output_messages IS NOT NULL),
    j AS (SELECT *, CASE WHEN json_valid(o) THEN CAST(o AS JSON) END AS j FROM o),
    t AS (SELECT trace_id, pos, list_transform(list_filter(CAST(j AS JSON[]), lambda m: (m ->> '$.role') = 'assistant' AND json_type(m, '$.content') NOT IN ('NULL')), lambda m: CASE WHEN json_type(m, '$.content') = 'ARRAY'
      THEN coalesce(array_to_string(list_transform(CAST(m -> '$.content' AS JSON[]), lambda p: p ->> '$.text'), ''), '') ELSE m ->> '$.content' END) AS x FROM j WHERE json_type(j) = 'ARRAY')
    SELECT j.trace_id, j.pos, CASE WHEN j IS NULL THEN o WHEN json_type(j) = 'ARRAY' THEN coalesce(array_to_string(x, chr(10)), '') END AS said FROM j LEFT JOIN t ON t.trace_id = j.trace_id AND t.pos = j.pos""",
)
def assistant_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    steps = trajectories.step_rows(table(spark, sf_dir, "trajectory")).where("output_messages is not null")
    return steps.select("trace_id", "pos", trajectories.assistant_text(F.col("output_messages")).alias("said"))
