"""Queries over the pipelines of corrections, with deterministic models in place of hosted ones."""

from __future__ import annotations

import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions import text as T
from threadloom.operators import anchors, folds, guards, ordered, packs, providers, replies, segments
from threadloom.operators.providers import TASKS, RuleModel, asked
from threadloom.plans.core import query
from threadloom.plans.records import _TRIPLES, triples
from threadloom.plans.views import SQL_BOT, SQL_MESSAGES, SQL_USER, messages, threaded
from threadloom.session import materialise, table
from threadloom.sources import sessions as S

_W = "WITH RECURSIVE " + SQL_MESSAGES
_SPACE = r"[\s\x0B\x{85}\p{Z}]+"
_N = ", n AS (SELECT *, row_number() OVER (PARTITION BY thread ORDER BY ts_us, row_id) AS pos FROM t)"
_UP = ", up(id, root, orphan) AS (SELECT id, id, parent IS NOT NULL FROM m WHERE parent IS NULL OR parent NOT IN (SELECT id FROM m) UNION ALL SELECT m.id, up.root, up.orphan FROM m JOIN up ON m.parent = up.id)"
_CHAIN = ", ch(id, ancestor, distance) AS (SELECT x.id, p.id, 1 FROM m x JOIN m p ON x.parent = p.id UNION ALL SELECT ch.id, p.id, distance + 1 FROM ch JOIN m x ON ch.ancestor = x.id JOIN m p ON x.parent = p.id WHERE distance < 16)"
_STRONG = guards.OVERRIDE


def _placed(m: DataFrame) -> DataFrame:
    rows = m.where("ts_us is not null").withColumn("thread", F.coalesce("thread_id", "group_id"))
    return ordered.numbered(rows.select("id", "parent", "thread", "ts_us", "row_id", "role", "name", "text"), ["thread"], ["ts_us", "row_id"])


@query(
    "quote_anchors",
    _W + _TRIPLES + rf""", q AS (SELECT tr.corrector, tr.anchor, tr.quote, c.thread, c.ts_us AS c_us, regexp_replace(tr.quote, '{_SPACE}', '', 'g') AS q FROM tr JOIN t c ON c.id = tr.corrector),
    b AS (SELECT id, thread, ts_us, regexp_replace(text, '{_SPACE}', '', 'g') AS flat FROM t WHERE {SQL_BOT}),
    h AS (SELECT q.corrector, q.anchor, arg_max(b.id, (b.ts_us < q.c_us, b.ts_us, b.id)) AS pick FROM q JOIN b ON b.thread = q.thread AND length(q.q) >= 4 AND contains(b.flat, q.q) GROUP BY 1, 2)
    SELECT q.corrector, coalesce(h.pick, q.anchor) AS anchor, coalesce(h.pick <> q.anchor, false) AS moved FROM q LEFT JOIN h ON h.corrector = q.corrector AND h.anchor = q.anchor""",
)
def quote_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = messages(spark, sf_dir, "parent", "row_id", "role", "text", "ts_us", "thread_id", "group_id")
    m = materialise(m.select("id", "parent", "row_id", "role", "text", "ts_us", F.coalesce("thread_id", "group_id").alias("thread")), "messages")
    rows = m.where("ts_us is not null")
    candidates = triples(m).join(rows.select(F.col("id").alias("corrector"), "thread"), "corrector").select("anchor", "corrector", "thread", "quote")
    return packs.reanchored_by_quote(candidates, rows, T.is_bot(F.col("role"))).select("corrector", "anchor", "moved")


_BARE = r"regexp_replace(lower({0}), '[\s\x0B\x{{85}}\p{{Z}}\p{{P}}]+', '', 'g')"


@query(
    "t0_lookup",
    _W + _TRIPLES + f""", q AS (SELECT tr.corrector AS key, CASE WHEN tr.row_id % 4 <> 0 THEN tr.t0 END AS t0, substr(p.text, 1, 40) AS text FROM tr LEFT JOIN m p ON p.id = tr.t0), u AS (SELECT id, {_BARE.format('text')} AS e FROM m WHERE {SQL_USER} AND text IS NOT NULL),
    r AS (SELECT q.key, q.text, i.id AS by_id, {_BARE.format('q.text')} AS k FROM q LEFT JOIN (SELECT id FROM m WHERE {SQL_USER}) i ON i.id = q.t0), d AS (SELECT DISTINCT k FROM r WHERE by_id IS NULL AND k IS NOT NULL),
    h AS (SELECT k, count(*) AS n, min(id) AS one FROM d JOIN u ON (length(k) >= 4 AND contains(e, k)) OR (length(e) >= 4 AND contains(k, e)) GROUP BY 1)
    SELECT r.key, coalesce(by_id, CASE WHEN n = 1 THEN one END) AS found, CASE WHEN by_id IS NOT NULL THEN 'id' WHEN n = 1 THEN 'text' WHEN n > 1 THEN 'ambiguous' ELSE 'missing' END AS how FROM r LEFT JOIN h ON h.k = r.k""",
)
def t0_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instructions of corrections, a quarter of them known by their text only."""
    m = materialise(messages(spark, sf_dir, "parent", "row_id", "role", "text"), "messages")
    text = m.select(F.col("id").alias("p"), F.substring("text", 1, 40).alias("text"))
    t = triples(m).join(text, F.col("t0") == F.col("p"), "left").select(F.col("corrector").alias("key"), F.when(F.col("row_id") % 4 != 0, F.col("t0")).alias("t0"), "text")
    return packs.t0_lookup(t, m.where(T.is_user(F.col("role"))).select("id", "text")).select("key", "found", "how")


class _LineDetector:
    """Answers a detection prompt: each line (id, parent, text) that corrects what it replies to."""

    def complete(self, prompt: str) -> str:
        out = []
        for line in prompt.split("\n"):
            parts = line.split("\t")
            if len(parts) == 3 and parts[1] and re.search(_STRONG, parts[2]):
                out.append(json.dumps({"anchor": parts[1], "corrector": parts[0], "quote": ""}))
        return "\n".join(out)


@query(
    "detected_corrections",
    _W + _N + rf""", l AS (SELECT thread, pos, id, coalesce(parent, '') AS parent, coalesce(regexp_replace(text, '{_SPACE}', ' ', 'g'), '') AS flat FROM n),
    k AS (SELECT thread FROM l GROUP BY 1 HAVING sum(length(id || chr(9) || parent || chr(9) || flat)) + count(*) - 1 >= 40)
    SELECT parent AS anchor, arg_min(id, (thread, pos)) AS corrector FROM l WHERE parent <> '' AND regexp_matches(flat, '{_STRONG}') AND thread IN (SELECT thread FROM k) GROUP BY 1""",
)
def detected_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threads cut into windows, each window asked about, what is found in two windows counted once."""
    flat = F.coalesce(F.regexp_replace("text", r"(?U)\s+", " "), F.lit(""))
    rows = threaded(spark, sf_dir, "parent", "text")
    rows = ordered.numbered(rows.select("thread", "ts_us", "row_id", F.concat_ws("\t", "id", F.coalesce("parent", F.lit("")), flat).alias("line")), ["thread"], ["ts_us", "row_id"]).withColumn("pos", F.col("pos") - 1)
    rows = materialise(rows.withColumn("n_chars", F.length("line")), "lines")
    windows = folds.char_windows(rows.select("thread", "ts_us", "row_id", "n_chars"), "thread", ["ts_us", "row_id"], "n_chars")
    texts = windows.join(rows.select("thread", "pos", "line"), ["thread", "pos"]).groupBy("thread", "window").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "line"))), lambda r: r["line"]), "\n").alias("text"))
    return packs.first_by_anchor(packs.detected(texts, _LineDetector()), ["thread", "window", "k"]).select("anchor", "corrector")


@query(
    "verified_corrections",
    _W + f""" SELECT c.id AS corrector, CASE WHEN regexp_matches(coalesce(b.text, '') || chr(10) || coalesce(c.text, ''), '{_STRONG}') THEN 'YES' ELSE 'NO' END AS verdict, CAST(NULL AS VARCHAR) AS error FROM m c JOIN m b ON c.parent = b.id""",
)
def verified_corrections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a reply corrects what it replies to; a call that fails would keep its row, with the error."""
    m = messages(spark, sf_dir, "parent", "text")
    b = m.select(F.col("id").alias("b"), F.col("text").alias("said"))
    pairs = m.join(b, F.col("parent") == F.col("b")).select(F.col("id").alias("corrector"), F.concat_ws("\n", F.coalesce("said", F.lit("")), F.coalesce("text", F.lit(""))).alias("both"))
    model = RuleModel([(_STRONG.replace("(?i)", r"(?is)\n.*"), "YES")], "NO")
    return asked(pairs, "both", TASKS["verify"], model).select("corrector", F.col("answer").alias("verdict"), F.col("answer_error").alias("error"))


@query(
    "outcome_verdicts",
    _W + """, x AS (SELECT task_id, arg_max(text, (ts_us, row_id)) FILTER (WHERE text IS NOT NULL) AS tail FROM m WHERE task_id IS NOT NULL AND ts_us IS NOT NULL GROUP BY 1)
    SELECT task_id, CASE WHEN tail IS NULL THEN NULL WHEN regexp_matches(tail, '(?i)(fail|broke|lost|error)') THEN 'failure' WHEN regexp_matches(tail, '(?i)(done|merged|works|thanks)') THEN 'success' ELSE 'unknown' END AS verdict FROM x""",
)
def outcome_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How each task ended, from its last text; an answer that cannot be read is unknown."""
    m = messages(spark, sf_dir, "task_id", "text", "ts_us", "row_id").where("task_id is not null and ts_us is not null")
    tails = m.groupBy("task_id").agg(F.max_by("text", F.when(F.col("text").isNotNull(), F.struct("ts_us", "row_id"))).alias("tail"))
    model = RuleModel([(r"(?is)\n.*(?:fail|broke|lost|error)", '```json\n{"verdict": "failure"}\n```'), (r"(?is)\n.*(?:done|merged|works|thanks)", "success")], '{"verdict": "Unknown"}')
    return asked(tails, "tail", TASKS["outcome"], model).select("task_id", F.col("answer").alias("verdict"))


_NUMBER = r"\d+(?:[.\-/→>~]\d+)*|[零一二三四五六七八九十百千万亿]+"


@query(
    "distilled_rules",
    _W + f""" SELECT id, CASE WHEN text IS NULL THEN NULL WHEN regexp_matches(text, '{_NUMBER}') OR regexp_full_match(text, '[\\s\\x0B\\x1C-\\x1F\\x{{85}}\\p{{Z}}]*') THEN 'Check the value first.' ELSE regexp_replace(text, '^[\\s\\x0B\\x1C-\\x1F\\x{{85}}\\p{{Z}}]+|[\\s\\x0B\\x1C-\\x1F\\x{{85}}\\p{{Z}}]+$', '', 'g') END AS rule,
      CASE WHEN text IS NULL THEN NULL WHEN regexp_matches(text, '{_NUMBER}') OR regexp_full_match(text, '[\\s\\x0B\\x1C-\\x1F\\x{{85}}\\p{{Z}}]*') THEN 2 ELSE 1 END AS calls FROM m WHERE {SQL_USER}""",
)
def distilled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule from each user's text; one that repeats its numbers is refused and asked for again."""
    m = messages(spark, sf_dir, "role", "text").where(T.is_user(F.col("role")))
    model = RuleModel([("Not accepted", "Check the value first."), (r"(?s)\n(.*)", r"\1")])
    out = asked(m.withColumn("source", F.col("text")), "text", TASKS["distil"], model, "source", providers.repeats_numbers)
    return out.select("id", F.col("answer").alias("rule"), F.col("answer_calls").alias("calls"))


@query(
    "replayable_requests",
    _W + f""", v AS (SELECT id, CASE WHEN regexp_matches(text, '(?i)(please|could you|bitte|por favor|麻烦)') THEN 'exec' WHEN regexp_matches(text, '[?？]') THEN 'qa' ELSE 'unknown' END AS verdict, CASE WHEN regexp_matches(text, '\\.(py|rs|toml)') THEN 'code' WHEN regexp_matches(text, '(?i)thread|session') THEN 'chat' ELSE 'none' END AS target FROM m WHERE {SQL_USER} AND text IS NOT NULL)
    SELECT * FROM v WHERE verdict IN ('exec', 'qa') AND target IN ('code', 'chat')""",
)
def replayable_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests by type and by what must be read for them; those that can be replayed."""
    m = messages(spark, sf_dir, "role", "text").where(T.is_user(F.col("role")) & F.col("text").isNotNull())
    kinds = RuleModel([(r"(?is)\n.*(?:please|could you|bitte|por favor|麻烦)", '{"request_type": "exec"}'), (r"(?s)\n.*[?？]", '{"request_type": "qa"}')], "unknown")
    targets = RuleModel([(r"(?s)\n.*\.(?:py|rs|toml)", "code"), (r"(?is)\n.*(?:thread|session)", "chat")], "none")
    rows = asked(asked(m, "text", TASKS["request"], kinds, name="verdict"), "text", TASKS["target"], targets, name="target")
    return guards.of_classes(rows, "verdict", ("exec", "qa"), "target", ("code", "chat")).select("id", "verdict", "target")


@query("instruction_picks", _W + _CHAIN + " SELECT id, arg_max(ancestor, distance) AS picked, CAST(count(*) AS INT) AS n_candidates FROM ch WHERE distance <= 3 GROUP BY 1")
def instruction_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The instruction behind each reply, picked by number among what it replies to; other numbers are none."""
    m = messages(spark, sf_dir)
    said = m.select(F.col("id").alias("a"), T.one_line(F.coalesce("text", F.lit("")), 200).alias("line"))
    some = replies.chains(m, 3).join(said, F.col("ancestor") == F.col("a")).groupBy("id").agg(F.array_sort(F.collect_list(F.struct("distance", "ancestor", "line"))).alias("x"))
    numbered = some.select("id", "x", F.array_join(F.transform("x", lambda r, i: F.concat((i + 1).cast("string"), F.lit(". "), r["line"])), "\n").alias("shown"))
    picked = asked(numbered, "shown", TASKS["pick"], RuleModel([(r"(?s).*\n(\d+)\. ", r"\1")]))
    return picked.select("id", F.try_element_at("x", F.col("answer").cast("int"))["ancestor"].alias("picked"), F.size("x").alias("n_candidates"))


@query(
    "replay_verdicts",
    _W + _TRIPLES + f""" SELECT tr.corrector, CASE WHEN a.text IS NULL THEN NULL ELSE regexp_replace('Please: ' || a.text, '[\\s\\x0B\\x1C-\\x1F\\x{{85}}\\p{{Z}}]+$', '') END AS rewritten, CASE WHEN c.text IS NULL THEN NULL WHEN regexp_matches(c.text, '{_STRONG}') THEN 'YES' ELSE 'NO' END AS failed,
      CASE WHEN b.text IS NULL THEN NULL WHEN regexp_matches(b.text, '(?i)(done|merged)') THEN 'confirmed' ELSE 'unclear' END AS truth, CASE WHEN c.text IS NULL THEN NULL WHEN c.task_id IS NOT NULL AND c.task_id IS DISTINCT FROM b.task_id THEN 'new' ELSE 'same' END AS boundary
    FROM tr JOIN m c ON c.id = tr.corrector JOIN m b ON b.id = tr.anchor LEFT JOIN m a ON a.id = tr.t0""",
)
def replay_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The request behind a correction written anew, and judges of the answer, of the outcome and of the boundary."""
    m = materialise(messages(spark, sf_dir), "messages")
    side = lambda p: m.select(F.col("id").alias(f"{p}_id"), F.col("text").alias(f"{p}_text"), F.col("task_id").alias(f"{p}_task"))
    t = triples(m).join(side("c"), F.col("corrector") == F.col("c_id")).join(side("b"), F.col("anchor") == F.col("b_id")).join(side("a"), F.col("t0") == F.col("a_id"), "left")
    moved = F.col("c_task").isNotNull() & ~F.col("c_task").eqNullSafe(F.col("b_task"))
    t = t.select("corrector", "a_text", "b_text", "c_text", F.when(F.col("c_text").isNotNull(), F.when(moved, F.lit("task changes")).otherwise(F.lit("task stays"))).alias("mark"))
    t = asked(t, "a_text", TASKS["rewrite"], RuleModel([(r"(?s)\n(.*)", r"Please: \1")]), name="rewritten")
    t = asked(t, "c_text", TASKS["behaviour"], RuleModel([(_STRONG.replace("(?i)", r"(?is)\n.*"), '{"failed": "yes"}')], "NO"), name="failed")
    t = asked(t, "b_text", TASKS["truth"], RuleModel([(r"(?is)\n.*(?:done|merged)", "confirmed")], "no idea"), name="truth")
    t = asked(t, "mark", TASKS["boundary"], RuleModel([("task changes", "new")], "same"), name="boundary")
    return t.select("corrector", "rewritten", "failed", "truth", "boundary")


_SQL_NOTES = "CASE WHEN c.row_id % 2 = 0 THEN c.text ELSE 'Check it first.' END"


def _notes(m: DataFrame) -> DataFrame:
    """Comments for replays: every other one is the correction itself, which may leak."""
    return m.select(F.col("id").alias("corrector"), F.when(F.col("row_id") % 2 == 0, F.col("text")).otherwise("Check it first.").alias("comment"))


_SNAPSHOT = (
    _N + _TRIPLES
    + rf""", s AS (SELECT tr.corrector, tr.t0, p.id AS pid, p.thread, p.pos, p.text AS original, p.ts_us AS t0_us, {_SQL_NOTES} AS comment,
      coalesce(len(list_filter(list_distinct(regexp_extract_all(coalesce(pc.text, ''), '{_NUMBER}')), lambda x: contains(coalesce({_SQL_NOTES}, ''), x))) > 0, false) AS leaks
      FROM tr JOIN m c ON c.id = tr.corrector LEFT JOIN n pc ON pc.id = tr.corrector LEFT JOIN n p ON p.id = tr.t0)"""
)


@query(
    "snapshot_pack",
    _W + _SNAPSHOT + """ SELECT corrector, t0, CASE WHEN pid IS NULL THEN 'missing_t0' ELSE 'ok' END AS status, CASE WHEN pid IS NOT NULL THEN CASE WHEN thread IS NULL THEN 0 ELSE least(pos - 1, 80) END END AS n_context,
      CASE WHEN pid IS NOT NULL AND thread IS NOT NULL AND pos > 1 THEN pos - least(pos - 1, 80) END AS first_pos, original AS original_instruction, CASE WHEN NOT leaks THEN comment END AS comment_for_replay, leaks AS comment_withheld FROM s""",
)
def snapshot_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = materialise(messages(spark, sf_dir), "messages")
    return packs.snapshot_pack(triples(m).select("anchor", "corrector", "t0"), _placed(m), _notes(m))


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = materialise(messages(spark, sf_dir), "messages")
    rows = materialise(_placed(m), "placed")
    t = triples(m).select("anchor", "corrector", "t0")
    roots = replies.roots(m).select(F.col("id").alias("r"), "root", (F.col("kind") == "root").alias("complete"))
    chosen = anchors.chosen_context(rows.join(roots, F.col("id") == F.col("r"), "left").drop("r"), ["thread"])
    return packs.replay_manifest(packs.snapshot_pack(t, rows, _notes(m)), chosen, t.select(F.col("corrector").alias("id")))


_MANIFEST = (
    _UP + _SNAPSHOT
    + """, r AS (SELECT n.id, n.parent, n.pos, n.ts_us, up.root, NOT up.orphan AS complete FROM n LEFT JOIN up ON up.id = n.id),
    e AS (SELECT *, (CASE WHEN root IS NULL THEN 0 ELSE coalesce(count(*) OVER (PARTITION BY root ORDER BY ts_us RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) END) AS earlier FROM r),
    q AS (SELECT id, CASE WHEN parent IS NOT NULL AND earlier > 0 AND complete THEN 'exact_thread' WHEN parent IS NOT NULL AND earlier > 0 THEN 'recovered_by_parent' WHEN pos > 1 THEN 'same_session_window' ELSE 'missing_or_ambiguous' END AS quality,
      CAST(least(CASE WHEN parent IS NOT NULL AND earlier > 0 THEN earlier ELSE pos - 1 END, 80) AS BIGINT) AS n_context FROM e),
    g AS (SELECT t0, count(*) AS n_corrections, min(original) AS text FROM s WHERE pid IS NOT NULL GROUP BY 1),
    mf AS (SELECT g.t0, n_corrections, CASE WHEN g.t0 IN (SELECT corrector FROM tr) THEN 'missing_or_ambiguous' ELSE coalesce(quality, 'missing_or_ambiguous') END AS quality, coalesce(n_context, 0) AS n_context, substr(text, 1, 40) AS head, CAST(length(text) AS INT) AS n_chars FROM g LEFT JOIN q ON q.id = g.t0)"""
)


@query("replay_manifest", _W + _MANIFEST + " SELECT * FROM mf")
def replay_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _manifest(spark, sf_dir)


@query("manifest_summary", _W + _MANIFEST + " SELECT quality, count(*) AS n FROM mf GROUP BY 1")
def manifest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packs.manifest_summary(_manifest(spark, sf_dir))


@query(
    "segment_events",
    _W + f""", b AS (SELECT *, lag(ts_us) OVER (PARTITION BY thread ORDER BY ts_us, row_id) AS p FROM t),
    s AS (SELECT *, CAST(sum(CASE WHEN ts_us - p >= 1800000000 THEN 1 ELSE 0 END) OVER (PARTITION BY thread ORDER BY ts_us, row_id) AS BIGINT) AS segment FROM b),
    g AS (SELECT thread, segment, count(*) AS n_rows, min(ts_us) AS first_us, max(ts_us) AS last_us, substr(trim(regexp_replace(arg_min(text, (ts_us, row_id)) FILTER (WHERE text IS NOT NULL), '{_SPACE}', ' ', 'g'), ' '), 1, 30) AS title FROM s GROUP BY 1, 2)
    SELECT *, CASE WHEN title IS NULL THEN NULL WHEN regexp_matches(title, '(?i)(please|could you|bitte|por favor|麻烦)') THEN 'exec' WHEN regexp_matches(title, '[?？]') THEN 'qa' ELSE 'unknown' END AS verdict FROM g""",
)
def segment_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments with their members' span, a title from the first text, and a judge of it."""
    rows = segments.gap_segments(threaded(spark, sf_dir, "text"), ["thread"], ["ts_us", "row_id"], F.col("ts_us") / F.lit(1_000_000))
    first = F.min(F.when(F.col("text").isNotNull(), F.struct("ts_us", "row_id", "text")))["text"]
    g = rows.groupBy("thread", "segment").agg(F.count("*").alias("n_rows"), F.min("ts_us").alias("first_us"), F.max("ts_us").alias("last_us"), first.alias("text"))
    g = g.withColumn("title", T.title(F.col("text"))).drop("text")
    model = RuleModel([(r"(?is)\n.*(?:please|could you|bitte|por favor|麻烦)", '{"request_type": "exec"}'), (r"(?s)\n.*[?？]", '{"request_type": "qa"}')], "unknown")
    return asked(g, "title", TASKS["request"], model, name="verdict").drop("verdict_error", "verdict_calls")


@query(
    "reply_gold",
    _W + """, e AS (SELECT c.id AS a, p.id AS b FROM m c JOIN m p ON c.parent = p.id WHERE c.id <> p.id UNION SELECT p.id, c.id FROM m c JOIN m p ON c.parent = p.id WHERE c.id <> p.id),
      r(id, reach) AS (SELECT DISTINCT a, a FROM e UNION SELECT r.id, e.b FROM r JOIN e ON r.reach = e.a), k AS (SELECT id, min(reach) AS component FROM r GROUP BY id)
      SELECT c.id AS child, p.id AS parent, component, 1 AS label FROM m c JOIN m p ON c.parent = p.id JOIN k ON k.id = c.id""",
)
def reply_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packs.reply_gold(messages(spark, sf_dir, "parent"))


@query(
    "review_cards",
    _W + _N + _CHAIN + rf""", a AS (SELECT thread, pos AS spot, id AS anchor FROM n WHERE {SQL_USER}),
      w AS (SELECT anchor, n.pos - spot AS off, (CASE WHEN n.pos = spot THEN '> ' ELSE '  ' END) || '[' || coalesce(role, '') || '/' || coalesce(name, '') || '] ' AS lead, trim(regexp_replace(translate(coalesce(text, ''), '#*`|', ''), '{_SPACE}', ' ', 'g'), ' ') AS flat FROM a JOIN n ON a.thread = n.thread AND n.pos BETWEEN spot - 3 AND spot + 2),
      c AS (SELECT anchor, string_agg(lead || CASE WHEN length(flat) > 60 THEN substr(flat, 1, 60) || ' [+' || (length(flat) - 60) || ']' ELSE flat END, chr(10) ORDER BY off) AS card FROM w GROUP BY 1), d AS (SELECT id, count(*) AS k FROM ch GROUP BY 1)
      SELECT anchor, CAST(coalesce(k, 0) AS INT) AS n_chain, card FROM c LEFT JOIN d ON d.id = anchor""",
)
def review_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = materialise(messages(spark, sf_dir), "messages")
    rows = _placed(m)
    found = rows.where(T.is_user(F.col("role"))).select("thread", F.col("pos").alias("at"), F.col("id").alias("anchor"))
    return packs.cards(rows, found, m)


@query(
    "evaluation_cases",
    _W + _CHAIN + f""", v AS (SELECT id, text, role FROM m WHERE {SQL_USER} AND regexp_matches(text, '(?i)(please|could you|bitte|por favor|麻烦)')), x AS (SELECT id, id AS ancestor, 0 AS distance FROM v UNION ALL SELECT ch.id, ancestor, distance FROM ch JOIN v ON v.id = ch.id WHERE distance <= 5),
      g AS (SELECT x.id, string_agg(coalesce(m.role, '') || ': ' || coalesce(m.text, ''), chr(10) ORDER BY -distance) AS messages, CAST(count(*) AS INT) AS n_messages FROM x JOIN m ON m.id = ancestor GROUP BY 1),
      s AS (SELECT id, regexp_replace(regexp_replace(text, '[^0-9A-Za-z一-鿿]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM v)
      SELECT 'case_' || substr(sha1(g.id), 1, 10) AS case_id, CASE WHEN slug = '' THEN 'untitled' ELSE substr(slug, 1, 30) END AS slug, messages, n_messages, 'request=' || g.id || ';class=exec' AS fixture FROM g JOIN s ON s.id = g.id""",
)
def evaluation_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = materialise(messages(spark, sf_dir), "messages")
    model = RuleModel([(r"(?is)\n.*(?:please|could you|bitte|por favor|麻烦)", '{"request_type": "exec"}')], "unknown")
    judged = asked(m.where(T.is_user(F.col("role"))).select("id", "text"), "text", TASKS["request"], model, name="verdict")
    return packs.cases(judged, m, ("exec",))


_SECRET, _TOKEN = r"amber-([a-z]{3,})", r"[A-Za-z]+"
_SCRUB = """, sec AS (SELECT DISTINCT unnest(regexp_extract_all(x, 'amber-([a-z]{3,})', 1)) AS s FROM tx WHERE x IS NOT NULL),
    tk AS (SELECT key, col, list_distinct(regexp_extract_all(x, '[A-Za-z]+')) AS k FROM tx WHERE x IS NOT NULL), hit AS (SELECT key, col, s FROM (SELECT key, col, unnest(k) AS t FROM tk) y JOIN sec ON s = t),
    kn AS (SELECT key, col, list_transform(list_sort(list({'n': -length(s), 's': s})), lambda v: v.s) AS known FROM hit GROUP BY 1, 2),
    dn AS (SELECT tx.key, tx.col, coalesce(len(known), 0) AS n, CASE WHEN known IS NULL THEN x ELSE list_reduce(known, lambda a, v: replace(a, v, '<SECRET_' || substr(sha1(v), 1, 8) || '>'), x) END AS y FROM tx LEFT JOIN kn ON kn.key = tx.key AND kn.col = tx.col)"""


@query(
    "scrubbed_events",
    "WITH tx AS (SELECT row_id AS key, 'text' AS col, text AS x FROM chat_events UNION ALL SELECT row_id, 'name', name FROM chat_events)" + _SCRUB + " SELECT key AS row_id, max(y) FILTER (WHERE col = 'text') AS text, max(y) FILTER (WHERE col = 'name') AS name, CAST(sum(n) AS BIGINT) AS n_hits FROM dn GROUP BY 1",
)
def scrubbed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packs.scrubbed(table(spark, sf_dir, "chat_events"), "row_id", ["text", "name"], _SECRET, _TOKEN)


@query(
    "anonymised_events",
    """SELECT row_id, CASE WHEN who IS NOT NULL THEN '<WHO_' || substr(sha1(who), 1, 8) || '>' END AS who, CASE WHEN trim(name, ' ') <> '' THEN '<NAME_' || substr(sha1(name), 1, 8) || '>' END AS name,
    CASE WHEN trim(name, ' ') <> '' THEN replace(text, name, '<NAME_' || substr(sha1(name), 1, 8) || '>') ELSE text END AS text FROM chat_events""",
)
def anonymised_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packs.anonymised(table(spark, sf_dir, "chat_events").select("row_id", "who", "name", "text"))


@query(
    "task_panel",
    _W + f""", c AS (SELECT group_id, coalesce(task_id, '-') AS cluster, max(ts_us) AS last_ts, count(*) FILTER (WHERE {SQL_USER}) AS n_user FROM t WHERE group_id IS NOT NULL GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY group_id ORDER BY last_ts DESC, cluster DESC) AS rn FROM c)
    SELECT group_id, CASE WHEN rn = 1 THEN 'active_tail' WHEN n_user > 1 THEN 'corrected' ELSE 'done' END AS status, count(*) AS n FROM r GROUP BY 1, 2 UNION ALL SELECT group_id, 'error', 0 FROM chat_groups WHERE group_id NOT IN (SELECT group_id FROM r)""",
)
def task_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = threaded(spark, sf_dir, "group_id", "task_id", "role").where("group_id is not null")
    c = rows.groupBy("group_id", F.coalesce("task_id", F.lit("-")).alias("cluster")).agg(F.max("ts_us").alias("last_ts"), F.count_if(T.is_user(F.col("role"))).alias("n_user"))
    tasks = segments.terminal_flags(c.withColumn("status", F.when(F.col("n_user") > 1, "corrected")), ["group_id"], F.lit(False))
    return packs.task_panel(tasks, table(spark, sf_dir, "chat_groups"))


@query(
    "split_verdicts",
    _W + """, a AS (SELECT group_id AS "window", CASE WHEN ascii(right(group_id, 1)) % 2 = 0 THEN 'merge' ELSE 'split' END AS kind, coalesce(task_id, '-') AS task, len(regexp_extract_all(coalesce(text, ''), 'ledger|snapshot')) - len(regexp_extract_all(coalesce(text, ''), 'thread|session')) AS more FROM m WHERE group_id IS NOT NULL),
    p AS (SELECT "window", kind, task, max(more > 0) AS has_a, max(more < 0) AS has_b FROM a GROUP BY ALL), g AS (SELECT "window", kind, count(*) AS n_tasks, max(has_a) AS a, max(has_b) AS b, max(has_a AND has_b) AS mixed FROM p GROUP BY ALL)
    SELECT "window", kind, n_tasks, CASE WHEN kind = 'merge' THEN n_tasks = 1 ELSE a AND b AND NOT mixed END AS ok FROM g""",
)
def split_verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = messages(spark, sf_dir).where("group_id is not null")
    kind = F.when(F.ascii(F.right(F.col("group_id"), F.lit(1))) % 2 == 0, "merge").otherwise("split")
    return packs.split_verdicts(m.select(F.col("group_id").alias("window"), kind.alias("kind"), F.coalesce("task_id", F.lit("-")).alias("task"), "text"), "ledger|snapshot", "thread|session")


@query(
    "memory_selection",
    """WITH it AS (SELECT concat_ws('/', coalesce(thread_id, ''), coalesce(turn_id, ''), coalesce(item_id, '')) AS key, thread_id, min(item_json) AS j FROM thread_items WHERE json_valid(item_json) AND json_type(item_json) = 'OBJECT' GROUP BY 1, 2),
    tx AS (SELECT key, thread_id, 'text' AS col, j ->> '$.text' AS x FROM it WHERE j ->> '$.type' IN ('agent_message', 'reasoning') AND j ->> '$.text' IS NOT NULL)""" + _SCRUB + """,
    v AS (SELECT tx.thread_id, y, regexp_matches(y, '(?i)(please|could you|bitte|por favor|麻烦)') AS e FROM dn JOIN tx ON tx.key = dn.key), p AS (SELECT thread_id, count(*) AS n_items, count(*) FILTER (WHERE e) AS n_exec, CAST(sum(length(y)) AS BIGINT) AS n_chars FROM v GROUP BY 1),
    c AS (SELECT thread_id FROM p WHERE n_exec > 0 ORDER BY n_exec DESC, n_chars DESC, thread_id LIMIT 20)
    SELECT *, thread_id IN (SELECT thread_id FROM c) AS chosen FROM p""",
)
def memory_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What threads hold for later, judged after secrets were replaced, and the best twenty."""
    items = table(spark, sf_dir, "thread_items")
    key = F.concat_ws("/", *(F.coalesce(F.col(c), F.lit("")) for c in ("thread_id", "turn_id", "item_id")))
    one = items.where(F.try_parse_json("item_json").isNotNull()).groupBy(key.alias("key"), "thread_id").agg(F.min("item_json").alias("j"))
    v = F.try_parse_json("j")
    rows = one.select("key", "thread_id", F.try_variant_get(v, "$.type", "string").alias("kind"), F.try_variant_get(v, "$.text", "string").alias("text"))
    model = RuleModel([(r"(?is)\n.*(?:please|could you|bitte|por favor|麻烦)", '{"request_type": "exec"}')], "unknown")
    return packs.memories(materialise(rows, "memories"), ("agent_message", "reasoning"), model, TASKS["request"], 20, _SECRET, _TOKEN)


@query(
    "gold_export",
    _W + _N + _TRIPLES + """, r AS (SELECT tr.row_id AS card, p.id AS t0, b.id AS b, c.id AS c FROM tr LEFT JOIN n p ON p.id = tr.t0 LEFT JOIN n b ON b.id = tr.anchor LEFT JOIN n c ON c.id = tr.corrector)
    SELECT CAST(card AS INT) AS card, CASE WHEN card % 5 = 0 THEN 'rejected' WHEN t0 IS NULL OR b IS NULL OR c IS NULL THEN 'incomplete' ELSE 'gold' END AS status FROM r""",
)
def gold_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Review sheets written from corrections, read back, and told by their notes whether they count."""
    m = messages(spark, sf_dir, "parent", "row_id", "role", "name", "text", "ts_us", "thread_id", "group_id")
    flat = F.concat(F.lit("#"), "id", F.lit(" "), T.one_line(F.coalesce("text", F.lit("")), 60))
    m = materialise(m.select("id", "parent", "row_id", "role", F.regexp_replace(F.coalesce("name", F.lit("")), r"\]", "").alias("name"), "ts_us", F.coalesce("thread_id", "group_id").alias("thread"), flat.alias("flat")), "messages")
    line = F.when(F.col("ts_us").isNotNull(), F.concat(F.lit("["), F.coalesce("role", F.lit("")), F.lit("/"), "name", F.lit("] "), "flat"))
    side = lambda p, *more: m.select(F.col("id").alias(f"{p}_id"), line.alias(f"{p}_line"), *more)
    t = side("c", F.col("parent").alias("up"), "row_id").join(side("b", F.col("parent").alias("t0")), F.col("up") == F.col("b_id")).join(side("t0"), F.col("t0") == F.col("t0_id"), "left")
    lines = F.concat_ws("\n", F.concat(F.lit("## Card "), F.col("row_id")), *(F.concat(F.lit(f"{label.upper()} "), F.col(f"{label}_line")) for label in ("t0", "b", "c")))
    sheet = materialise(packs.review_lines(t.select(F.col("row_id").alias("sheet"), lines.alias("text"))), "lines")
    notes = t.select(F.col("row_id").alias("card"), F.when(F.col("row_id") % 5 == 0, "no").otherwise("accept").alias("note"))
    verdicts = S.adjudications(notes, "card", "note").select(F.col("card").cast("int").alias("card"), "accepted")
    named = ordered.numbered(m.where("ts_us is not null").select("id", "thread", "ts_us", "row_id", "name", "flat"), ["thread"], ["ts_us", "row_id"]).select("id", "name", "flat", "pos")
    gold = packs.gold_rows(packs.resolved_lines(sheet, named), verdicts)
    return gold.select("card", F.when(F.col("status").startswith("missing"), "incomplete").otherwise(F.col("status")).alias("status"))


@query(
    "review_eligibility",
    _W + f""", k AS (SELECT CASE WHEN c.row_id % 13 = 0 THEN 'gone' ELSE c.parent END AS b, CASE WHEN c.row_id % 11 = 0 THEN 'gone' ELSE c.id END AS c, c.row_id FROM m c WHERE c.parent IS NOT NULL), x AS (SELECT id, CASE WHEN {SQL_BOT} THEN 'bot' WHEN {SQL_USER} THEN 'user' ELSE coalesce(role, 'unknown') END AS who FROM m),
    r AS (SELECT k.row_id, CASE WHEN c.id IS NULL THEN 'missing_C' WHEN c.who <> 'user' THEN 'C_is_' || c.who WHEN b.id IS NULL THEN 'missing_B' WHEN b.who <> 'bot' THEN 'B_is_' || b.who ELSE '' END AS reason FROM k LEFT JOIN x b ON b.id = k.b LEFT JOIN x c ON c.id = k.c)
    SELECT row_id, reason = '' AS eligible, reason FROM r""",
)
def review_eligibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = messages(spark, sf_dir, "parent", "role")
    c = m.where("parent is not null").select(F.when(F.col("row_id") % 13 == 0, "gone").otherwise(F.col("parent")).alias("b"), F.when(F.col("row_id") % 11 == 0, "gone").otherwise(F.col("id")).alias("c"), "row_id")
    return guards.eligible(c, m.select("id", "role")).select("row_id", "eligible", "reason")


@query(
    "instruction_predicates",
    _W + f""", p AS (SELECT id, role, coalesce(text, '') AS x, coalesce(regexp_matches(text, '{_STRONG}') OR regexp_matches(text, '(?i)^\\s*(why|how come|warum|por qué|为什么)'), false) AS is_trigger FROM m)
    SELECT id, is_trigger, {SQL_USER} AND NOT is_trigger AND NOT regexp_matches(x, '(?i)(looks good|in summary|thanks)') AND trim(x, ' ') <> '' AS is_original FROM p""",
)
def instruction_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = messages(spark, sf_dir, "role", "text")
    return m.select("id", guards.correction_trigger(F.col("text")).alias("is_trigger"), guards.original_instruction(F.col("role"), F.col("text")).alias("is_original"))


@query(
    "pick_reply_lines",
    _W + _UP + rf""", n AS (SELECT *, row_id AS pos FROM m), pk AS (SELECT x.t0, x.b, x.c, b.text AS bt, CASE WHEN x.c_row % 2 = 0 THEN 'user_trigger' ELSE 'other' END AS kind, x.c_row FROM (SELECT lag(id, 2) OVER (ORDER BY row_id) AS t0, lag(id, 1) OVER (ORDER BY row_id) AS b, id AS c, row_id AS c_row FROM m) x JOIN m b ON b.id = x.b WHERE x.t0 IS NOT NULL),
    ms AS (SELECT n.*, up.root, {SQL_BOT} AS is_bot, {SQL_USER} AS is_user FROM n LEFT JOIN up ON up.id = n.id)
    SELECT c, CASE WHEN NOT x.is_user THEN 't0_not_user' WHEN NOT y.is_bot THEN 'b_not_bot' WHEN NOT z.is_user THEN 'c_not_user' WHEN NOT (x.pos < y.pos AND y.pos < z.pos) THEN 'order' WHEN bt IS NULL OR length(regexp_replace(bt, '{_SPACE}', '', 'g')) < 4 THEN 'quote_short'
      WHEN pk.kind = 'user_trigger' AND z.parent IS NOT NULL AND NOT coalesce(regexp_matches(z.text, '{_STRONG}'), false) AND NOT coalesce(y.root = z.root, false) THEN 'reply_line' END AS drop_reason
    FROM pk JOIN ms x ON x.id = t0 JOIN ms y ON y.id = b JOIN ms z ON z.id = c""",
)
def pick_reply_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three messages in a row as picks; corrections by a trigger must hang under the root of what they correct."""
    m = materialise(messages(spark, sf_dir), "messages")
    neighbours = ordered.numbered(m.select("id", "row_id").withColumn("all", F.lit(0)), ["all"], ["row_id"])
    at = lambda k, name: neighbours.select((F.col("pos") + k).alias("pos"), F.col("id").alias(name))
    picks = neighbours.select("pos", F.col("id").alias("c"), F.when(F.col("row_id") % 2 == 0, "user_trigger").otherwise("other").alias("kind")).join(at(1, "b"), "pos").join(at(2, "t0"), "pos")
    picks = picks.join(m.select(F.col("id").alias("b"), F.col("text").alias("quote")), "b").withColumn("verdict", F.lit("ACCEPT")).drop("pos")
    roots = replies.roots(m).select(F.col("id").alias("r"), "root")
    rows = m.join(roots, F.col("id") == F.col("r")).select("id", "role", "text", "parent", "root", F.col("row_id").alias("pos"))
    return guards.validate_picks(picks, rows).select("c", "drop_reason")


@query(
    "wrapped_requests",
    """SELECT row_id, CASE WHEN row_id % 3 = 0 THEN 'RULES be brief' END AS system, CASE WHEN row_id % 3 = 1 AND text IS NULL THEN '' ELSE coalesce(trim(text, ' '), '') END AS said, CASE WHEN row_id % 2 = 0 THEN coalesce(kind, '-') END AS metadata FROM chat_events WHERE coalesce(text, '') NOT LIKE '%<%' AND coalesce(text, '') NOT LIKE '%RULES%'""",
)
def wrapped_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages wrapped as a tool would, and taken apart again; texts with tags of their own are left out on both sides."""
    e = table(spark, sf_dir, "chat_events").where("coalesce(text, '') not like '%<%' and coalesce(text, '') not like '%RULES%'")
    text = F.coalesce("text", F.lit(""))
    body = F.when(F.col("row_id") % 3 == 0, F.concat(F.lit("<USER_REQUEST>RULES be brief SAYS "), text, F.lit("</USER_REQUEST>"))).when(F.col("row_id") % 3 == 1, F.concat(F.lit("<USER_REQUEST>"), text, F.lit("</USER_REQUEST>"))).otherwise(text)
    meta = F.when(F.col("row_id") % 2 == 0, F.concat(F.lit("<ADDITIONAL_METADATA>"), F.coalesce("kind", F.lit("-")), F.lit("</ADDITIONAL_METADATA>"))).otherwise("")
    whole = F.when(F.col("row_id") % 3 == 2, body).otherwise(F.concat(body, meta))
    split = T.split_request(whole, "RULES", "SAYS")
    return e.select("row_id", split["system"].alias("system"), split["said"].alias("said"), F.when(F.col("row_id") % 3 == 2, F.when(F.col("row_id") % 2 == 0, F.coalesce("kind", F.lit("-")))).otherwise(split["metadata"]).alias("metadata"))


@query(
    "objectives_and_lanes",
    """SELECT id, trim(coalesce(title, ''), ' ') AS title, CASE WHEN trim(coalesce(git_branch, ''), ' ') <> '' THEN trim(git_branch, ' ') END AS objective, CASE WHEN archived = 1 THEN 'MAIN' ELSE coalesce(source, '-') END AS lane FROM threads WHERE coalesce(title, '') NOT LIKE '%' || chr(10) || '%'""",
)
def objectives_and_lanes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threads as a list of summaries, newest first, and as lanes of a group; what is read back of the first."""
    t = table(spark, sf_dir, "threads").where(~F.contains(F.coalesce("title", F.lit("")), F.lit("\n")))
    block = F.concat(F.lit("x <conversation_summaries>\n## Conversation 1: "), F.coalesce("title", F.lit("")), F.lit("\n### USER Objective:\n"), F.coalesce("git_branch", F.lit("")), F.lit("\n## Conversation 2: older\n</conversation_summaries> y"))
    top = T.top_objective(block)
    lane = F.when(F.col("archived") == 1, F.lit("g7:main")).otherwise(F.concat(F.lit("g7:"), F.coalesce("source", F.lit("-"))))
    return t.select("id", top["title"].alias("title"), top["objective"].alias("objective"), T.lane_name(lane, "g7", "g7:main").alias("lane"))


# --- small operators, each over a whole table -----------------------------------


@query("noise_rows", _W + rf""" SELECT id, text IS NULL OR regexp_matches(text, '^\s*(\[[^\]]*\]|\(.*\)|\.\.\.|…|ok)\s*$') OR starts_with(text, '[card]') OR contains(text, '<at>') AS is_noise FROM m""")
def noise_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(spark, sf_dir, "text").select("id", guards.is_noise(F.col("text")).alias("is_noise"))


@query("demand_changes", _W + f""" SELECT id, coalesce(regexp_matches(text, '{guards.DEMAND}') AND NOT regexp_matches(text, '{_STRONG}'), false) AS asks_more FROM m""")
def demand_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(spark, sf_dir, "text").select("id", guards.asks_more(F.col("text")).alias("asks_more"))


@query("control_commands", "SELECT event_id, CASE WHEN event_id % 3 = 0 THEN CAST(event_id % 50 AS INT) END AS target FROM events")
def control_commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written as commands, every third with a target."""
    from threadloom.operators import jobs

    text = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit(" /Stop q"), F.col("event_id") % 50)).otherwise(F.concat(F.lit("please /stop "), F.col("event_type")))
    return table(spark, sf_dir, "events").select("event_id", jobs.control_target(text).alias("target"))


@query(
    "late_evidence",
    _W + _TRIPLES + """ SELECT tr.corrector FROM tr JOIN m b ON b.id = tr.anchor JOIN m c ON c.id = tr.corrector WHERE b.ts_us >= 1750000000000000 AND regexp_matches(c.text, '(?i)(fail|broke|error|lost|result|finished|失败|结果)')""",
)
def late_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Corrections whose anchor lies after a fixed time and that tell of a result."""
    from threadloom.operators import jobs

    m = materialise(messages(spark, sf_dir), "messages")
    c = triples(m).join(m.select(F.col("id").alias("corrector"), "text"), "corrector").withColumn("limit_us", F.lit(1_750_000_000_000_000))
    return jobs.late_evidence(c, m.select("id", "ts_us"), "limit_us").select("corrector")


@query("persisted_items", "SELECT left(item_id, 6) AS prefix, count(*) AS n FROM thread_items WHERE json_valid(item_json) AND json_type(item_json) = 'OBJECT' AND item_json ->> '$.type' IN ('agent_message', 'error') GROUP BY 1")
def persisted_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    from threadloom.operators import jobs

    kind = F.try_variant_get(F.try_parse_json("item_json"), "$.type", "string")
    rows = table(spark, sf_dir, "thread_items").where(jobs.persisted(kind, ("agent_message", "error")))
    return jobs.group_sizes(rows.select(F.substring("item_id", 1, 6).alias("prefix")), ["prefix"])


@query("largest_threads", "SELECT thread_id, count(*) AS n FROM thread_items GROUP BY 1 ORDER BY n DESC, thread_id LIMIT 10")
def largest_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    from threadloom.operators import jobs

    return jobs.largest_groups(table(spark, sf_dir, "thread_items"), ["thread_id"], 10)


@query("stale_items", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O' AND epoch_us(o_orderdate) <= 1700000000000000 - 86400000000")
def stale_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open orders as running items whose day is over at a fixed time."""
    from threadloom.operators import jobs

    o = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "O", "running").otherwise("done").alias("status"), F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("at"))
    return jobs.stale(o, "at", 1_700_000_000_000_000, 86_400).select("o_orderkey")


@query(
    "sessions_with_files",
    """WITH f AS (SELECT thread_id AS session, min(trace_id) AS path, arg_min(coalesce(model, ''), (start_ns, trace_id)) AS prompt, count(DISTINCT coalesce(model, '')) AS n, list(coalesce(model, '') ORDER BY start_ns, trace_id) AS v FROM trajectory WHERE thread_id IS NOT NULL GROUP BY 1)
    SELECT t.id AS session, f.path, f.prompt, CASE WHEN f.n > 1 THEN array_to_string(v, ',') END AS variants FROM threads t LEFT JOIN f ON f.session = t.id""",
)
def sessions_with_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threads with their first trace as transcript and the models as captured prompts."""
    from threadloom.operators import jobs

    t = table(spark, sf_dir, "trajectory").where("thread_id is not null")
    s = table(spark, sf_dir, "threads").select(F.col("id").alias("session"))
    files = t.select(F.col("thread_id").alias("session"), F.col("trace_id").alias("path"))
    captures = t.select(F.col("thread_id").alias("session"), F.struct("start_ns", "trace_id").alias("ts"), F.coalesce("model", F.lit("")).alias("prompt"))
    return jobs.with_captures(jobs.with_transcript(s, files), captures).withColumn("variants", F.array_join("variants", ","))


@query(
    "interaction_edges",
    """WITH f AS (SELECT thread_id, arg_min(item_id, (rollout_ordinal, item_id)) AS item FROM thread_items GROUP BY 1) SELECT coalesce(source, '-') AS parent, t.id AS child, coalesce(f.item, 'thread:' || t.id) AS target FROM threads t LEFT JOIN f ON f.thread_id = t.id""",
)
def interaction_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    from threadloom.operators import jobs

    spawns = table(spark, sf_dir, "threads").select(F.coalesce("source", F.lit("-")).alias("parent"), F.col("id").alias("child"))
    items = table(spark, sf_dir, "thread_items").select(F.col("thread_id").alias("thread"), F.col("item_id").alias("item"), F.struct("rollout_ordinal", "item_id").alias("pos"))
    return jobs.interaction_edges(spawns, items)


@query(
    "hard_examples",
    """WITH s AS (SELECT trace_id, steps, list_filter(list_transform(coalesce(steps, []), lambda s, i: CASE WHEN s.error IS NOT NULL AND s.error <> '' THEN i - 1 END), lambda i: i IS NOT NULL) AS e, (source = 'cli') AS corrected, len(steps) > 8 AS reworked FROM trajectory),
    r AS (SELECT trace_id, e, CASE WHEN coalesce(corrected, false) THEN 'corrected' WHEN len(e) > 0 THEN 'tool_error' WHEN coalesce(reworked, false) THEN 'rework' END AS reason FROM s) SELECT trace_id, reason, CASE WHEN reason IS NOT NULL THEN CAST(e[1] AS INT) END AS error_step_idx FROM r""",
)
def hard_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    from threadloom.operators import trajectories

    status = F.when(F.col("source") == "cli", "corrected")
    h = trajectories.hard_example(status, F.coalesce("steps", F.array().cast(table(spark, sf_dir, "trajectory").schema["steps"].dataType)), F.size("steps") > 8)
    return table(spark, sf_dir, "trajectory").select("trace_id", h["reason"].alias("reason"), h["error_step_idx"].alias("error_step_idx"))


@query(
    "text_helpers",
    r"""SELECT row_id, regexp_replace(regexp_replace(coalesce(text, ''), '[^0-9A-Za-z一-鿿]+', '-', 'g'), '^-+|-+$', '', 'g') = '' AS untitled, CASE WHEN row_id % 2 = 0 THEN row_id ELSE 1735689600 + row_id END AS at,
    list_reduce(list_transform(string_split(coalesce(text, ''), '```'), lambda x, i: CASE WHEN i % 2 = 1 THEN replace(x, '`', '') ELSE x END), lambda a, b: a || '```' || b) AS plain, array_to_string(list_filter([kind, CASE WHEN role <> kind OR kind IS NULL THEN role END], lambda x: x IS NOT NULL), '; ') AS merged
    FROM (SELECT row_id, text, nullif(trim(kind, ' '), '') AS kind, nullif(trim(replace(role, ';', ''), ' '), '') AS role FROM chat_events) x""",
)
def text_helpers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File-safe names, time arguments, code marks taken off outside of fences, and lists merged."""
    e = table(spark, sf_dir, "chat_events")
    at = F.when(F.col("row_id") % 2 == 0, F.col("row_id").cast("string")).otherwise(F.date_format(F.timestamp_seconds(F.lit(1_735_689_600) + F.col("row_id")), "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    return e.select(
        "row_id", (T.slug(F.coalesce("text", F.lit(""))) == "untitled").alias("untitled"), T.time_argument(at).alias("at"), T.unfenced(F.coalesce("text", F.lit(""))).alias("plain"),
        T.merged_items(F.col("kind"), F.concat(F.lit(" "), F.replace("role", F.lit(";"), F.lit("")), F.lit("; ;"))).alias("merged"),
    )


@query("thread_filters", "SELECT id FROM threads WHERE archived = 0 AND source IN ('cli', 'vscode') AND contains(lower(coalesce(title, '')), 'the')")
def thread_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from threadloom.operators import store

    return store.listing(table(spark, sf_dir, "threads"), sources=("cli", "vscode"), term="The").select("id")


@query("job_item_page", "SELECT o_orderkey AS row_index, o_orderstatus AS status FROM orders WHERE o_orderstatus = 'F' AND o_orderkey > 500 ORDER BY o_orderkey LIMIT 21")
def job_item_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    from threadloom.operators import store

    return store.item_page(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("row_index"), F.col("o_orderstatus").alias("status")), "F", 500, 20)


@query("edge_statuses", "WITH u AS (SELECT who AS child, arg_max(kind, row_id) FILTER (WHERE kind IS NOT NULL) AS k, max(row_id) AS r FROM chat_events WHERE who IS NOT NULL AND kind IS NOT NULL GROUP BY 1), e AS (SELECT who AS child, arg_max(group_id, row_id) AS parent FROM chat_events WHERE who IS NOT NULL GROUP BY 1) SELECT e.child, parent, coalesce(k, 'open') AS status FROM e LEFT JOIN u ON u.child = e.child")
def edge_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges from groups to senders, the last kind of a sender being its status."""
    e = table(spark, sf_dir, "chat_events").where("who is not null")
    edges = replies.upsert_edges(e.select(F.col("who").alias("child"), F.col("group_id").alias("parent"), "row_id")).select("child", "parent", F.lit("open").alias("status"))
    return replies.with_status(edges, e.where("kind is not null").select(F.col("who").alias("child"), F.col("kind").alias("status"), "row_id"))


@query("archive_states", "SELECT id, CAST(rollout_path LIKE '%/archived%/%' OR rollout_path LIKE 'archived%/%' AS INT) AS archived, CASE WHEN rollout_path LIKE '%/archived%/%' OR rollout_path LIKE 'archived%/%' THEN coalesce(archived_at, 7) END AS archived_at FROM threads")
def archive_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    from threadloom.operators import store

    return store.archived_as_found(table(spark, sf_dir, "threads").select("id", "rollout_path", "archived", "archived_at"), F.lit(7).cast("bigint")).select("id", "archived", "archived_at")
