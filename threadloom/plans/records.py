"""Queries over text forms, guards, evaluation, stores, jobs and life cycles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions import text as T
from threadloom.operators import evaluation, guards, lifecycle, ordered, similarity, store, trajectories
from threadloom.plans.core import query
from threadloom.plans.views import SQL_BOT, SQL_MESSAGES, SQL_USER, messages
from threadloom.session import materialise, table

_W = "WITH RECURSIVE " + SQL_MESSAGES
_SPACE = r"[\s\x0B\x{85}\p{Z}]+"


# --- text forms ---------------------------------------------------------------


@query(
    "text_normal_forms",
    rf"""SELECT row_id, regexp_replace(text, '{_SPACE}', '', 'g') AS no_space, regexp_replace(regexp_replace(text, '[*_`~>]+', '', 'g'), '{_SPACE}', '', 'g') AS no_marks,
    substr(trim(regexp_replace(text, '{_SPACE}', ' ', 'g'), ' '), 1, 30) AS title FROM chat_events""",
)
def text_normal_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.col("text")
    return table(spark, sf_dir, "chat_events").select("row_id", T.without_space(x).alias("no_space"), T.without_emphasis(x).alias("no_marks"), T.title(x).alias("title"))


@query(
    "text_fingerprint",
    r"""WITH f AS (SELECT doc_id, regexp_replace(lower(text), '[^\p{L}\p{N}]+', '', 'g') AS x FROM documents)
    SELECT doc_id, CASE WHEN length(x) >= 20 THEN substr(x, 1, 180) ELSE '' END AS fp FROM f""",
)
def text_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of every document, in any script; one without text has an empty form."""
    return table(spark, sf_dir, "documents").select("doc_id", T.fingerprint(F.col("text")).alias("fp"))


@query(
    "previews_and_lines",
    rf"""WITH f AS (SELECT row_id, text, trim(regexp_replace(translate(text, '#*`|', ''), '{_SPACE}', ' ', 'g'), ' ') AS flat FROM chat_events)
    SELECT row_id, substr(text, 1, 20) AS head, length(text) AS n_chars, CASE WHEN length(flat) > 60 THEN substr(flat, 1, 60) || ' [+' || (length(flat) - 60) || ']' ELSE flat END AS line FROM f""",
)
def previews_and_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = T.preview(F.col("text"), 20)
    return table(spark, sf_dir, "chat_events").select("row_id", p["head"].alias("head"), p["n_chars"].alias("n_chars"), T.one_line(F.col("text"), 60).alias("line"))


_NUMBER = r"'\d+(?:[.\-/→>~]\d+)*|[零一二三四五六七八九十百千万亿]+'"


@query(
    "number_leaks",
    _W + f""" SELECT c.id, array_to_string(list_sort(list_filter(list_distinct(regexp_extract_all(coalesce(p.text, ''), {_NUMBER})), lambda t: contains(coalesce(c.text, ''), t))), '|') AS leaked FROM m c JOIN m p ON c.parent = p.id""",
)
def number_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each reply as a rule made from what it replies to: the numbers that it repeats."""
    m = messages(spark, sf_dir, "parent", "text")
    up = m.select(F.col("id").alias("p"), F.col("text").alias("source"))
    return m.join(up, F.col("parent") == F.col("p")).select("id", F.array_join(T.leaked_numbers(F.col("text"), F.col("source")), "|").alias("leaked"))


@query("pii_pseudonym", "SELECT row_id, CASE WHEN who IS NOT NULL THEN '<WHO_' || substr(sha1(who), 1, 8) || '>' END AS code FROM chat_events")
def pii_pseudonym(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "chat_events").select("row_id", T.pseudonym(F.col("who"), "WHO").alias("code"))


@query(
    "pii_pseudonyms_in_text",
    r"""WITH f AS (SELECT row_id, text, list_sort(list_transform(list_distinct(regexp_extract_all(text, '[a-z]+/[a-z_-]+\.[a-z]+')), lambda v: {'n': -length(v), 'v': v})) AS x FROM chat_events)
    SELECT row_id, CASE WHEN len(x) > 0 THEN list_reduce(list_transform(x, lambda s: s.v), lambda a, v: replace(a, v, '<FILE_' || substr(sha1(v), 1, 8) || '>'), text) ELSE text END AS coded FROM f""",
)
def pii_pseudonyms_in_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every token that looks like a task file, replaced by a stable code inside the text."""
    return table(spark, sf_dir, "chat_events").select("row_id", T.with_pseudonyms(F.col("text"), r"[a-z]+/[a-z_-]+\.[a-z]+", "FILE").alias("coded"))


@query(
    "row_templates",
    "SELECT c_custkey, '{{name}} is ' || c_name || ' in ' || coalesce(c_mktsegment, '') || ' of {nation} ' || c_nationkey AS prompt FROM customer",
)
def row_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    row = F.create_map(F.lit("name"), F.col("c_name"), F.lit("segment"), F.col("c_mktsegment"), F.lit("nation"), F.col("c_nationkey").cast("string"))
    return c.select("c_custkey", T.rendered(F.lit("{{{name}}} is {name} in {segment} of {{nation}} {nation}"), row).alias("prompt"))


@query(
    "search_snippets",
    rf"""WITH f AS (SELECT row_id, trim(regexp_replace(text, '{_SPACE}', ' ', 'g'), ' ') AS x FROM chat_events), g AS (SELECT *, instr(lower(x), 'ledger') AS p FROM f)
    SELECT row_id, CASE WHEN p > 49 THEN '... ' ELSE '' END || substr(x, greatest(p - 48, 1), p + 102 - greatest(p - 48, 1)) || CASE WHEN p + 102 <= length(x) THEN ' ...' ELSE '' END AS snippet FROM g WHERE p > 0""",
)
def search_snippets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "chat_events").select("row_id", T.snippet(F.col("text"), "ledger").alias("snippet")).where("snippet is not null")


@query(
    "role_classes",
    "SELECT trace_id, CASE WHEN x LIKE '%checkpoint%' THEN 'aux/checkpoint' WHEN x LIKE '%ledger%' THEN 'main/ledger' ELSE 'aux/unknown' END AS class FROM (SELECT trace_id, lower(coalesce(messages[1].content, '')) AS x FROM trajectory) y",
)
def role_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered substring rules over a prompt."""
    first = F.try_element_at("messages", F.lit(1))["content"]
    return table(spark, sf_dir, "trajectory").select("trace_id", T.first_match(first, [("checkpoint", "aux/checkpoint"), ("ledger", "main/ledger")], "aux/unknown").alias("class"))


@query(
    "speaker_predicates",
    _W + f""" SELECT id, {SQL_BOT} OR coalesce(regexp_matches(name, '(?i)(^|[^a-z])bot([^a-z]|$)'), false) AS is_bot, {SQL_USER} AS is_user FROM m""",
)
def speaker_predicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return messages(spark, sf_dir).select("id", T.is_bot(F.col("role"), F.col("name")).alias("is_bot"), T.is_user(F.col("role")).alias("is_user"))


# --- guards -------------------------------------------------------------------

_TRIPLES = """, tr AS (SELECT c.id AS corrector, b.id AS anchor, b.parent AS t0, CASE WHEN c.row_id % 11 = 0 THEN 'zz' WHEN c.row_id % 13 = 0 THEN 'not there at all' ELSE substr(b.text, 1, 14) END AS quote, c.row_id AS row_id FROM m c JOIN m b ON c.parent = b.id)"""


def triples(m: DataFrame) -> DataFrame:
    """Replies as (corrector, anchor, quote): some quotes too short, some absent."""
    c = m.select(F.col("id").alias("corrector"), F.col("parent").alias("up"), "row_id")
    b = m.select(F.col("id").alias("anchor"), F.col("parent").alias("t0"), F.substring("text", 1, 14).alias("said"))
    quote = F.when(F.col("row_id") % 11 == 0, "zz").when(F.col("row_id") % 13 == 0, "not there at all").otherwise(F.col("said"))
    return c.join(b, F.col("up") == F.col("anchor")).select("corrector", "anchor", "t0", quote.alias("quote"), "row_id")


_STRONG = guards.OVERRIDE
_GUARD = (
    _TRIPLES
    + rf""", ms AS (SELECT *, {SQL_BOT} AS is_bot, {SQL_USER} AS is_user, {SQL_BOT} OR coalesce(regexp_matches(name, '(?i)(^|[^a-z])bot([^a-z]|$)'), false) AS bot_row FROM m),
    np AS (SELECT id, thread, row_number() OVER (PARTITION BY thread ORDER BY ts_us, row_id) AS pos, {SQL_BOT} AND coalesce(regexp_matches(text, '{guards.ASKED_OUTPUT}'), false) AS asked FROM t),
    pl AS (SELECT id AS pid, thread AS pth, pos AS ppos, max(CASE WHEN asked THEN pos END) OVER (PARTITION BY thread ORDER BY pos ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING) AS found FROM np WHERE thread IS NOT NULL),
    v AS (SELECT tr.*, a.id AS a_id, a.is_bot AS a_bot, a.text AS a_text, a.ts_us AS a_ts, c.id AS c_id, c.role AS c_role, c.is_user AS c_user, c.bot_row AS c_bot, c.text AS c_text, c.ts_us AS c_ts,
      pa.pth = pc.pth AND pc.ppos > pa.ppos AND pc.found >= pa.ppos AS near,
      regexp_replace(quote, '{_SPACE}', '', 'g') AS q, regexp_replace(a.text, '{_SPACE}', '', 'g') AS a_flat FROM tr LEFT JOIN ms a ON a.id = anchor LEFT JOIN ms c ON c.id = corrector LEFT JOIN pl pa ON pa.pid = anchor LEFT JOIN pl pc ON pc.pid = corrector),
    g AS (SELECT corrector, anchor, CASE WHEN a_id IS NULL THEN 'anchor_missing' WHEN NOT a_bot THEN 'anchor_not_bot' WHEN a_text IS NULL OR regexp_matches(a_text, '^\s*(\[[^\]]*\]|\(.*\)|\.\.\.|…|ok)\s*$') THEN 'anchor_placeholder'
      WHEN q IS NULL OR length(q) < 4 THEN 'quote_short' WHEN NOT contains(a_flat, q) THEN 'quote_absent' WHEN c_id IS NULL THEN 'corrector_missing' WHEN c_role IS NOT NULL AND NOT c_user THEN 'corrector_not_user'
      WHEN c_text IS NULL OR regexp_matches(c_text, '^\s*(\[[^\]]*\]|\(.*\)|\.\.\.|…|ok)\s*$') THEN 'corrector_placeholder' WHEN c_bot THEN 'corrector_is_bot'
      WHEN regexp_matches(c_text, '{guards.DEMAND}') AND NOT regexp_matches(c_text, '{_STRONG}') THEN 'demand_change'
      WHEN regexp_matches(c_text, '{guards.FEEDBACK}') AND NOT regexp_matches(c_text, '{_STRONG}') AND near THEN 'troubleshooting_feedback' WHEN c_ts <= a_ts THEN 'not_later' END AS drop_reason FROM v)"""
)


@query("guard_validation", _W + _GUARD + " SELECT corrector, anchor, drop_reason FROM g")
def guard_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = materialise(messages(spark, sf_dir), "messages")
    return guards.validate_triples(triples(m), _with_requests(m)).select("corrector", "anchor", "drop_reason")


def _with_requests(m: DataFrame) -> DataFrame:
    """Messages with their place in the thread and that of a bot's request for output shortly before."""
    placed = ordered.numbered(m.where("ts_us is not null").select("id", "role", "text", "ts_us", "row_id", F.coalesce("thread_id", "group_id").alias("thread")), ["thread"], ["ts_us", "row_id"])
    asked = T.is_bot(F.col("role")) & F.coalesce(F.col("text").rlike(guards.ASKED_OUTPUT), F.lit(False))
    near = guards.requested_before(placed.where("thread is not null"), ["thread"], asked).select(F.col("id").alias("p"), "thread", "pos", "asked_pos")
    return m.join(near, F.col("id") == F.col("p"), "left").drop("p")


@query("guard_validation_counts", _W + _GUARD + " SELECT coalesce(drop_reason, 'kept') AS reason, count(*) AS n FROM g GROUP BY 1")
def guard_validation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = materialise(messages(spark, sf_dir), "messages")
    return guards.reasons(guards.validate_triples(triples(m), _with_requests(m)))


@query(
    "red_flags",
    "SELECT doc_id, array_to_string(list_filter([CASE WHEN text IS NULL OR trim(text) = '' THEN 'blank' END, CASE WHEN lang IS NULL THEN 'no_lang' END, CASE WHEN n_chars > 3000 THEN 'long' END, CASE WHEN group_id IS NULL THEN 'no_group' END], lambda x: x IS NOT NULL), ',') AS flags FROM documents",
)
def red_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = {"blank": F.col("text").isNull() | (F.trim("text") == ""), "no_lang": F.col("lang").isNull(), "long": F.col("n_chars") > 3000, "no_group": F.col("group_id").isNull()}
    return guards.red_flags(table(spark, sf_dir, "documents"), flags).select("doc_id", "flags")


@query(
    "leakage_guard",
    _W + _TRIPLES + """, l AS (SELECT tr.anchor, tr.corrector, b.ts_us AS limit_us FROM tr JOIN m b ON b.id = tr.anchor), k AS (SELECT p.id AS anchor, c.id, c.ts_us FROM m p JOIN m c ON c.parent = p.parent)
    SELECT k.anchor, max(coalesce(k.ts_us >= l.limit_us, false) OR k.id = l.corrector) AS needs_review, count(*) AS n_context FROM k JOIN l ON k.anchor = l.anchor GROUP BY 1""",
)
def leakage_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contexts of the siblings of each anchor, checked against its time and its correction."""
    m = materialise(messages(spark, sf_dir), "messages")
    t = triples(m)
    limits = t.join(m.select(F.col("id").alias("anchor"), F.col("ts_us").alias("limit_us")), "anchor").select("anchor", "corrector", "limit_us")
    placed = m.where("parent is not null").select("id", F.col("parent").alias("place"), "ts_us")
    return guards.leaks_among(placed.select(F.col("id").alias("anchor"), "place"), placed, limits)


# --- evaluation ---------------------------------------------------------------

_GOLD = """, gold AS (SELECT corrector AS card, CASE WHEN row_id % 17 <> 0 THEN t0 END AS t0, anchor AS b, corrector AS c FROM tr WHERE row_id % 3 = 0),
    found AS (SELECT CASE WHEN row_id % 5 = 0 THEN anchor ELSE t0 END AS t0, anchor AS b, CASE WHEN row_id % 4 = 0 THEN NULL ELSE corrector END AS c FROM tr WHERE row_id % 2 = 0),
    pool AS (SELECT corrector FROM tr WHERE row_id % 7 = 0)"""
_CLASSES = """, cl AS (SELECT card, CASE WHEN t0 IS NULL OR b IS NULL OR c IS NULL THEN 'not_evaluable'
      WHEN EXISTS (SELECT 1 FROM found f WHERE f.t0 = g.t0 AND f.b = g.b AND f.c = g.c) THEN 'exact' WHEN EXISTS (SELECT 1 FROM found f WHERE f.b = g.b AND f.c = g.c) THEN 't0_mismatch'
      WHEN EXISTS (SELECT 1 FROM found f WHERE f.b = g.b) THEN 'bot_error_without_corrector' WHEN EXISTS (SELECT 1 FROM found f WHERE f.c = g.c) THEN 'corrector_with_wrong_bot_error'
      WHEN EXISTS (SELECT 1 FROM found f WHERE f.t0 = g.t0) THEN 'same_t0_wrong_pair' WHEN EXISTS (SELECT 1 FROM pool p WHERE p.corrector = g.c) THEN 'candidate_pool_only' ELSE 'missed' END AS class FROM gold g)"""


def _gold(m: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    t = triples(m)
    r = F.col("row_id")
    gold = t.where(r % 3 == 0).select(F.col("corrector").alias("card"), F.when(r % 17 != 0, F.col("t0")).alias("t0"), F.col("anchor").alias("b"), F.col("corrector").alias("c"))
    found = t.where(r % 2 == 0).select(F.when(r % 5 == 0, F.col("anchor")).otherwise(F.col("t0")).alias("t0"), F.col("anchor").alias("b"), F.when(r % 4 != 0, F.col("corrector")).alias("c"))
    return gold, found, t.where(r % 7 == 0).select("corrector")


@query("gold_match_classes", _W + _TRIPLES + _GOLD + _CLASSES + " SELECT card, class FROM cl")
def gold_match_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold and results are dealt from the triples of all messages."""
    return evaluation.gold_classes(*_gold(messages(spark, sf_dir)))


@query("gold_evaluation", _W + _TRIPLES + _GOLD + _CLASSES + " SELECT class, count(*) AS n FROM cl GROUP BY 1")
def gold_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.gold_classes(*_gold(messages(spark, sf_dir))).groupBy("class").agg(F.count("*").alias("n"))


_LABEL = """CASE WHEN EXISTS (SELECT 1 FROM {s} f WHERE f.t0 = g.t0 AND f.b = g.b AND f.c = g.c) THEN 'exact_t0_b_c' WHEN EXISTS (SELECT 1 FROM {s} f WHERE f.b = g.b AND f.c = g.c) THEN 'exact_b_c'
      WHEN EXISTS (SELECT 1 FROM {s} f WHERE f.b = g.b) AND EXISTS (SELECT 1 FROM {s} f WHERE f.c = g.c) THEN 'b_and_c_separate' WHEN EXISTS (SELECT 1 FROM {s} f WHERE f.b = g.b) THEN 'b_only'
      WHEN EXISTS (SELECT 1 FROM {s} f WHERE f.c = g.c) THEN 'c_only' WHEN EXISTS (SELECT 1 FROM {s} f WHERE f.t0 = g.t0) THEN 't0_only' ELSE 'absent' END"""
_LINEAGE = f""", late AS (SELECT * FROM found WHERE c IS NOT NULL AND substr(b, length(b), 1) < '8'),
    li AS (SELECT card, 0 AS stage_no, 'found' AS stage, {_LABEL.format(s='found')} AS label FROM gold g UNION ALL SELECT card, 1, 'kept', {_LABEL.format(s='late')} FROM gold g)"""


def _lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    gold, found, _ = _gold(messages(spark, sf_dir))
    late = found.where(F.col("c").isNotNull() & (F.expr("substr(b, length(b), 1)") < "8"))
    return evaluation.lineage(gold, [("found", found), ("kept", late)])


@query("stage_lineage", _W + _TRIPLES + _GOLD + _LINEAGE + " SELECT card, stage, label FROM li")
def stage_lineage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lineage(spark, sf_dir).select("card", "stage", "label")


@query(
    "last_strong_stage",
    _W + _TRIPLES + _GOLD + _LINEAGE + ", s AS (SELECT card, arg_max(stage, stage_no) FILTER (WHERE label IN ('exact_t0_b_c', 'exact_b_c')) AS stage FROM li GROUP BY 1) SELECT coalesce(stage, 'none') AS stage, count(*) AS n FROM s GROUP BY 1",
)
def last_strong_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.last_strong_stage(_lineage(spark, sf_dir))


@query(
    "length_distribution",
    """SELECT count(n_chars) AS n, min(n_chars) AS lo, max(n_chars) AS hi, round(avg(n_chars), 3) AS mean, CAST(floor(round(quantile_cont(n_chars, 0.5), 6)) AS BIGINT) AS p50, CAST(floor(round(quantile_cont(n_chars, 0.75), 6)) AS BIGINT) AS p75,
    CAST(floor(round(quantile_cont(n_chars, 0.9), 6)) AS BIGINT) AS p90, CAST(floor(round(quantile_cont(n_chars, 0.95), 6)) AS BIGINT) AS p95, CAST(floor(round(quantile_cont(n_chars, 0.99), 6)) AS BIGINT) AS p99,
    count(*) FILTER (WHERE n_chars > 2048) AS n_over, round(100.0 * count(*) FILTER (WHERE n_chars > 2048) / count(n_chars), 3) AS percent_over FROM documents""",
)
def length_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.distribution(table(spark, sf_dir, "documents"), "n_chars", 2048)


@query(
    "majority_vote",
    "SELECT l_orderkey, count(*) FILTER (WHERE l_returnflag = 'R') AS n_yes, count(*) AS n, count(*) FILTER (WHERE l_returnflag = 'R') > count(*) // 2 AS passes FROM lineitem GROUP BY 1",
)
def majority_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.strict_majority(table(spark, sf_dir, "lineitem"), ["l_orderkey"], F.col("l_returnflag") == "R")


@query(
    "three_valued_vote",
    """WITH v AS (SELECT l_orderkey, CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN NULL ELSE l_returnflag = 'R' END AS f FROM lineitem), c AS (SELECT l_orderkey, count(*) FILTER (WHERE f) AS n_failed, count(f) AS n_valid FROM v GROUP BY 1)
    SELECT l_orderkey, n_failed, n_valid, CASE WHEN 2 * n_failed > n_valid THEN true WHEN 2 * n_failed < n_valid THEN false END AS failed FROM c""",
)
def three_valued_vote(spark: SparkSession, sf_dir: str) -> DataFrame:
    failed = F.when(~((F.col("l_linestatus") == "O") & (F.col("l_returnflag") == "N")), F.col("l_returnflag") == "R")
    return evaluation.three_valued_vote(table(spark, sf_dir, "lineitem"), ["l_orderkey"], failed)


@query(
    "set_compare",
    "SELECT count(*) FILTER (WHERE a IS NOT NULL AND b IS NOT NULL) AS both, count(*) FILTER (WHERE b IS NULL) AS only_left, count(*) FILTER (WHERE a IS NULL) AS only_right FROM (SELECT DISTINCT thread_id AS a FROM thread_items) x FULL JOIN (SELECT DISTINCT thread_id AS b FROM trajectory) y ON a = b",
)
def set_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return evaluation.set_compare(table(spark, sf_dir, "thread_items"), table(spark, sf_dir, "trajectory"), "thread_id")


_MEMBERS = """, mb AS (SELECT id, coalesce(task_id, '-') AS task, row_id AS task_pos FROM m WHERE row_id % 10 < 7 UNION ALL SELECT parent, coalesce(task_id, '-'), row_id FROM m WHERE row_id % 10 = 3 AND parent IN (SELECT id FROM m))"""


def _members(m: DataFrame) -> DataFrame:
    task = F.coalesce("task_id", F.lit("-")).alias("task")
    own = m.where("row_id % 10 < 7").select("id", task, F.col("row_id").alias("task_pos"))
    up = m.where("row_id % 10 = 3").join(m.select(F.col("id").alias("p")), F.col("parent") == F.col("p"), "left_semi")
    return own.unionByName(up.select(F.col("parent").alias("id"), task, F.col("row_id").alias("task_pos")))


@query(
    "membership_audit",
    _W + _MEMBERS + " SELECT id, 'several' AS fault FROM mb GROUP BY 1 HAVING count(DISTINCT task) > 1 UNION ALL SELECT id, 'none' FROM m WHERE id NOT IN (SELECT id FROM mb)",
)
def membership_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = messages(spark, sf_dir)
    return evaluation.membership_audit(_members(m), m.select("id"))


@query(
    "task_assembly",
    _W + _MEMBERS + " SELECT id, arg_min(task, (task_pos, task)) AS task FROM mb GROUP BY 1 UNION ALL SELECT id, 'orphan-' || id FROM m WHERE id NOT IN (SELECT id FROM mb)",
)
def task_assembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = messages(spark, sf_dir)
    return evaluation.assembled(_members(m), m.select("id"))


@query(
    "title_carry_forward",
    _W + """, o AS (SELECT DISTINCT id, coalesce(task_id, '-') AS old FROM m WHERE row_id % 3 <> 0), n AS (SELECT DISTINCT id, coalesce(thread_id, '-') AS new FROM m WHERE row_id % 3 <> 1), z AS (SELECT old, count(DISTINCT id) AS size FROM o GROUP BY 1),
    s AS (SELECT old, new, count(*) AS shared FROM o JOIN n ON o.id = n.id GROUP BY 1, 2) SELECT s.old, new, shared, round(shared / size, 6) AS containment FROM s JOIN z ON s.old = z.old""",
)
def title_carry_forward(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = messages(spark, sf_dir)
    old = m.where("row_id % 3 <> 0").select("id", F.coalesce("task_id", F.lit("-")).alias("old"))
    new = m.where("row_id % 3 <> 1").select("id", F.coalesce("thread_id", F.lit("-")).alias("new"))
    return evaluation.containment(old, new)


@query(
    "carried_titles",
    _W + """, o AS (SELECT id, coalesce(task_id, '-') AS old FROM m WHERE row_id % 3 <> 0), n AS (SELECT id, coalesce(thread_id, '-') AS new FROM m WHERE row_id % 3 <> 1), z AS (SELECT old, count(*) AS size FROM o WHERE trim(old, ' ') <> '' GROUP BY 1),
    s AS (SELECT old, new, round(count(*) / max(size), 6) AS c FROM o JOIN n ON o.id = n.id JOIN z USING (old) GROUP BY 1, 2 HAVING round(count(*) / max(size), 6) >= 0.6) SELECT new, arg_max(old, (c, -length(old), old)) AS title, max(c) AS containment FROM s GROUP BY 1""",
)
def carried_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threads as new clusters that take over the titles of tasks, shorter ones ahead of longer."""
    m = messages(spark, sf_dir, "task_id", "thread_id")
    old = m.where("row_id % 3 <> 0").select("id", F.coalesce("task_id", F.lit("-")).alias("old"))
    new = m.where("row_id % 3 <> 1").select("id", F.coalesce("thread_id", F.lit("-")).alias("new"))
    return evaluation.carried_titles(old.withColumns({"title": F.col("old"), "pos": F.length("old")}), new)


_PAIRS = """WITH s AS (SELECT a.vec_id AS query, b.vec_id AS vec_id, list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) AS sim,
      CASE WHEN a.label >= 0 AND b.label >= 0 THEN a.label = b.label END AS same, abs(b.vec_id - a.vec_id) = 1 AS adjacent FROM embeddings a JOIN embeddings b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id)"""
_VECTORS = ("vec_id", "embedding", "label")


@query("embedding_pairs", _PAIRS + " SELECT query, vec_id, round(sim, 4) AS similarity, same, adjacent FROM s WHERE sim >= 0.2")
def embedding_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = similarity.similar_pairs(table(spark, sf_dir, "embeddings"), *_VECTORS, 0.2)
    return found.withColumn("similarity", F.round("similarity", 4))


@query(
    "embedding_nearest",
    _PAIRS + " SELECT query, arg_max(vec_id, (sim, -vec_id)) AS vec_id, round(max(sim), 4) AS similarity FROM s GROUP BY 1",
)
def embedding_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.nearest(table(spark, sf_dir, "embeddings"), *_VECTORS).withColumn("similarity", F.round("similarity", 4))


@query(
    "embedding_recall",
    _PAIRS + """, c AS (SELECT t AS threshold, count(*) FILTER (WHERE same AND NOT adjacent) AS n_wanted, count(*) FILTER (WHERE same AND NOT adjacent AND sim >= t) AS n_recalled, count(*) FILTER (WHERE same IS NOT NULL AND sim >= t) AS n_above,
      count(*) FILTER (WHERE same AND sim >= t) AS n_hit FROM s, (SELECT unnest([0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8])::DOUBLE AS t) x GROUP BY 1)
    SELECT *, n_above - n_hit AS n_crossed, CASE WHEN n_wanted > 0 THEN n_recalled / n_wanted ELSE 0 END AS recall, CASE WHEN n_above > 0 THEN n_hit / n_above ELSE 0 END AS precision FROM c""",
)
def embedding_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.recall_by_threshold(table(spark, sf_dir, "embeddings"), *_VECTORS, (0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8))


@query(
    "embedding_hardest",
    _PAIRS + """ SELECT * FROM (SELECT 'crossed' AS kind, query, vec_id, round(sim, 4) AS similarity FROM s WHERE NOT same ORDER BY sim DESC, query, vec_id LIMIT 6) x
    UNION ALL SELECT * FROM (SELECT 'missed', query, vec_id, round(sim, 4) FROM s WHERE same AND NOT adjacent ORDER BY sim, query, vec_id LIMIT 6) y""",
)
def embedding_hardest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similarity.hardest_pairs(table(spark, sf_dir, "embeddings"), *_VECTORS).withColumn("similarity", F.round("similarity", 4))


# --- stores, jobs, life cycles --------------------------------------------------


@query("keyset_page", "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice < 200000 OR (o_totalprice = 200000 AND o_orderkey < 100) ORDER BY o_totalprice DESC, o_orderkey DESC LIMIT 51")
def keyset_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of 50 after a key, and one row more."""
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return store.keyset_page(rows, ["o_totalprice", "o_orderkey"], (200000.0, 100), 50)


@query(
    "thread_listing",
    """SELECT id, CASE WHEN created_at < 1577836800000 THEN created_at * 1000 ELSE created_at END AS created_at, CASE WHEN updated_at < 1577836800000 THEN updated_at * 1000 ELSE updated_at END AS updated_at FROM threads
    WHERE archived = 0 AND git_sha IS NOT NULL AND id IN (SELECT thread_id FROM thread_items)""",
)
def thread_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = store.thread_times(table(spark, sf_dir, "threads").where("archived = 0 and git_sha is not null"))
    return t.join(table(spark, sf_dir, "thread_items").select(F.col("thread_id").alias("id")), "id", "left_semi").select("id", "created_at", "updated_at")


@query(
    "metadata_fold",
    """WITH t AS (SELECT * FROM trajectory WHERE thread_id IS NOT NULL), u AS (SELECT thread_id, start_ns, trace_id, unnest(messages) AS m, generate_subscripts(messages, 1) AS i FROM t),
    r AS (SELECT thread_id, (start_ns, trace_id, 0) AS spot, 'turn_context' AS kind, model, CAST(NULL AS VARCHAR) AS text, CAST(NULL AS BIGINT) AS tokens FROM t
      UNION ALL SELECT thread_id, (start_ns, trace_id, i), 'user_message', NULL, m.content, NULL FROM u WHERE m.role = 'user'
      UNION ALL SELECT thread_id, (start_ns, trace_id, 1000000), 'token_count', NULL, NULL, CASE WHEN tokens IS NOT NULL AND cardinality(tokens) > 0 THEN CAST(list_sum(map_values(tokens)) AS BIGINT) END FROM t)
    SELECT thread_id, arg_max(model, spot) FILTER (WHERE kind = 'turn_context' AND model IS NOT NULL) AS model, arg_min(text, spot) FILTER (WHERE kind = 'user_message' AND trim(text, ' ') <> '') AS first_user_message,
      substr(arg_min(text, spot) FILTER (WHERE kind = 'user_message' AND trim(text, ' ') <> ''), 1, 60) AS title, greatest(0, coalesce(arg_max(tokens, spot) FILTER (WHERE kind = 'token_count' AND tokens IS NOT NULL), 0)) AS tokens_used FROM r GROUP BY 1""",
)
def metadata_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The traces of a thread as its rollout: models, what the user said, tokens."""
    t = table(spark, sf_dir, "trajectory").where("thread_id is not null")
    none = F.lit(None).cast("string")
    row = lambda df, k, kind, model=none, text=none, tokens=None: df.select(
        "thread_id", F.struct(F.col("start_ns").alias("a"), F.col("trace_id").alias("b"), F.lit(k).cast("int").alias("c") if isinstance(k, int) else k.cast("int").alias("c")).alias("at"), F.lit(kind).alias("kind"),
        none.alias("meta_id"), model.alias("model"), text.alias("text"), (F.lit(None) if tokens is None else tokens).cast("bigint").alias("tokens"),
    )
    said = t.select("thread_id", "start_ns", "trace_id", F.posexplode("messages").alias("i", "m")).where("m.role = 'user'")
    total = F.when(F.size("tokens") > 0, F.aggregate(F.map_values("tokens"), F.lit(0).cast("bigint"), lambda a, v: a + F.coalesce(v, F.lit(0))))
    rows = row(t, 0, "turn_context", model=F.col("model")).unionByName(row(said, F.col("i") + 1, "user_message", text=F.col("m.content"))).unionByName(row(t, 1_000_000, "token_count", tokens=total))
    return store.metadata_fold(rows)


@query(
    "thread_names",
    """WITH n AS (SELECT thread_id AS id, model AS name, start_ns AS pos FROM trajectory WHERE trim(coalesce(model, '')) <> ''), l AS (SELECT id, arg_max(name, (pos, name)) AS indexed FROM n GROUP BY 1)
    SELECT t.id, coalesce(CASE WHEN trim(coalesce(title, '')) <> '' THEN title END, indexed) AS name FROM threads t LEFT JOIN l ON l.id = t.id""",
)
def thread_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = table(spark, sf_dir, "trajectory").select(F.col("thread_id").alias("id"), F.col("model").alias("name"), F.struct("start_ns", "model").alias("pos")).where("name is not null")
    return store.names(table(spark, sf_dir, "threads"), index)


@query(
    "thread_search",
    rf"""WITH f AS (SELECT thread_id, rollout_ordinal AS o, trim(regexp_replace(item_json, '{_SPACE}', ' ', 'g'), ' ') AS x FROM thread_items), g AS (SELECT *, instr(lower(x), 'ledger') AS p FROM f),
    h AS (SELECT thread_id, o, CASE WHEN p > 49 THEN '... ' ELSE '' END || substr(x, greatest(p - 48, 1), p + 102 - greatest(p - 48, 1)) || CASE WHEN p + 102 <= length(x) THEN ' ...' ELSE '' END AS snippet FROM g WHERE p > 0),
    s AS (SELECT thread_id, arg_min(snippet, (o, snippet)) AS snippet, count(*) AS n_hits FROM h GROUP BY 1), l AS (SELECT id, CASE WHEN updated_at < 1577836800000 THEN updated_at * 1000 ELSE updated_at END AS updated_at FROM threads)
    SELECT id, updated_at, snippet, n_hits FROM l JOIN s ON id = thread_id ORDER BY updated_at DESC, id DESC LIMIT 21""",
)
def thread_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of 20, and one row more that tells where the next begins."""
    return store.search(table(spark, sf_dir, "thread_items"), store.thread_times(table(spark, sf_dir, "threads")), "ledger", 20).select("id", "updated_at", "snippet", "n_hits")


@query(
    "new_files",
    """WITH c AS (SELECT trace_id AS path, start_ns AS mtime, sha256(coalesce(model, '')) AS digest FROM trajectory), l AS (SELECT * FROM c WHERE mtime % 3 = 0)
    SELECT c.path FROM c WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.path = c.path AND l.mtime = c.mtime) AND c.digest NOT IN (SELECT digest FROM l WHERE mtime % 2 = 1)""",
)
def new_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "trajectory").select(F.col("trace_id").alias("path"), F.col("start_ns").alias("mtime"), F.sha2(F.coalesce("model", F.lit("")).cast("binary"), 256).alias("digest"))
    known = c.where("mtime % 3 = 0")
    return store.new_files(c, known.withColumn("digest", F.when(F.col("mtime") % 2 == 1, F.col("digest")))).select("path")


@query(
    "thread_reconcile",
    """WITH f AS (SELECT id, 'fresh' AS title, NULL AS git_sha, tokens_used + 1 AS tokens_used FROM threads WHERE tokens_used % 2 = 0 UNION ALL SELECT 'new-' || id, title, git_sha, tokens_used FROM threads WHERE tokens_used % 7 = 0)
    SELECT coalesce(f.id, t.id) AS id, coalesce(CASE WHEN t.title <> '' THEN t.title END, f.title) AS title, coalesce(CASE WHEN t.git_sha <> '' THEN t.git_sha END, f.git_sha) AS git_sha, coalesce(f.tokens_used, t.tokens_used) AS tokens_used FROM f FULL JOIN threads t ON f.id = t.id""",
)
def thread_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = table(spark, sf_dir, "threads").select("id", "title", "git_sha", "tokens_used")
    found = t.where("tokens_used % 2 = 0").select("id", F.lit("fresh").alias("title"), F.lit(None).cast("string").alias("git_sha"), (F.col("tokens_used") + 1).alias("tokens_used"))
    found = found.unionByName(t.where("tokens_used % 7 = 0").withColumn("id", F.concat(F.lit("new-"), "id")))
    return store.reconcile(t, found)


@query("job_progress", "SELECT o_orderpriority, count(*) AS total, count(*) FILTER (WHERE o_orderstatus = 'O') AS n_o, count(*) FILTER (WHERE o_orderstatus = 'F') AS n_f, count(*) FILTER (WHERE o_orderstatus = 'P') AS n_p FROM orders GROUP BY 1")
def job_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.progress(table(spark, sf_dir, "orders"), ["o_orderpriority"], "o_orderstatus", ("O", "F", "P"))


@query(
    "runtime_metrics_rollup",
    "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total, arg_max(value, event_id) FILTER (WHERE value > 0) AS last_positive FROM events GROUP BY 1",
)
def runtime_metrics_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return store.metrics_rollup(table(spark, sf_dir, "events"), ["event_type"], "value", "event_id")


@query(
    "history_trim",
    """WITH s AS (SELECT user_id, event_id, length(props) AS b, sum(length(props)) OVER (PARTITION BY user_id) AS total, sum(length(props)) OVER (PARTITION BY user_id ORDER BY event_id DESC) AS back, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS n FROM events)
    SELECT user_id, event_id FROM s WHERE total <= 200 OR back <= 160 OR n = 1""",
)
def history_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("user_id", "event_id", F.length("props").alias("b"))
    return store.trimmed_history(rows, ["user_id"], "event_id", "b", 200).select("user_id", "event_id")


@query(
    "log_rows",
    "SELECT event_id FROM events WHERE event_type IN ('view', 'click') AND ts >= TIMESTAMP '2024-01-01' AND (props LIKE '%1%' OR props LIKE '%7%')",
)
def log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    level = F.when(F.col("event_type") == "view", "WARN").when(F.col("event_type") == "click", "ERROR").otherwise("INFO")
    keep = store.log_filter(level, "WARN", since=F.lit("2024-01-01").cast("timestamp_ntz"), ts=F.col("ts"), any_like=[F.col("props").like("%1%"), F.col("props").like("%7%")])
    return table(spark, sf_dir, "events").where(keep).select("event_id")


@query(
    "lifecycle_spans",
    """WITH e AS (SELECT l_orderkey * 10 + l_linenumber AS call, min((l_shipdate + INTERVAL 3 DAY, l_returnflag)) AS x FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1),
    s AS (SELECT l_orderkey AS turn, l_orderkey * 10 + l_linenumber AS call, x[1] AS end_at, x[2] AS end_status FROM lineitem l LEFT JOIN e ON e.call = l.l_orderkey * 10 + l.l_linenumber),
    t AS (SELECT o_orderkey AS turn, o_orderdate + INTERVAL 90 DAY AS turn_end, CASE o_orderstatus WHEN 'O' THEN 'completed' WHEN 'F' THEN 'failed' ELSE 'aborted' END AS turn_status FROM orders)
    SELECT s.call, CASE WHEN end_at IS NULL THEN CASE WHEN turn_status = 'completed' THEN 'cancelled' ELSE coalesce(turn_status, 'running') END ELSE end_status END AS status, coalesce(end_at, turn_end) AS closed_at FROM s LEFT JOIN t ON s.turn = t.turn""",
)
def lifecycle_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as calls of the turn that is their order; some never end by themselves."""
    l, o = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    call = (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("call")
    starts = l.select(F.col("l_orderkey").alias("turn"), call, F.col("l_shipdate").alias("started"))
    ends = l.where("l_returnflag <> 'N'").select(call, F.expr("l_shipdate + interval 3 day").alias("at"), F.col("l_returnflag").alias("status"))
    state = F.when(F.col("o_orderstatus") == "O", "completed").when(F.col("o_orderstatus") == "F", "failed").otherwise("aborted")
    turns = o.select(F.col("o_orderkey").alias("turn"), F.expr("o_orderdate + interval 90 day").alias("end_at"), state.alias("end_status"))
    return lifecycle.closed_by_turn(lifecycle.spans(starts, ends, "call", "at"), turns).select("call", "status", "closed_at")


@query(
    "job_transitions",
    """WITH RECURSIVE l AS (SELECT l_orderkey AS item, ['running', 'completed', 'failed', 'running'][l_linenumber % 4 + 1] AS t, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, ['running', 'completed', 'failed', 'running'][l_linenumber % 4 + 1]) AS n FROM lineitem),
    s AS (SELECT item, CAST(0 AS BIGINT) AS n, 'pending' AS state, 0 AS attempts, 0 AS rejected FROM l WHERE n = 1
      UNION ALL SELECT s.item, l.n, CASE WHEN ok THEN l.t ELSE s.state END, s.attempts + CASE WHEN ok AND l.t = 'running' THEN 1 ELSE 0 END, s.rejected + CASE WHEN ok THEN 0 ELSE 1 END
      FROM s JOIN l ON l.item = s.item AND l.n = s.n + 1, LATERAL (SELECT (s.state IN ('pending', 'failed') AND l.t = 'running') OR (s.state = 'running' AND l.t IN ('completed', 'failed')) AS ok) x)
    SELECT item, state, attempts, rejected FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY n DESC) AS k FROM s) y WHERE k = 1""",
)
def job_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    to = F.element_at(F.array(*map(F.lit, ("running", "completed", "failed", "running"))), (F.col("l_linenumber") % 4 + 1).cast("int"))
    log = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("item"), F.col("l_linenumber").alias("seq"), to.alias("to"))
    return lifecycle.transitions(log, "item", "seq", {"pending": ("running",), "running": ("completed", "failed"), "failed": ("running",), "completed": ()})


_KEYS = """, k AS (SELECT trace_id AS call, list_transform(list_filter(messages, lambda x: x IS NOT NULL), lambda x: coalesce(x.role, '') || ':' || coalesce(x.content, '')) AS keys FROM trajectory WHERE len(messages) > 0),
    c AS (SELECT call, keys, list_position(list_transform(keys, lambda x: starts_with(x, 'assistant:')), true) AS p FROM k)"""


@query(
    "message_tree_thread_id",
    "WITH z AS (SELECT 1)" + _KEYS + " SELECT call, 't' || substr(sha256(array_to_string(CASE WHEN coalesce(p, 0) > 0 THEN keys[1:p] ELSE keys END, chr(31))), 1, 12) AS thread, coalesce(p, 0) = 0 AS provisional FROM c",
)
def message_tree_thread_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lifecycle.message_thread_ids(_calls(spark, sf_dir))


def _calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = lambda m: F.concat(F.coalesce(m["role"], F.lit("")), F.lit(":"), F.coalesce(m["content"], F.lit("")))
    return table(spark, sf_dir, "trajectory").where(F.size("messages") > 0).select(F.col("trace_id").alias("call"), F.transform(F.filter("messages", lambda m: m.isNotNull()), key).alias("keys"))


@query(
    "provisional_threads",
    "WITH z AS (SELECT 1)" + _KEYS + """, a AS (SELECT 't' || substr(sha256(array_to_string(keys[1:p], chr(31))), 1, 12) AS thread, keys FROM c WHERE coalesce(p, 0) > 0), o AS (SELECT call, keys FROM c WHERE coalesce(p, 0) = 0)
    SELECT call, CASE WHEN count(DISTINCT thread) = 1 THEN min(thread) END AS resolved FROM o LEFT JOIN a ON len(o.keys) <= len(a.keys) AND array_to_string(a.keys[1:len(o.keys)], chr(31)) = array_to_string(o.keys, chr(31)) GROUP BY 1""",
)
def provisional_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls = _calls(spark, sf_dir)
    return lifecycle.resolve_provisional(calls, lifecycle.message_thread_ids(calls))


@query(
    "replay_legs",
    """WITH v AS (SELECT l_orderkey, max(l_returnflag = 'R') AS hint, max(l_linestatus = 'F') AS base, max(CASE WHEN l_quantity > 25 THEN l_tax > 0.04 END) AS placebo, max(l_discount > 0.09) AS treated FROM lineitem GROUP BY 1)
    SELECT l_orderkey, CASE WHEN hint AND base AND NOT treated AND coalesce(placebo, false) THEN 'isolated' WHEN hint AND base AND NOT treated AND coalesce(NOT placebo, false) THEN 'confounded' WHEN hint AND base AND NOT treated THEN 'passed' WHEN base THEN 'reproduced' ELSE 'note' END AS leg FROM v""",
)
def replay_legs(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        F.max(F.col("l_returnflag") == "R").alias("hint"), F.max(F.col("l_linestatus") == "F").alias("base"),
        F.max(F.when(F.col("l_quantity") > 25, F.col("l_tax") > 0.04)).alias("placebo"), F.max(F.col("l_discount") > 0.09).alias("treated"),
    )
    return v.select("l_orderkey", trajectories.legs(F.col("hint"), F.col("base"), F.col("placebo"), F.col("treated")).alias("leg"))
