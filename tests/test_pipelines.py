"""Prompted calls, corrections, event logs and states."""

import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from threadloom import session
from threadloom.operators import folds, packs, providers, reduction, segments
from threadloom.operators.providers import TASKS, RuleModel, asked, called
from threadloom.sources import logs


class Flaky:
    """Fails, then answers badly, then well."""

    def __init__(self):
        self.answers = itertools.chain([RuntimeError("down"), "perhaps"], itertools.repeat("Yes."))

    def complete(self, prompt):
        answer = next(self.answers)
        if isinstance(answer, Exception):
            raise answer
        return answer


def test_calls_are_repeated_and_fall_back():
    task = providers.Task("{text}", providers.one_label(("YES", "NO")), retries=2)
    assert called(task, Flaky(), "x") == ("YES", None, 3)
    value, error, n = called(TASKS["verify"], Flaky(), "x")
    assert value is None and "none of" in error and n == 2
    assert called(TASKS["outcome"], RuleModel([], "?"), "x")[0] == "unknown"
    assert called(TASKS["distil"], RuleModel([("Not accepted", "check it")], "use 42"), "x", lambda v: providers.repeats_numbers(v, "42 rows")) == ("check it", None, 2)
    assert called(TASKS["distil"], RuleModel([], "use 42"), "x", lambda v: providers.repeats_numbers(v, "42 rows")) == (None, "repeats 42", 3)


def test_answers_are_read():
    assert providers.json_objects('```json\n[{"a": 1}, 2]\n```') == [{"a": 1}]
    assert providers.json_objects('first {"a": {"b": 1}} then {"c": 2}\n{broken\nnone') == [{"a": {"b": 1}}, {"c": 2}]
    assert providers.one_number("It is number 12.") == "12" and providers.one_number("a new one") == "new"
    assert providers.some_text("```py\nx = 1\n```") == "x = 1" and providers.some_text("a ```b``` c") == "a ```b``` c"
    for read, answer in ((providers.some_text, " \n"), (providers.one_number, "none")):
        with pytest.raises(ValueError):
            read(answer)


def test_rows_keep_their_place_when_calls_fail(spark):
    rows = spark.createDataFrame([(1, "x", 9), (2, "x", 9), (3, None, 9), (4, "", 9)], "i int, t string, answer_old int")
    out = {r.i: (r.answer, r.answer_error is None) for r in asked(rows, "t", TASKS["verify"], RuleModel([("x", "yes")], "?")).collect()}
    assert out == {1: ("YES", True), 2: ("YES", True), 3: (None, True), 4: (None, False)}
    assert asked(rows.limit(0), "t", TASKS["verify"], RuleModel([])).count() == 0


def test_quotes_find_every_text_that_holds_them(spark):
    texts = ["abcdefghijklmnop", "xxabcdefghijklmno", "abcd", "zabcdz", "", None, "aaaaaaaaaaaaaaaa"]
    quotes = ["abcdefghijklm", "abcd", "abc", "aaaa", "aaaaaaaaaaaaa", "nopq", None]
    q = spark.createDataFrame([("t", x) for x in quotes], "thread string, q string")
    t = spark.createDataFrame([("t", x, i) for i, x in enumerate(texts)] + [("u", texts[0], 99)], "thread string, flat string, i int")
    got = sorted((r.q, r.i) for r in packs.quoted_in(q, t, ["thread"]).collect())
    assert got == sorted((x, i) for x in quotes if x and len(x) >= 4 for i, y in enumerate(texts) if y and x in y)


def test_pieces_are_found_once_per_text(spark):
    texts = ["abcdefghijklmnop", "xabcdefghijklmx abcdefghijklm", "abcd abcd", "", None, "aaaaaaaaaaaaaaaa", "日本語の文章です"]
    quotes = ["abcdefghijklm", "abcdefghijklmn", "abcd", "abc", "aaaa", "aaaaaaaaaaaaa", "語の文章", None, "abcd"]
    q, t = spark.createDataFrame([(x,) for x in quotes], "q string"), spark.createDataFrame(list(enumerate(texts)), "i int, flat string")
    want = sorted({(x, i) for x in quotes if x and len(x) >= 4 for i, y in enumerate(texts) if y and x in y})
    for limit in (1 << 20, packs.ENTRY_BYTES):
        assert sorted((r.q, r.i) for r in packs.pieces(q, t, limit=limit).collect()) == want
    first = packs.pieces(q, t, start=True)
    assert sorted((r.q, r.i) for r in first.collect()) == [(x, i) for x, i in want if texts[i].startswith(x)]


def test_many_equal_quotes_meet_many_equal_texts(spark):
    n = 20_000
    rows = spark.range(n).select(F.concat(F.lit("b"), "id").alias("id"), F.lit("bot").alias("role"), F.lit("it is done").alias("text"), (F.col("id") * 2).alias("ts_us"), F.lit("t").alias("thread"))
    rows = rows.unionByName(spark.range(n).select(F.concat(F.lit("c"), "id").alias("id"), F.lit("user").alias("role"), F.lit("no").alias("text"), (F.col("id") * 2 + 1).alias("ts_us"), F.lit("t").alias("thread")))
    asked = spark.range(n).select(F.lit("x").alias("anchor"), F.concat(F.lit("c"), "id").alias("corrector"), F.lit("t").alias("thread"), F.lit("it is done").alias("quote"))
    found = packs.reanchored_by_quote(asked, rows, F.col("role") == "bot")
    assert found.where(F.col("moved") & (F.substring("anchor", 2, 9) == F.substring("corrector", 2, 9))).count() == n


def test_anchor_is_the_latest_before_the_corrector(spark):
    rows = spark.createDataFrame([("a", "bot", "it is done", 1, "t"), ("b", "bot", "it  is done now", 2, "t"), ("c", "user", "no, it is done", 3, "t"), ("d", "bot", "it is done", 4, "t"), ("e", "bot", "it is done", 2, "u")], "id string, role string, text string, ts_us bigint, thread string")
    make = lambda *r: spark.createDataFrame(list(r), "anchor string, corrector string, thread string, quote string")
    found = packs.reanchored_by_quote(make(("x", "c", "t", "it is done"), ("x", "gone", "t", "is done"), ("x", "c", "t", "it"), (None, "c", "t", "never said")), rows, F.col("role") == "bot")
    got = {(r.quote): (r.anchor, r.moved) for r in found.collect()}
    assert got == {"it is done": ("b", True), "is done": ("d", True), "it": ("x", False), "never said": (None, False)}
    again = packs.reanchored_by_quote(found.select("anchor", "corrector", "thread", "quote"), rows, F.col("role") == "bot")
    assert {r.quote: r.anchor for r in again.collect()} == {k: v[0] for k, v in got.items()}


def test_many_requests_and_texts_that_begin_alike(spark):
    n = 20_000
    text = lambda c: F.concat(F.lit("Please run the export now, number "), F.lpad(c.cast("string"), 6, "0"))
    rows = spark.range(n).select(F.concat(F.lit("m"), "id").alias("id"), text(F.col("id")).alias("text"))
    asked = spark.range(n).select("id", F.lit(None).cast("string").alias("t0"), text(F.col("id")).alias("text")).withColumnRenamed("id", "key")
    found = packs.t0_lookup(asked, rows.unionByName(rows.where("id = 'm7'").withColumn("id", F.lit("again"))))
    got = {r.how: r.n for r in found.groupBy(F.when(F.concat(F.lit("m"), "key") == F.col("found"), "own").otherwise(F.col("how")).alias("how")).agg(F.count("*").alias("n")).collect()}
    assert got == {"own": n - 1, "ambiguous": 1}


def test_whole_texts_are_looked_up(spark):
    long, end = "Lange Wörter, 長い文章. " * 10_000, "and then export the ledger"
    rows = [("m1", "x" * 900 + " first end"), ("m2", "x" * 900 + " second end"), ("m3", long + end), ("m4", long), ("m5", "tiny part")]
    asked = [("1", "x" * 900 + " second end"), ("2", "Export the ledger"), ("3", "second end"), ("4", "y" * 1000 + " tiny part, and more"), ("5", "x" * 900), ("6", "x" * 900 + " third end")]
    asked = spark.createDataFrame([(k, None, t) for k, t in asked], "key string, t0 string, text string")
    got = {r.key: (r.found, r.how) for r in packs.t0_lookup(asked, spark.createDataFrame(rows, "id string, text string")).collect()}
    assert got == {"1": ("m2", "text"), "2": ("m3", "text"), "3": ("m2", "text"), "4": ("m5", "text"), "5": (None, "ambiguous"), "6": (None, "missing")}


def test_lines_of_a_sheet_are_resolved_by_their_card(spark):
    rows = spark.createDataFrame([("m1", "Ann", "please run the export", 1), ("m2", "Bot", "the export ran", 2), ("m8", "Ann", "please run the export", 8), ("m9", "Bot", "another answer here", 9), ("s1", "Cy", "the same words", 3), ("s2", "Cy", "the same words", 1)], "id string, name string, flat string, pos bigint")
    sheet = spark.createDataFrame([(1, "intro\n## Card 1\nT0 [user/Ann] please run the export\nB [bot/Bot] the export ran\nC [user/Cy] the same words\n## Card 2\nT0 [user/Ann] please run\nB [bot/Bot] another answer\nL9 [x/Nobody] nothing\nL8 [x/Ann] ⋯ cut")], "sheet int, text string")
    got = {(r.card, r.label): (r.id, r.status) for r in packs.resolved_lines(packs.review_lines(sheet), rows).collect()}
    assert got == {(1, "T0"): ("m1", "nearest"), (1, "B"): ("m2", "ok"), (1, "C"): (None, "ambiguous"), (2, "T0"): ("m8", "nearest"), (2, "B"): ("m9", "ok"), (2, "L9"): (None, "missing")}


def test_lines_take_the_nearest_row_as_a_search_of_all_rows_does(spark):
    dice = random.Random(5)
    rows = [(f"r{i}", dice.choice(["A", "B"]), dice.choice(["the first text", "the first", "another line", f"sure line {i:03d}", "tiny"]), dice.randrange(40)) for i in range(120)]
    lines = [(s, c, f"L{k}", r[1], r[2][: dice.choice([6, 9, 99])]) for s in range(30) for c in (1, 2) for k, r in enumerate(dice.choices(rows, k=4))]
    want = {}
    hits = {x[:3]: [r for r in rows if r[1] == x[3] and len(x[4]) >= 4 and r[2].startswith(x[4])] for x in lines}
    for key, found in hits.items():
        near = [h[0][3] for k, h in hits.items() if k[:2] == key[:2] and len(h) == 1]
        away = sorted((max(min(near) - r[3], r[3] - max(near), 0), r[0]) for r in found) if near else []
        nearest = away[0][1] if away and (len(away) == 1 or away[1][0] > away[0][0]) else None
        want[key] = (None, "missing") if not found else (found[0][0], "ok") if len(found) == 1 else (nearest, "nearest" if nearest else "ambiguous")
    got = packs.resolved_lines(spark.createDataFrame(lines, "sheet int, card int, label string, name string, prefix string"), spark.createDataFrame(rows, "id string, name string, flat string, pos bigint"))
    assert {(r.sheet, r.card, r.label): (r.id, r.status) for r in got.collect()} == want
    assert {s for _, s in want.values()} >= {"ok", "nearest", "ambiguous"}


def test_secrets_found_once_are_replaced_everywhere(spark):
    rows = spark.createDataFrame([(1, "key=hunter2 here", None), (2, "say hunter2 or hunter22", "hunter2"), (3, None, None)], "k int, a string, b string")
    got = {r.k: r for r in packs.scrubbed(rows, "k", ["a", "b"], r"key=(\w+)", r"\w+").collect()}
    assert "hunter2" not in got[1].a and got[2].a.endswith("or hunter22") is False and got[2].b.startswith("<SECRET_") and got[2].n_hits == 2
    assert got[3].a is None and got[3].n_hits == 0 and got[1].a.split("=")[1].split()[0] == got[2].b


RAW = "rollout_id string, seq bigint, schema_version int, kind string, ref string, thread_id string, turn_id string, status string, call string"


def raw(spark, *rows):
    return spark.createDataFrame([(r[0], r[1], 1, r[2], r[3], "t", None, r[4] if len(r) > 4 else None, r[5] if len(r) > 5 else None) for r in rows], RAW)


def test_event_logs_become_entities(spark):
    log = raw(spark, ("r", 1, "inference_started", "i"), ("r", 2, "tool_call_started", "c"), ("r", 3, "inference_cancelled", "i"), ("r", 4, "tool_call_ended", "c", "failed"), ("r", 5, "tool_call_started", "d"), ("r", 6, "other", None), ("r", 7, "agent_turn_started", "u"), ("r", 8, "turn_ended", "u", "completed"))
    got = {(r.entity, r.ref): (r.started_seq, r.ended_seq, r.status) for r in reduction.reduced(log).collect()}
    assert got == {("inference", "i"): (1, 3, "cancelled"), ("tool_call", "c"): (2, 4, "failed"), ("tool_call", "d"): (5, None, "running"), ("turn", "u"): (7, 8, "completed")}
    assert len(reduction.KINDS) == 25 and reduction.reduced(log.limit(0)).count() == 0


def test_logs_that_cannot_be_replayed_are_refused(spark):
    bad = raw(spark, ("r", 1, "tool_call_ended", "c"), ("r", 1, "tool_call_started", "c"), ("r", 3, "tool_call_started", "c"), ("r", 4, "thread_ended", "t"), ("r", 5, "reboot", None))
    assert {r.fault: r.n for r in reduction.faults(bad).collect()} == {"seq_twice": 1, "started_twice": 1, "never_started": 1, "unknown_kind": 1}
    with pytest.raises(ValueError, match="never_started"):
        reduction.reduced(bad)


def test_code_cells_wait_for_their_item(spark):
    log = raw(spark, ("r", 5, "code_cell_started", "x", None, "k1"), ("r", 6, "code_cell_initial_response", "x", "yielded"), ("r", 9, "code_cell_ended", "x", "completed"), ("r", 7, "code_cell_started", "y", None, "k2"), ("r", 8, "code_cell_started", "z", None, "gone"))
    items = spark.createDataFrame([("k1", 8), ("k2", 3)], "call string, seq bigint")
    got = {r.cell: (r.visible_seq, r.n_responses, r.status) for r in reduction.code_cells(log, items).collect()}
    assert got == {"x": (8, 2, "completed"), "y": (7, 0, "running"), "z": (None, 0, "pending")}


def test_ids_take_the_next_free_suffix(spark):
    names = ["a", "a", "a-2", "a", "b", "b", "a-2", " ", "row-8", None, "a-3", "c-2"]
    seen, want = set(), []
    for n, name in enumerate(names, 1):
        base = name if name and name.strip() else f"row-{n}"
        one, k = base, 2
        while one in seen:
            one, k = f"{base}-{k}", k + 1
        seen.add(one)
        want.append(one)
    df = spark.createDataFrame(list(enumerate(names, 1)), "i int, n string")
    got = [r.unique_id for r in segments.unique_ids(df, "n", ["i"]).orderBy("i").collect()]
    assert got == want and len(set(got)) == len(names)


def test_items_keep_their_ids_over_a_compaction(spark):
    rows = [("k", 1, 0, "s"), ("k", 1, 1, "a"), ("k", 1, 2, "a"), ("k", 2, 0, "summary"), ("k", 2, 1, "a"), ("k", 3, 0, "summary"), ("k", 3, 1, "a"), ("k", 3, 2, "new")]
    got = [(r.snapshot, r.idx, r.item_id) for r in folds.reconciled_items(spark.createDataFrame(rows, "key string, snapshot bigint, idx bigint, item string"), "key").orderBy("snapshot", "idx").collect()]
    assert got == [(1, 0, 0), (1, 1, 1), (1, 2, 2), (2, 0, 3), (2, 1, 1), (3, 0, 3), (3, 1, 1), (3, 2, 4)]


def test_states_exports_and_missing_files(spark, tmp_path):
    path = f"file://{tmp_path}"
    assert logs.read_tolerant(spark, f"{path}/none.jsonl", "a int").count() == 0
    (tmp_path / "x.jsonl").write_text('{"a":1}\n{broken\n\n{"a":2}\n')
    assert sorted(r.a for r in logs.read_tolerant(spark, f"{path}/x.jsonl", "a int").collect()) == [1, 2]
    state = spark.createDataFrame([(1, "x")], "b int, a string")
    assert logs.read_state(spark, f"{path}/state", "a string, b int").count() == 0
    assert [logs.write_state(state, f"{path}/state") for _ in range(2)] == [0, 1]
    (tmp_path / "state" / "2").mkdir()  # never finished
    assert [tuple(r) for r in logs.read_state(spark, f"{path}/state", "a string, b int").collect()] == [("x", 1)]
    tasks = spark.createDataFrame([("t1", "One", "done"), ("t2", None, "open")], "task string, title string, status string")
    members = spark.createDataFrame([("t1", 2, "bot", "yes\nok"), ("t1", 1, "user", "hi")], "task string, pos int, role string, text string")
    logs.export_tasks(tasks, members, f"{path}/out")
    assert next((tmp_path / "out" / "texts" / "task=t1").glob("*.txt")).read_text() == "# One\n\n- [user] hi\n- [bot] yes ok\n"
    assert {r.task: r.n_members for r in spark.read.json(f"{path}/out/index").collect()} == {"t1": 2, "t2": 0}
    (tmp_path / "wire" / "id7").mkdir(parents=True)
    (tmp_path / "wire" / "id7" / "log.jsonl").write_bytes(b'{"m":"a\xffb"}\nno\n')
    rows, bad = logs.read_wire(spark, f"{path}/wire/*/*.jsonl", "m string")
    assert [tuple(r) for r in rows.collect()] == [("a�b", "id7")] and bad.first().n_bad_lines == 1
    h = spark.createDataFrame([(1, 0, "x"), (1, 1, "y")], "log_id int, pos int, text string")
    assert logs.history_at(h, 1, 1).first().text == "y" and logs.history_at(h, 2, 0).count() == 0


def test_job_rows_have_the_columns_of_the_job(spark):
    rows = spark.createDataFrame([(0, "a", "mine"), (1, "b", None)], "row_index int, name string, status string")
    items = spark.createDataFrame([("j", "a", 0, None, "completed", 1, None, json.dumps({"x": 1}), 1_700_000_000_000_000, None), ("j", "b", 1, "s", "failed", 2, "E", None, None, None)], "job_id string, item_id string, row_index int, source_id string, status string, attempt_count int, last_error string, result_json string, reported_at bigint, completed_at bigint")
    out = logs.job_rows(rows, items)
    assert out.columns == ["row_index", "name", "status", "job_id", "item_id", "source_id", "job_status", "attempt_count", "last_error", "result_json", "reported_at", "completed_at"]
    assert {r.row_index: (r.status, r.job_status, r.reported_at) for r in out.collect()} == {0: ("mine", "completed", "2023-11-14T22:13:20.000000Z"), 1: (None, "failed", None)}


class _Named:
    class conf:  # noqa: N801
        @staticmethod
        def get(name, default=None):
            return {"spark.master": "spark://x:7077"}.get(name, default)


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_dir(_Named)
