"""Queries over every row: nothing is left out for its script, its number or its place."""

import json
import unicodedata

import pytest
from helpers import SMALL
from pyspark.sql import functions as F

import __spark_entry__  # noqa: F401 - registers all queries
from threadloom.functions import text as T
from threadloom.operators import replies, samples, shredding, similarity
from threadloom.plans import core, flows

TEXTS = [
    "Why does the build fail on the second machine?", "Warum schlägt der Aufbau auf Gerät Ä-7 ständig fehl? Größe: 12 m²", "¿Por qué falla la compilación de mañana según el señor Núñez?",
    "请问为什么第二台机器上的构建总是失败，而第一台机器上一切正常呢？谢谢！", "हिन्दी में लिखा गया एक लम्बा वाक्य यहाँ है और वह यहीं समाप्त होता है", "kurz", "", None,
]


def brute_fingerprint(text):
    x = "".join(c for c in (text or "").lower() if unicodedata.category(c)[0] in "LN")
    return x[:180] if len(x) >= 20 else ""


def test_fingerprints_in_all_languages(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i int, t string")
    got = {r.i: r.fp for r in df.select("i", T.fingerprint(F.col("t")).alias("fp")).collect()}
    assert got == {i: brute_fingerprint(t) for i, t in enumerate(TEXTS)}
    assert all(got[i] for i in range(5))


def test_every_document_has_a_fingerprint(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    got = {r.doc_id: r.fp for r in core.QUERIES["text_fingerprint"](spark, SMALL).collect()}
    assert got == {i: brute_fingerprint(t) for i, t in docs.items()}


def test_requests_in_all_languages_are_judged(spark, monkeypatch):
    asked = ["Bitte öffne die Datei", "麻烦看一下", "为什么失败", "请问为什么失败", "¿Por qué?", "Größe?", "somewhat", None]
    rows = spark.createDataFrame([(str(i), "user", t) for i, t in enumerate(asked)], "id string, role string, text string")
    monkeypatch.setattr(flows, "messages", lambda *_: rows)
    got = {int(r.id): r.verdict for r in flows.judged_requests(spark, "").collect()}
    assert [got[i] for i in range(len(asked))] == ["exec", "exec", "qa", "qa", "qa", "unknown", "unknown", None]


def test_every_user_message_is_an_anchor(spark):
    rows = flows.threaded(spark, SMALL).select("id", "role", "thread", "ts_us", "row_id").toPandas().sort_values(["ts_us", "row_id"])
    lanes, windows, before = {}, set(), {}
    for r in rows.itertuples():
        lanes.setdefault(r.thread, []).append((r.id, r.role in T.USER_ROLES))
    for lane in lanes.values():
        for at, (anchor, is_user) in enumerate(lane):
            if is_user:
                windows |= {(anchor, lane[p][0], p - at) for p in range(max(0, at - 3), min(len(lane), at + 3))}
                before[anchor] = (min(at, 80), max(1, at - 79) if at else None)
    assert {tuple(r) for r in core.QUERIES["context_window_range"](spark, SMALL).select("anchor", "id", "off").collect()} == windows
    assert {r.anchor: (r.n_context, r.first_pos) for r in core.QUERIES["context_before"](spark, SMALL).collect()} == before


def leaves(value, path="", name=None):
    """(path, text) of every plain value, by recursion; as member text is read, so here."""
    value = shredding._structure(name, value)
    if isinstance(value, dict):
        for k, x in value.items():
            yield from leaves(x, f"{path}.{k}" if path else k, k)
    elif isinstance(value, list):
        for i, x in enumerate(value):
            yield from leaves(x, f"{path}[{i}]")
    elif value is not None:
        yield path, value if isinstance(value, str) else json.dumps(value)


def rebuilt(child_path, members):
    prefix = "" if child_path == "$" else child_path
    return {(prefix if k == "$value" else f"{prefix}.{k}" if prefix else k, v) for k, v in members.items()}


def test_tables_hold_records_and_plain_values():
    records = [{"type": "x", "n": {"k": 1}, "x": [{"y": ["a", None, 2, {"z": 1}, ["deep"]]}, "b"], "arguments": '{"any_of": ["p", "q"]}'}, ["top", {"m": True}], None, {}]
    want = [(i, p, v) for i, r in enumerate(records) for p, v in leaves(json.loads(json.dumps(r)))]
    found = [(int(i), p, v) for _, at, paths, _, members in shredding.tables(json.loads(json.dumps(records)), True) for i, path, m in zip(at, paths, members, strict=True) for p, v in rebuilt(path, m)]
    assert sorted(found) == sorted(want)


def test_tables_give_back_every_leaf(spark):
    items, traces = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("thread_items", "trajectory"))
    plain = lambda v: v.asDict(recursive=True) if hasattr(v, "asDict") else [plain(x) for x in v] if isinstance(v, list) else v
    want = {("thread_items", r.k, p, v) for r in items.select(shredding.item_key().alias("k"), "item_json").collect() for p, v in leaves(shredding.parse_item(r.item_json))}
    want |= {("trajectory", r.trace_id, p, v) for r in traces.select("trace_id", "steps", "messages").collect() for p, v in leaves({"steps": plain(r.steps), "messages": plain(r.messages)})}
    rows = core.QUERIES["p3_tables"](spark, SMALL).collect()
    assert {(r.table_name, r.owner_key, p, v) for r in rows for p, v in rebuilt(r.child_path, json.loads(r.members))} == want
    paths = {(r.table_name, r.owner_key, r.child_path) for r in rows}
    assert all(r.parent_path is None or (r.table_name, r.owner_key, r.parent_path) in paths for r in rows if not r.child_path.startswith("["))


def test_links_keep_their_ids(spark):
    rows = [(0, [1.0, 0.0], 1), (1, [1.0, 0.1], 1), (300, [0.9, 0.1], 2), (301, [0.0, 1.0], 1), (302, None, 1), (303, [1.0, 1.0], None), (5, [0.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "i int, v array<float>, l int")
    found = similarity.similar_pairs(df, "i", "v", "l", 0.8).collect()
    assert {(r.query, r.vec_id): (r.same, r.adjacent) for r in found} == {(0, 1): (True, True), (0, 300): (False, False), (300, 0): (False, False), (300, 1): (False, False)}
    assert {r.query: r.vec_id for r in similarity.nearest(df, "i", "v", "l").collect()} == {0: 1, 300: 1}
    (r,) = similarity.recall_by_threshold(df, "i", "v", "l", (0.8,)).collect()
    assert (r.n_wanted, r.n_recalled, r.n_above, r.n_hit, r.n_crossed, r.recall) == (2, 0, 4, 1, 3, 0.0)
    hard = [(r.kind, r.query, r.vec_id) for r in similarity.hardest_pairs(df, "i", "v", "l", 1).collect()]
    assert hard == [("crossed", 300, 1), ("missed", 0, 5)]


def lanes_of(spark):
    rows = flows.threaded(spark, SMALL).select("thread", "ts_us", "row_id", "role", "name", "text").collect()
    lanes = {}
    for r in sorted(rows, key=lambda r: (r.ts_us, r.row_id)):
        lanes.setdefault(r.thread, []).append(r)
    return lanes


def test_context_has_eighty_rows(spark):
    want = {}
    for thread, lane in lanes_of(spark).items():
        want[thread] = "\n".join(f"M{i} [{r.role or ''}/{r.name or ''}] {r.text}" for i, r in enumerate(lane[-80:], 1) if r.text), min(len(lane), 80)
    got = {r.thread: (r.context, r.n_rows) for r in core.QUERIES["rendered_context"](spark, SMALL).collect()}
    assert got == want and max(n for _, n in want.values()) > 20


def test_windows_have_twenty_thousand_characters(spark):
    want = []
    for thread, lane in lanes_of(spark).items():
        window, held, sizes = 0, [], [len(r.text or "") for r in lane]
        for pos, n in enumerate(sizes):
            if held and sum(sizes[p] for p in held) + n > 20_000:
                window, held = window + 1, held[-8:]
                want += [(thread, p, window) for p in held]
            held.append(pos)
            want.append((thread, pos, window))
    got = [(r.thread, r.pos, r.window) for r in core.QUERIES["char_windows"](spark, SMALL).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_descendants_have_no_depth_limit(spark):
    spawn = spark.createDataFrame([(str(i), str(i + 1)) for i in range(68)], "parent string, child string")
    top = spark.createDataFrame([("0",)], "id string")
    assert sorted((int(r.id), r.depth) for r in replies.descendants(spawn, top).collect()) == [(i, i) for i in range(1, 69)]


def test_a_cycle_of_descendants_is_an_error(spark):
    spawn = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d"), ("d", "b")], "parent string, child string")
    with pytest.raises(ValueError, match="cycle"):
        replies.descendants(spawn, spark.createDataFrame([("a",)], "id string"))


def test_long_lines_differ_by_their_end(spark):
    diff = "diff --git a/x b/x\n--- a/x\n+++ b/x\n@@ -0,0 +1,2 @@\n+" + "y" * 100_000 + "1\n+" + "y" * 100_000 + "2"
    (r,) = samples.diff_lines(spark.createDataFrame([(1, diff)], "i int, d string"), "i", "d").collect()
    assert len(set(r.fingerprints)) == 2
