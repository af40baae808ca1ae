import json

from pyspark.sql import functions as F

from threadloom.operators import jobs
from threadloom.sources import sessions as S


def lines(*rows):
    return "\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows) + "\n"


def test_session_ids(spark):
    u = "session_" + "a" * 8 + "-bbbb-cccc-dddd-" + "e" * 12
    df = spark.createDataFrame([('{"session_id":"s1"}',), (f"user_{u}",), ("none",), (None,)], "u string")
    assert [r[0] for r in df.select(S.session_id(F.col("u"))).collect()] == ["s1", u.removeprefix("session_"), None, None]


def test_content_forms(spark):
    df = spark.createDataFrame([('"plain"',), ('[{"type":"t","text":"a"},{"type":"i"},{"type":"t","text":"b"}]',), ("bare",), (None,)], "c string")
    assert [r[0] for r in df.select(S.content_text(F.col("c"))).collect()] == ["plain", "a\nb", "bare", None]


def test_response_items(spark):
    items = [{"type": "message", "role": "assistant", "content": [{"type": "t", "text": "hi"}]}, {"type": "reasoning"}, {"type": "function_call", "name": "f", "arguments": "{}"}, {"type": "function_call_output", "output": "ok"}, {"type": "odd"}]
    df = spark.createDataFrame([("c", i, json.dumps(x)) for i, x in enumerate(items)], "call string, pos int, item string")
    got = [(r.pos, r.role, r.name, r.content) for r in S.response_items(df).orderBy("pos").collect()]
    assert got == [(0, "assistant", None, "hi"), (2, "assistant", "f", "{}"), (3, "tool", None, "ok"), (4, "system", None, '{"type": "odd"}')]


def test_rollouts(spark, tmp_path):
    (tmp_path / "2025" / "06").mkdir(parents=True)
    (tmp_path / "2025" / "06" / "r.jsonl").write_text(
        lines({"timestamp": "1", "type": "session_meta", "payload": {"id": "t1", "model": "m0"}}, "{bad", {"timestamp": "2", "type": "user_message", "payload": {"message": "do it"}}, {"timestamp": "3", "type": "turn", "payload": {"model": "m1"}})
    )
    (r,) = S.read_rollouts(spark, f"file://{tmp_path}").collect()
    assert (r.thread_id, r.n_lines, r.n_bad, r.first_user_message, r.last_model) == ("t1", 4, 1, "do it", "m1")


def test_bundles(spark, tmp_path):
    (tmp_path / "payloads").mkdir()
    (tmp_path / "manifest.json").write_text('{"version": 1}')
    (tmp_path / "trace.jsonl").write_text(lines({"seq": 1, "kind": "a", "payload_ref": "p1"}, {"seq": 2, "kind": "b"}))
    (tmp_path / "payloads" / "p1.json").write_text('{"x": 1}')
    manifest, events = S.read_bundle(spark, f"file://{tmp_path}")
    assert manifest.first().version == 1
    assert [(r.seq, r.payload) for r in events.orderBy("seq").collect()] == [(1, '{"x": 1}'), (2, None)]


def test_foreign_sessions(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text(lines({"cwd": "/w", "timestamp": "1", "message": {"role": "user", "content": "hello"}}, {"timestamp": "2", "aiTitle": "made"}, {"timestamp": "3", "customTitle": "own"}))
    (tmp_path / "b.jsonl").write_text(lines({"timestamp": "1", "message": {"role": "user", "content": "no folder"}}))
    assert [(r.cwd, r.title, r.last_at) for r in S.summarised_sessions(spark, f"file://{tmp_path}").collect()] == [("/w", "own", "3")]


def test_notes_and_sections(spark):
    df = spark.createDataFrame([(1, "Accept. T0: m1 B：m2 C: m3")], "i int, t string")
    (r,) = S.adjudications(df, "i", "t").collect()
    assert r.accepted and r.labels == {"T0": "m1", "B": "m2", "C": "m3"}
    doc = spark.createDataFrame([(1, "intro\n# A\nx\n## B\ny")], "i int, t string")
    assert [(r.section, r.heading, r.body) for r in S.sections(doc, "i", "t").collect()] == [(0, "", "intro\n"), (1, "A", "x\n"), (2, "B", "y")]


def test_small_joins(spark):
    s = spark.createDataFrame([("s",), ("t",)], "session string")
    caps = spark.createDataFrame([("s", 2, "b"), ("s", 1, "a")], "session string, ts int, prompt string")
    assert {r.session: (r.prompt, r.variants) for r in jobs.with_captures(s, caps).collect()} == {"s": ("a", ["a", "b"]), "t": (None, None)}
    files = spark.createDataFrame([("s", "/b"), ("s", "/a")], "session string, path string")
    assert {r.session: r.path for r in jobs.with_transcript(s, files).collect()} == {"s": "/a", "t": None}
    df = spark.createDataFrame([("/stop q12",), ("please stop q1",), (None,)], "t string")
    assert [r[0] for r in df.select(jobs.control_target(F.col("t"))).collect()] == [12, None, None]
    spawns = spark.createDataFrame([("p", "c"), ("p", "d")], "parent string, child string")
    items = spark.createDataFrame([("c", 2, "i2"), ("c", 1, "i1")], "thread string, pos int, item string")
    assert {r.child: r.target for r in jobs.interaction_edges(spawns, items).collect()} == {"c": "i1", "d": "thread:d"}
