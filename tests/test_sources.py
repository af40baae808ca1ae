import gzip
import json

import pytest
from pyspark.sql import functions as F

from threadloom.sources import logs
from threadloom.streaming import landing
from threadloom.streaming.incremental import IncrementalSegments, freezable, unfinished


def test_dated_logs_fail_on_bad_lines(spark, tmp_path):
    (tmp_path / "2025-06-01.jsonl").write_text('{"time_ns":1,"severity":"info","body":"a"}\n\n{"time_ns":2}\n')
    (tmp_path / "2025-06-02.jsonl").write_text("{broken\n")
    assert logs.read_dated(spark, f"file://{tmp_path}", logs.LOG, "2025-06-01").count() == 2
    with pytest.raises(Exception):
        logs.read_dated(spark, f"file://{tmp_path}", logs.LOG).collect()


def test_gzip_of_several_members(spark, tmp_path):
    with open(tmp_path / "a.jsonl.gz", "wb") as f:
        for i in range(3):
            f.write(gzip.compress(json.dumps({"ts": 3.0 - i, "session_id": "s", "sha": f"h{i}", "status": 200}).encode() + b"\n"))
    calls = logs.read_calls(spark, f"file://{tmp_path}", 2)
    (r,) = logs.grouped_captures(calls).collect()
    assert [c.ts for c in r.calls] == [1.0, 2.0, 3.0] and (r.first_sha, r.n_versions) == ("h2", 3)


def test_transcripts_count_bad_lines(spark, tmp_path):
    (tmp_path / "s1.jsonl").write_text('{"type":"user","message":{"role":"user","content":"hi"}}\nnope\n{"type":"summary"}\n')
    path = f"file://{tmp_path}"
    assert [tuple(r) for r in logs.read_transcripts(spark, path).collect()] == [("s1", "user", "hi", None)]
    assert [(r.n_bad_lines, r.n_lines) for r in logs.read_lines(spark, path, "type string")[1].collect()] == [(1, 3)]
    assert [(r.line_no, r.value) for r in logs.numbered_lines(spark, path).where("line_no = 2").collect()] == [(2, "nope")]


def test_first_and_last_win(spark):
    a = spark.createDataFrame([("x", 2, "a2"), ("x", 1, "a1"), (None, 3, "n")], "k string, o int, v string")
    b = spark.createDataFrame([("x", 0, "b"), ("y", 5, "y")], "k string, o int, v string")
    assert {r.k: r.v for r in logs.first_wins([a.where("k is not null"), b], "k", "o").collect()} == {"x": "a1", "y": "y"}
    assert {r.k: r.v for r in logs.last_wins(a, "k", "o").collect()} == {"x": "a2", "ts:3": "n"}


def test_streams_of_answers(spark):
    events = [
        {"type": "message_start", "message": {"id": "m", "content": []}}, {"type": "content_block_start", "index": 0, "content_block": {"type": "text"}},
        {"type": "content_block_delta", "index": 0, "delta": {"text": "he"}}, {"type": "content_block_delta", "index": 0, "delta": {"text": "y"}}, {"type": "message_delta", "delta": {"stop_reason": "end"}},
    ]
    text = "\n".join("data: " + json.dumps(e) for e in events) + "\ndata: {broken\nevent: x"
    df = spark.createDataFrame([(1, text), (2, None)], "i int, t string")
    got = {r.i: r.message for r in logs.assembled_streams(df, "i", "t").collect()}
    assert got[2] is None and json.loads(got[1]) == {"id": "m", "stop_reason": "end", "content": [{"type": "text", "text": "hey"}]}


def test_objects_in_text(spark):
    df = spark.createDataFrame([('say ```json\n{"a": 1}\n``` ok',), ("none",), (None,)], "t string")
    assert [r[0] for r in df.select(F.try_variant_get(logs.objects_in_text(F.col("t")), "$.a", "int")).collect()] == [1, None, None]


def test_csv_jobs(spark, tmp_path):
    (tmp_path / "j.csv").write_text('﻿id,text\n1,"a ""b"", c"\n,\n2,d\n', encoding="utf-8")
    rows = logs.read_job_csv(spark, f"file://{tmp_path}/j.csv")
    assert sorted((r.id, r.text) for r in rows.collect()) == [("1", 'a "b", c'), ("2", "d")]
    logs.write_job_csv(rows.withColumn("o", F.col("id")), f"file://{tmp_path}/out", "o")
    assert sorted((r.id, r.text) for r in logs.read_job_csv(spark, next((tmp_path / "out").glob("*.csv")).as_uri()).collect()) == [("1", 'a "b", c'), ("2", "d")]
    (tmp_path / "k.csv").write_text("id,id\n1,2\n")
    with pytest.raises(ValueError):
        logs.read_job_csv(spark, f"file://{tmp_path}/k.csv")


def test_writers(spark, tmp_path):
    df = spark.createDataFrame([("s", "r", "2025-06-01", "x" * 50, 1748772000000000), ("s", "", "2025-06-01", "y", 1748772000000000)], "source string, role string, date string, text string, ts_us bigint")
    with pytest.raises(Exception):
        logs.write_guarded(df, f"file://{tmp_path}/long", 80)
    logs.write_guarded(df, f"file://{tmp_path}/fits", 500)
    logs.publish(df, f"file://{tmp_path}/published")
    logs.append_daily(df, f"file://{tmp_path}/daily", "ts_us")
    assert spark.read.json(f"file://{tmp_path}/published").count() == 1
    assert (tmp_path / "daily" / "day=2025-06-01").exists()


def test_landing_reads_each_file_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"i":1}\n{"i":2}\n')
    seen = []
    landing.drain(landing.json_stream(spark, f"file://{tmp_path}/in", "i int", 1), lambda df, epoch: seen.append((epoch, df.count())), f"file://{tmp_path}/drained")
    assert seen == [(0, 2)]
    for n in (2, 2, 3):
        if n == 3:
            (tmp_path / "in" / "b.json").write_text('{"i":3}\n')
        landing.land(landing.json_stream(spark, f"file://{tmp_path}/in", "i int"), f"file://{tmp_path}/out")
        assert spark.read.parquet(f"file://{tmp_path}/out").count() == n


def test_incremental_state(spark):
    make = lambda *r: spark.createDataFrame(list(r), "id string, parent string, thread string, ts_us bigint, row_id bigint")
    s = 1_000_000
    state = IncrementalSegments(spark)
    state.write_batch(make(("a", None, "t", 0, 1), ("b", None, "t", 4000 * s, 2), ("z", None, "u", 0, 3)), 0)
    state.write_batch(make(("lost", None, "t", 0, 9)), 0)  # an epoch seen again
    state.write_batch(make(("c", "a", "t", 1500 * s, 4), ("d", "a", "t", 3000 * s, 5)), 1)
    assert {r.id: r.segment for r in state.read().collect()} == {"a": 0, "c": 0, "d": 0, "b": 0, "z": 0}


def test_incremental_state_survives_a_restart(spark, tmp_path):
    make = lambda *r: spark.createDataFrame(list(r), "id string, parent string, thread string, ts_us bigint, row_id bigint")
    path = f"file://{tmp_path}/state"
    IncrementalSegments(spark, path).write_batch(make(("a", None, "t", 0, 1), ("b", None, "u", 0, 2)), 0)
    (tmp_path / "state" / "commits" / "7").mkdir()  # a commit that was never finished
    again = IncrementalSegments(spark, path)
    assert again.read().count() == 2
    again.write_batch(make(("lost", None, "t", 0, 9)), 0)
    again.write_batch(make(("a", None, "v", 5, 3)), 1)  # moves to another thread
    assert sorted((r.id, r.thread) for r in IncrementalSegments(spark, path).read().collect()) == [("a", "v"), ("b", "u")]


def test_frozen_segments_take_no_late_messages(spark):
    make = lambda *r: spark.createDataFrame(list(r), "id string, parent string, thread string, ts_us bigint, row_id bigint")
    minute = 60_000_000
    first = make(("a", None, "t", 0, 1), ("b", None, "t", 60 * minute, 2), ("n", None, "t", 48 * 60 * minute, 3))
    late = make(("l", None, "t", minute, 4))
    for hours, want in ((None, {"a": 0, "l": 0, "b": 1, "n": 2}), (24, {"a": 0, "b": 1, "l": 2, "n": 3})):
        state = IncrementalSegments(spark, thaw_hours=hours)
        state.update(first)
        state.update(late)
        assert {r.id: r.segment for r in state.read().collect()} == want
    state.update(make(("r", "a", "t", 2 * minute, 5)))  # a reply thaws the segment of a
    assert {r.id: r.segment for r in state.read().collect()} == {"b": 1, "l": 2, "a": 3, "r": 3, "n": 4}


def test_freeze_and_resume(spark):
    hour = 3_600_000_000
    tasks = spark.createDataFrame([("old", True, 0), ("new", True, 30 * hour), ("open", False, 0), ("back", True, 0)], "task string, terminal boolean, last_us bigint")
    reopened = spark.createDataFrame([("back",)], "task string")
    assert [r.task for r in freezable(tasks, 30 * hour, reopened).collect()] == ["old"]
    assert unfinished(tasks, reopened, "task").count() == 3


def test_name_index(spark):
    e = spark.createDataFrame([("a", 1, "x", False), ("a", 2, "y", False), ("b", 3, "y", False), ("c", 4, "y", False), ("c", 5, "", True)], "id string, pos int, name string, removed boolean")
    index = landing.name_index(e)
    assert [r.id for r in landing.by_name(index, "y").collect()] == ["b", "a"]
    assert landing.by_name(index, "x").count() == 0
