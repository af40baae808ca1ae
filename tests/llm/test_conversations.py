import random

from helpers import EVENTS, GROUPS, event

from threadloom.llm import conversations as C


def convo(spark, rows, **kw):
    groups = spark.createDataFrame([("g", "UTC", "en-GB", "t", 1)], GROUPS)
    return sorted(tuple(r) for r in C.conversations(spark.createDataFrame(rows, EVENTS), groups, **kw).collect())


T0 = 1748772000.0


def test_kept_and_dropped(spark):
    rows = [
        event(1, msg_id="A", role=" User", ts=T0, text="hi"), event(2, msg_id="b", parent_id=" a", role="BOT", ts=T0 + 5, text="yes"), event(3, msg_id="c", parent_id="A", role="user", ts=T0 + 2, text="​"),
        event(4, msg_id="d", role="user", ts=T0, text="no reply"), event(5, msg_id="e", role="user", ts=T0, text="　"), event(6, msg_id="f", parent_id="e", role="bot", ts=T0 + 1, text="x"),
        event(7, msg_id="g", parent_id="lost", role="user", ts=T0, text="q"), event(8, msg_id="h", parent_id="g", role="bot", ts=T0 + 1, text="x"),
        event(9, msg_id="i", parent_id="j", role="user", ts=T0, text="q"), event(10, msg_id="j", parent_id="i", role="bot", ts=T0, text="x"),
        event(11, msg_id=None, parent_id="a", role="user", ts=T0 + 9, text="no id"), event(12, msg_id="B ", role="user", ts=T0 + 99, text="delivered again"),
    ]
    want = [("a", 1, "a"), ("a", 2, "c"), ("a", 3, "b")]
    assert convo(spark, rows) == want
    assert convo(spark, rows, bucket_rows=2, block_rows=2) == want
    assert convo(spark, rows, bucket_rows=1) == want
    assert convo(spark, []) == []


def test_order_by_latest_time_then_steps_then_id(spark):
    rows = [
        event(1, group_id="g", msg_id="r", role="human", ts=T0 + 50, text="q"), event(2, msg_id="x", parent_id="r", role="agent", ts=T0, text="a"), event(3, msg_id="w", parent_id="x", role="agent", ts=T0, text="a"),
        event(4, msg_id="b", parent_id="r", role="other", ts=T0, text=None), event(5, group_id="g", msg_id="z", parent_id="r", role="assistant", created_at="2025-06-01 10:00:55", text="late"), event(6, msg_id="n", parent_id="r", role="bot", text="no time"),
    ]
    want = [("r", i + 1, x) for i, x in enumerate(["r", "b", "n", "x", "w", "z"])]
    assert convo(spark, rows) == want
    assert convo(spark, rows, bucket_rows=1) == want


def test_kahn_leaves_cycles():
    order = C.kahn(["a", "b", "c", "d"], [None, "a", "d", "c"], [1, 0, 0, 0])
    assert order == [0, 1]


def test_kahn_equals_sorting_by_path():
    rng = random.Random(1)
    ids = [f"m{i:03d}" for i in range(200)]
    parents = [None if i == 0 else ids[rng.randrange(i)] for i in range(200)]
    times = [rng.randrange(30) for _ in ids]
    key = {}
    for i, p in enumerate(parents):
        up = key.get(p, (0, -1))
        key[ids[i]] = (max(up[0], times[i]), up[1] + 1)
    assert [ids[i] for i in C.kahn(ids, parents, times)] == sorted(ids, key=lambda x: (*key[x], x))


def test_kahn_takes_up_where_earlier_ranges_ended():
    order = C.kahn(["c", "d", "e", "o"], ["a", "c", "gone", "lost"], [5, 1, 0, 0], [(9, 3), None, (2, 1), None])
    assert order == [2, 0, 1]


def test_speakers_take_turns(spark):
    rows = [("r", 1, "r", C.USER), ("r", 2, "a", C.BOT), ("r", 3, "b", C.OTHER), ("r", 4, "c", C.USER), ("s", 1, "s", C.USER), ("s", 2, "t", C.USER), ("s", 3, "u", C.BOT)]
    got = sorted(tuple(r) for r in C.alternation(spark.createDataFrame(rows, C._PLACED)).collect())
    assert got == [("r", 4, 3, 0, True), ("s", 3, 2, 1, False)]
    assert C.alternation(spark.createDataFrame([], C._PLACED)).count() == 0


def test_large_conversations_by_ranges_equal_small_ones(spark):
    rng = random.Random(5)
    rows = [event(i, msg_id=f"m{i:03d}", parent_id=None if i < 2 else f"m{rng.randrange(i):03d}", role="bot" if i % 3 else "user", ts=T0 + rng.randrange(20), text="x") for i in range(150)]
    rows += [event(200 + i, msg_id=f"o{i}", parent_id=f"o{i - 1}" if i else "lost", role="bot" if i % 2 else "user", ts=T0, text="x") for i in range(30)]
    small = convo(spark, rows)
    assert small == convo(spark, rows, bucket_rows=10, block_rows=16)
    assert {r for r, _, _ in small} <= {"m000", "m001"} and small
