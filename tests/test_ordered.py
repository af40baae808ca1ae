import random

import pytest
from pyspark.sql import functions as F

from threadloom.operators import context, ordered
from threadloom.operators.ordered import COUNT, LAG, LAST, MAX, SUM


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(4)
    data = [("hot" if rng.random() < 0.6 else f"k{rng.randrange(5)}", i, rng.choice([None, rng.randrange(50)])) for i in range(300)]
    return data, spark.createDataFrame(data, "k string, pos int, v int").repartition(5)


def test_running_values_equal_a_loop(rows):
    data, df = rows
    got = ordered.running(df, ["k"], ["pos"], {"s": (SUM, F.col("v")), "m": (MAX, F.col("v")), "l": (LAST, F.col("v")), "g": (LAG, F.col("v")), "n": (COUNT, F.lit(1))})
    got = {r.pos: (r.s, r.m, r.l, r.g, r.n) for r in got.collect()}
    want, state = {}, {}
    for k, pos, v in data:
        s, m, l, g, n = state.get(k, (None, None, None, None, 0))
        if v is not None:
            s, m, l = (s or 0) + v, max(m, v) if m is not None else v, v
        want[pos] = (s, m, l, g, n + 1)
        state[k] = (s, m, l, v, n + 1)
    assert got == want


@pytest.mark.parametrize("strict", [False, True])
def test_as_of(spark, strict):
    left = spark.createDataFrame([("a", 5, 1), ("a", 2, 2), ("a", 9, 3), ("b", 5, 4)], "k string, t int, i int")
    right = spark.createDataFrame([("a", 2, 1, "x"), ("a", 5, 2, "y"), ("a", 5, 3, "z")], "k string, t int, i int, v string")
    got = {r.i: r.asof_v for r in ordered.as_of(left, right, ["k"], "t", ["v"], "i", strict).collect()}
    assert got == ({1: "x", 2: None, 3: "z", 4: None} if strict else {1: "z", 2: "x", 3: "z", 4: None})


def test_windows_around_cross_tiles(spark):
    df = spark.range(1, 1001).select(F.lit("k").alias("k"), F.col("id").alias("pos"))
    at = spark.createDataFrame([("k", 1, "a"), ("k", 256, "b"), ("k", 1000, "c")], "k string, at bigint, anchor string")
    got = context.window_around(df, at, ["k"], 3, 2).groupBy("anchor").agg(F.sort_array(F.collect_list("pos")).alias("p"))
    assert {r.anchor: list(r.p) for r in got.collect()} == {"a": [1, 2, 3], "b": [253, 254, 255, 256, 257, 258], "c": [997, 998, 999, 1000]}


def test_nearest_rows(spark):
    df = spark.range(1, 11).select(F.lit("k").alias("k"), F.col("id").alias("pos"))
    after = {r.pos: r.found_pos for r in context.first_after(df, ["k"], F.col("pos").isin(4, 9), 3).collect()}
    assert after == {1: 4, 2: 4, 3: 4, 4: None, 5: None, 6: 9, 7: 9, 8: 9, 9: None, 10: None}
    before = {r.pos: r.found_pos for r in context.last_before(df, ["k"], F.col("pos").isin(4, 9)).collect()}
    assert before == {1: None, 2: None, 3: None, 4: None, 5: 4, 6: 4, 7: 4, 8: 4, 9: 4, 10: 9}
