"""Extra columns whose names operators use themselves, and nulls in every column."""

from helpers import EVENTS, GROUPS, event
from pyspark.sql import functions as F

from threadloom.operators import forest, instants, shredding

CLASHING = ("id", "root", "top", "hops", "most", "kind", "pos", "parent", "value", "raw", "zone", "month_first", "instant_us", "field_name", "__s", "path", "owner_key", "child_path")


def crowded(df):
    return df.withColumns({c: F.lit("clash") for c in CLASHING if c not in df.columns})


def test_forest(spark):
    df = crowded(spark.createDataFrame([event(1, msg_id="a"), event(2, msg_id="b", parent_id="a"), event(None)], EVENTS))
    assert sorted(tuple(r) for r in forest.hierarchy(df).collect()) == [("a", "a", 0), ("b", "a", 1)]
    assert sorted(r.path for r in forest.paths(df).collect()) == [["a"], ["a", "b"]]


def test_instants(spark):
    groups = crowded(spark.createDataFrame([("g", "Europe/Berlin", "de-DE", "t", 1), (None, None, None, None, None)], GROUPS))
    df = crowded(spark.createDataFrame([event(1, group_id="g", created_at="01.06.2025 12:00:00"), event(None)], EVENTS))
    assert [tuple(r) for r in instants.instants(df, groups).collect()] == [(1, "created_at", 1748772000000000)]


def test_shredding(spark):
    df = crowded(spark.createDataFrame([("t", "u", "i", '{"x":[{}]}'), (None, None, None, None)], "thread_id string, turn_id string, item_id string, item_json string"))
    assert [tuple(r) for r in shredding.flatten_items(df).collect()] == [("t/u/i", "x[0]", "$")]
