"""Extra columns whose names operators use themselves, and nulls in every column."""

from helpers import EVENTS, GROUPS, event
from pyspark.sql import functions as F

from threadloom.llm import conversations, packing, pii, quality, tokens

CLASHING = ("id", "root", "up", "own", "value", "said", "most", "n", "bucket", "raw", "zone", "ids", "n_tokens", "uid", "cell", "bin", "fill", "size", "part", "n_words", "failures", "pii_type", "pos")


def crowded(df):
    return df.withColumns({c: F.lit("clash") for c in CLASHING if c not in df.columns})


def test_events(spark):
    rows = [event(1, msg_id="a", role="user", text="q ann@mail.example", ts=1748772000.0), event(2, msg_id="b", parent_id="a", role="bot", text="r", ts=1748772001.0), event(None)]
    df, groups = crowded(spark.createDataFrame(rows, EVENTS)), crowded(spark.createDataFrame([], GROUPS))
    assert sorted(tuple(r) for r in conversations.conversations(df, groups).collect()) == [("a", 1, "a"), ("a", 2, "b")]
    assert [tuple(r) for r in pii.personal_data(df).collect()] == [(1, "text", "EMAIL", "ann@mail.example")]


def test_documents(spark):
    df = crowded(spark.createDataFrame([(1, "some words"), (None, None)], "doc_id bigint, text string"))
    assert sorted(len(r.ids) for r in tokens.encode(df).collect()) == [0, 2]
    assert [(r.doc_id, r.start, r.n_tokens) for r in packing.pack(df).collect()] == [(1, 0, 2)]
    assert [r.doc_id for r in quality.statistics(df, ["some"]).collect()] == [1]
