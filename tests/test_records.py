import pytest
from pyspark.sql import functions as F

from threadloom.functions import text as T
from threadloom.operators import folds, guards, lifecycle, providers, samples, store


def one(spark, column, **values):
    return spark.range(1).select(column).first()[0]


def test_text_forms(spark):
    lit = F.lit
    assert one(spark, T.without_space(lit("a 　b\n c"))) == "abc"
    assert one(spark, T.fingerprint(lit("too short"))) == ""
    assert one(spark, T.one_line(lit("# a\n* b"), 1)) == "a [+2]"
    assert one(spark, T.merged_items(lit("a; b"), lit("b；c"))) == "a; b; c"
    assert one(spark, T.rendered(lit("{{x}} {x} {{{x}}}"), F.create_map(lit("x"), lit("1")))) == "{x} 1 {{x}}"
    assert one(spark, T.snippet(lit("x" * 60 + " Needle " + "y" * 120), "needle", 5, 5)) == "... xxxx Needle yyyy ..."
    assert one(spark, T.unfenced(lit("a `b` ```c `d` ``` `e`"))) == "a b ```c `d` ``` e"
    assert one(spark, T.with_pseudonyms(lit("ab abc ab"), "[a-c]+", "X")) == one(spark, F.concat_ws(" ", T.pseudonym(lit("ab"), "X"), T.pseudonym(lit("abc"), "X"), T.pseudonym(lit("ab"), "X")))
    assert one(spark, T.leaks_numbers(lit("use 42 rows"), lit("it had 42"))) is True
    assert one(spark, T.time_argument(lit("2025-06-01T10:00:00Z"))) == 1748772000 and one(spark, T.time_argument(lit("17"))) == 17


def test_windows_of_characters(spark):
    df = spark.createDataFrame([("k", i, n) for i, n in enumerate([6, 5, 4, 30, 1])], "k string, o int, n int")
    got = [(r.window, r.pos) for r in folds.char_windows(df, "k", ["o"], "n", budget=12, overlap=1).collect()]
    assert sorted(got) == [(0, 0), (0, 1), (1, 1), (1, 2), (2, 2), (2, 3), (3, 3), (3, 4)]


def test_routing(spark):
    rows = [("g", 1, "a", None, "first", True), ("g", 2, "b", None, None, False), ("g", 3, "c", "b", "re", True), ("g", 4, "d", None, "new", True), ("g", 5, "e", "a", "back", True), ("g", 6, "f", None, "x", False)]
    df = spark.createDataFrame(rows, "k string, o int, id string, parent string, text string, is_request boolean")
    got = {r.id: (r.session, r.reason) for r in folds.routed_sessions(df, "k", ["o"]).collect()}
    assert got == {"a": (0, "opener"), "b": (0, "inherited"), "c": (0, "reply"), "d": (1, "new"), "e": (0, "reply"), "f": (0, "inherited")}
    judged = folds.routed_sessions(df, "k", ["o"], judge=lambda text, titles: 0 if text == "new" else 99)
    assert {r.id: r.session for r in judged.collect()}["d"] == 0


def test_snapshots_keep_ids(spark):
    rows = [("k", 1, 0, "a"), ("k", 1, 1, "b"), ("k", 2, 0, "b"), ("k", 2, 1, "b"), ("k", 2, 2, "c"), ("k", 3, 0, "b"), ("k", 3, 1, "c")]
    df = spark.createDataFrame(rows, "k string, snapshot bigint, idx bigint, item string")
    got = {(r.snapshot, r.idx): r.item_id for r in folds.reconciled_items(df, "k").collect()}
    assert got == {(1, 0): 0, (1, 1): 1, (2, 0): 1, (2, 1): 2, (2, 2): 3, (3, 0): 1, (3, 1): 3}
    with pytest.raises(Exception):
        folds.reconciled_items(df, "k", full=False).collect()


def test_guards_in_order(spark):
    m = spark.createDataFrame([("b", "bot", "bot", "the whole answer", 5), ("u", "user", "ann", "that is wrong", 9), ("w", "user", "ann", "also add this", 9), ("e", "user", "ann", "early", 1)], "id string, role string, name string, text string, ts_us bigint")
    t = spark.createDataFrame([("b", "u", "whole answer"), ("x", "u", "q"), ("u", "u", "that"), ("b", "u", "no"), ("b", "u", "not in it"), ("b", "x", "whole"), ("b", "w", "whole"), ("b", "e", "whole"), ("b", "b", "whole")], "anchor string, corrector string, quote string")
    got = [r.drop_reason for r in guards.validate_triples(t, m).collect()]
    assert sorted(map(str, got)) == sorted(["None", "anchor_missing", "anchor_not_bot", "quote_short", "quote_absent", "corrector_missing", "demand_change", "not_later", "corrector_not_user"])


def test_transitions_are_guarded(spark):
    log = spark.createDataFrame([("a", 1, "completed"), ("a", 2, "running"), ("a", 3, "failed"), ("a", 4, "running"), ("a", 5, "completed"), ("a", 6, "failed")], "item string, seq int, to string")
    rules = {"pending": ("running",), "running": ("completed", "failed"), "failed": ("running",), "completed": ()}
    assert [tuple(r) for r in lifecycle.transitions(log, "item", "seq", rules).collect()] == [("a", "completed", 2, 2)]


def test_thread_ids_do_not_depend_on_what_follows(spark):
    calls = spark.createDataFrame([("1", ["system:s", "user:a", "assistant:b", "user:c"]), ("2", ["system:s", "user:a", "assistant:b"]), ("3", ["system:s", "user:a"]), ("4", ["system:s", "user:z"])], "call string, keys array<string>")
    ids = lifecycle.message_thread_ids(calls)
    got = {r.call: (r.thread, r.provisional) for r in ids.collect()}
    assert got["1"] == got["2"] and got["3"][1] and got["4"][1]
    assert {r.call: r.resolved for r in lifecycle.resolve_provisional(calls, ids).collect()} == {"3": got["1"][0], "4": None}


def test_providers_fail_softly(spark):
    class Broken:
        def judge(self, text):
            if text == "boom":
                raise RuntimeError
            return "odd"

    df = spark.createDataFrame([("boom",), ("x",), (None,)], "t string")
    got = {r.t: (r.verdict, r.error) for r in providers.judged(df, "t", Broken(), ("yes",)).collect()}
    assert got == {"boom": (None, "RuntimeError"), "x": ("unknown", None), None: (None, None)}
    with pytest.raises(ValueError):
        providers.preflight(df, 2)
    e = {r.t: r.embedding for r in providers.embedded(df, "t", providers.HashEmbedder(8)).collect()}
    assert e[None] is None and abs(sum(v * v for v in e["x"]) - 1) < 1e-9


def test_pages_follow_each_other(spark):
    df = spark.createDataFrame([(1, i) for i in range(5)] + [(2, 9)], "t int, id int")
    first = [tuple(r) for r in store.keyset_page(df, ["t", "id"], None, 2).collect()]
    second = [tuple(r) for r in store.keyset_page(df, ["t", "id"], first[1], 2).collect()]
    assert first == [(2, 9), (1, 4), (1, 3)] and second == [(1, 3), (1, 2), (1, 1)]


def test_diff_lines(spark):
    diff = "diff --git a/x b/x\n--- a/x\n+++ b/x\n@@ -1 +1,2 @@\n-old\n+new\n+\n unchanged\ndiff --git a/y b/y\n+++ b/y\n@@ -0,0 +1 @@\n+only"
    got = sorted((r.path, r.n_added, r.n_deleted, len(r.fingerprints)) for r in samples.diff_lines(spark.createDataFrame([(1, diff)], "i int, d string"), "i", "d").collect())
    assert got == [("x", 2, 1, 1), ("y", 1, 0, 1)]


def test_aligned_joins_fail_on_differences(spark):
    a, b = spark.range(3), spark.range(3).withColumn("v", F.lit(1))
    assert samples.aligned(a, b, "id").count() == 3
    with pytest.raises(Exception):
        samples.aligned(a, b.limit(2), "id").collect()
