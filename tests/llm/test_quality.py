import pytest

from threadloom.llm import quality

COMMON = ["the", "a", "it", "is", "was", "and", "we", "to", "in", "of", "der", "und", "de", "la", "的", "了", "我们"]
PROSE = "We looked at the panel first, and it was the right place to begin. The old index is still there, but it was moved to the archive in spring. "


@pytest.mark.parametrize(
    "text, kind",
    [
        (PROSE * 4, "prose"),
        ("We looked at the panel first, and it was\nthe right place to begin. The old index is\nstill there, but it was moved to the place\nof the archive in spring. We left it there.", "prose"),
        (PROSE * 3 + "\n\n- one\n- two\n- three\n", "prose"),
        ("Points:\n- [ ] broken index\n- [ ] late panel\n- [ ] old sheet\n", "list"),
        ("1. index\n2. panel\n3. sheet\n4. ledger", "list"),
        ("src/a_b.py\nlib/c.sql\ntools/d.sh\ntests/long_name_here.py\njobs/e.toml", "list"),
        ("| a | b | c |\n| --- | --- | --- |\n| 1 | 2 | 3 |\n| 4 | 5 | 6 |", "table"),
        ("a,b,c\n1,2,3\n4,5,6\n7,,9", "table"),
        ("a\tb\tc\n1\t2\t3\n4\t5\t6", "table"),
        ("name      state  cost\nfirst     open   1.50\nsecond    shut   2.50", "table"),
        ("2025-08-08T06:52:08Z DEBUG a::b id=74\n2025-08-08T06:52:09Z INFO a::c id=75", "junk"),
        ('[{"k":"a","v":73356,"f":[8,1,0,0]},{"k":"b","v":24542,"f":[3,3,4,9]}]', "junk"),
        ("00000000  dd c1 6e bb cb 36 a6 71 3a 83\n00000010  92 82 8e 81 e1 a4 39 bd 90 f6", "junk"),
        ("Home | Login | More | Home | Top | Page 4 | Login | Menu | Home", "junk"),
        ("ok " * 60, "junk"),
        ("哈" * 90, "junk"),
        ("$%+&!<*~|_=@@$!?\n%%:+=%~~\n&/= @|:?", "junk"),
        ("collector backfill empty missing noisy reorders freezes nested inflates forgotten splits session index hides thread", "junk"),
        ("YUQI5nRvrG1VLZf2Upwwpz6QZmO0H+nBQ7AbM38av+eID0g3IG075i12p2fi1oYfw8A0v7P2", "junk"),
    ],
)
def test_kinds(text, kind):
    s = quality.Scorer(COMMON).score([text])
    assert quality.KINDS[s["kind"][0]] == kind


def test_batches_do_not_change_results():
    texts = [PROSE * 2, "- a\n- b\n- c", "x\n\n\r\ny.", "ok " * 30, "|a|b|c|\n|1|2|3|", "　中文的了。"]
    scorer = quality.Scorer(COMMON)
    together = scorer.score(texts)
    for i, t in enumerate(texts):
        alone = scorer.score([t])
        assert {k: together[k][i] for k in together} == pytest.approx({k: alone[k][0] for k in alone})


def test_statistics_by_hand():
    s = quality.Scorer(["the"]).score(["The cat sat.\n- the end"])
    assert (s["n_words"][0], s["n_lines"][0], s["common_words"][0]) == (5, 2, 2)
    assert s["terminal_lines"][0] == 0.5 and s["bullet_lines"][0] == 0.5
    assert s["mean_word_length"][0] == pytest.approx(15 / 5)


def test_table(spark):
    df = spark.createDataFrame([(1, None, 0), (2, " \n", 0), (3, "a,b,c\n1,2,3\n4,5,6", 0), (3, "a,b,c\n1,2,3\n4,5,6", 0), (4, "the word. " * 30_000, 0)], "doc_id bigint, text string, n_words int")
    got = sorted((r.doc_id, r.kind) for r in quality.statistics(df, COMMON).collect())
    assert [g[0] for g in got] == [3, 3, 4] and got[0][1] == "table"
    assert quality.statistics(df.limit(0), []).count() == 0
