import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from threadloom.llm import tokens

tiktoken = pytest.importorskip("tiktoken")
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@pytest.fixture(scope="module")
def reference():
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=tokens.read_ranks(tokens.vocabulary_path()), special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return tokens.BatchEncoder(tokens.vocabulary_path())


def encoded(encoder, texts):
    counts, flat = encoder.encode(texts)
    out, at = [], 0
    for n in counts.tolist():
        out.append(flat[at : at + n].tolist())
        at += n
    return out


PIECES = ["a", "b", " ", "  ", "\n", "'", "'s", "'re", "l", "'ll", "12", "é", "中", "。", "-", "!", " '", "\t", "　", "̈", "'t", "\U0001f600", "٣", "\xa0", "<|endoftext|>", "lll", "~~~", "``````"]


def test_random_texts(encoder, reference):
    rng = random.Random(3)
    texts = ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 16))) for _ in range(4000)]
    assert encoded(encoder, texts) == [reference.encode_ordinary(t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=4))
def test_any_text(encoder, reference, texts):
    texts = [t.encode("utf-8", "replace").decode() for t in texts]
    got = encoded(encoder, texts)
    assert got == [reference.encode_ordinary(t) for t in texts]
    assert [encoder.automaton.decode(x).decode() for x in got] == texts
    assert encoder.count(texts).tolist() == [len(x) for x in got]


def test_words_of_one_letter(encoder, reference):
    for n in range(1, 70):
        assert encoder.automaton.encode_word(b"l" * n) == reference.encode_ordinary("l" * n)


def test_table(spark):
    long = "ab 12 " * 30_000
    df = spark.createDataFrame([(1, None, "z"), (2, "", "z"), (3, "hi there", "z"), (3, "hi there", "z"), (4, long, "z"), (None, "hi", "z")], "doc_id bigint, text string, ids string")
    got = sorted(((r.doc_id, list(r.ids)) for r in tokens.encode(df).collect()), key=lambda r: (r[0] is None, r[0] or 0, len(r[1])))
    assert [g[0] for g in got] == [1, 2, 3, 3, 4, None] and got[0][1] == got[1][1] == [] and got[2] == got[3]
    back = {r.doc_id: r.text for r in tokens.decode(tokens.encode(df)).collect()}
    assert back[4] == long and back[2] == "" and back[1] == ""
    assert tokens.encode(df.limit(0)).count() == 0


def test_table_of_transitions_starts_afresh(reference):
    machine = tokens.MergeAutomaton(tokens.read_ranks(tokens.vocabulary_path()))
    machine.max_states = 50
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdeäöü中文字123") for _ in range(rng.randint(1, 60))) for _ in range(150)]
    for word in words:
        spelled = machine.encode_word(word.encode())
        assert machine.decode(spelled).decode() == word
        assert len(machine.beginnings) <= 51
    for word in (w for w in words if w.isascii() and w.isalpha()):
        assert machine.encode_word(word.encode()) == reference.encode_ordinary(word)
    assert machine.encode_word(b"internationalization") == reference.encode_ordinary("internationalization")
