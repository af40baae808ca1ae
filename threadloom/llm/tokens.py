"""Byte-pair encoding of texts by a tokenization automaton.

``MergeAutomaton`` is built by successive merge gadgets. Processing the merges
in order of rank, the gadget of (u, v) takes the arc ``v`` away from where ``u``
leads and adds an arc ``uv`` beside every arc ``u``. So each merge excludes
``v`` after ``u`` from its rank on, and whether token ``b`` may follow token
``a`` is read off those exclusions along the right side of ``a`` and the left
side of ``b``; that reading is the validity check of pairs known from public
byte-pair encoders. The token arcs accept exactly one sequence for each byte
string, its encoding.

Encoding is driven by a table of transitions on bytes, the subset construction
over those arcs: a state holds, for every position where a token may still
begin, the trie node reached since and the token before it, and it tells which
token ends there. States and transitions are made when they are first needed
and kept up to a bound, beyond which the table starts afresh.

Texts are split into words over whole batches with code-point class tables, and
each distinct word of a batch is encoded once.
"""

from __future__ import annotations

import base64
import functools
import sys
import unicodedata
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame

TOKENIZER_DIR = "/opt/tokenizers"
VOCABULARY = "byte_bpe_50k.tiktoken"
MEMO_WORDS = 200_000
"""Words whose encoding a worker keeps; beyond, it starts afresh."""
MAX_STATES = 120_000
"""States in a worker's table of transitions; beyond, it starts afresh."""
MAX_PAIRS = 1_000_000
"""Pairs of tokens whose arc a worker keeps."""
PIECE_CHARS = 2_000_000
"""Characters that are split into words at once, rounded up to whole texts."""


class MergeAutomaton:
    """Deterministic automaton over tokens, compiled from merge ranks.

    ``left``, ``right`` hold the two sides of each token (-1 for bytes), and
    ``rank`` the gadget that made it. Ids are those of the vocabulary file.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ids = ranks
        size = max(ranks.values()) + 1
        self.label: list[bytes] = [b""] * size
        for token, i in ranks.items():
            self.label[i] = token
        self.left, self.right = [-1] * size, [-1] * size
        self.rank = [-1] * size
        self.gadget: dict[tuple[int, int], int] = {}
        self.arc: dict[int, bool] = {}
        self.size = size
        by_rank = sorted(ranks.items(), key=lambda x: x[1])
        for token, i in by_rank:
            if len(token) > 1:
                self._add_gadget(token, i)
        self.edges, self.token_at, self.inner = self._trie()
        self.max_states = MAX_STATES
        self._restart()

    def _add_gadget(self, token: bytes, i: int) -> None:
        """Adds the arc ``token``: finds the two arcs that spelled it so far."""
        ids = self.ids
        splits = [k for k in range(1, len(token)) if ids.get(token[:k], i) < i and ids.get(token[k:], i) < i]
        parts = [ids[token[: splits[0]]], ids[token[splits[0] :]]] if len(splits) == 1 else self._spell(token, i)
        if len(parts) != 2:
            raise ValueError(f"token {i} is not made by one merge of earlier tokens")
        u, v = parts
        self.left[i], self.right[i], self.rank[i] = u, v, i
        self.gadget[u, v] = i

    def _spell(self, token: bytes, limit: int) -> list[int]:
        """The path that spells ``token`` through arcs made before ``limit``."""
        parts = [self.ids[token[k : k + 1]] for k in range(len(token))]
        while len(parts) > 2:
            best, at = limit, -1
            for k in range(len(parts) - 1):
                made = self.gadget.get((parts[k], parts[k + 1]), limit)
                if made < best:
                    best, at = made, k
            if at < 0:
                break
            parts[at : at + 2] = [best]
        return parts

    def _trie(self) -> tuple[dict[int, int], list[int], list[bool]]:
        """Tokens by their bytes: (node * 256 + byte) to node, the token that a node spells or -1, and whether longer ones follow."""
        edges: dict[int, int] = {}
        token_at, inner = [-1], [True]
        for token, i in self.ids.items():
            node = 0
            for byte in token:
                inner[node] = True
                key = node << 8 | byte
                node = edges.get(key, 0)
                if not node:
                    node = edges[key] = len(token_at)
                    token_at.append(-1)
                    inner.append(False)
            token_at[node] = i
        return edges, token_at, inner

    def _restart(self) -> None:
        """Empties the table; state 0 is the beginning of a word."""
        start = ((0, -1),)
        self.number: dict[tuple, int] = {start: 0}
        self.beginnings: list[tuple] = [start]
        self.ending: list[int] = [-1]
        self.step: dict[int, int] = {}

    def _advance(self, state: int, byte: int) -> int:
        """Fills in the transition of ``state`` on ``byte``."""
        edges, token_at, inner, follows = self.edges, self.token_at, self.inner, self.follows
        live, ended = [], -1
        for node, before in self.beginnings[state]:
            node = edges.get(node << 8 | byte)
            if node is None:
                continue
            token = token_at[node]
            # Just one token with an arc from where it begins ends here.
            if ended < 0 <= token and (before < 0 or follows(before, token)):
                ended = token
            if inner[node]:
                live.append((node, before))
        live.append((0, ended))
        reached = tuple(live)
        found = self.number.get(reached)
        if found is not None:
            self.step[state << 8 | byte] = found
            return found
        full = len(self.beginnings) >= self.max_states
        if full:
            self._restart()
        found = self.number[reached] = len(self.beginnings)
        self.beginnings.append(reached)
        self.ending.append(ended)
        if not full:
            self.step[state << 8 | byte] = found
        return found

    def follows(self, a: int, b: int) -> bool:
        """Whether the state after token ``a`` has an arc ``b``.

        It has one unless some gadget, at its rank, joins what then is the last
        part of ``a`` with what then is the first part of ``b``.
        """
        key = a * self.size + b
        known = self.arc.get(key)
        if known is None:
            if len(self.arc) >= MAX_PAIRS:
                self.arc.clear()
            known = self.arc[key] = self._follows(a, b)
        return known

    def _follows(self, a: int, b: int) -> bool:
        left, right, rank, gadget = self.left, self.right, self.rank, self.gadget
        until = sys.maxsize
        while True:
            made = gadget.get((a, b))
            if made is not None and made < until:
                return False
            # Step back to before the later of the two was made. One rule joins
            # from the left, so at the same rank it reaches a and b's first part
            # before it makes b, but not a's last part and b before it makes a.
            if rank[a] > rank[b]:
                until = rank[a]
                a = right[a]
                if a < 0:
                    return True
            else:
                if rank[b] < 0:
                    return True
                until = rank[b] + 1
                b = left[b]

    def encode_word(self, word: bytes) -> list[int]:
        """The labels of the one accepted path that spells ``word``.

        Each byte is one transition; the state tells the token that ends there,
        and the path is read back from the last one.
        """
        state, last = 0, []
        for byte in word:
            reached = self.step.get(state << 8 | byte)
            state = self._advance(state, byte) if reached is None else reached
            last.append(self.ending[state])
        out, n = [], len(word)
        while n:
            out.append(last[n - 1])
            n -= len(self.label[last[n - 1]])
        out.reverse()
        return out

    def decode(self, tokens: list[int]) -> bytes:
        """Emits the arc labels."""
        return b"".join(self.label[t] for t in tokens)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f)}


@functools.cache
def automaton(path: str) -> MergeAutomaton:
    return MergeAutomaton(read_ranks(path))


_LETTER, _NUMBER, _SPACE, _OTHER = 0, 1, 2, 3


@functools.cache
def _classes() -> np.ndarray:
    """Per code point: letter, number, white space or other."""
    out = np.full(0x110000, _OTHER, np.uint8)
    kinds = {"L": _LETTER, "N": _NUMBER}
    for c in range(0x110000):
        kind = kinds.get(unicodedata.category(chr(c))[0])
        if kind is not None:
            out[c] = kind
    out[[*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = _SPACE
    return out


_CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")


def word_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Where the words of the byte-level splitting rule begin.

    ``points`` are the code points of all texts on end, ``first`` flags the
    first of each text. The rule, in order: the listed contractions; an
    optional space and letters, or numbers, or others; white space up to the
    last one before a word; remaining white space.
    """
    n = len(points)
    kind = _classes()[points]
    before = np.empty(n, np.uint8)
    before[0] = 255
    before[1:] = kind[:-1]
    before[first] = 255
    space = kind == _SPACE
    # A run begins where the class changes or a text begins.
    run = kind != before
    # A single space joins the run after it, a longer white space gives its last one if that is a space.
    follows_space = ~space & (before == _SPACE)
    previous = np.empty(n, points.dtype)
    previous[0] = 0
    previous[1:] = points[:-1]
    joined = follows_space & (previous == 32)
    start = run & ~joined
    at = np.flatnonzero(follows_space)
    start[at - 1] = True  # its last white-space character is a word of its own, or leads the next
    # Contractions: an apostrophe that begins a word, then one of the endings.
    marks = np.flatnonzero((points == 39) & start & ~space)
    if len(marks):
        ends = np.flatnonzero(first)
        limit = np.append(ends[1:], n)[np.searchsorted(ends, marks, side="right") - 1]
        pad = np.zeros(2, points.dtype)
        padded = np.concatenate([points, pad])
        one = np.where(marks + 1 < limit, padded[marks + 1], 0)
        two = np.where(marks + 2 < limit, padded[np.minimum(marks + 2, n + 1)], 0)
        length = np.zeros(len(marks), np.int64)
        for ending in _CONTRACTIONS:
            hit = (one == ord(ending[0])) & (length == 0)
            if len(ending) == 2:
                hit &= two == ord(ending[1])
            length[hit] = len(ending)
        # The apostrophe must stand alone: a run of others keeps it, unless it leads that run.
        marks, length = marks[length > 0], length[length > 0]
        for k in (1, 2):
            start[marks[length >= k] + k] = False
        after = marks + 1 + length
        inside = after < n
        start[after[inside]] = True
    start[first] = True
    return start


def _hash_table(limit: int) -> tuple[np.ndarray, np.ndarray]:
    base = np.uint64(0x9E3779B97F4A7C15)
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    powers = np.empty(limit + 1, np.uint64)
    backward = np.empty(limit + 1, np.uint64)
    powers[0] = backward[0] = 1
    with np.errstate(over="ignore"):
        np.multiply.accumulate(np.full(limit, base, np.uint64), out=powers[1:])
        np.multiply.accumulate(np.full(limit, inverse, np.uint64), out=backward[1:])
    return powers, backward


class BatchEncoder:
    """Encodes whole batches of texts; keeps the encodings of words."""

    def __init__(self, path: str) -> None:
        self.automaton = automaton(path)
        self.memo: dict[str, tuple[int, ...]] = {}

    def _encode(self, word: str) -> tuple[int, ...]:
        found = self.memo.get(word)
        if found is None:
            if len(self.memo) >= MEMO_WORDS:
                self.memo.clear()
            found = self.memo[word] = tuple(self.automaton.encode_word(word.encode("utf-8", "surrogatepass")))
        return found

    def piece(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of non-empty texts: the word number of each word, the number of words
        of each text, and the tokens of the distinct words (starts, sizes, flat)."""
        joined = "".join(texts)
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        first = np.zeros(len(points), bool)
        first[begins] = True
        starts = np.flatnonzero(word_starts(points, first))
        sizes = np.diff(np.append(starts, len(points)))
        code = self._distinct(points, starts, sizes)
        numbers, uniques = pd.factorize(code)
        shown = np.empty(len(uniques), np.int64)
        shown[numbers[::-1]] = np.arange(len(numbers))[::-1]
        words = [self._encode(joined[s : s + k]) for s, k in zip(starts[shown].tolist(), sizes[shown].tolist(), strict=True)]
        token_sizes = np.fromiter(map(len, words), np.int64, len(words))
        per_text = np.add.reduceat(np.ones(len(starts), np.int64), np.searchsorted(starts, begins))
        flat = np.fromiter((t for w in words for t in w), np.int32, int(token_sizes.sum()))
        return numbers, per_text, np.concatenate([[0], np.cumsum(token_sizes)[:-1]]), token_sizes, flat

    def _distinct(self, points: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """A number per word, equal for equal words only.

        Words are numbered by a 64-bit polynomial of their code points. Each is
        then compared, character by character, with the first of its number;
        should two differ, the words of this piece are numbered by their texts.
        """
        n = len(points)
        powers, backward = _powers(1 << max(1, n).bit_length())
        with np.errstate(over="ignore"):
            sums = np.empty(n + 1, np.uint64)
            sums[0] = 0
            np.cumsum((points.astype(np.uint64) + np.uint64(1)) * powers[:n], out=sums[1:])
            code = (sums[starts + sizes] - sums[starts]) * backward[starts] ^ (sizes.astype(np.uint64) << np.uint64(56))
        numbers, uniques = pd.factorize(code)
        shown = np.empty(len(uniques), np.int64)
        shown[numbers[::-1]] = np.arange(len(numbers))[::-1]
        model = starts[shown][numbers]
        same = np.array_equal(sizes, sizes[shown][numbers])
        if same:
            shift = np.repeat(model - starts, sizes)
            same = np.array_equal(points[shift + np.arange(n)], points)
        if same:
            return numbers
        text = points.tobytes()
        return pd.factorize(np.array([text[4 * s : 4 * (s + k)] for s, k in zip(starts.tolist(), sizes.tolist(), strict=True)], dtype=object))[0]

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(number of tokens per text, all tokens on end)."""
        counts = np.zeros(len(texts), np.int64)
        flats = []
        for at, some in self._pieces(texts):
            numbers, per_text, begin, size, flat = self.piece(some)
            sizes = size[numbers]
            shift = begin[numbers] - np.concatenate([[0], np.cumsum(sizes)[:-1]])
            flats.append(flat[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))])
            counts[at] = np.add.reduceat(sizes, np.concatenate([[0], np.cumsum(per_text)[:-1]]))
        return counts, np.concatenate(flats) if flats else np.empty(0, np.int32)

    def count(self, texts: list[str | None]) -> np.ndarray:
        counts = np.zeros(len(texts), np.int64)
        for at, some in self._pieces(texts):
            numbers, per_text, _, size, _ = self.piece(some)
            counts[at] = np.add.reduceat(size[numbers], np.concatenate([[0], np.cumsum(per_text)[:-1]]))
        return counts

    @staticmethod
    def _pieces(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
        at, some, held = [], [], 0
        for i, text in enumerate(texts):
            if text:
                at.append(i)
                some.append(text)
                held += len(text)
                if held >= PIECE_CHARS:
                    yield at, some
                    at, some, held = [], [], 0
        if some:
            yield at, some


@functools.cache
def _powers(limit: int) -> tuple[np.ndarray, np.ndarray]:
    return _hash_table(limit)


def vocabulary_path(directory: str = TOKENIZER_DIR, name: str = VOCABULARY) -> str:
    return str(Path(directory) / name)


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id, ids): the tokens of each text, without special tokens.

    Null and empty texts give an empty list; strings that look like special
    tokens are ordinary text; texts are encoded whole.
    """
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = BatchEncoder(path)
        for batch in batches:
            counts, tokens = encoder.encode(batch[text_col].to_pylist())
            offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(tokens, pa.int32()))
            yield pa.RecordBatch.from_arrays([batch[id_col], lists], [id_col, "ids"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>")


def token_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id, n_tokens)."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = BatchEncoder(path)
        for batch in batches:
            counts = encoder.count(batch[text_col].to_pylist())
            yield pa.RecordBatch.from_arrays([batch[id_col], pa.array(counts)], [id_col, "n_tokens"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_tokens bigint")


def decode(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """(id, text): emits the labels of the tokens; invalid UTF-8 is replaced."""
    path = path or vocabulary_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = automaton(path)
        for batch in batches:
            texts = [machine.decode(x or []).decode("utf-8", "replace") for x in batch[ids_col].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch[id_col], pa.array(texts, pa.string())], [id_col, "text"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, ids_col).mapInArrow(run, f"`{id_col}` {kind}, text string")
