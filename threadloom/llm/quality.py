"""Per-document text statistics, and natural prose told from lists, tables and junk.

All counts are taken over whole batches of code points: class tables give
letters, digits, symbols and white space, and sums between line starts give the
statistics of each line and each document. The published fixed thresholds are
applied and every rule that a document fails is recorded by name; as they do
not tell prose, lists, tables and junk apart, the kind is that of the lines
with most of a document's characters.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from threadloom.llm.tokens import _LETTER, _NUMBER, _OTHER, _SPACE, BatchEncoder, _classes, _powers

# Thresholds of published quality rules for web text (word count,
# mean word length, symbols and ellipses, bullet lines, alphabetic words, stop
# words, lines ending in punctuation).
MIN_WORDS, MAX_WORDS = 50, 100_000
MIN_MEAN_WORD, MAX_MEAN_WORD = 3.0, 10.0
MAX_SYMBOL_RATIO = 0.1
MAX_BULLET_LINES = 0.9
MAX_ELLIPSIS_LINES = 0.3
MIN_ALPHA_WORDS = 0.8
MIN_COMMON_WORDS = 2
MIN_TERMINAL_LINES = 0.12

# Our own values for the kinds of lines, which the published rules do not tell
# apart. No publication stands behind them, and nothing is recorded of how the
# single values were set; what they do on the test tables stands in the README.
MAX_TOKEN = 40
"""Mean length of white-space separated pieces beyond which a line is encoded data."""
MAX_TURNS = 0.18
"""Share of characters after which case or digits change inside a piece."""
MIN_ENCODED = 16
"""Characters of the shortest line that counts as encoded."""
MAX_MOJIBAKE, MIN_GARBLED = 0.3, 8
"""Share of characters that wrong decoding gives, and the shortest line it is asked of."""
MAX_SYMBOLS, MAX_SYMBOL_WORDS = 0.4, 6
"""Share of symbols beyond which a line of fewer words is noise."""
MIN_SALAD_WORDS, MIN_COMMON_SHARE = 10, 0.08
"""A line of so many words with fewer common ones is words without sentences."""
BARE_WORDS, MAX_BARE_COMMON, WORDS_A_MARK = (7, 16), 0.12, 10
"""So is a line of bare words with hardly a mark."""
WIDE_SALAD, WIDE_PIECES, WIDE_PIECE = 20, 8, 8
"""Characters, pieces and characters a piece of such a line in scripts without spaces."""
MIN_SEPARATORS, PIECES_A_COMMA = 2, 4
"""Separators of a row, and pieces that a row of commas may have for each."""
MAX_CELL = 40
"""Mean visible characters of a cell between gaps."""
MIN_GAPPED = 0.6
"""Share of a text's lines with a gap that makes one gap a row."""
MIN_CELL_TEXT = 0.2
"""Share of letters and digits in a row."""
MENU_PIPES = 3
MAX_QUOTES, MIN_QUOTES, MIN_STRUCTURE = 0.12, 6, 0.25
"""Share and number of quotes and brackets, and share of symbols, of machine data."""
MAX_REPEATS, MIN_LOOP_PIECES = 0.5, 8
MAX_SAME_CHARS, MIN_LOOP_CHARS = 0.5, 16
"""Shares of a text that repeats itself, and the shortest it is asked of."""
FULL_LINE, MIN_WRAPPED = 0.6, 0.6
"""Lines this near to the longest count as wrapped, not as items; the share of them in wrapped text."""
LONG_LINE, LONG_WIDE_LINE = 72, 33
"""Characters of a written line, and of one in scripts without spaces."""
MIN_ITEMS, SHORTEST_SENTENCE, LONGEST_SENTENCE = 3, 5, 60
"""Lines of the shortest list, and the words of sentences."""
ENDED_ITEMS = 0.6
"""Sentence ends a line below which short lines are items."""
MIN_PROSE_COMMON, MIN_READ_COMMON, MIN_READ_WORDS = 0.12, 0.05, 20
"""Shares of common words in wrapped prose and in anything read, and how many words tell."""

PROSE, LIST, TABLE, JUNK = 0, 1, 2, 3
KINDS = ("prose", "list", "table", "junk")
_BREAKS = (10, 11, 12, 13, 0x85, 0x2028, 0x2029)
_BULLETS = tuple(map(ord, "-*•+–—·‣▪●○◦■□"))
_PIPES = (0x7C, 0x2502, 0x2503, 0xFF5C)
_ENDERS = tuple(map(ord, ".?!…"))
_WIDE_ENDERS = tuple(map(ord, "。？！"))


@functools.cache
def _lower() -> np.ndarray:
    """Lower case per code point, where that is one code point."""
    table = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x2000):
        low = chr(c).lower()
        if len(low) == 1:
            table[c] = ord(low)
    return table


def _flag(values: tuple[int, ...]) -> np.ndarray:
    table = np.zeros(0x110000, bool)
    table[list(values)] = True
    return table


@functools.cache
def _tables() -> dict[str, np.ndarray]:
    mojibake = np.zeros(0x110000, bool)
    mojibake[0x80:0x100] = True
    mojibake[[0x152, 0x153, 0x160, 0x161, 0x178, 0x17D, 0x17E, 0x192, 0x2C6, 0x2DC, 0x20AC, 0x2122]] = True
    mojibake[0x2013:0x203B] = True
    return {"break": _flag(_BREAKS), "bullet": _flag(_BULLETS), "pipe": _flag(_PIPES), "ender": _flag(_ENDERS), "wide": _flag(_WIDE_ENDERS), "mojibake": mojibake}


def _hash(points: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    powers, backward = _powers(1 << max(1, len(points)).bit_length())
    with np.errstate(over="ignore"):
        sums = np.empty(len(points) + 1, np.uint64)
        sums[0] = 0
        np.cumsum((points.astype(np.uint64) + np.uint64(1)) * powers[: len(points)], out=sums[1:])
        return (sums[starts + sizes] - sums[starts]) * backward[starts] ^ (sizes.astype(np.uint64) << np.uint64(56))


class Scorer:
    """Statistics of batches of texts, against a list of common words."""

    def __init__(self, common_words: list[str]) -> None:
        spaced = sorted({w.lower() for w in common_words if w and ord(w[0]) < 0x2E80})
        points = np.array([ord(c) for w in spaced for c in w], np.uint32)
        sizes = np.array([len(w) for w in spaced], np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(sizes) else sizes
        self.common = np.sort(_hash(points, starts, sizes)) if len(sizes) else np.empty(0, np.uint64)
        wide = [w for w in common_words if w and ord(w[0]) >= 0x2E80]
        self.single = _flag(tuple(ord(w) for w in wide if len(w) == 1))
        self.pairs = np.array(sorted(ord(w[0]) << 21 | ord(w[1]) for w in wide if len(w) > 1), np.int64)

    def score(self, texts: list[str]) -> dict[str, np.ndarray]:
        """Of texts that are not blank, one value per text and statistic."""
        joined = "\n".join(texts) + "\n"
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        n = len(points)
        t = _tables()
        kind = _classes()[points]
        lengths = np.fromiter((len(x) + 1 for x in texts), np.int64, len(texts))
        doc_at = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        is_break = t["break"][points]
        is_break &= ~((points == 13) & np.append(points[1:] == 10, False))
        is_break[np.cumsum(lengths) - 1] = True
        line_at = np.concatenate([[0], np.flatnonzero(is_break)[:-1] + 1])
        line_doc = np.searchsorted(doc_at, line_at, side="right") - 1
        per_line = lambda mask: np.add.reduceat(mask, line_at, dtype=np.int64)
        following = lambda a, fill: np.append(a[1:], np.array([fill], a.dtype))
        preceding = lambda a, fill: np.append(np.array([fill], a.dtype), a[:-1])

        docs = len(texts)
        by_doc = lambda at, weights=None: np.bincount(at, weights, docs)
        space = kind == _SPACE
        letter = kind == _LETTER
        wide = letter & (points >= 0x2E80)
        narrow = letter & ~wide
        shown = ~space
        next_space, last_space = following(space, True), preceding(space, True)
        line_first = np.zeros(n, bool)
        line_first[line_at] = True
        vis, digits, others, wides = per_line(shown), per_line(kind == _NUMBER), per_line(kind == _OTHER), per_line(wide)
        mojibake = per_line(t["mojibake"][points] & ~wide)
        pieces = per_line(shown & (last_space | line_first))
        pipe = per_line(t["pipe"][points])
        tabs = per_line(points == 9)
        semicolons = per_line((points == 59) | (points == 0xFF1B))
        tight_commas = per_line((points == 44) & ~next_space) + per_line((points == 44) & is_break[np.minimum(np.arange(n) + 1, n - 1)])
        wide_commas = per_line((points == 0xFF0C) | (points == 0x3001))
        blank = space & ~is_break
        gaps = per_line(blank & following(blank, False) & ~preceding(blank, False) & ~preceding(is_break, True))
        quotes = per_line((points == 34) | (points == 123) | (points == 125) | (points == 91) | (points == 93))
        after_word = preceding(letter | (points == 41) | (points == 96), False)
        end = t["ender"][points] & next_space & (after_word | (points != 46)) | t["wide"][points]
        enders = per_line(end)
        dots = per_line((points == 0x2026) | ((points == 46) & following(points == 46, False) & ~preceding(points == 46, False)))

        # Words: runs of letters of scripts that put spaces between words.
        word = narrow & ~preceding(narrow, False)
        starts = np.flatnonzero(word)
        stops = np.flatnonzero(narrow & ~following(narrow, False)) + 1
        sizes = stops - starts
        code = _hash(_lower()[points], starts, sizes)
        common_word = np.zeros(len(code), bool)
        if len(self.common):
            found = np.searchsorted(self.common, code)
            common_word = self.common[np.minimum(found, len(self.common) - 1)] == code
        word_line = np.searchsorted(line_at, starts, side="right") - 1
        lines = len(line_at)
        count = lambda at, weights=None: np.bincount(at, weights, lines)
        words = count(word_line)
        commons = count(word_line[common_word])
        word_chars = count(word_line, sizes)
        wide_common = per_line(self.single[points])
        if len(self.pairs):
            pair = (points[:-1].astype(np.int64) << 21) | points[1:]
            wide_common = wide_common + per_line(np.append(np.isin(pair, self.pairs) & wide[:-1], False))

        # Pieces equal to the one a few before: a text that repeats itself.
        p_starts = np.flatnonzero(shown & (last_space | line_first))
        p_stops = np.flatnonzero(shown & (next_space | is_break[np.minimum(np.arange(n) + 1, n - 1)])) + 1
        p_code = _hash(points, p_starts, p_stops - p_starts)
        p_doc = np.searchsorted(doc_at, p_starts, side="right") - 1
        again = np.zeros(len(p_code), bool)
        for lag in (1, 2, 3, 4, 6):
            if len(p_code) > lag:
                again[lag:] |= (p_code[lag:] == p_code[:-lag]) & (p_doc[lag:] == p_doc[:-lag])
        n_pieces = by_doc(p_doc)
        repeats = by_doc(p_doc[again]) / np.maximum(1, n_pieces)
        same_char = shown & preceding(shown, False) & (points == preceding(points, 0))
        same_char = np.add.reduceat(same_char, doc_at, dtype=np.int64)

        # The first characters of each line that are not white space.
        lead = self._lead(points, kind, line_at, shown)
        marked = self._marked(lead, kind)
        log = self._log(lead)

        # Lines, most telling rule first.
        row = (pipe >= MIN_SEPARATORS) & np.isin(lead[:, 0], _PIPES) | (tabs >= MIN_SEPARATORS) | (semicolons >= MIN_SEPARATORS) & (enders == 0) & (quotes < 4) | (tight_commas >= MIN_SEPARATORS) & (quotes < 4) & (pieces <= (tight_commas + 1) * PIECES_A_COMMA)
        full = np.maximum(1, vis)
        row |= (gaps >= MIN_SEPARATORS) & (enders == 0) & (vis / (gaps + 1) < MAX_CELL)
        # A table with empty cells: most lines of the document have a gap.
        gapped = by_doc(line_doc[(gaps >= 1) & (enders == 0)]) / np.maximum(1, by_doc(line_doc[vis > 0]))
        row |= (gaps >= 1) & (enders == 0) & (gapped >= MIN_GAPPED)[line_doc] & (vis / (gaps + 1) < MAX_CELL)
        ruled = per_line(np.isin(points, (45, 58, 61, 43, 0x2500, 0x2550, 0x253C)) | t["pipe"][points]) == vis
        row &= ((vis - others) / full >= MIN_CELL_TEXT) | (ruled & (pipe + gaps >= 2))
        navigation = (pipe >= MENU_PIPES) & ~np.isin(lead[:, 0], _PIPES)
        hexadecimal = self._hexadecimal(points, line_at, vis)
        encoded = (vis / np.maximum(1, pieces) > MAX_TOKEN) & (wides * 2 < vis)
        upper = narrow & (_lower()[points] != points)
        number = kind == _NUMBER
        turn = narrow & ~upper & following(upper, False) | number & following(narrow, False) | narrow & following(number, False)
        encoded |= (per_line(turn) / full > MAX_TURNS) & (vis >= MIN_ENCODED) & (commons == 0)
        structured = (quotes / full > MAX_QUOTES) & (quotes >= MIN_QUOTES) & (others / full > MIN_STRUCTURE)
        garbled = (mojibake / full > MAX_MOJIBAKE) & (vis >= MIN_GARBLED)
        symbols = (others / full > MAX_SYMBOLS) & ~row & ~ruled & ~marked & (wides == 0) & (words < MAX_SYMBOL_WORDS)
        rare = commons / np.maximum(1, words)
        salad = (words >= MIN_SALAD_WORDS) & (rare < MIN_COMMON_SHARE) & (wides * 3 < vis)
        # Short lines of bare words, without marks between them.
        salad |= (words >= BARE_WORDS[0]) & (words < BARE_WORDS[1]) & (rare < MAX_BARE_COMMON) & (others * WORDS_A_MARK <= words) & (wides * 3 < vis)
        salad |= (wides >= WIDE_SALAD) & (pieces >= WIDE_PIECES) & (wide_commas == 0) & (enders == 0) & (wides / np.maximum(1, pieces) < WIDE_PIECE)
        junk = log | (navigation & ~row) | hexadecimal | (structured & ~row) | garbled | symbols | (encoded & ~row)
        junk |= salad & ~row & ~marked & (tabs + semicolons < 2)
        item = marked & ~junk & ~row

        visible = vis > 0
        klass = np.full(lines, PROSE)
        klass[item] = LIST
        klass[row & ~log & ~garbled & ~hexadecimal] = TABLE
        klass[junk & (klass != TABLE)] = JUNK
        # What is left is prose if its lines are long or wrapped, and items if they are short and uneven.
        left = visible & (klass == PROSE) & (lead[:, 0] != 35)
        widest = np.zeros(docs)
        np.maximum.at(widest, line_doc[left], vis[left])
        next_left = np.append(left[1:] & (line_doc[1:] == line_doc[:-1]), False)
        inner = left & next_left
        wrapped = by_doc(line_doc[inner & (vis >= FULL_LINE * widest[line_doc])]) / np.maximum(1, by_doc(line_doc[inner]))
        n_left, left_chars = by_doc(line_doc[left]), by_doc(line_doc[left], vis[left])
        left_enders = by_doc(line_doc[left], enders[left])
        left_words = by_doc(line_doc[left], words[left] + wides[left] / 2)
        left_common = by_doc(line_doc[left], (commons + wide_common)[left]) / np.maximum(1, left_words)
        mean_line = left_chars / np.maximum(1, n_left)
        wide_doc = by_doc(line_doc, wides) * 3 > by_doc(line_doc, vis)
        long_line = np.where(wide_doc, LONG_WIDE_LINE, LONG_LINE)
        sentence = left_words / np.maximum(1, left_enders)
        even = (wrapped >= MIN_WRAPPED) & (left_enders > 0) & (sentence <= LONGEST_SENTENCE) & (left_common >= MIN_PROSE_COMMON)
        short = (n_left >= MIN_ITEMS) & (mean_line < long_line) & ~even & (by_doc(line_doc[inner]) >= 2)
        short &= (sentence < SHORTEST_SENTENCE) | (left_enders < ENDED_ITEMS * n_left) | (left_common < MIN_READ_COMMON)
        klass[left & short[line_doc]] = LIST
        # Long lines without sentence ends or common words are no sentences.
        unread = ~short & (left_words >= MIN_READ_WORDS) & (left_enders == 0) & (left_common < MIN_READ_COMMON)
        klass[left & unread[line_doc]] = JUNK

        mass = np.stack([by_doc(line_doc[klass == k], vis[klass == k]) for k in range(4)])
        doc_vis = np.maximum(1, mass.sum(0))
        looping = ((repeats > MAX_REPEATS) & (n_pieces >= MIN_LOOP_PIECES)) | (same_char / doc_vis > MAX_SAME_CHARS) & (doc_vis >= MIN_LOOP_CHARS)
        mass[JUNK] = np.where(looping, doc_vis + 1, mass[JUNK])
        # Rows of cells repeat few values by nature.
        mass[JUNK] = np.where(looping & (mass[TABLE] > doc_vis * 0.5) & (same_char / doc_vis <= MAX_SAME_CHARS), 0, mass[JUNK])
        best = mass.argmax(0)

        total_words = by_doc(line_doc, words) + by_doc(line_doc, wides) / 2
        n_lines = np.maximum(1, by_doc(line_doc[visible]))
        ended = self._ends_in_punctuation(points, shown, line_at, vis, t)
        return {
            "n_chars": lengths - 1,
            "n_words": total_words.astype(np.int64),
            "n_lines": n_lines.astype(np.int64),
            "mean_word_length": by_doc(line_doc, word_chars) / np.maximum(1, by_doc(line_doc, words)),
            "symbol_ratio": by_doc(line_doc, others) / doc_vis,
            "digit_ratio": by_doc(line_doc, digits) / doc_vis,
            "hash_ellipsis_ratio": (by_doc(line_doc, dots) + np.add.reduceat(points == 35, doc_at, dtype=np.int64)) / np.maximum(1, total_words),
            "terminal_lines": by_doc(line_doc[visible & ended]) / n_lines,
            "bullet_lines": by_doc(line_doc[visible & marked]) / n_lines,
            "ellipsis_lines": by_doc(line_doc[visible & (dots > 0)]) / n_lines,
            "alpha_pieces": by_doc(line_doc, np.minimum(pieces, words + wides)) / np.maximum(1, n_pieces),
            "common_words": (by_doc(line_doc, commons) + by_doc(line_doc, wide_common)).astype(np.int64),
            "common_share": (by_doc(line_doc, commons) + by_doc(line_doc, wide_common)) / np.maximum(1, total_words),
            "repeats": repeats,
            "list_share": mass[LIST] / doc_vis,
            "table_share": mass[TABLE] / doc_vis,
            "junk_share": np.minimum(1, mass[JUNK] / doc_vis),
            "kind": best,
        }

    @staticmethod
    def _lead(points: np.ndarray, kind: np.ndarray, line_at: np.ndarray, shown: np.ndarray) -> np.ndarray:
        """The 20 code points from the first visible one of each line; 0 beyond the end of the line."""
        n = len(points)
        seen = np.append(np.flatnonzero(shown), n)
        first = seen[np.searchsorted(seen, line_at)]
        stop = np.append(line_at[1:], n) - 1
        at = first[:, None] + np.arange(20)
        return np.where(at < stop[:, None], points[np.minimum(at, n - 1)], 0)

    @staticmethod
    def _marked(lead: np.ndarray, kind: np.ndarray) -> np.ndarray:
        """Bullets, numbers with a point or bracket, check boxes and TODO."""
        blank = lambda c: (c == 32) | (c == 9) | (c == 0x3000) | (c == 0xA0)
        digit = (lead >= 48) & (lead <= 57)
        bullet = _tables()["bullet"][lead[:, 0]] & blank(lead[:, 1])
        out = bullet & (lead[:, 2] != 0)
        for k in (1, 2, 3, 4):
            number = digit[:, :k].all(1) & np.isin(lead[:, k], (46, 41, 0x3001, 0xFF09)) & blank(lead[:, k + 1])
            bracket = (lead[:, 0] == 40) & digit[:, 1 : k + 1].all(1) & (lead[:, k + 1] == 41) & blank(lead[:, k + 2])
            out |= number | bracket
        todo = np.array([84, 79, 68, 79])
        box = (lead[:, 0] == 91) & np.isin(lead[:, 1], (32, 120, 88)) & (lead[:, 2] == 93)
        return out | ((lead[:, :4] == todo).all(1) & (blank(lead[:, 4]) | (lead[:, 4] == 58))) | box

    @staticmethod
    def _log(lead: np.ndarray) -> np.ndarray:
        digit = (lead >= 48) & (lead <= 57)
        date = digit[:, :4].all(1) & (lead[:, 4] == 45) & digit[:, 5:7].all(1) & (lead[:, 7] == 45) & digit[:, 8:10].all(1)
        clock = digit[:, 11] & digit[:, 12] & (lead[:, 13] == 58)
        return date & np.isin(lead[:, 10], (84, 32)) & clock

    @staticmethod
    def _hexadecimal(points: np.ndarray, line_at: np.ndarray, vis: np.ndarray) -> np.ndarray:
        is_hex = ((points >= 48) & (points <= 57)) | ((points >= 97) & (points <= 102)) | ((points >= 65) & (points <= 70))
        digits = np.add.reduceat((points >= 48) & (points <= 57), line_at, dtype=np.int64)
        return (np.add.reduceat(is_hex, line_at, dtype=np.int64) >= 0.97 * vis) & (vis >= 16) & (digits >= 0.3 * vis) & (digits < vis)

    @staticmethod
    def _ends_in_punctuation(points: np.ndarray, shown: np.ndarray, line_at: np.ndarray, vis: np.ndarray, t: dict) -> np.ndarray:
        seen = np.flatnonzero(shown)
        stop = np.append(line_at[1:], len(points))
        last = np.searchsorted(seen, stop) - 1
        mark = points[seen[np.maximum(last, 0)]] if len(seen) else np.zeros(len(line_at), np.uint32)
        return (vis > 0) & (t["ender"][mark] | t["wide"][mark] | np.isin(mark, (34, 39, 0x201D, 0x2019)))


_FLOATS = ("mean_word_length", "symbol_ratio", "digit_ratio", "hash_ellipsis_ratio", "terminal_lines", "bullet_lines", "ellipsis_lines", "alpha_pieces", "common_share", "repeats", "list_share", "table_share", "junk_share")
_INTS = ("n_chars", "n_words", "n_lines", "common_words")
STATISTICS = ", ".join([*(f"{n} bigint" for n in _INTS), *(f"{n} double" for n in _FLOATS), "kind string", "failures array<string>"])


def _failures(s: dict[str, np.ndarray]) -> list[list[str]]:
    """The names of the rules that each document fails."""
    rules = {
        "few_words": s["n_words"] < MIN_WORDS,
        "many_words": s["n_words"] > MAX_WORDS,
        "short_words": s["mean_word_length"] < MIN_MEAN_WORD,
        "long_words": s["mean_word_length"] > MAX_MEAN_WORD,
        "hashes_and_ellipses": s["hash_ellipsis_ratio"] > MAX_SYMBOL_RATIO,
        "bullet_lines": s["bullet_lines"] > MAX_BULLET_LINES,
        "ellipsis_lines": s["ellipsis_lines"] > MAX_ELLIPSIS_LINES,
        "few_alphabetic_words": s["alpha_pieces"] < MIN_ALPHA_WORDS,
        "few_common_words": s["common_words"] < MIN_COMMON_WORDS,
        "few_sentence_lines": s["terminal_lines"] < MIN_TERMINAL_LINES,
        "repeats": s["repeats"] > MAX_REPEATS,
        "mainly_list": s["kind"] == LIST,
        "mainly_table": s["kind"] == TABLE,
        "mainly_junk": s["kind"] == JUNK,
    }
    flags = np.stack(list(rules.values()), 1)
    names = np.array(list(rules), object)
    return [names[row].tolist() for row in flags]


def statistics(df: DataFrame, common_words: list[str], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Statistics, kind and failed rules of each text; null and blank texts give no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(common_words)
        for batch in batches:
            ids = batch[id_col]
            texts = [x if x and not x.isspace() else None for x in batch[text_col].to_pylist()]
            for at, some in BatchEncoder._pieces(texts):
                s = scorer.score(some)
                columns = [ids.take(pa.array(at, pa.int64()))]
                columns += [pa.array(s[n].astype(np.int64)) for n in _INTS] + [pa.array(s[n].astype(np.float64)) for n in _FLOATS]
                columns += [pa.array([KINDS[k] for k in s["kind"].tolist()]), pa.array(_failures(s), pa.list_(pa.string()))]
                yield pa.RecordBatch.from_arrays(columns, [id_col, *_INTS, *_FLOATS, "kind", "failures"])

    kind = df.schema[id_col].dataType.simpleString()
    return df.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, {STATISTICS}")


def common_word_list(words: DataFrame) -> list[str]:
    """The words of the common-word table, a fixed list of some hundred."""
    return [r["word"] for r in words.select("word").where("word is not null").distinct().toLocalIterator()]
