"""Judges, embedders and tokenizers behind one interface, called on batches.

A provider is a plain object with ``judge``, ``embed`` or ``count``. The ones
here are deterministic and need no network; hosted ones take their place. Calls
are made once per distinct text, and failures become rows with an error.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.functions import text as T


class KeywordJudge:
    """Labels a text by the first rule whose pattern it holds."""

    def __init__(self, rules: list[tuple[str, str]], otherwise: str = "unknown") -> None:
        self.rules = [(re.compile(p), label) for p, label in rules]
        self.otherwise = otherwise

    def judge(self, text: str) -> str:
        return next((label for p, label in self.rules if p.search(text)), self.otherwise)


class HashEmbedder:
    """Word hashes as unit vectors; equal words pull texts together."""

    def __init__(self, dimensions: int = 64, cap: int = 2000) -> None:
        self.dimensions, self.cap = dimensions, cap

    def embed(self, text: str) -> list[float] | None:
        v = np.zeros(self.dimensions, np.float64)
        for word in re.findall(r"\w+", text[: self.cap].lower()):
            h = int.from_bytes(hashlib.blake2b(word.encode(), digest_size=8).digest(), "little")
            v[h % self.dimensions] += 1 if h >> 63 else -1
        norm = np.linalg.norm(v)
        return (v / norm).tolist() if norm else None


def judged(rows: DataFrame, text_col: str, provider, allowed: tuple[str, ...]) -> DataFrame:
    """Adds ``verdict`` and ``error``; a label outside ``allowed`` is unknown, a failed call keeps its row."""
    texts = rows.select(F.col(text_col).alias("__t")).where("__t is not null").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            verdicts, errors = [], []
            for text in batch["__t"].to_pylist():
                try:
                    label = provider.judge(text)
                    verdicts.append(label if label in allowed else "unknown")
                    errors.append(None)
                except Exception as e:  # noqa: BLE001 - a provider may fail in any way
                    verdicts.append(None)
                    errors.append(type(e).__name__)
            yield pa.RecordBatch.from_arrays([batch["__t"], pa.array(verdicts, pa.string()), pa.array(errors, pa.string())], ["__t", "verdict", "error"])

    said = texts.mapInArrow(run, "__t string, verdict string, error string")
    return rows.join(said, F.col(text_col) == F.col("__t"), "left").drop("__t")


def embedded(rows: DataFrame, text_col: str, provider: HashEmbedder) -> DataFrame:
    """Adds ``embedding``, a unit vector or null."""
    texts = rows.select(F.col(text_col).alias("__t")).where("__t is not null").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = pa.array([provider.embed(t) for t in batch["__t"].to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch["__t"], vectors], ["__t", "embedding"])

    return rows.join(texts.mapInArrow(run, "__t string, embedding array<double>"), F.col(text_col) == F.col("__t"), "left").drop("__t")


def cosine(a: F.Column, b: F.Column) -> F.Column:
    """Of two vectors of the same length, by built-in folds."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda acc, v: acc + v)
    return dot(a, b) / F.sqrt(dot(a, a) * dot(b, b))


def preflight(rows: DataFrame, most: int, confirmed: bool = False) -> int:
    """Refuses a batch of more than ``most`` calls unless confirmed; gives their number."""
    n = rows.count()
    if n > most and not confirmed:
        raise ValueError(f"{n} calls exceed {most}; confirm to go on")
    return n


# --- prompted calls -----------------------------------------------------------


@dataclass(frozen=True)
class Task:
    """What a model is asked: a template with ``{text}``, how its answer is read, and when to ask again.

    ``read`` gives the value of an answer, or raises ``ValueError`` when it is
    no answer; the call is then repeated up to ``retries`` times with the
    complaint added. ``fallback`` is the value of a call that never gave one.
    """

    template: str
    read: Callable[[str], str | None]
    retries: int = 1
    fallback: str | None = None


def json_objects(answer: str) -> list[dict]:
    """The JSON objects of an answer: of a fenced block, a list, or one a line; what does not parse is left out."""
    body = re.sub(r"^```(?:json)?|```$", "", answer.strip(), flags=re.MULTILINE).strip()
    try:
        whole = json.loads(body)
        return [x for x in (whole if isinstance(whole, list) else [whole]) if isinstance(x, dict)]
    except ValueError:
        pass
    out = []
    decoder = json.JSONDecoder()
    for line in body.splitlines():
        at = line.find("{")
        while at >= 0:
            try:
                found, end = decoder.raw_decode(line, at)
            except ValueError:
                at = line.find("{", at + 1)
                continue
            out.append(found)
            at = line.find("{", end)
    return out


def one_label(labels: tuple[str, ...], member: str = "verdict") -> Callable[[str], str]:
    """Reads one of ``labels`` from the member of a JSON answer or from a bare word."""

    def read(answer: str) -> str:
        found = json_objects(answer)
        label = str(found[0].get(member, "")) if found else answer.strip().strip('."')
        for known in labels:
            if label.lower() == known.lower():
                return known
        raise ValueError(f"none of {', '.join(labels)}")

    return read


def some_text(answer: str) -> str:
    """Any answer that is not blank, without a fence around all of it."""
    whole = re.fullmatch(r"```\w*\n(.*?)\n?```", answer.strip(), re.DOTALL)
    text = (whole.group(1) if whole and "```" not in whole.group(1) else answer).strip()
    if not text:
        raise ValueError("empty answer")
    return text


def json_lines(answer: str) -> str:
    """The objects of an answer as a JSON list, perhaps empty."""
    return json.dumps(json_objects(answer), ensure_ascii=False, sort_keys=True)


def one_number(answer: str) -> str:
    """The first number of an answer, or ``new``."""
    found = re.search(r"\d+|\bnew\b", answer.lower())
    if not found:
        raise ValueError("no number")
    return found.group()


# The judges and writers of the pipelines. Templates are ours; labels are what later steps read.
TASKS = {
    "detect": Task("List each correction of the bot as a JSON object a line, with anchor, corrector and quote.\n{text}", json_lines, fallback="[]"),
    "verify": Task("Does the second message correct the first? YES or NO.\n{text}", one_label(("YES", "NO"))),
    "route": Task("Which session does the request belong to? Its number, or new.\n{text}", one_number, fallback="new"),
    "outcome": Task("Did the task end in success, failure, or is it unknown?\n{text}", one_label(("success", "failure", "unknown")), fallback="unknown"),
    "pick": Task("Which numbered message gave the instruction? Its number.\n{text}", one_number),
    "rewrite": Task("Write the request so that the correction is not needed.\n{text}", some_text),
    "distil": Task("State the rule behind this correction without its numbers.\n{text}", some_text, retries=2),
    "request": Task("Is this request exec or qa?\n{text}", one_label(("exec", "qa", "unknown"), "request_type"), fallback="unknown"),
    "target": Task("What must be read for this: code, chat, none or other?\n{text}", one_label(("code", "chat", "none", "other"), "target"), fallback="other"),
    "behaviour": Task("Does the answer show the failure? YES or NO.\n{text}", one_label(("YES", "NO"), "failed")),
    "boundary": Task("Does a new task begin at the marked message? new, same or unsure.\n{text}", one_label(("new", "same", "unsure")), fallback="unsure"),
    "truth": Task("Is the recorded outcome right? confirmed, refuted or unclear.\n{text}", one_label(("confirmed", "refuted", "unclear")), fallback="unclear"),
}


class RuleModel:
    """A deterministic stand-in for a hosted model: answers by the first rule whose pattern the prompt holds."""

    def __init__(self, rules: list[tuple[str, str]], otherwise: str = "") -> None:
        self.rules = [(re.compile(p), answer) for p, answer in rules]
        self.otherwise = otherwise

    def complete(self, prompt: str) -> str:
        return next((m.expand(answer) for p, answer in self.rules if (m := p.search(prompt))), self.otherwise)


def called(task: Task, model, text: str, refuse: Callable[[str], str | None] | None = None) -> tuple[str | None, str | None, int]:
    """(value, error, calls) of one text; ``refuse`` names what is wrong with a value that was read."""
    prompt, error = task.template.replace("{text}", text), None
    for n in range(1, task.retries + 2):
        try:
            value = task.read(model.complete(prompt))
            wrong = refuse(value) if refuse else None
            if wrong is None:
                return value, None, n
            error = wrong
        except Exception as e:  # noqa: BLE001 - a provider may fail in any way
            error = f"{type(e).__name__}: {e}"[:80]
        prompt = f"{task.template.replace('{text}', text)}\nNot accepted: {error}"
    return task.fallback, error, n


def asked(rows: DataFrame, text_col: str, task: Task, model, refuse_col: str | None = None, refuse: Callable[[str, str], str | None] | None = None, name: str = "answer") -> DataFrame:
    """Adds ``name``, ``<name>_error`` and ``<name>_calls``; each distinct text is asked once.

    With ``refuse`` a value is checked against the row's ``refuse_col``; it
    gives what is wrong, or None. A row whose call fails stays, with its error.
    A null text is not asked.
    """
    keys = [text_col] if refuse_col is None else [text_col, refuse_col]
    texts = rows.select(*(F.col(k).alias(f"__{i}") for i, k in enumerate(keys))).where("__0 is not null").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch[f"__{i}"].to_pylist() for i in range(len(keys))]
            found = [called(task, model, x[0], (lambda v, x=x: refuse(v, x[1])) if refuse else None) for x in zip(*columns, strict=True)]
            arrays = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.string()), pa.array([f[2] for f in found], pa.int32())]
            yield pa.RecordBatch.from_arrays([*(batch[f"__{i}"] for i in range(len(keys))), *arrays], [*(f"__{i}" for i in range(len(keys))), name, f"{name}_error", f"{name}_calls"])

    said = texts.mapInArrow(run, ", ".join([*(f"__{i} string" for i in range(len(keys))), f"{name} string", f"{name}_error string", f"{name}_calls int"]))
    same = [rows[k].eqNullSafe(said[f"__{i}"]) for i, k in enumerate(keys)]
    joined = rows.join(said, same, "left")
    return joined.select(*(rows[c] for c in rows.columns), name, f"{name}_error", f"{name}_calls")


def repeats_numbers(value: str, source: str) -> str | None:
    """What is wrong with a rule that repeats numbers of its source; None when nothing is."""
    found = sorted({t for t in re.findall(f"(?a){T.NUMBER}", source or "") if t in value})
    return f"repeats {', '.join(found)}" if found else None
