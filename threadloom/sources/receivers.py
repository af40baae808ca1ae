"""Telemetry requests as they came over the wire: bodies unpacked, spans and log records as rows.

A receiver lands each request as a row (path, encoding, chunked, body). The
messages are read with the field numbers of the public telemetry protocol; only
its wire format is needed, no generated classes.
"""

from __future__ import annotations

import gzip
import json
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TRACES, LOGS, METRICS = "/v1/traces", "/v1/logs", "/v1/metrics"
_SPANS = "trace_id string, span_id string, parent_span_id string, name string, start_ns bigint, end_ns bigint, status_code int, status_message string, attributes string, events string, resource string"
_RECORDS = "trace_id string, span_id string, time_ns bigint, severity string, body string, attributes string, resource string"


def unchunked(body: bytes) -> bytes:
    """A body sent in chunks, put together; a chunk cut short is an error."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if not size:
            return b"".join(out)
        at = end + 2
        if len(body) < at + size + 2:
            raise ValueError("chunk cut short")
        out.append(body[at : at + size])
        at += size + 2


def unpacked(body: bytes, encoding: str | None, chunked: bool | None) -> bytes:
    plain = unchunked(body) if chunked else body
    return gzip.decompress(plain) if (encoding or "").strip().lower() == "gzip" else plain


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a message: numbers of varints and fixed widths, bytes of the rest."""
    at, n = 0, len(data)

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < n:
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        elif kind in (1, 5):
            width = 8 if kind == 1 else 4
            if at + width > n:
                raise ValueError("message cut short")
            yield key >> 3, int.from_bytes(data[at : at + width], "little")
            at += width
        elif kind == 2:
            size = varint()
            if at + size > n:
                raise ValueError("message cut short")
            yield key >> 3, data[at : at + size]
            at += size
        else:
            raise ValueError(f"unknown wire type {kind}")


def _parts(data: bytes, number: int) -> list:
    return [v for k, v in _fields(data) if k == number]


def _value(data: bytes):
    """A value of any type as plain Python; bytes as hexadecimal digits."""
    for number, v in _fields(data):
        if number == 1:
            return v.decode("utf-8", "replace")
        if number == 2:
            return bool(v)
        if number == 3:
            return v - (1 << 64) if v >> 63 else v
        if number == 4:
            return struct.unpack("<d", v.to_bytes(8, "little"))[0]
        if number == 5:
            return [_value(x) for x in _parts(v, 1)]
        if number == 6:
            return _attributes(_parts(v, 1))
        if number == 7:
            return v.hex()
    return None


def _attributes(pairs: list[bytes]) -> dict:
    out = {}
    for pair in pairs:
        found = dict(_fields(pair))
        out[found.get(1, b"").decode("utf-8", "replace")] = _value(found.get(2, b""))
    return out


def _json(value) -> str:
    return json.dumps(value, ensure_ascii=False, sort_keys=True)


def _last(data: bytes) -> dict:
    """The single fields of a message; the last value of each counts."""
    return dict(_fields(data))


def span_rows(data: bytes) -> Iterator[dict]:
    for group in _parts(data, 1):
        resource = _json(_attributes([x for r in _parts(group, 1) for x in _parts(r, 1)]))
        for scope in _parts(group, 2):
            for span in _parts(scope, 2):
                f, status = _last(span), _last(_last(span).get(15, b""))
                events = []
                for e in _parts(span, 11):
                    one = _last(e)
                    events.append({"name": one.get(2, b"").decode("utf-8", "replace"), "time_ns": one.get(1, 0), "attributes": _attributes(_parts(e, 3))})
                yield {
                    "trace_id": f.get(1, b"").hex(), "span_id": f.get(2, b"").hex(), "parent_span_id": f.get(4, b"").hex() or None, "name": f.get(5, b"").decode("utf-8", "replace"),
                    "start_ns": f.get(7, 0), "end_ns": f.get(8, 0), "status_code": status.get(3, 0), "status_message": status.get(2, b"").decode("utf-8", "replace") or None,
                    "attributes": _json(_attributes(_parts(span, 9))), "events": _json(events), "resource": resource,
                }


def log_rows(data: bytes) -> Iterator[dict]:
    for group in _parts(data, 1):
        resource = _json(_attributes([x for r in _parts(group, 1) for x in _parts(r, 1)]))
        for scope in _parts(group, 2):
            for record in _parts(scope, 2):
                f = _last(record)
                body = _value(f[5]) if 5 in f else None
                yield {
                    "trace_id": f.get(9, b"").hex() or None, "span_id": f.get(10, b"").hex() or None, "time_ns": f.get(1, 0),
                    "severity": f.get(3, b"").decode("utf-8", "replace") or str(f.get(2, 0)), "body": body if body is None or isinstance(body, str) else _json(body),
                    "attributes": _json(_attributes(_parts(record, 6))), "resource": resource,
                }


def _decoded(requests: DataFrame, path: str, rows_of, schema: str) -> DataFrame:
    names = [c.strip().split()[0] for c in schema.split(",")]
    kinds = {"string": pa.string(), "bigint": pa.int64(), "int": pa.int32()}
    shape = pa.schema([*((c.strip().split()[0], kinds[c.strip().split()[1]]) for c in schema.split(",")), ("error", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[dict] = []
            for body, encoding, chunked in zip(batch["body"].to_pylist(), batch["encoding"].to_pylist(), batch["chunked"].to_pylist(), strict=True):
                try:
                    out += list(rows_of(unpacked(body or b"", encoding, chunked)))
                except (ValueError, IndexError, OSError, EOFError, AttributeError) as e:
                    out.append({"error": type(e).__name__})
            yield pa.RecordBatch.from_pydict({n: [r.get(n) for r in out] for n in [*names, "error"]}, schema=shape)

    return requests.where(F.col("path") == path).select("body", "encoding", "chunked").mapInArrow(run, f"{schema}, error string")


def spans(requests: DataFrame) -> DataFrame:
    """Rows of spans, attributes as JSON; a body that cannot be read gives one row with ``error``.

    Requests of other paths, metrics among them, are accepted and dropped.
    """
    return _decoded(requests, TRACES, span_rows, _SPANS)


def records(requests: DataFrame) -> DataFrame:
    """Rows of log records, as ``spans``; severity is the text, else the number."""
    return _decoded(requests, LOGS, log_rows, _RECORDS)


# --- the writing side, for senders and round trips ------------------------------


def _varint(n: int) -> bytes:
    out = bytearray()
    n &= (1 << 64) - 1
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _sized(number: int, data: bytes) -> bytes:
    return _varint(number << 3 | 2) + _varint(len(data)) + data


def _fixed(number: int, n: int) -> bytes:
    return _varint(number << 3 | 1) + n.to_bytes(8, "little")


def written_value(v) -> bytes:
    if v is None:
        return b""
    if isinstance(v, bool):
        return _varint(2 << 3) + _varint(int(v))
    if isinstance(v, int):
        return _varint(3 << 3) + _varint(v)
    if isinstance(v, float):
        return _varint(4 << 3 | 1) + struct.pack("<d", v)
    if isinstance(v, bytes):
        return _sized(7, v)
    if isinstance(v, list):
        return _sized(5, b"".join(_sized(1, written_value(x)) for x in v))
    if isinstance(v, dict):
        return _sized(6, b"".join(_sized(1, _pair(k, x)) for k, x in v.items()))
    return _sized(1, str(v).encode())


def _pair(key: str, value) -> bytes:
    return _sized(1, key.encode()) + _sized(2, written_value(value))


def written_spans(rows: list[dict], resource: dict) -> bytes:
    """A request of spans with trace_id, span_id, name, start_ns, end_ns and, where given, parent, status, message, attributes and events."""
    made = []
    for r in rows:
        data = _sized(1, bytes.fromhex(r["trace_id"])) + _sized(2, bytes.fromhex(r["span_id"])) + _sized(5, r["name"].encode()) + _fixed(7, r["start_ns"]) + _fixed(8, r["end_ns"])
        if r.get("parent_span_id"):
            data += _sized(4, bytes.fromhex(r["parent_span_id"]))
        data += b"".join(_sized(9, _pair(k, v)) for k, v in r.get("attributes", {}).items())
        for e in r.get("events", []):
            data += _sized(11, _fixed(1, e["time_ns"]) + _sized(2, e["name"].encode()) + b"".join(_sized(3, _pair(k, v)) for k, v in e.get("attributes", {}).items()))
        status = _sized(2, r["status_message"].encode()) if r.get("status_message") else b""
        data += _sized(15, status + _varint(3 << 3) + _varint(r.get("status_code", 0)))
        made.append(_sized(2, data))
    return _sized(1, _sized(1, b"".join(_sized(1, _pair(k, v)) for k, v in resource.items())) + _sized(2, b"".join(made)))


def written_records(rows: list[dict], resource: dict) -> bytes:
    made = []
    for r in rows:
        data = _fixed(1, r["time_ns"]) + _sized(5, written_value(r.get("body")))
        data += _sized(3, r["severity"].encode()) if isinstance(r.get("severity"), str) else _varint(2 << 3) + _varint(r.get("severity") or 0)
        data += b"".join(_sized(6, _pair(k, v)) for k, v in r.get("attributes", {}).items())
        if r.get("trace_id"):
            data += _sized(9, bytes.fromhex(r["trace_id"]))
        made.append(_sized(2, data))
    return _sized(1, _sized(1, b"".join(_sized(1, _pair(k, v)) for k, v in resource.items())) + _sized(2, b"".join(made)))
