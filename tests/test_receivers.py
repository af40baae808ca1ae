import gzip
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from threadloom.sources import receivers as R

REQUESTS = "path string, encoding string, chunked boolean, body binary"
values = st.recursive(st.none() | st.booleans() | st.integers(-(2**63), 2**63 - 1) | st.floats(allow_nan=False) | st.text(max_size=5), lambda kids: st.lists(kids, max_size=3) | st.dictionaries(st.text(max_size=3), kids, max_size=3), max_leaves=8)


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.text(max_size=4), values, max_size=4))
def test_attributes_come_back(attributes):
    body = R.written_spans([{"trace_id": "ab" * 16, "span_id": "cd" * 8, "name": "n", "start_ns": 1, "end_ns": 2**63 - 1, "attributes": attributes}], attributes)
    (row,) = R.span_rows(body)
    assert json.loads(row["attributes"]) == attributes == json.loads(row["resource"])
    assert (row["trace_id"], row["parent_span_id"], row["end_ns"], row["status_message"]) == ("ab" * 16, None, 2**63 - 1, None)


def test_spans_and_records(spark):
    spans = R.written_spans([{"trace_id": "00" * 16, "span_id": "01" * 8, "parent_span_id": "02" * 8, "name": "é", "start_ns": 5, "end_ns": 6, "status_code": 2, "status_message": "bad", "events": [{"name": "e", "time_ns": 7, "attributes": {"k": b"\x01"}}]}] * 2, {"service": "s"})
    logs = R.written_records([{"time_ns": 9, "body": {"a": [1]}, "severity": 17}, {"time_ns": 10, "body": "text", "severity": "INFO", "trace_id": "0a" * 16}], {})
    chunks = b"3\r\n" + spans[:3] + b"\r\n" + b"%x;x=y\r\n" % (len(spans) - 3) + spans[3:] + b"\r\n0\r\n\r\n"
    rows = [(R.TRACES, "gzip", False, gzip.compress(spans)), (R.TRACES, None, True, chunks), (R.METRICS, None, False, b"\xff"), (R.TRACES, None, False, b"\x0a\x7f"), (R.TRACES, "gzip", False, b"no"), (R.TRACES, None, False, None), (R.LOGS, "GZIP ", False, gzip.compress(logs))]
    df = spark.createDataFrame(rows, REQUESTS)
    got = R.spans(df).collect()
    assert sum(r.error is not None for r in got) == 2 and sum(r.error is None for r in got) == 4
    good = next(r for r in got if r.error is None)
    assert (good.name, good.parent_span_id, good.status_message) == ("é", "02" * 8, "bad") and json.loads(good.events) == [{"name": "e", "time_ns": 7, "attributes": {"k": "01"}}]
    assert sorted((r.time_ns, r.severity, r.body, r.trace_id) for r in R.records(df).collect()) == [(9, "17", '{"a": [1]}', None), (10, "INFO", "text", "0a" * 16)]
    assert R.spans(df.limit(0)).count() == 0


def test_a_chunk_cut_short():
    with pytest.raises(ValueError, match="cut short"):
        R.unchunked(b"5\r\nab")
