import datetime as dt
import zoneinfo

import pytest
from helpers import EVENTS, GROUPS, event

from threadloom.operators import instants


def us(*at, tz="UTC", fold=0):
    local = dt.datetime(*at, tzinfo=zoneinfo.ZoneInfo(tz), fold=fold)
    return round(local.timestamp() * 1e6)


CASES = [
    ("2025-06-01T10:00:00.123456789Z", "UTC", False, us(2025, 6, 1, 10, 0, 0, 123456)),
    ("2025-06-01T10:00:00z", "Asia/Shanghai", False, us(2025, 6, 1, 10)),
    ("2025-06-01T10:00:00.5+05:45", "UTC", False, us(2025, 6, 1, 4, 15, 0, 500000)),
    ("2025-06-01 10:00:00-0300", "Asia/Shanghai", False, us(2025, 6, 1, 13)),
    ("2025-06-01 10:00", "Asia/Kolkata", False, us(2025, 6, 1, 10, tz="Asia/Kolkata")),
    ("2025/06/01 10:00:00", "Asia/Shanghai", False, us(2025, 6, 1, 2)),
    ("01.06.2025 10:00:00", "Europe/Berlin", False, us(2025, 6, 1, 8)),
    ("02/03/2025 10:00:00", "UTC", False, us(2025, 3, 2, 10)),
    ("02/03/2025 10:00:00", "UTC", True, us(2025, 2, 3, 10)),
    ("02/03/2025 12:05:00 AM", "UTC", True, us(2025, 2, 3, 0, 5)),
    ("Mar 8, 2026, 1:14:49 PM", "America/New_York", True, us(2026, 3, 8, 13, 14, 49, tz="America/New_York")),
    ("Tue, 23 Jun 2026 06:00:11 +0545", "UTC", False, us(2026, 6, 23, 0, 15, 11)),
    ("2025年6月1日 07:08:09", "Asia/Shanghai", False, us(2025, 5, 31, 23, 8, 9)),
    ("20250601T100000Z", "Asia/Shanghai", False, us(2025, 6, 1, 10)),
    ("2025-06-01 10:00:00 America/New_York", "Asia/Shanghai", False, us(2025, 6, 1, 14)),
    ("2025-06-01T10:00:00[America/Sao_Paulo]", "Asia/Shanghai", False, us(2025, 6, 1, 13)),
    ("2025-06-01 10:00:00 CST", "Asia/Shanghai", False, us(2025, 6, 1, 2)),
    ("2025-01-01 10:00:00 CST", "America/Chicago", True, us(2025, 1, 1, 16)),
    ("2025-06-01 10:00:00 UTC", "America/Chicago", True, us(2025, 6, 1, 10)),
    # A time that occurs twice is the earlier one, unless its abbreviation says which.
    ("2025-11-02 01:30:00", "America/New_York", True, us(2025, 11, 2, 5, 30)),
    ("2025-11-02 01:30:00 EST", "America/New_York", True, us(2025, 11, 2, 6, 30)),
    # A skipped time takes the offset before the change.
    ("2025-03-09 02:30:00", "America/New_York", True, us(2025, 3, 9, 7, 30)),
    ("1748772000", "Asia/Shanghai", False, us(2025, 6, 1, 10)),
    ("1748772000123", "UTC", False, us(2025, 6, 1, 10, 0, 0, 123000)),
    ("1748772000123456", "UTC", False, us(2025, 6, 1, 10, 0, 0, 123456)),
    ("1748772000.5", "UTC", False, us(2025, 6, 1, 10, 0, 0, 500000)),
    ("2025-06-01 10:00:00", None, False, us(2025, 6, 1, 10)),
    *((x, "UTC", False, None) for x in ("", "  ", "n/a", "yesterday", "0", "2025-13-40 10:00:00", "0000-00-00 00:00:00", "9999-12-31T23:59:59Z", "2019-12-31T23:59:59Z", "2030-01-01T00:00:00Z", "x" * 50_000)),
]


def test_forms(spark):
    df = spark.createDataFrame([(i, *c[:3]) for i, c in enumerate(CASES)], "i int, raw string, zone string, month_first boolean")
    got = {r.i: r.instant_us for r in instants.parse_texts(df).collect()}
    assert {i: (CASES[i][0][:60], got[i]) for i in got} == {i: (c[0][:60], c[3]) for i, c in enumerate(CASES)}


@pytest.mark.parametrize("value, want", [(1748772000.1236, 1748772000124000), (1748772000123.0, 1748772000123000), (1748772000123456.0, 1748772000123000), (0.0, None), (-1.0, None), (float("nan"), None), (float("inf"), None), (None, None)])
def test_numbers(spark, value, want):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(value,)], "ts double")
    assert df.select(instants.number_to_us(F.col("ts"))).first()[0] == want


def test_all_rows_and_fields(spark):
    rows = [event(1, group_id="g", ts=1748772000.0, created_at="2025-06-01 10:00:00"), event(2, group_id="g", ts=1748772000.0, created_at="2025-06-01 10:00:00"), event(3, group_id="?", created_at="2025-06-01 10:00:00"), event(4)]
    groups = spark.createDataFrame([("g", "Asia/Shanghai", "zh-CN", "t", 1), ("g", "Asia/Shanghai", "zh-CN", "t", 1)], GROUPS)
    got = sorted(tuple(r) for r in instants.instants(spark.createDataFrame(rows, EVENTS), groups).collect())
    t = us(2025, 6, 1, 10)
    assert got == [(1, "created_at", t - 8 * 3600 * 10**6), (1, "ts", t), (2, "created_at", t - 8 * 3600 * 10**6), (2, "ts", t), (3, "created_at", t)]
    assert instants.instants(spark.createDataFrame([], EVENTS), groups.limit(0)).count() == 0


def test_dictionary_grows_by_what_it_lacks(spark, tmp_path):
    path = f"file://{tmp_path}/dictionary"
    make = lambda *texts: spark.createDataFrame([(t, "UTC", False) for t in texts], "raw string, zone string, month_first boolean")
    first = instants.InstantDictionary(spark, path)
    first.update(make("2025-06-01 10:00", "2025-06-01 10:00"))
    again = instants.InstantDictionary(spark, path)
    again.update(make("2025-06-01 10:00", "2025-06-02 10:00"))
    assert sorted(r.raw for r in again.read().collect()) == ["2025-06-01 10:00", "2025-06-02 10:00"]
