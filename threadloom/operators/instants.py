"""Timestamps of many formats, precisions and zones as one instant in UTC.

Texts go through a dictionary: each distinct (text, zone, day order) is parsed
once, kept as a table that grows by what it lacks, and joined back to the rows.
Parsing stays in built-in expressions.
"""

from __future__ import annotations

import datetime as dt
import functools
import zoneinfo
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.functions.ids import stripped
from threadloom.session import path_exists, scratch_path

FIRST_US = 1_577_836_800_000_000
"""2020-01-01 in microseconds; earlier values denote no instant."""
END_US = 1_893_456_000_000_000
"""2030-01-01."""
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_FULL_WIDTH = ("０１２３４５６７８９：／－．，＋　", "0123456789:/-.,+ ")

_TIME = r"(\d{1,2})(?::(\d{1,2})(?::(\d{1,2})(?:[.,](\d+))?)?)"
_AMPM = r"\s*([AaPp]\.?[Mm](?![A-Za-z])\.?)?"
_ZONE = r"\s*((?:[Zz]|[+-]\d{1,2}(?::?\d{2})?|[A-Za-z]{2,5}(?:[+-]\d{1,2}(?::?\d{2})?)?|[A-Za-z_]+/[A-Za-z_/+-]+\d*)?\s*[\[(]?(?:[A-Za-z_]+(?:/[A-Za-z_/+-]+\d*)?)?[\])]?)"
_NAME = r"([A-Za-z]{3})[A-Za-z]*\.?"
# Each form and its replacement: year|month|day|hour|minute|second|fraction|am/pm|zone.
_FORMS = {
    "ymd": (rf"^(\d{{4}})[-/.](\d{{1,2}})[-/.](\d{{1,2}})(?:(?:[Tt]|\s*,?\s+|\s*,\s*){_TIME}{_AMPM}{_ZONE})?$", "$1|$2|$3|$4|$5|$6|$7|$8|$9"),
    "compact": (rf"^(\d{{4}})(\d{{2}})(\d{{2}})[Tt ]?(\d{{2}})(\d{{2}})(\d{{2}})?(?:[.,](\d+))?{_ZONE}$", "$1|$2|$3|$4|$5|$6|$7||$8"),
    "dotted": (rf"^(\d{{1,2}})\.(\d{{1,2}})\.(\d{{4}})(?:\s*,?\s+{_TIME}{_AMPM}{_ZONE})?$", "$3|$2|$1|$4|$5|$6|$7|$8|$9"),
    "slashed": (rf"^(\d{{1,2}})[/-](\d{{1,2}})[/-](\d{{4}})(?:\s*,?\s+{_TIME}{_AMPM}{_ZONE})?$", "$3|$2|$1|$4|$5|$6|$7|$8|$9"),
    "cjk": (r"^(\d{4})\s*年\s*(\d{1,2})\s*月\s*(\d{1,2})\s*[日号]\s*(上午|下午)?\s*(\d{1,2})[:时点](?:(\d{1,2})(?:[:分](?:(\d{1,2})秒?(?:\.(\d+))?)?)?)?$", "$1|$2|$3|$5|$6|$7|$8|$4|"),
    "name_first": (rf"^(?:[A-Za-z]+\.?,?\s+)?{_NAME}\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}})(?:\s*,?\s+(?:at\s+)?{_TIME}{_AMPM}{_ZONE})?$", "$3|$1|$2|$4|$5|$6|$7|$8|$9"),
    "day_first": (rf"^(?:[A-Za-z]+\.?,?\s+)?(\d{{1,2}})\.?[\s-]+{_NAME}[\s-]+(\d{{4}})(?:\s*,?\s+{_TIME}{_AMPM}{_ZONE})?$", "$3|$2|$1|$4|$5|$6|$7|$8|$9"),
}
_EPOCH = r"^[+-]?\d{1,20}(\.\d+)?$"


def number_to_us(col: Column) -> Column:
    """Microseconds of an epoch number, rounded to the millisecond.

    The unit follows from the magnitude: seconds, milliseconds, microseconds or
    nanoseconds. Values outside 2020 to 2029, NaN and infinities give null.
    """
    x = col.cast("double")
    ms = F.when(x < 1e11, x * 1000).when(x < 1e14, x).when(x < 1e17, x / 1e3).when(x < 1e20, x / 1e6)
    good = ~F.isnan(x) & (x > 0)
    return in_range(F.when(good, F.floor(ms + 0.5) * 1000))


def in_range(us: Column) -> Column:
    return F.when((us >= FIRST_US) & (us < END_US), us)


@functools.cache
def _abbreviation_rows() -> tuple[tuple[str, str, int], ...]:
    rows: dict[tuple[str, str], int] = {}
    weeks = [dt.datetime(2020, 1, 1, tzinfo=dt.UTC) + dt.timedelta(days=7 * k) for k in range(523)]
    for zone in [*_zone_names(), "UTC", "GMT"]:
        tz = zoneinfo.ZoneInfo(zone)
        for week in weeks:
            at = week.astimezone(tz)
            name = at.tzname() or ""
            if name.isalpha():
                rows.setdefault((zone, name.upper()), int(at.utcoffset().total_seconds()))
    return tuple((z, a, o) for (z, a), o in rows.items())


def abbreviations(spark: SparkSession) -> DataFrame:
    """(zone, abbreviation, offset in seconds) as used in 2020 to 2029.

    One row per zone and abbreviation of the public zone database, whatever the
    data: about 1,500 rows.
    """
    return spark.createDataFrame(list(_abbreviation_rows()), "__zone string, __abbr string, __offset int")


@functools.cache
def _zone_names() -> tuple[str, ...]:
    return tuple(sorted(n for n in zoneinfo.available_timezones() if "/" in n))


SHORTEST = 8
"""Characters of the shortest text that denotes an instant, a date without separators."""


def may_denote(raw: Column) -> Column:
    """Whether a text is long enough to denote an instant; ``parse_texts`` gives none for others."""
    return F.length(raw) >= SHORTEST


def _known(zone: Column) -> Column:
    return zone.isin(*_zone_names(), "UTC", "GMT")


def parse_texts(values: DataFrame, raw: str = "raw", zone: str = "zone", month_first: str = "month_first") -> DataFrame:
    """Adds ``instant_us`` (null where the text denotes no instant in range).

    A zone in the text wins: an offset, then a zone name, then an abbreviation
    of ``zone``. Without one the clock of ``zone`` holds, or UTC when that is
    null or unknown. A time that occurs twice is the earlier one unless an
    abbreviation says otherwise; a skipped time takes the offset before the
    change. Fractions below a microsecond are cut off.
    """
    table = abbreviations(values.sparkSession)
    text = F.regexp_replace(stripped(F.translate(F.col(raw), *_FULL_WIDTH)), "^[\"']|[\"']$", "")
    df = values.withColumn("__s", text)
    s = F.col("__s")
    epoch = s.rlike(_EPOCH)
    forms = F.when(s.isNull() | epoch | ~s.rlike(r"\d{4}"), F.lit(None).cast("string"))
    for name, (pattern, out) in _FORMS.items():
        if name == "slashed":
            swapped = "$3|$1|$2|$4|$5|$6|$7|$8|$9"
            forms = forms.when(s.rlike(pattern), F.when(F.col(month_first), F.regexp_replace(s, pattern, swapped)).otherwise(F.regexp_replace(s, pattern, out)))
        else:
            forms = forms.when(s.rlike(pattern), F.regexp_replace(s, pattern, out))
    df = df.withColumn("__p", F.split(forms, r"\|", -1))
    part = lambda i: F.col("__p")[i]
    number = lambda c: F.when(c == "", F.lit(0)).otherwise(c.try_cast("int"))

    named = F.expr(f"instr('{_MONTHS}', lower(__p[1]))")
    month = F.when(part(1).rlike("^[0-9]+$"), part(1).try_cast("int")).when((named > 0) & (named % 3 == 1), ((named + 2) / 3).cast("int"))
    hour = number(part(3))
    half = F.lower(F.substring(part(7), 1, 1))
    hour = (
        F.when((half == "p") & (hour < 12), hour + 12)
        .when((half == "a") & (hour == 12), F.lit(0))
        .when((part(7) == "下午") & (hour < 12), hour + 12)
        .otherwise(hour)
    )
    date = F.concat_ws("-", F.lpad(part(0), 4, "0"), F.lpad(month.cast("string"), 2, "0"), F.lpad(part(2), 2, "0"))
    date = F.when(month.isNotNull(), date.try_cast("date"))
    minute, second = number(part(4)), number(part(5))
    fraction = F.rpad(F.substring(F.coalesce(part(6), F.lit("")), 1, 6), 6, "0").try_cast("bigint")
    fits = (hour < 24) & (minute < 60) & (second <= 60)
    local = F.when(fits, (F.unix_date(date).cast("bigint") * 86400 + hour * 3600 + minute * 60 + second) * 1_000_000 + fraction)

    sign = F.regexp_extract(part(8), r"([+-])\d", 1)
    hours = F.regexp_extract(part(8), r"[+-](\d{1,2})", 1).try_cast("int")
    minutes = F.coalesce(F.regexp_extract(part(8), r"[+-]\d{1,2}:?(\d{2})", 1).try_cast("int"), F.lit(0))
    offset = F.when((sign != "") & (hours <= 18), F.when(sign == "-", F.lit(-1)).otherwise(F.lit(1)) * (hours * 3600 + minutes * 60))
    region = F.regexp_extract(part(8), r"([A-Za-z_]+/[A-Za-z_/+-]+\d*)", 1)
    letters = F.upper(F.regexp_extract(part(8), r"([A-Za-z]+)", 1))
    clock = F.when(_known(F.col(zone)), F.col(zone)).otherwise(F.lit("UTC"))

    df = df.withColumns(
        {
            "__epoch": F.when(epoch, F.col("__s").try_cast("decimal(38,9)")),
            "__local": local,
            "__fixed": F.when(region == "", offset),
            "__region": F.when((region != "") & _known(region), region),
            "__abbr": F.when((region == "") & offset.isNull() & (letters != ""), letters),
            "__clock": clock,
        }
    )
    df = df.join(F.broadcast(table), (F.col(zone) == F.col("__zone")) & (df["__abbr"] == table["__abbr"]), "left").drop(table["__abbr"]).drop("__zone")
    utc_names = df["__abbr"].isin("Z", "UTC", "GMT", "UT")
    fixed = F.coalesce("__fixed", F.when(df["__abbr"].isin("Z", "UTC", "UT"), F.lit(0)), "__offset", F.when(utc_names, F.lit(0)))
    wall = F.timestamp_micros("__local")
    by_zone = F.unix_micros(F.to_utc_timestamp(wall, F.coalesce("__region", "__clock")))
    e = F.col("__epoch")
    scale = F.when(e < 100_000_000_000, F.lit(1_000_000)).when(e < 100_000_000_000_000, F.lit(1000)).when(e < 100_000_000_000_000_000, F.lit(1)).otherwise(F.lit(0))
    epoch_us = F.when(scale > 0, F.floor(e.cast("decimal(26,9)") * scale)).otherwise(F.floor(e / 1000)).try_cast("bigint")
    instant = F.when(~may_denote(F.col(raw)), F.lit(None)).when(e.isNotNull(), epoch_us).when(fixed.isNotNull(), F.col("__local") - fixed.cast("bigint") * 1_000_000).otherwise(by_zone)
    helpers = ["__s", "__p", "__epoch", "__local", "__fixed", "__region", "__abbr", "__clock", "__offset"]
    return df.withColumn("instant_us", in_range(instant)).drop(*helpers)


class InstantDictionary:
    """Distinct (text, zone, day order) and their instants, kept at ``path``.

    ``update`` parses only what the table lacks and appends it, so texts seen
    in an earlier batch are never parsed again.
    """

    KEY = ("raw", "zone", "month_first")

    def __init__(self, spark: SparkSession, path: str | None = None) -> None:
        self.spark = spark
        self.path = path or scratch_path(spark, "instants")
        self.shared = path is not None
        self._written = path is not None and path_exists(spark, path)

    def read(self) -> DataFrame:
        return self.spark.read.schema("raw string, zone string, month_first boolean, instant_us bigint").parquet(self.path)

    def update(self, values: DataFrame) -> None:
        new = values.select(*self.KEY).where("raw is not null").distinct()
        if self._written:
            old = self.read().select(*self.KEY)
            new = new.join(old, [new[k].eqNullSafe(old[k]) for k in self.KEY], "left_anti")
        parse_texts(new).select(*self.KEY, "instant_us").write.mode("append").option("compression", "zstd").parquet(self.path)
        self._written = True

    def lookup(self, rows: DataFrame) -> DataFrame:
        """``rows`` with ``instant_us``, for the texts that denote an instant.

        A text that a third of all rows share is a skewed key of a sort-merge
        join, which adaptive execution splits.
        """
        known = self.read().where("instant_us is not null")
        if self.shared:  # two updates at once may both have added a text
            known = known.dropDuplicates(list(self.KEY))
        same = [rows["raw"] == known["raw"], rows["zone"].eqNullSafe(known["zone"]), rows["month_first"] == known["month_first"]]
        return rows.join(known, reduce(lambda a, b: a & b, same)).select(*(rows[c] for c in rows.columns), known["instant_us"])


def with_zone(events: DataFrame, groups: DataFrame) -> DataFrame:
    """Adds the group's ``zone`` and ``month_first``; unknown groups get null and day first."""
    clean = groups.select(F.col("group_id").alias("__g"), F.col("tz").alias("zone"), (F.col("locale") == "en-US").alias("month_first"))
    clean = clean.where("__g is not null").dropDuplicates(["__g"])
    joined = events.join(clean, events["group_id"] == clean["__g"], "left").drop("__g")
    return joined.withColumn("month_first", F.coalesce("month_first", F.lit(False)))


def instants(events: DataFrame, groups: DataFrame, dictionary: InstantDictionary | None = None) -> DataFrame:
    """(row_id, field_name, instant_us) of each ``ts`` and ``created_at`` in 2020 to 2029.

    Nulls, blanks and texts that denote no instant give no row; repeated
    deliveries give one row each; empty tables give none.
    """
    own = dictionary or InstantDictionary(events.sparkSession)
    numbers = events.select("row_id", F.lit("ts").alias("field_name"), number_to_us(F.col("ts")).alias("instant_us")).where("instant_us is not null")
    texts = with_zone(events.select("row_id", "group_id", F.col("created_at").alias("raw")).where("raw is not null"), groups)
    texts = texts.where(may_denote(F.col("raw"))).select("row_id", "raw", "zone", "month_first")
    own.update(texts)
    found = own.lookup(texts).select("row_id", F.lit("created_at").alias("field_name"), "instant_us")
    return numbers.unionByName(found)
