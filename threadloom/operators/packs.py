"""Pipelines over corrections: snapshots, replay manifests, gold sheets, cards, cases and memories."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions import text as T
from threadloom.operators import context, guards, ordered, providers, replies
from threadloom.session import BROADCAST_LIMIT, broadcast_if_small, materialise

CONTEXT_ROWS = 80
GRAM = 12
"""Bytes by which quotes are looked up in texts."""
ENTRY_BYTES = 128
"""What one quote takes in the two broadcasts of ``pieces``."""


def pieces(quotes: DataFrame, texts: DataFrame, start: bool = False, limit: int = BROADCAST_LIMIT) -> DataFrame:
    """``texts`` (flat, ...) without ``flat``, with ``q``: each piece of a text that is one of ``quotes`` (q), once per text.

    At each place of a text, or with ``start`` only at its first, the next
    ``GRAM`` bytes, four for shorter quotes, tell whether and in which
    lengths quotes begin so; only pieces of these lengths are looked up. Places
    and lengths are in bytes, as a character of a long text is reached only by
    way of all before it. Both look-ups are broadcasts of hashes, several in
    turn where the quotes take more than ``limit`` bytes, so no text is shuffled
    and what comes out is as long as the list of what is found. With ``start`` a text has one place, so
    beyond that limit it is joined in one shuffle. Quotes of less than four characters find
    nothing. By a collision of 64-bit hashes a piece may come out that is no
    quote; joining by ``q`` leaves it out.
    """
    rest = [c for c in texts.columns if c != "flat"]
    some = quotes.select("q").where(F.length("q") >= 4).distinct()
    some = some.select(F.when(F.octet_length("q") >= GRAM, GRAM).otherwise(4).alias("__size"), F.col("q").cast("binary").alias("q"))
    known = materialise(some.select("__size", F.xxhash64(F.substr("q", F.lit(1), F.col("__size"))).alias("__head"), F.octet_length("q").alias("__n"), F.xxhash64("q").alias("__whole")), "quotes")
    n_known = {r["__size"]: r["n"] for r in known.groupBy("__size").agg(F.count("*").alias("n")).collect()}
    out = texts.select(*rest, F.col("flat").alias("q")).limit(0)
    for size in sorted(n_known):
        long = texts.where(F.octet_length("flat") >= size)
        raw = F.col("flat").cast("binary") if start else F.col("__raw")
        at = long.withColumn("__at", F.lit(1)) if start else long.withColumn("__raw", F.col("flat").cast("binary")).withColumn("__at", F.explode(F.sequence(F.lit(1), F.octet_length("flat") - size + 1)))
        at = at.withColumn("__head", F.xxhash64(F.substr(raw, F.col("__at"), F.lit(size))))
        bytes_ = n_known[size] * ENTRY_BYTES
        turns = 1 if start else -(-bytes_ // limit)
        for turn in range(turns):
            mine = known.where((F.col("__size") == size) & (F.pmod("__head", F.lit(turns)) == turn))
            look = lambda df: broadcast_if_small(df, bytes_ // turns, limit)  # noqa: B023, E731
            met = at.join(look(mine.select("__head", "__n").distinct()), "__head").where(F.col("__at") + F.col("__n") - 1 <= F.octet_length("flat"))
            met = met.withColumn("q", F.substr(raw, F.col("__at"), F.col("__n")).cast("string")).withColumn("__whole", F.xxhash64(F.col("q").cast("binary")))
            before = F.substr(raw, F.lit(1), F.col("__at") + F.col("__n") - 2).cast("string")
            met = met.join(look(mine.select("__whole")), "__whole", "left_semi").where(~F.contains(before, F.col("q"))).select(*rest, "q")
            out = out.unionByName(materialise(met, "turn") if turns > 1 else met)
    return out


def quoted_in(quotes: DataFrame, texts: DataFrame, keys: list[str]) -> DataFrame:
    """``quotes`` (keys, q, ...) joined with each of ``texts`` (keys, flat, ...) that contains ``q``.

    The pairs are as many as they are: where many quotes are equal and many
    texts hold them, reduce the ``pieces`` of the texts by ``q`` instead.
    """
    return quotes.join(pieces(quotes, texts.withColumn("__flat", F.col("flat"))).withColumnRenamed("__flat", "flat"), [*keys, "q"])


def reanchored_by_quote(candidates: DataFrame, rows: DataFrame, is_bot: Column) -> DataFrame:
    """``candidates`` (anchor, corrector, thread, quote) with the anchor that the quote names.

    Of the bot's messages of the thread that contain the quote, without white
    space, the latest before the corrector is taken, else the latest of all; a
    quote of less than four characters, or that nobody said, changes nothing.
    Doing it again changes nothing. Among equal times the larger id counts.
    Quotes and messages that hold them are merged by time, never paired.
    """
    said = rows.where(is_bot & F.col("thread").isNotNull()).select("thread", T.without_space(F.col("text")).alias("flat"), F.col("id").alias("found"), F.col("ts_us").alias("found_us"))
    when = rows.select(F.col("id").alias("corrector"), F.col("ts_us").alias("__us"))
    asked = materialise(candidates.join(when, "corrector", "left").select(*candidates.columns, T.without_space(F.col("quote")).alias("q"), "__us", F.lit(None).cast("string").alias("found")), "asked")
    hits = materialise(pieces(asked, said), "hits")
    timed = hits.where("found_us is not null").select("thread", "q", F.col("found_us").alias("__us"), "found")
    before = ordered.as_of(asked, timed, ["thread", "q"], "__us", ["found"], "found", strict=True)
    latest = hits.groupBy("thread", "q").agg(F.max(F.struct("found_us", "found"))["found"].alias("__latest"))
    j = before.join(latest, ["thread", "q"], "left")
    pick = F.coalesce("asof_found", "__latest")
    return j.select(*(c for c in candidates.columns if c != "anchor"), F.coalesce(pick, "anchor").alias("anchor"), F.coalesce(pick != F.col("anchor"), F.lit(False)).alias("moved"))


def t0_lookup(requests: DataFrame, rows: DataFrame) -> DataFrame:
    """``requests`` (key, t0, text) with ``found`` and ``how``: by id, by text, or not at all.

    Without an id that exists, the one of ``rows`` (id, text) counts whose text
    contains that of the request or is contained in it, both whole, without
    white space and punctuation; if several do it is ambiguous. Equal texts are compared once,
    and texts of less than four characters find nothing. What a text holds is
    counted by request as it is found, so no list of pairs is kept.
    """
    ids = rows.select(F.col("id").alias("by_id"))
    named = materialise(requests.join(ids, F.col("t0") == F.col("by_id"), "left").withColumn("__k", T.without_punctuation(F.col("text"))), "named")
    keys = materialise(named.where("by_id is null and __k is not null").select(F.col("__k").alias("k")).distinct(), "keys")
    said = materialise(rows.select("id", T.without_punctuation(F.col("text")).alias("e")).where("e is not null").groupBy("e").agg(F.count("*").alias("n"), F.min("id").alias("one")), "said")
    longest = keys.agg(F.max(F.length("k")).alias("n")).first()["n"] or 0
    inside = pieces(keys.select(F.col("k").alias("q")), said.withColumnRenamed("e", "flat")).select(F.col("q").alias("k"), "n", "one")
    short = said.where(F.length("e") <= longest)
    around = pieces(short.select(F.col("e").alias("q")), keys.withColumn("flat", F.col("k"))).where("q <> k")
    around = around.join(short, F.col("q") == F.col("e")).select("k", "n", "one")
    per = inside.unionByName(around).groupBy("k").agg(F.sum("n").alias("n"), F.min("one").alias("one"))
    j = named.join(per, F.col("__k") == F.col("k"), "left")
    how = F.when(F.col("by_id").isNotNull(), "id").when(F.col("n") == 1, "text").when(F.col("n") > 1, "ambiguous").otherwise("missing")
    return j.select(*requests.columns, F.coalesce("by_id", F.when(F.col("n") == 1, F.col("one"))).alias("found"), how.alias("how"))


def detected(windows: DataFrame, model, task: providers.Task = providers.TASKS["detect"], least_chars: int = 40) -> DataFrame:
    """(thread, window, k, anchor, corrector, quote): what a detector lists for each window of text.

    ``windows`` has thread, window and text; threads of less than
    ``least_chars`` characters in all are not asked about.
    """
    long = windows.groupBy("thread").agg(F.sum(F.length("text")).alias("n")).where(F.col("n") >= least_chars).select("thread")
    said = providers.asked(windows.join(long, "thread", "left_semi"), "text", task, model)
    rows = said.select("thread", "window", F.posexplode(F.from_json("answer", "array<struct<anchor:string,corrector:string,quote:string>>")).alias("k", "r"))
    return rows.select("thread", "window", "k", "r.anchor", "r.corrector", "r.quote")


def first_by_anchor(events: DataFrame, order: list[str]) -> DataFrame:
    """One event per anchor, the first in ``order``; events without anchor are left out."""
    rest = [c for c in events.columns if c not in ("anchor", *order)]
    first = events.where("anchor is not null").groupBy("anchor").agg(F.min(F.struct(*order, *rest)).alias("r"))
    return first.select("anchor", "r.*")


def snapshot_pack(corrections: DataFrame, placed: DataFrame, notes: DataFrame) -> DataFrame:
    """Per correction (anchor, corrector, t0) what a replay before ``t0`` may see.

    ``placed`` are messages with thread and pos, ``notes`` (corrector,
    comment). A missing ``t0`` gives a row that says so. A comment that repeats
    numbers of the correction it was made from is withheld.
    """
    t0 = placed.select(F.col("id").alias("t"), "thread", F.col("pos").alias("at"), F.col("text").alias("original_instruction"), F.col("ts_us").alias("t0_us"))
    c = placed.select(F.col("id").alias("corrector"), F.col("text").alias("what"))
    j = corrections.join(t0, F.col("t0") == F.col("t"), "left").join(c, "corrector", "left").join(notes, "corrector", "left")
    j = context.counted_before(j, ["thread"], CONTEXT_ROWS)
    here = F.col("t").isNotNull()
    leaks = T.leaks_numbers(F.col("comment"), F.col("what"))
    return j.select(
        "corrector", "t0", F.when(here, "ok").otherwise("missing_t0").alias("status"), F.when(here, F.coalesce("n_context", F.lit(0))).alias("n_context"), "first_pos",
        "original_instruction", F.when(~leaks, F.col("comment")).alias("comment_for_replay"), F.coalesce(leaks, F.lit(False)).alias("comment_withheld"),
    )


def replay_manifest(snapshots: DataFrame, chosen: DataFrame, limits: DataFrame) -> DataFrame:
    """(t0, n_corrections, quality, n_context, head, n_chars): snapshots of one ``t0`` as one row.

    ``chosen`` gives id, quality and n_context of each message, ``limits`` (t0,
    id) the ids that would give a correction away; a ``t0`` that is itself
    among them is ambiguous.
    """
    merged = snapshots.where("status = 'ok'").groupBy("t0").agg(F.count("*").alias("n_corrections"), F.min("original_instruction").alias("text"))
    leaked = merged.select("t0").join(limits.select(F.col("id").alias("t0")).distinct(), "t0", "left_semi").withColumn("leaked", F.lit(True))
    j = merged.join(chosen.select(F.col("id").alias("t0"), "quality", "n_context"), "t0", "left").join(leaked, "t0", "left")
    quality = F.when(F.col("leaked"), "missing_or_ambiguous").otherwise(F.coalesce("quality", F.lit("missing_or_ambiguous")))
    preview = T.preview(F.col("text"), 40)
    return j.select("t0", "n_corrections", quality.alias("quality"), F.coalesce("n_context", F.lit(0)).alias("n_context"), preview["head"].alias("head"), preview["n_chars"].alias("n_chars"))


def manifest_summary(manifest: DataFrame) -> DataFrame:
    """How many rows each quality has."""
    return manifest.groupBy("quality").agg(F.count("*").alias("n"))


def review_lines(sheet: DataFrame) -> DataFrame:
    """(card, label, name, prefix) of each line like ``L1 [bot/Name] text`` of cards begun by ``## Card n``.

    ``sheet`` has sheet and text. Lines of another form, and those whose text
    is elided, are left out.
    """
    cards = sheet.select("sheet", F.explode(F.split("text", r"(?m)^(?=## Card \d+)")).alias("body")).where(F.col("body").startswith("## Card "))
    lines = cards.select("sheet", F.regexp_extract("body", r"^## Card (\d+)", 1).cast("int").alias("card"), F.explode(F.split("body", "\n")).alias("line"))
    form = r"^(\w+) \[(\w*)/([^\]]*)\] (.*)$"
    rows = lines.where(F.col("line").rlike(form)).select("sheet", "card", *(F.regexp_extract("line", form, k).alias(n) for k, n in ((1, "label"), (3, "name"), (4, "prefix"))))
    return rows.where((F.col("prefix") != "") & ~F.col("prefix").startswith("⋯"))


def resolved_lines(lines: DataFrame, rows: DataFrame) -> DataFrame:
    """``lines`` with id and status (ok, missing, ambiguous, nearest).

    A line is the one row of its name whose flat text begins with its prefix.
    Where several do, and other lines of the card are sure, the row nearest to
    these is taken unless two are as near. ``rows`` has id, name, flat and pos.
    Rows are counted by name, prefix and position; a line meets these counts
    and, if it stays open, the positions around its card, never all its rows.
    """
    keys, same = ["sheet", "card", "label"], ["name", "q"]
    named = rows.select(F.coalesce("name", F.lit("")).alias("name"), "flat", "id", F.col("pos").cast("bigint").alias("pos"))
    spots = pieces(lines.select(F.col("prefix").alias("q")), named, start=True).groupBy(*same, "pos").agg(F.count("*").alias("n"), F.min("id").alias("id"))
    spots = materialise(spots, "spots")
    spot = F.struct("pos", "n", "id")
    per = spots.groupBy(*same).agg(F.sum("n").alias("__n"), F.min("id").alias("__only"), F.min("pos").alias("__at"), F.min(F.when(F.col("pos").isNotNull(), spot)).alias("__head"))
    card, line = Window.partitionBy("sheet", "card"), Window.partitionBy(*keys)
    met = lines.withColumn("q", F.col("prefix")).join(per, same, "left").repartition("sheet", "card")
    met = met.withColumn("__hit", F.col("__n").isNotNull()).withColumns({"__n": F.sum("__n").over(line), "__only": F.min("__only").over(line), "__at": F.min("__at").over(line)})
    sure = F.when(F.col("__n") == 1, F.col("__at"))
    met = met.withColumns({"__lo": F.min(sure).over(card), "__hi": F.max(sure).over(card), "__line": F.monotonically_increasing_id()})
    met = materialise(met, "met")
    open_ = F.coalesce((F.col("__n") > 1) & F.col("__lo").isNotNull(), F.lit(False))
    asked = met.where(open_ & F.col("__hit"))
    places = ordered.running(spots.where("pos is not null").join(asked.select(*same).distinct(), same, "left_semi"), same, ["pos"], {"upto": (ordered.SUM, F.col("n")), "next": (ordered.LEAD, spot)})
    ends = F.explode(F.array(F.struct(F.lit(False).alias("end"), (F.col("__lo") - 1).alias("pos")), F.struct(F.lit(True).alias("end"), F.col("__hi").alias("pos"))))
    sought = asked.select("__line", *same, ends.alias("e")).select("__line", *same, "e.end", "e.pos")
    found = ordered.as_of(sought, places, same, "pos", ["pos", "n", "id", "upto", "next"], "q")
    last = F.struct(*(F.col(f"asof_{c}").alias(c) for c in ("pos", "n", "id", "upto", "next")))
    ended = found.groupBy("__line").agg(F.max(F.when(F.col("end"), last)).alias("hi"), F.max(F.when(~F.col("end"), F.col("asof_upto"))).alias("before"))
    j = asked.join(ended, "__line")
    inside = F.coalesce(F.col("hi.upto"), F.lit(0)) - F.coalesce("before", F.lit(0))
    above = F.when(F.col("hi.pos").isNull(), F.col("__head")).otherwise(F.col("hi.next"))
    j = j.withColumns({"inside": inside, "above": above, "down": F.col("__lo") - F.col("hi.pos"), "up": above["pos"] - F.col("__hi")})
    lower, upper = F.col("down") <= F.col("up"), F.col("up") <= F.col("down")
    down, up = F.coalesce(lower, F.col("up").isNull()), F.coalesce(upper, F.col("down").isNull())
    m = F.when(F.col("inside") > 0, F.col("inside")).otherwise(F.when(down, F.coalesce("hi.n", F.lit(0))).otherwise(0) + F.when(up, F.coalesce("above.n", F.lit(0))).otherwise(0))
    away = F.when(F.col("inside") > 0, F.lit(0)).otherwise(F.least("down", "up"))
    j = j.where((F.col("inside") > 0) | F.col("hi.pos").isNotNull() | F.col("above.pos").isNotNull())
    each = j.select(*keys, away.alias("away"), m.alias("m"), F.when((F.col("inside") > 0) | down, F.col("hi.id")).otherwise(F.col("above.id")).alias("id"))
    by_away = each.groupBy(*keys, "away").agg(F.sum("m").alias("m"), F.min("id").alias("id"))
    near = by_away.groupBy(*keys).agg(F.min(F.struct("away", "m", "id")).alias("r")).where("r.m = 1").select(*keys, F.col("r.id").alias("nearest"))
    done = met.where(open_).join(near, keys, "left").select(*lines.columns, "__n", "__only", "nearest")
    done = done.unionByName(met.where(~open_).select(*lines.columns, "__n", "__only", F.lit(None).cast("string").alias("nearest")))
    status = F.when(F.col("__n").isNull(), "missing").when(F.col("__n") == 1, "ok").when(F.col("nearest").isNotNull(), "nearest").otherwise("ambiguous")
    return done.select(*lines.columns, F.when(F.col("__n") == 1, F.col("__only")).otherwise(F.col("nearest")).alias("id"), status.alias("status"))


def gold_rows(resolved: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(card, t0, b, c, status): resolved lines of a card under its labels T0, B and C, for cards accepted.

    A card that lacks a label is ``missing`` with the labels that are; others
    are ``gold``, or ``rejected``.
    """
    pivot = resolved.where("status in ('ok', 'nearest')").groupBy("card").agg(*(F.max(F.when(F.col("label") == label, F.col("id"))).alias(label.lower()) for label in ("T0", "B", "C")))
    j = verdicts.join(pivot, "card", "left")
    missing = F.array_join(F.array_compact(F.array(*(F.when(F.col(c).isNull(), F.lit(c)) for c in ("t0", "b", "c")))), ",")
    status = F.when(~F.col("accepted"), "rejected").when(missing != "", F.concat(F.lit("missing:"), missing)).otherwise("gold")
    return j.select("card", "t0", "b", "c", status.alias("status"))


def reply_gold(messages: DataFrame) -> DataFrame:
    """(child, parent, component, label): every reply edge with its component, all of them positive."""
    parts = replies.tree_components(messages)
    return replies.edges(messages).join(parts, F.col("child") == F.col("id")).select("child", "parent", "component", F.lit(1).alias("label"))


def cards(rows: DataFrame, anchors: DataFrame, messages: DataFrame, before: int = 3, after: int = 2, cap: int = 60, depth: int = 16) -> DataFrame:
    """(anchor, n_chain, card): the window around each anchor as lines, its own marked, with the length of its parent chain."""
    window = context.window_around(rows.select("thread", "pos", "id", "role", "name", "text"), anchors, ["thread"], before, after)
    mark = F.when(F.col("off") == 0, F.lit("> ")).otherwise(F.lit("  "))
    line = F.concat(mark, F.lit("["), F.coalesce("role", F.lit("")), F.lit("/"), F.coalesce("name", F.lit("")), F.lit("] "), T.one_line(F.coalesce("text", F.lit("")), cap))
    body = window.groupBy("anchor").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("off", line.alias("line")))), lambda r: r["line"]), "\n").alias("card"))
    chain = replies.chains(messages, depth).groupBy(F.col("id").alias("anchor")).agg(F.count("*").alias("n_chain"))
    return body.join(chain, "anchor", "left").select("anchor", F.coalesce("n_chain", F.lit(0)).cast("int").alias("n_chain"), "card")


def cases(requests: DataFrame, messages: DataFrame, classes: tuple[str, ...], most: int = 6) -> DataFrame:
    """(case_id, slug, messages, fixture) of each request of the classes given.

    The messages are the request and what it replies to, up to ``most`` of
    them, oldest first; the fixture names the request and its class.
    """
    kept = guards.of_classes(requests, "verdict", classes)
    up = replies.chains(messages, most - 1)
    own = kept.select(F.col("id").alias("case"), F.col("id").alias("ancestor"), F.lit(0).alias("distance"))
    some = own.unionByName(up.join(kept.select(F.col("id").alias("k")), F.col("id") == F.col("k")).select(F.col("id").alias("case"), "ancestor", "distance"))
    said = messages.select(F.col("id").alias("a"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    lines = some.join(said, F.col("ancestor") == F.col("a")).groupBy("case").agg(F.array_sort(F.collect_list(F.struct((-F.col("distance")).alias("o"), "role", "text"))).alias("x"))
    j = kept.join(lines, F.col("id") == F.col("case"))
    shown = F.array_join(F.transform("x", lambda r: F.concat(r["role"], F.lit(": "), r["text"])), "\n")
    return j.select(
        F.concat(F.lit("case_"), F.substring(F.sha1(F.col("id").cast("binary")), 1, 10)).alias("case_id"), T.slug(F.coalesce("text", F.lit(""))).alias("slug"), shown.alias("messages"), F.size("x").alias("n_messages"),
        F.concat(F.lit("request="), "id", F.lit(";class="), "verdict").alias("fixture"),
    )


def scrubbed(rows: DataFrame, key: str, columns: list[str], pattern: str, token: str, tag: str = "SECRET") -> DataFrame:
    """(key, columns..., n_hits): every string that looks secret anywhere is replaced everywhere.

    First the whole corpus is searched for ``pattern`` (group 1); then each
    ``token`` of a text that is one of the strings found is replaced by its
    pseudonym, also where the pattern itself would not have seen it. The set of
    secrets is joined by token and never collected.
    """
    texts = rows.select(key, F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("text")) for c in columns))).alias("r")).select(key, "r.column", "r.text").where("text is not null")
    secrets = texts.select(F.explode(F.regexp_extract_all("text", F.lit(pattern), 1)).alias("secret")).distinct()
    tokens = texts.select(key, "column", F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(f"({token})"), 1))).alias("secret"))
    known = tokens.join(secrets, "secret").groupBy(key, "column").agg(F.array_sort(F.collect_list("secret")).alias("known"))
    longest = F.array_sort("known", lambda a, b: F.length(b) - F.length(a))
    done = texts.join(known, [key, "column"], "left").select(
        key, "column", F.when(F.col("known").isNull(), F.col("text")).otherwise(F.aggregate(longest, F.col("text"), lambda acc, v: F.replace(acc, v, T.pseudonym(v, tag)))).alias("text"), F.coalesce(F.size("known"), F.lit(0)).alias("n")
    )
    out = done.groupBy(key).agg(*(F.max(F.when(F.col("column") == c, F.col("text"))).alias(c) for c in columns), F.sum("n").alias("n_hits"))
    return rows.select(key).join(out, key, "left").withColumn("n_hits", F.coalesce("n_hits", F.lit(0)))


def anonymised(rows: DataFrame) -> DataFrame:
    """Events fit for export: sender ids and names as pseudonyms, names inside their own texts too."""
    name = F.when(F.trim("name") != "", F.col("name"))
    text = F.when(name.isNull(), F.col("text")).otherwise(F.replace(F.col("text"), name, T.pseudonym(name, "NAME")))
    return rows.withColumns({"text": text, "who": F.when(F.col("who").isNotNull(), T.pseudonym(F.col("who"), "WHO")), "name": F.when(name.isNotNull(), T.pseudonym(name, "NAME"))})


def task_panel(tasks: DataFrame, groups: DataFrame) -> DataFrame:
    """(group_id, status, n): how many tasks of each status; the open tail counts as ``active_tail``, a group without state as ``error``."""
    state = F.when(F.col("terminal"), F.coalesce("status", F.lit("done"))).otherwise("active_tail")
    counts = tasks.groupBy("group_id", state.alias("status")).agg(F.count("*").alias("n"))
    empty = groups.select("group_id").join(tasks.select("group_id").distinct(), "group_id", "left_anti").select("group_id", F.lit("error").alias("status"), F.lit(0).cast("bigint").alias("n"))
    return counts.unionByName(empty)


def split_verdicts(atoms: DataFrame, a: str, b: str) -> DataFrame:
    """(window, kind, n_tasks, ok): whether a grouping of atoms is as expected.

    ``atoms`` has window, kind (merge or split), task and text. To merge is
    right if there is one task; to split, if atoms with more words of ``a``
    and such with more of ``b`` exist and no task holds both.
    """
    more = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(a)) - F.regexp_count(F.coalesce("text", F.lit("")), F.lit(b))
    per = atoms.groupBy("window", "kind", "task").agg(F.max(more > 0).alias("has_a"), F.max(more < 0).alias("has_b"))
    g = per.groupBy("window", "kind").agg(F.count("*").alias("n_tasks"), F.max("has_a").alias("a"), F.max("has_b").alias("b"), F.max(F.col("has_a") & F.col("has_b")).alias("both"))
    return g.select("window", "kind", "n_tasks", F.when(F.col("kind") == "merge", F.col("n_tasks") == 1).otherwise(F.col("a") & F.col("b") & ~F.col("both")).alias("ok"))


def memories(items: DataFrame, allowed: tuple[str, ...], model, task: providers.Task, top: int, secret: str, token: str) -> DataFrame:
    """(thread_id, n_items, verdict, rank): per thread what its allowed items hold, judged, and the ``top`` longest kept.

    ``items`` has key, thread_id, kind and text. Secrets are replaced before
    anything is judged. The rank is null for threads that are not chosen.
    """
    kept = items.where(F.coalesce(F.col("kind").isin(*allowed), F.lit(False)) & F.col("text").isNotNull())
    clean = scrubbed(kept, "key", ["text"], secret, token).select("key", F.col("text").alias("clean"), "n_hits").join(kept.select("key", "thread_id"), "key")
    judged = providers.asked(clean, "clean", task, model)
    per = judged.groupBy("thread_id").agg(F.count("*").alias("n_items"), F.count_if(F.col("answer") == "exec").alias("n_exec"), F.sum(F.length("clean")).alias("n_chars"))
    chosen = per.where("n_exec > 0").orderBy(F.col("n_exec").desc(), F.col("n_chars").desc(), "thread_id").limit(top)
    return per.join(chosen.select("thread_id", F.lit(True).alias("chosen")), "thread_id", "left").withColumn("chosen", F.coalesce("chosen", F.lit(False)))
