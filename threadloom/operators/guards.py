"""Checks that keep or drop rows, with a reason for each that is dropped."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions import text as T

PLACEHOLDER = r"^\s*(\[[^\]]*\]|\(.*\)|\.\.\.|…|ok)\s*$"
DEMAND = r"(?i)(also|additionally|one more|instead of|could you also)"
OVERRIDE = r"(?i)(wrong|not what|incorrect|correction)"
FEEDBACK = r"(?i)(exit|ran|checked)"
ASKED_OUTPUT = r"(?i)(could you|please)"
"""Words by which the checks here tell demands, corrections and troubleshooting apart; other patterns can be given."""


def first_reason(checks: list[tuple[str, Column]]) -> Column:
    """The name of the first check that holds; null when none does."""
    out = F.when(F.lit(False), F.lit(""))
    for name, failed in checks:
        out = out.when(F.coalesce(failed, F.lit(False)), F.lit(name))
    return out


def validate_triples(triples: DataFrame, messages: DataFrame, demand: str = DEMAND, override: str = OVERRIDE, feedback: str = FEEDBACK) -> DataFrame:
    """(anchor, corrector, quote) with ``drop_reason``, the first of twelve guards that fails, or null.

    Kept and dropped rows together are the input. Feedback to troubleshooting
    is told by thread, pos and ``asked_pos`` of ``requested_before``; messages
    without these columns pass that guard.
    """
    placed = [c for c in ("thread", "pos", "asked_pos") if c in messages.columns]
    side = lambda p: messages.select(
        F.col("id").alias(f"{p}_id"), F.col("role").alias(f"{p}_role"), F.col("name").alias(f"{p}_name"), F.col("text").alias(f"{p}_text"), F.col("ts_us").alias(f"{p}_ts"), *(F.col(c).alias(f"{p}_{c}") for c in placed)
    )
    j = triples.join(side("a"), F.col("anchor") == F.col("a_id"), "left").join(side("c"), F.col("corrector") == F.col("c_id"), "left")
    quote = T.without_space(F.col("quote"))
    strong = F.col("c_text").rlike(override)
    near = (F.col("a_thread") == F.col("c_thread")) & (F.col("c_pos") > F.col("a_pos")) & (F.col("c_asked_pos") >= F.col("a_pos")) if len(placed) == 3 else F.lit(False)
    checks = [
        ("anchor_missing", F.col("a_id").isNull()),
        ("anchor_not_bot", ~T.is_bot(F.col("a_role"))),
        ("anchor_placeholder", F.col("a_text").isNull() | F.col("a_text").rlike(PLACEHOLDER)),
        ("quote_short", quote.isNull() | (F.length(quote) < 4)),
        ("quote_absent", ~F.contains(T.without_space(F.col("a_text")), quote)),
        ("corrector_missing", F.col("c_id").isNull()),
        ("corrector_not_user", F.col("c_role").isNotNull() & ~T.is_user(F.col("c_role"))),
        ("corrector_placeholder", F.col("c_text").isNull() | F.col("c_text").rlike(PLACEHOLDER)),
        ("corrector_is_bot", T.is_bot(F.col("c_role"), F.col("c_name"))),
        ("demand_change", F.col("c_text").rlike(demand) & ~strong),
        ("troubleshooting_feedback", F.col("c_text").rlike(feedback) & ~strong & near),
        ("not_later", F.col("c_ts") <= F.col("a_ts")),
    ]
    return j.select(*triples.columns, first_reason(checks).alias("drop_reason"))


def red_flags(rows: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """Independent flags collected to a list per row."""
    listed = F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in flags.items())))
    return rows.withColumns({"flags": F.array_join(listed, ","), "n_flags": F.size(listed)})


def leaks(context: DataFrame, limits: DataFrame) -> DataFrame:
    """Whether a context holds a row at or after its limit, or the correction itself."""
    j = context.join(limits, "anchor")
    return j.groupBy("anchor").agg(
        F.max((F.col("ts_us") >= F.col("limit_us")) | (F.col("id") == F.col("corrector"))).alias("needs_review"), F.count("*").alias("n_context")
    )


def leaks_among(anchors: DataFrame, members: DataFrame, limits: DataFrame) -> DataFrame:
    """As ``leaks`` where the context of an anchor is a whole group, without pairing its members.

    ``anchors`` has anchor and place, ``members`` id, place and ts_us, ``limits``
    anchor, limit_us and corrector. The latest member of a place, and whether
    the corrector is a member of it, tell the same.
    """
    per = members.groupBy("place").agg(F.count("*").alias("n"), F.max("ts_us").alias("latest"))
    where = members.select(F.col("id").alias("corrector"), F.col("place").alias("c_place")).distinct()
    j = anchors.join(per, "place").join(limits, "anchor").join(where, "corrector", "left")
    late = F.coalesce(F.col("latest") >= F.col("limit_us"), F.lit(False)) | F.coalesce(F.col("c_place") == F.col("place"), F.lit(False))
    return j.groupBy("anchor").agg(F.max(late).alias("needs_review"), F.sum("n").alias("n_context"))


def reasons(validated: DataFrame) -> DataFrame:
    """How many rows each reason dropped; ``kept`` for the rest."""
    return validated.groupBy(F.coalesce(F.substring_index("drop_reason", "(", 1), F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def is_noise(text: Column) -> Column:
    """Receipts, cards and placeholders."""
    return F.coalesce(text.rlike(PLACEHOLDER) | text.startswith("[card]") | F.contains(text, F.lit("<at>")), F.lit(True))


def asks_more(text: Column) -> Column:
    """A new demand that corrects nothing."""
    return F.coalesce(text.rlike(DEMAND) & ~text.rlike(OVERRIDE), F.lit(False))


def troubleshooting(rows: DataFrame, keys: list[str], feedback: Column, asked: Column) -> DataFrame:
    """Adds ``is_feedback``: a text that answers a bot which asked for output within the four rows before."""
    from threadloom.operators import context

    near = context.last_before(rows, keys, asked, 4)
    return near.withColumn("is_feedback", F.coalesce(feedback, F.lit(False)) & F.col("found_pos").isNotNull()).drop("found_pos")


def requested_before(rows: DataFrame, keys: list[str], asked: Column, span: int = 4) -> DataFrame:
    """Adds ``asked_pos``, the last row among the ``span`` before that asked for output."""
    from threadloom.operators import context

    return context.last_before(rows, keys, asked, span).withColumnRenamed("found_pos", "asked_pos")


def eligible(cards: DataFrame, messages: DataFrame) -> DataFrame:
    """(b, c, ...) with ``eligible`` and ``reason``: a correction must be a user's, what it corrects a bot's."""
    side = lambda p: messages.select(F.col("id").alias(f"{p}_id"), F.when(T.is_bot(F.col("role")), "bot").when(T.is_user(F.col("role")), "user").otherwise(F.coalesce("role", F.lit("unknown"))).alias(f"{p}_role"))
    j = cards.join(side("b"), F.col("b") == F.col("b_id"), "left").join(side("c"), F.col("c") == F.col("c_id"), "left")
    reason = (
        F.when(F.col("c_id").isNull(), "missing_C").when(F.col("c_role") != "user", F.concat(F.lit("C_is_"), "c_role"))
        .when(F.col("b_id").isNull(), "missing_B").when(F.col("b_role") != "bot", F.concat(F.lit("B_is_"), "b_role")).otherwise("")
    )
    return j.select(*cards.columns, (reason == "").alias("eligible"), reason.alias("reason"))


def correction_trigger(text: Column, strong: str = OVERRIDE, challenge: str = r"(?i)^\s*(why|how come|warum|por qué|为什么)") -> Column:
    """A text that corrects or challenges."""
    return F.coalesce(text.rlike(strong) | text.rlike(challenge), F.lit(False))


def original_instruction(role: Column, text: Column, confirm: str = r"(?i)(looks good|in summary|thanks)") -> Column:
    """A user's text that starts something: neither a trigger nor a confirmation, and not blank."""
    said = F.coalesce(text, F.lit(""))
    return T.is_user(role) & ~correction_trigger(text) & ~said.rlike(confirm) & (F.trim(said) != "")


def of_classes(rows: DataFrame, verdict: str, classes: tuple[str, ...], target: str | None = None, targets: tuple[str, ...] = ()) -> DataFrame:
    """Rows whose class, and read target if one is asked for, is among those given; nulls are not."""
    kept = rows.where(F.col(verdict).isin(*classes))
    return kept if target is None else kept.where(F.col(target).isin(*targets))


def validate_picks(picks: DataFrame, rows: DataFrame, trigger: str = "user_trigger", counter: str = OVERRIDE) -> DataFrame:
    """(t0, b, c, quote, verdict) with ``drop_reason``: verdict, missing ids, roles, order, quote, reply line.

    Where ``rows`` have ``root``, ``parent`` and picks ``kind``, a correction
    of kind ``trigger`` that replies to something and does not itself say that
    it counters must hang under the same root as what it corrects.
    """
    lined = "root" in rows.columns and "kind" in picks.columns
    more = ["root", "parent"] if lined else []
    side = lambda p: rows.select(F.col("id").alias(f"{p}_id"), F.col("role").alias(f"{p}_role"), F.col("pos").alias(f"{p}_pos"), F.col("text").alias(f"{p}_text"), *(F.col(c).alias(f"{p}_{c}") for c in more))
    j = picks
    for k in ("t0", "b", "c"):
        j = j.join(side(f"x{k}"), F.col(k) == F.col(f"x{k}_id"), "left")
    quote = T.without_space(F.col("quote"))
    missing = F.array_join(F.array_compact(F.array(*(F.when(F.col(f"x{k}_id").isNull(), F.lit(k)) for k in ("t0", "b", "c")))), ",")
    reason = (
        F.when(F.coalesce(F.col("verdict"), F.lit("")) != "ACCEPT", "not_accepted").when(missing != "", F.concat(F.lit("missing("), missing, F.lit(")")))
        .when(~T.is_user(F.col("xt0_role")), "t0_not_user").when(~T.is_bot(F.col("xb_role")), "b_not_bot").when(~T.is_user(F.col("xc_role")), "c_not_user")
        .when(~((F.col("xt0_pos") < F.col("xb_pos")) & (F.col("xb_pos") < F.col("xc_pos"))), "order").when(quote.isNull() | (F.length(quote) < 4), "quote_short")
        .when(~F.coalesce(F.contains(T.without_space(F.col("xb_text")), quote), F.lit(False)), "quote_absent")
    )
    if lined:
        apart = ~F.coalesce(F.col("xb_root") == F.col("xc_root"), F.lit(False))
        reason = reason.when((F.col("kind") == trigger) & F.col("xc_parent").isNotNull() & ~F.coalesce(F.col("xc_text").rlike(counter), F.lit(False)) & apart, "reply_line")
    return j.select(*picks.columns, reason.alias("drop_reason"))
