"""Steps and messages as trajectories per trace, session and speaker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.functions import text as T


def trace_summary(steps: DataFrame) -> DataFrame:
    """Per trace, from its ordered steps: first model, span, tools used, counts by type.

    ``steps`` has trace_id, pos, type, start_ns, model, tool_name, error. Empty
    texts count as missing.
    """
    filled = lambda c: F.when(F.col(c) != "", F.col(c))
    return steps.groupBy("trace_id").agg(
        F.min_by(filled("model"), F.when(filled("model").isNotNull(), F.col("pos"))).alias("first_model"),
        F.max_by(filled("model"), F.when(filled("model").isNotNull(), F.col("pos"))).alias("last_model"),
        F.min("start_ns").alias("first_ns"), F.max("start_ns").alias("last_ns"),
        F.array_join(F.sort_array(F.collect_set(filled("tool_name"))), ",").alias("tools"),
        F.count("*").alias("n_steps"), F.count_if(F.col("type") == "model").alias("n_model"), F.count_if(F.col("type") == "tool").alias("n_tool"),
        F.count_if(filled("error").isNotNull()).alias("n_errors"),
    )


def token_sums(traces: DataFrame, by: list[str]) -> DataFrame:
    """Token counts added up by kind; absent kinds count as nothing."""
    rows = traces.select(*by, F.explode("tokens").alias("token_kind", "n"))
    return rows.groupBy(*by, "token_kind").agg(F.sum("n").alias("n_tokens"), F.count("*").alias("n_traces"))


def step_rows(traces: DataFrame) -> DataFrame:
    """One row per step that is not null, with its place from 0."""
    rows = traces.select("trace_id", "thread_id", F.posexplode("steps").alias("pos", "s")).where("s is not null")
    return rows.select("trace_id", "thread_id", F.col("pos").cast("bigint").alias("pos"), "s.*")


def message_rows(traces: DataFrame) -> DataFrame:
    rows = traces.select("trace_id", "thread_id", F.posexplode("messages").alias("pos", "m")).where("m is not null")
    return rows.select("trace_id", "thread_id", F.col("pos").cast("bigint").alias("pos"), "m.*")


def turns(steps: DataFrame) -> DataFrame:
    """A model step and the tool steps right after it become one turn.

    Tool steps that follow no model step of their trace, or come after a step
    of another type, are orphans. Works on the array of each trace, so that no
    row leaves it.
    """
    sorted_steps = steps.groupBy("trace_id").agg(F.array_sort(F.collect_list(F.struct("pos", "type", "tool_name"))).alias("x"))
    state = F.aggregate(
        "x",
        F.struct(F.lit(-1).cast("int").alias("turn"), F.lit(False).alias("open"), F.array().cast("array<struct<pos:bigint,type:string,turn:int,k:int,tool_name:string>>").alias("out"), F.lit(0).alias("k")),
        lambda acc, s: F.when(
            s["type"] == "model",
            F.struct((acc["turn"] + 1).alias("turn"), F.lit(True).alias("open"), F.concat(acc["out"], F.array(F.struct(s["pos"].alias("pos"), s["type"].alias("type"), (acc["turn"] + 1).alias("turn"), F.lit(0).alias("k"), s["tool_name"].alias("tool_name")))).alias("out"), F.lit(0).alias("k")),
        ).when(
            s["type"] == "tool",
            F.struct(acc["turn"].alias("turn"), acc["open"].alias("open"), F.concat(acc["out"], F.array(F.struct(s["pos"].alias("pos"), s["type"].alias("type"), F.when(acc["open"], acc["turn"]).alias("turn"), (acc["k"] + 1).alias("k"), s["tool_name"].alias("tool_name")))).alias("out"), (acc["k"] + 1).alias("k")),
        ).otherwise(F.struct(acc["turn"].alias("turn"), F.lit(False).alias("open"), acc["out"].alias("out"), F.lit(0).alias("k"))),
        lambda acc: acc["out"],
    )
    return sorted_steps.select("trace_id", F.explode(state).alias("r")).select("trace_id", "r.*")


def tool_bindings(messages: DataFrame) -> DataFrame:
    """Tool messages bound to the calls of the last assistant that made some, first in first out.

    Call ids count through the conversation. An assistant without calls leaves
    what is pending; surplus tool messages get no id.
    """
    rows = messages.groupBy("trace_id").agg(F.array_sort(F.collect_list(F.struct("pos", "role", F.greatest(F.size(F.coalesce("tool_calls", F.array())), F.lit(0)).alias("n")))).alias("x"))
    entry = "array<struct<pos:bigint,call:int>>"
    bound = F.aggregate(
        "x",
        F.struct(F.lit(0).alias("made"), F.lit(0).alias("next"), F.lit(0).alias("end"), F.array().cast(entry).alias("out")),
        lambda a, m: F.when(
            (m["role"] == "assistant") & (m["n"] > 0),
            F.struct((a["made"] + m["n"]).alias("made"), a["made"].alias("next"), (a["made"] + m["n"]).alias("end"), a["out"].alias("out")),
        ).when(
            m["role"] == "tool",
            F.struct(a["made"].alias("made"), F.least(a["next"] + 1, a["end"]).alias("next"), a["end"].alias("end"),
                     F.concat(a["out"], F.array(F.struct(m["pos"].alias("pos"), F.when(a["next"] < a["end"], a["next"]).alias("call")))).alias("out")),
        ).otherwise(a),
        lambda a: a["out"],
    )
    flat = rows.select("trace_id", F.explode(bound).alias("r"))
    return flat.select("trace_id", F.col("r.pos").alias("pos"), F.when(F.col("r.call").isNotNull(), F.concat(F.lit("call_"), F.col("r.call").cast("string"))).alias("call_id"))


def chat_samples(messages: DataFrame, least_calls: int = 1) -> DataFrame:
    """(trace_id, pos, role, content, call_id): what a chat sample keeps of each trace.

    The first system message, the first of a user with text, and all of
    assistant and tools; tool messages have the id of their call. Traces with
    less than ``least_calls`` calls are left out.
    """
    m = messages.select("trace_id", "pos", "role", "content", F.greatest(F.size(F.coalesce("tool_calls", F.array())), F.lit(0)).alias("n"))
    said = (F.col("role") == "user") & (F.trim(F.coalesce("content", F.lit(""))) != "")
    g = m.groupBy("trace_id").agg(F.min(F.when(F.col("role") == "system", F.col("pos"))).alias("s"), F.min(F.when(said, F.col("pos"))).alias("u"), F.sum(F.when(F.col("role") == "assistant", F.col("n")).otherwise(0)).alias("calls"))
    kept = m.join(g.where(F.col("calls") >= least_calls), "trace_id").where((F.col("pos") == F.col("s")) | (F.col("pos") == F.col("u")) | F.col("role").isin("assistant", "tool"))
    bound = tool_bindings(messages).select(F.col("trace_id").alias("t"), F.col("pos").alias("p"), "call_id")
    return kept.join(bound, (F.col("trace_id") == F.col("t")) & (F.col("pos") == F.col("p")), "left").select("trace_id", "pos", "role", "content", "call_id")


def completion_start(messages: DataFrame) -> DataFrame:
    """Where the output begins: the first message after the last one that is not an assistant's."""
    return messages.groupBy("trace_id").agg(
        (F.coalesce(F.max(F.when(F.col("role") != "assistant", F.col("pos"))), F.lit(-1)) + 1).alias("completion_start_index"), F.count("*").alias("n_messages")
    )


def surfaced_instruction(messages: DataFrame, probe: str = "probe") -> DataFrame:
    """The instruction of each trace and where it comes from: the user, else injected, else nothing but probes."""
    user = (F.col("role") == "user") & (F.trim(F.coalesce("content", F.lit(""))) != "") & (F.col("content") != probe)
    injected = (F.col("role") == "system") & (F.trim(F.coalesce("content", F.lit(""))) != "")
    g = messages.groupBy("trace_id").agg(F.min(F.when(user, F.struct("pos", "content"))).alias("u"), F.min(F.when(injected, F.struct("pos", "content"))).alias("i"))
    return g.select(
        "trace_id", F.coalesce("u.content", "i.content").alias("instruction"),
        F.when(F.col("u").isNotNull(), "real_user").when(F.col("i").isNotNull(), "injected").otherwise("probe_only").alias("source"),
    )


def session_trajectories(messages: DataFrame, key: str) -> DataFrame:
    """Per session of chat rows: span, turns by speaker, retries, first request, how it ends."""
    bot, user = T.is_bot(F.col("role")), T.is_user(F.col("role"))
    at = F.struct("ts_us", "row_id")
    return messages.groupBy(key).agg(
        F.min("ts_us").alias("first_us"), F.max("ts_us").alias("last_us"), F.count("*").alias("n_messages"), F.count_if(user).alias("n_user"), F.count_if(bot).alias("n_bot"),
        F.greatest(F.count_if(user) - 1, F.lit(0)).alias("n_retries"), F.substring(F.min_by(F.when(user, F.col("text")), F.when(user & F.col("text").isNotNull(), at)), 1, 60).alias("first_request"),
        F.max_by(bot, at).alias("ends_with_bot"),
    )


def identities(calls: DataFrame, by: list[str]) -> DataFrame:
    """Calls of one identity: count, span, versions in order of first sight."""
    seen = calls.groupBy(*by, "version").agg(F.min("row_id").alias("first"))
    versions = seen.groupBy(*by).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("first", "version"))), lambda x: x["version"]), ",").alias("versions"))
    spans = calls.groupBy(*by).agg(F.count("*").alias("n_calls"), F.min("ts_us").alias("first_us"), F.max("ts_us").alias("last_us"))
    return spans.join(versions, by)


def outcome(terminal: Column, status: Column, verdict: Column) -> Column:
    return F.when(~terminal, "incomplete").when(F.coalesce(verdict, F.lit("")) == "failure", "failure").when(F.coalesce(status, F.lit("")) == "corrected", "corrected").otherwise("success")


def confirmation(terminal: Column, tail_by: Column, closing: Column, delivery: Column) -> Column:
    """Whether a task's result was confirmed, from its last meaningful message."""
    return (
        F.when(~terminal, "open").when(tail_by.isNull(), "done")
        .when(tail_by == "user", F.when(closing, "done").otherwise("unconfirmed"))
        .otherwise(F.when(F.coalesce(delivery, F.lit("")).isin("placeholder_only", "none"), "unconfirmed").otherwise("done"))
    )


def legs(hint: Column, base: Column, placebo: Column, treated: Column) -> Column:
    """Reading of a three-leg replay; unknown legs stay unknown."""
    passed = hint & F.coalesce(base, F.lit(False)) & F.coalesce(~treated, F.lit(False))
    return F.when(passed & F.coalesce(placebo, F.lit(False)), "isolated").when(passed & F.coalesce(~placebo, F.lit(False)), "confounded").when(passed, "passed").when(F.coalesce(base, F.lit(False)), "reproduced").otherwise("note")


def assistant_text(output: Column) -> Column:
    """The text of an answer given as JSON messages whose content is a string or a list of parts."""
    v = F.try_parse_json(output)
    flat = F.from_json(F.when(output.startswith("["), output), "array<struct<role:string,content:string>>")
    said = F.filter(flat, lambda m: (m["role"] == "assistant") & m["content"].isNotNull())
    texts = F.transform(said, lambda m: F.coalesce(F.array_join(F.transform(F.from_json(F.when(m["content"].startswith("["), m["content"]), "array<struct<type:string,text:string>>"), lambda p: p["text"]), ""), m["content"]))
    return F.when(v.isNotNull(), F.array_join(texts, "\n")).otherwise(output)


def hard_example(status: Column, steps: Column, reworked: Column) -> Column:
    """(reason, error_step_idx): why a sample is hard, a correction before a tool error before rework; null when it is not.

    The first step with an error is told for each of the three; an empty error is none.
    """
    failed = F.filter(F.transform(steps, lambda s, i: F.when(s["error"].isNotNull() & (s["error"] != ""), i)), lambda i: i.isNotNull())
    reason = F.when(F.coalesce(status == "corrected", F.lit(False)), "corrected").when(F.size(failed) > 0, "tool_error").when(F.coalesce(reworked, F.lit(False)), "rework")
    return F.struct(reason.alias("reason"), F.when(reason.isNotNull(), F.try_element_at(failed, F.lit(1))).alias("error_step_idx"))


def chat_steps(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """(…, id, step, loss): messages as steps from 0; what users say is not trained on."""
    from threadloom.operators.ordered import numbered

    placed = numbered(rows, by, order, "__n")
    return placed.select(*by, "id", (F.col("__n") - 1).alias("step"), F.when(T.is_user(F.col("role")), 0).otherwise(1).alias("loss"))
