"""Text expressions for chat rows: normal forms, previews, titles, speakers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from threadloom.functions.ids import stripped

# How speakers are written.
BOT_ROLES = ("bot", "assistant", "agent")
USER_ROLES = ("user", "human")


def role(col: Column) -> Column:
    return F.lower(stripped(col))


def is_bot(role_: Column, name: Column | None = None) -> Column:
    """A bot by role, or by a marker in the author's name."""
    by_role = F.coalesce(role_.isin(*BOT_ROLES), F.lit(False))
    return by_role if name is None else by_role | F.coalesce(name.rlike("(?i)(^|[^a-z])bot([^a-z]|$)"), F.lit(False))


def is_user(role_: Column) -> Column:
    return F.coalesce(role_.isin(*USER_ROLES), F.lit(False))


def without_space(col: Column) -> Column:
    """All white space removed, that of other scripts too."""
    return F.regexp_replace(col, r"(?U)\s+", "")


def without_punctuation(col: Column) -> Column:
    return F.regexp_replace(F.lower(col), r"(?U)[\s\p{Punct}\p{IsPunctuation}]+", "")


def without_emphasis(col: Column) -> Column:
    """Markdown emphasis and quote marks, then white space removed."""
    return without_space(F.regexp_replace(col, r"[*_`~>]+", ""))


def fingerprint(col: Column, least: int = 20, cap: int = 180) -> Column:
    """A coarse form for finding equal texts; empty when too short to tell."""
    x = F.regexp_replace(F.lower(col), r"[^\p{L}\p{N}]+", "")
    return F.when(F.length(x) >= least, F.substring(x, 1, cap)).otherwise(F.lit(""))


def one_line(col: Column, cap: int) -> Column:
    """One line without markup characters; a cut text says how much is missing."""
    flat = F.trim(F.regexp_replace(F.translate(col, "#*`|", ""), r"(?U)\s+", " "))
    rest = F.length(flat) - cap
    return F.when(rest > 0, F.concat(F.substring(flat, 1, cap), F.lit(" [+"), rest.cast("string"), F.lit("]"))).otherwise(flat)


def title(col: Column, cap: int = 30) -> Column:
    return F.substring(F.trim(F.regexp_replace(col, r"(?U)\s+", " ")), 1, cap)


def slug(col: Column, cap: int = 30) -> Column:
    """Fit for a file name."""
    x = F.regexp_replace(F.regexp_replace(col, r"[^0-9A-Za-z一-鿿]+", "-"), "^-+|-+$", "")
    return F.when(x == "", F.lit("untitled")).otherwise(F.substring(x, 1, cap))


def preview(col: Column, cap: int = 200) -> Column:
    return F.struct(F.substring(col, 1, cap).alias("head"), F.length(col).alias("n_chars"))


def structure_or_text(col: Column) -> Column:
    """VARIANT of a text that begins like structure and parses; else of the text itself."""
    parsed = F.when(F.substring(F.ltrim(col), 1, 1).isin("[", "{"), F.try_parse_json(col))
    return F.coalesce(parsed, F.when(col.isNotNull(), F.try_parse_json(F.to_json(F.struct(col.alias("v"))))))


def merged_items(*cols: Column, joiner: str = "; ") -> Column:
    """The distinct items of lists written with semicolons, in order of first sight."""
    text = F.concat_ws(";", *cols)
    items = F.filter(F.transform(F.split(text, "[;；]"), lambda x: F.trim(x)), lambda x: x != "")
    return F.array_join(F.array_distinct(items), joiner)


# What counts as a number in a text, digits with joints or Chinese numerals.
NUMBER = r"\d+(?:[.\-/→>~]\d+)*|[零一二三四五六七八九十百千万亿]+"


def number_tokens(col: Column) -> Column:
    """The distinct numbers in a text, joined ones such as ``276->318`` as one."""
    return F.array_distinct(F.regexp_extract_all(col, F.lit(f"({NUMBER})"), 1))


def leaked_numbers(principle: Column, source: Column) -> Column:
    """The numbers of the case that a rule made from it repeats, sorted; none is clean."""
    return F.array_sort(F.filter(number_tokens(F.coalesce(source, F.lit(""))), lambda t: F.contains(F.coalesce(principle, F.lit("")), t)))


def leaks_numbers(principle: Column, source: Column) -> Column:
    """Whether a rule repeats a number of the case it came from."""
    return F.size(leaked_numbers(principle, source)) > 0


def pseudonym(col: Column, tag: str) -> Column:
    """The same value always gives the same code."""
    return F.concat(F.lit(f"<{tag}_"), F.substring(F.sha1(col.cast("binary")), 1, 8), F.lit(">"))


def with_pseudonyms(col: Column, pattern: str, tag: str) -> Column:
    """Each match of ``pattern`` replaced by its pseudonym, by built-in folds."""
    found = F.array_distinct(F.regexp_extract_all(col, F.lit(f"({pattern})"), 1))
    longest_first = F.array_sort(found, lambda a, b: F.length(b) - F.length(a))
    return F.aggregate(longest_first, col, lambda acc, v: F.replace(acc, v, pseudonym(v, tag)))


def rendered(template: Column, row: Column) -> Column:
    """``{column}`` replaced from a map; doubled braces, read from the left, are literal ones."""
    opened, closed = "\x01", "\x02"
    hidden = F.replace(F.replace(template, F.lit("{{"), F.lit(opened)), F.lit("}}"), F.lit(closed))
    filled = F.aggregate(F.map_entries(row), hidden, lambda acc, e: F.replace(acc, F.concat(F.lit("{"), e["key"], F.lit("}")), F.coalesce(e["value"], F.lit(""))))
    return F.replace(F.replace(filled, F.lit(opened), F.lit("{")), F.lit(closed), F.lit("}"))


def snippet(text: Column, term: str, before: int = 48, after: int = 96) -> Column:
    """The surroundings of the first match, in either case; null without one."""
    flat = F.trim(F.regexp_replace(text, r"(?U)\s+", " "))
    at = F.instr(F.lower(flat), term.lower())
    start = F.greatest(at - before, F.lit(1))
    stop = at + len(term) + after
    cut = F.concat(
        F.when(start > 1, F.lit("... ")).otherwise(F.lit("")), F.substring(flat, start, stop - start), F.when(stop <= F.length(flat), F.lit(" ...")).otherwise(F.lit(""))
    )
    return F.when(at > 0, cut)


def unfenced(col: Column) -> Column:
    """Inline code marks removed outside fenced blocks."""
    parts = F.split(col, "```", -1)
    return F.array_join(F.transform(parts, lambda x, i: F.when(i % 2 == 0, F.replace(x, F.lit("`"), F.lit(""))).otherwise(x)), "```")


def first_match(col: Column, rules: list[tuple[str, str]], otherwise: str) -> Column:
    """The label of the first rule whose text occurs, in either case."""
    low = F.lower(F.coalesce(col, F.lit("")))
    out = reduce(lambda acc, r: acc.when(F.contains(low, F.lit(r[0])), F.lit(r[1])), rules, F.when(F.lit(False), F.lit("")))
    return out.otherwise(F.lit(otherwise))


def time_argument(col: Column) -> Column:
    """Whole seconds, or an RFC 3339 time, as seconds."""
    return F.coalesce(col.try_cast("bigint"), F.unix_timestamp(F.try_to_timestamp(col)))


def _between(col: Column, tag: str) -> Column:
    found = F.regexp_extract(col, rf"(?s)<{tag}>(.*?)</{tag}>", 1)
    return F.when(F.regexp_like(col, F.lit(rf"(?s)<{tag}>.*?</{tag}>")), found)


def split_request(content: Column, header: str, marker: str, request: str = "USER_REQUEST", metadata: str = "ADDITIONAL_METADATA") -> Column:
    """(system, said, metadata) of a user message that a tool wrapped.

    The body is what stands in the request tags, else all of it. With
    ``header`` in it, what comes before ``marker`` is the system's; without the
    marker all of it is, and the user said nothing.
    """
    whole = F.coalesce(content, F.lit(""))
    body = F.trim(F.coalesce(_between(whole, request), whole))
    injected, at = F.contains(body, F.lit(header)), F.instr(body, marker)
    system = F.when(injected & (at > 0), F.trim(F.substring(body, F.lit(1), at - 1))).when(injected, body)
    said = F.when(injected & (at > 0), F.trim(F.substr(body, at + len(marker)))).when(injected, F.lit("")).otherwise(body)
    return F.struct(system.alias("system"), said.alias("said"), F.trim(_between(whole, metadata)).alias("metadata"))


def top_objective(summaries: Column, opening: str = "<conversation_summaries>", closing: str = "</conversation_summaries>") -> Column:
    """(title, objective) of the first block of a list of summaries, which is the newest; nulls without one."""
    inside = F.when(F.contains(summaries, F.lit(opening)), F.split_part(F.substr(summaries, F.instr(summaries, opening) + len(opening)), F.lit(closing), F.lit(1)))
    blocks = F.filter(F.split(F.concat(F.lit("\n"), inside), r"\n##\s+Conversation "), lambda b: F.trim(F.translate(b, "\n", "")) != "")
    first = F.try_element_at(blocks, F.lit(1))
    title = F.when(F.contains(first, F.lit(":")), F.trim(F.split_part(F.substr(first, F.instr(first, ":") + 1), F.lit("\n"), F.lit(1))))
    mark = "### USER Objective:"
    after = F.when(F.contains(first, F.lit(mark)), F.trim(F.split(F.btrim(F.substr(first, F.instr(first, mark) + len(mark)), F.lit(" \n")), r"\n##\s")[0]))
    return F.struct(title.alias("title"), F.when(after != "", after).alias("objective"))


def lane_name(lane: Column, group: str, main: str) -> Column:
    """A lane without the group in front of it; the main one as MAIN."""
    rest = F.regexp_replace(F.substr(lane, F.instr(lane, group) + len(group)), "^:+", "")
    return F.when(lane == main, F.lit("MAIN")).when(F.contains(lane, F.lit(group)), rest).otherwise(lane)
