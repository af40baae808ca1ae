"""Ordered conversations from message rows.

The reply forest of the core only says which messages belong together. Kahn's
algorithm then sorts each group topologically, the times of the messages
breaking ties, and finds what is broken: a message that is left over hangs on
a message that never came, or on a cycle. Speakers and completeness are checked
on the order it gives. Groups go to tasks in buckets of bounded size. A larger
one is cut into ranges of the order that Kahn's algorithm would give, which
only ever goes up along a path; every range is sorted by the same algorithm,
the messages that earlier ranges took being free already.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions.ids import stripped
from threadloom.operators import forest, instants, ordered
from threadloom.session import broadcast_if_small, materialise

BUCKET_ROWS = 32768
"""Messages that one task sorts at once."""
OTHER, USER, BOT = 0, 1, 2
# How the speakers are written.
USERS, BOTS = ("user", "human"), ("bot", "assistant", "agent")
# White space and characters without width.
_NO_TEXT = r"^[\s\x1c-\x1f\x85\xa0\xad\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}\x{2029}\x{202f}\x{205f}-\x{2064}\x{3000}\x{feff}]*$"


def speaker(role: Column) -> Column:
    x = F.lower(stripped(role))
    return F.when(x.isin(*USERS), F.lit(USER)).when(x.isin(*BOTS), F.lit(BOT)).otherwise(F.lit(OTHER))


def has_text(text: Column) -> Column:
    return F.coalesce(~text.rlike(_NO_TEXT), F.lit(False))


def timed_messages(events: DataFrame, groups: DataFrame) -> DataFrame:
    """One row per identifier with its speaker, whether it has text, and its time.

    The time is the instant of ``ts``, or of ``created_at`` if ``ts`` denotes
    none, or null.
    """
    rows = forest.messages(
        events,
        ts_us=instants.number_to_us(F.col("ts")),
        raw=F.when(instants.number_to_us(F.col("ts")).isNull(), F.col("created_at")),
        group_id=F.col("group_id"),
        who=speaker(F.col("role")),
        said=has_text(F.col("text")),
    )
    rows = materialise(rows, "messages")
    columns = ["id", "parent", "pos", "who", "said"]
    timed = rows.where("ts_us is not null or raw is null").select(*columns, F.col("ts_us").alias("value"))
    written = instants.parse_texts(instants.with_zone(rows.where("ts_us is null and raw is not null"), groups))
    return timed.unionByName(written.select(*columns, F.col("instant_us").alias("value")))


def kahn(ids: list[str], parents: list[str | None], times: list[int], taken: list[tuple[int, int] | None] | None = None) -> list[int]:
    """Positions of the messages in topological order.

    A message becomes free when its parent was taken; one without parent is
    free at once, and so is one whose parent was ``taken`` elsewhere, with the
    latest time on its path and its steps from the root given there. Of the
    free ones that with the earliest latest time on its path goes first, then
    the one with the fewest steps, then the smallest identifier. Messages never
    freed are left out: their parent never came, or they lie on or below a
    cycle.
    """
    at = {x: i for i, x in enumerate(ids)}
    replies: dict[int, list[int]] = {}
    free = []
    for i, p in enumerate(parents):
        if p is None:
            free.append((times[i], 0, ids[i], i))
        elif p in at:
            replies.setdefault(at[p], []).append(i)
        elif taken is not None and taken[i] is not None:
            free.append((*taken[i], ids[i], i))
    heapq.heapify(free)
    out = []
    while free:
        latest, steps, _, i = heapq.heappop(free)
        out.append(i)
        for k in replies.get(i, ()):
            heapq.heappush(free, (max(latest, times[k]), steps + 1, ids[k], k))
    return out


def complete(order: list[int], who: list[int], said: list[bool]) -> bool:
    """Some user message has text, and a bot message with text follows the last user message."""
    asked, answered = False, False
    for i in order:
        if who[i] == USER:
            asked = asked or said[i]
            answered = False
        elif who[i] == BOT and said[i]:
            answered = True
    return asked and answered


_PLACED = "root_id string, pos bigint, msg_id string, who int"


def _by_root(roots: list[str]) -> dict[str, list[int]]:
    out: dict[str, list[int]] = {}
    for i, root in enumerate(roots):
        out.setdefault(root, []).append(i)
    return out


def _sort_bucket(bucket: pa.Table) -> pa.Table:
    columns = {c: bucket[c].to_pylist() for c in ("root", "id", "up", "value", "who", "said")}
    out: list[list] = [[], [], [], []]
    for root, rows in _by_root(columns["root"]).items():
        own = {c: [v[i] for i in rows] for c, v in columns.items() if c != "root"}
        order = kahn(own["id"], own["up"], own["value"])
        if len(order) != len(rows) or not complete(order, own["who"], own["said"]):
            continue
        out[0] += [root] * len(order)
        out[1] += range(1, len(order) + 1)
        out[2] += [own["id"][i] for i in order]
        out[3] += [own["who"][i] for i in order]
    return pa.table({"root_id": pa.array(out[0], pa.string()), "pos": pa.array(out[1], pa.int64()), "msg_id": pa.array(out[2], pa.string()), "who": pa.array(out[3], pa.int32())})


def _sort_range(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``rank`` within the range, 0 for messages left over."""
    held = list(batches)
    if not held:
        return
    rows = pa.Table.from_batches(held)
    columns = {c: rows[c].to_pylist() for c in ("root", "id", "up", "value", "most", "depth")}
    ranks = [0] * rows.num_rows
    for mine in _by_root(columns["root"]).values():
        # Below a root the parent lies in an earlier range unless it is here.
        taken = [(columns["most"][i], columns["depth"][i]) if columns["depth"][i] else None for i in mine]
        order = kahn([columns["id"][i] for i in mine], [columns["up"][i] for i in mine], [columns["value"][i] for i in mine], taken)
        for rank, i in enumerate(order, 1):
            ranks[mine[i]] = rank
    yield from rows.select(["root", "part", "id", "who", "said"]).append_column("rank", pa.array(ranks, pa.int64())).to_batches()


def _by_ranges(rows: DataFrame, n_rows: int, n_roots: int, bucket_rows: int) -> DataFrame:
    """Conversations of any size, by Kahn's algorithm over ranges of their order.

    A message's position is its rank in its own range plus the messages of the
    same conversation in earlier ranges. A conversation of which any message is
    left over is broken.
    """
    ranged = rows.repartitionByRange(max(1, -(-n_rows // bucket_rows)), "root", "most", "depth", "id").withColumn("part", F.spark_partition_id())
    ranked = ranged.select("root", "part", "id", "up", "value", "most", "depth", "who", "said").mapInArrow(_sort_range, "root string, part int, id string, who int, said boolean, rank bigint")
    ranked = materialise(ranked, "ranges")
    per = ranked.groupBy("root", "part").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("root").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = ranked.join(per.select("root", "part", before.alias("before")), ["root", "part"]).withColumn("pos", F.col("rank") + F.col("before"))
    user, bot = F.col("who") == USER, (F.col("who") == BOT) & F.col("said")
    ends = placed.groupBy("root").agg(
        F.max(F.when(user, F.col("pos"))).alias("last_user"), F.max(F.when(bot, F.col("pos"))).alias("last_bot"), F.max(user & F.col("said")).alias("asked"), F.min("rank").alias("least")
    )
    kept = ends.where("asked and last_bot > last_user and least > 0").select("root")
    kept = broadcast_if_small(kept, n_roots * 128)
    return placed.join(kept, "root").select(F.col("root").alias("root_id"), "pos", F.col("id").alias("msg_id"), "who")


def spoken(events: DataFrame, groups: DataFrame, bucket_rows: int = BUCKET_ROWS, block_rows: int = forest.BLOCK_ROWS) -> DataFrame:
    """(root_id, pos, msg_id, who) of each message of each kept conversation; ``who`` is 1 for a user, 2 for a bot, else 0."""
    nodes = timed_messages(events, groups).withColumn("up", F.col("parent")).withColumn("value", F.coalesce("value", F.lit(forest.LOWEST))).withColumn("own", F.col("value"))
    rows = forest.resolve(nodes, block_rows=block_rows, keep=("up", "own", "who", "said"))
    # A message on or below a cycle has no root and is left over wherever it goes.
    rows = materialise(rows.select("id", F.coalesce("root", "id").alias("root"), "depth", "most", "up", F.col("own").alias("value"), "who", "said"), "grouped")
    large = materialise(rows.groupBy("root").agg(F.count("*").alias("n")).where(F.col("n") > bucket_rows), "large")
    found = large.agg(F.count("*").alias("roots"), F.sum("n").alias("n")).first()
    some = rows
    if found["roots"]:
        named = broadcast_if_small(large.select("root"), found["roots"] * 128)
        some = rows.join(named, "root", "left_anti")
    buckets = max(1, -(-2 * rows.count() // bucket_rows))
    some = some.select(F.pmod(F.xxhash64("root"), F.lit(buckets)).alias("bucket"), "root", "id", "up", "value", "who", "said")
    out = some.groupBy("bucket").applyInArrow(_sort_bucket, _PLACED)
    if found["roots"]:
        out = out.unionByName(_by_ranges(rows.join(named, "root", "left_semi"), found["n"], found["roots"], bucket_rows))
    return out


def conversations(events: DataFrame, groups: DataFrame, bucket_rows: int = BUCKET_ROWS, block_rows: int = forest.BLOCK_ROWS) -> DataFrame:
    """(root_id, pos, msg_id) of each message of each kept conversation.

    Rows without identifier take no part, the first row of an identifier
    counts, messages under a missing message or a cycle belong to none. A
    message without any time counts as earliest. Empty tables give no rows.
    """
    return spoken(events, groups, bucket_rows, block_rows).drop("who")


def alternation(placed: DataFrame) -> DataFrame:
    """(root_id, n_messages, n_turns, n_repeated, alternates) of conversations from ``spoken``.

    A turn is a run of messages of one side; a repeated message follows one of
    its own side. Messages of neither side are counted but take no turn. A
    conversation alternates when user and bot messages strictly take turns. An
    empty table gives no rows.
    """
    sides = ordered.running(placed.where(F.col("who") != OTHER), ["root_id"], ["pos"], {"before": (ordered.LAG, F.col("who"))})
    repeated = sides.groupBy("root_id").agg(F.count("*").alias("n"), F.count_if(F.col("before") == F.col("who")).alias("n_repeated"))
    total = placed.groupBy("root_id").agg(F.count("*").alias("n_messages"))
    out = total.join(repeated, "root_id", "left")
    return out.select("root_id", "n_messages", F.coalesce(F.col("n") - F.col("n_repeated"), F.lit(0)).alias("n_turns"), F.coalesce("n_repeated", F.lit(0)).alias("n_repeated"), (F.coalesce("n_repeated", F.lit(0)) == 0).alias("alternates"))
