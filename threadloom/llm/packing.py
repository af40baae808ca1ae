"""Documents placed in containers of fixed capacity with little unused space.

A grouping genetic algorithm: a solution is a set of containers, and crossover
passes whole containers on. The well-filled containers of one parent are
injected into the other; containers of the other that hold one of the same
documents are taken apart, and the documents displaced are exchanged for
smaller ones where that fills a container better, then put where they fit
best. Documents are dealt to cells of bounded size. Every cell is worked on by
several islands, populations with different seeds in different tasks, which
send their best solution to the next island after each epoch. Containers that
stay loose are taken apart once more and dealt anew, across cells.
"""

from __future__ import annotations

import random
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm import tokens
from threadloom.session import materialise

CAPACITY = 2048
CELL_ITEMS = 1000
"""Documents per cell on average; cells are drawn by hash, so their sizes stay close to it."""
ISLANDS = 2
ISLANDS_PER_TASK = 64
EPOCHS = 2
GENERATIONS = 8
POPULATION = 4
LOOSE = 0.97
"""Containers filled less than this are dealt anew."""
ROUNDS = 2
"""How often loose containers are dealt anew."""

REFINED = 40
"""Containers in which a child tries exchanges."""

Solution = list[list[int]]


def best_fit(order: list[int], sizes: list[int], capacity: int, bins: Solution | None = None) -> Solution:
    """Puts items, in ``order``, where the least space remains; adds to ``bins``."""
    bins = [] if bins is None else bins
    free = [(capacity - sum(sizes[i] for i in b), k) for k, b in enumerate(bins)]
    free.sort()
    for i in order:
        need = sizes[i]
        at = bisect_left(free, (need, -1))
        if at < len(free):
            left, k = free.pop(at)
            bins[k].append(i)
            left -= need
        else:
            k, left = len(bins), capacity - need
            bins.append([i])
        if left:
            insort(free, (left, k))
    return bins


def fitness(bins: Solution, sizes: list[int], capacity: int) -> float:
    """Few containers first; among as many, uneven filling, which leaves useful space."""
    return sum((sum(sizes[i] for i in b) / capacity) ** 2 for b in bins) / max(1, len(bins)) - len(bins)


def crossover(giver: Solution, taker: Solution, sizes: list[int], capacity: int, rng: random.Random) -> Solution:
    """``taker`` with well-filled containers of ``giver``."""
    fills = sorted(((sum(sizes[i] for i in b), k) for k, b in enumerate(giver)), reverse=True)
    top = fills[: max(1, len(fills) // 2)]
    share = rng.uniform(0.3, 0.9)
    injected = [giver[k] for fill, k in top if fill == capacity or rng.random() < share]
    inside = {i for b in injected for i in b}
    kept, displaced = [], []
    for b in taker:
        rest = [i for i in b if i not in inside]
        if len(rest) == len(b):
            kept.append(b)
        else:
            displaced += rest
    return refit([*map(list, injected), *map(list, kept)], displaced, sizes, capacity, rng)


def refit(bins: Solution, displaced: list[int], sizes: list[int], capacity: int, rng: random.Random) -> Solution:
    """Takes some of the loosest containers apart too, then fits all displaced items best."""
    bins.sort(key=lambda b: sum(sizes[i] for i in b))
    loose = rng.randint(1, max(1, min(len(bins), 3 + len(bins) // 20))) if bins else 0
    for b in bins[:loose]:
        displaced += b
    kept = bins[loose:]
    displaced = exchanged(kept, displaced, sizes, capacity, rng)
    displaced.sort(key=lambda i: -sizes[i])
    return best_fit(displaced, sizes, capacity, kept)


def exchanged(bins: Solution, displaced: list[int], sizes: list[int], capacity: int, rng: random.Random) -> list[int]:
    """Swaps up to two items of a container for up to two displaced ones that fill it better.

    Small items come free that way, which are easier to place. Changes ``bins``
    and gives the items then displaced.
    """
    pool = sorted((sizes[i], i) for i in displaced)
    open_ = [k for k, b in enumerate(bins) if sum(sizes[i] for i in b) < capacity]
    for k in rng.sample(open_, min(REFINED, len(open_))):
        b = bins[k]
        free = capacity - sum(sizes[i] for i in b)
        best: tuple[int, tuple[int, ...], tuple[int, ...]] = (0, (), ())
        for out in [(x,) for x in b] + [(x, y) for n, x in enumerate(b) for y in b[:n]]:
            held = sum(sizes[i] for i in out)
            most = held + free
            at = bisect_right(pool, (most, len(sizes))) - 1
            if at >= 0 and pool[at][0] - held > best[0]:
                best = (pool[at][0] - held, out, (at,))
            for first in range(min(at + 1, len(pool))):
                second = bisect_right(pool, (most - pool[first][0], len(sizes))) - 1
                if second > first and pool[first][0] + pool[second][0] - held > best[0]:
                    best = (pool[first][0] + pool[second][0] - held, out, (first, second))
            if best[0] == free:
                break
        if best[0]:
            _, out, entering = best
            bins[k] = [i for i in b if i not in out] + [pool[at][1] for at in entering]
            for at in reversed(entering):
                del pool[at]
            for i in out:
                insort(pool, (sizes[i], i))
    return [i for _, i in pool]


def evolve(sizes: list[int], population: list[Solution], seed: int, capacity: int = CAPACITY, generations: int = GENERATIONS) -> list[Solution]:
    """The population after some generations, best first."""
    rng = random.Random(seed)
    least = -(-sum(sizes) // capacity)
    while len(population) < POPULATION:
        order = sorted(range(len(sizes)), key=lambda i: -sizes[i] * (rng.uniform(0.85, 1.15) if population else 1))
        population.append(best_fit(order, sizes, capacity))
    scored = sorted(((fitness(s, sizes, capacity), k, s) for k, s in enumerate(population)), key=lambda x: (-x[0], x[1]))
    number = len(scored)
    for _ in range(generations):
        if len(scored[0][2]) <= least:
            break
        for _ in range(max(1, len(scored) // 2)):
            a, b = rng.sample(range(len(scored)), 2) if len(scored) > 1 else (0, 0)
            child = crossover(scored[a][2], scored[b][2], sizes, capacity, rng)
            scored.append((fitness(child, sizes, capacity), number, child))
            number += 1
        scored.sort(key=lambda x: (-x[0], x[1]))
        del scored[POPULATION:]
    return [s for _, _, s in scored]


def _numbers(bins: Solution, n: int) -> list[int]:
    out = [0] * n
    for k, b in enumerate(bins):
        for i in b:
            out[i] = k
    return out


def _bins(numbers: list[int]) -> Solution:
    out: Solution = [[] for _ in range(max(numbers, default=-1) + 1)]
    for i, k in enumerate(numbers):
        out[k].append(i)
    return [b for b in out if b]


_ISLAND = "cell bigint, island int, uids array<bigint>, sizes array<int>, population array<array<int>>, score double"


def _epoch(number: int, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.to_pydict()
            grown, scores = [], []
            for cell, island, sizes, population in zip(columns["cell"], columns["island"], columns["sizes"], columns["population"], strict=True):
                seed = (cell * 31 + island) * 31 + number
                found = evolve(sizes, [_bins(s) for s in population or []], seed, capacity)
                grown.append([_numbers(s, len(sizes)) for s in found])
                scores.append(fitness(found[0], sizes, capacity))
            lists = pa.array(grown, pa.list_(pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(
                [batch["cell"], batch["island"], batch["uids"], batch["sizes"], lists, pa.array(scores, pa.float64())],
                ["cell", "island", "uids", "sizes", "population", "score"],
            )

    return run


def pack_items(items: DataFrame, n_items: int, round_: int = 0, capacity: int = CAPACITY, cell_items: int = CELL_ITEMS) -> DataFrame:
    """(uid, size, cell, bin, fill): ``items`` of (uid, size) in containers of their cells."""
    cells = max(1, round(n_items / cell_items))
    dealt = items.withColumn("cell", F.pmod(F.xxhash64("uid", F.lit(round_)), F.lit(cells)))
    # A cell holds about ``cell_items`` items, whatever the data.
    packed = dealt.groupBy("cell").agg(F.sort_array(F.collect_list(F.struct("uid", "size"))).alias("x"))
    islands = packed.select(
        "cell", F.explode(F.array(*(F.lit(k) for k in range(ISLANDS)))).alias("island"), F.col("x.uid").alias("uids"), F.col("x.size").alias("sizes"),
        F.lit(None).cast("array<array<int>>").alias("population"), F.lit(None).cast("double").alias("score"),
    )
    tasks = max(1, min(cells * ISLANDS, max(3 * items.sparkSession.sparkContext.defaultParallelism, cells * ISLANDS // ISLANDS_PER_TASK)))
    for epoch in range(EPOCHS):
        # A number of tasks that adaptive execution leaves alone: an island is much work in few bytes.
        spread = islands.repartition(tasks, "cell", "island")
        islands = materialise(spread.mapInArrow(_epoch(epoch + round_ * EPOCHS, capacity), _ISLAND), "islands")
        if epoch + 1 < EPOCHS:
            migrants = islands.select("cell", ((F.col("island") + 1) % ISLANDS).alias("island"), F.slice("population", 1, 1).alias("migrant"))
            islands = islands.join(migrants, ["cell", "island"]).withColumn("population", F.concat("population", "migrant")).drop("migrant").select(*islands.columns)
    best = islands.groupBy("cell").agg(F.max_by(F.struct("uids", "sizes", F.col("population")[0].alias("bins")), F.col("score")).alias("b"))
    flat = best.select("cell", F.explode(F.arrays_zip("b.uids", "b.sizes", "b.bins")).alias("r"))
    placed = flat.select(F.col("r.uids").alias("uid"), F.col("r.sizes").alias("size"), "cell", F.col("r.bins").alias("bin"))
    fills = placed.groupBy("cell", "bin").agg(F.sum("size").alias("fill"))
    return placed.join(fills, ["cell", "bin"]).select("uid", "size", "cell", "bin", "fill")


def pack(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, capacity: int = CAPACITY, cell_items: int = CELL_ITEMS) -> DataFrame:
    """(container_id, doc_id, part, start, n_tokens): every token of every text in one container.

    A text of at most ``capacity`` tokens lies whole in one container. A longer
    one fills containers of its own; only what is left over is packed with
    others. Null and empty texts are not placed. Rows with equal ids are placed
    each for itself.
    """
    counts = tokens.token_counts(documents, id_col, text_col, path).where("n_tokens > 0")
    counts = materialise(counts.withColumn("uid", F.monotonically_increasing_id()), "sizes")
    whole = (F.col("n_tokens") / capacity).cast("bigint")
    full = counts.where(F.col("n_tokens") >= capacity).select(
        "uid", id_col, F.explode(F.sequence(F.lit(0).cast("bigint"), whole - 1)).alias("part")
    )
    full = full.select(
        F.concat(F.lit("w"), "uid", F.lit("-"), "part").alias("container_id"), id_col, "part", (F.col("part") * capacity).alias("start"), F.lit(capacity).cast("bigint").alias("n_tokens")
    )
    rest = counts.where(F.col("n_tokens") % capacity > 0)
    items = rest.select("uid", (F.col("n_tokens") % capacity).cast("int").alias("size"))
    left, done = items.count(), None
    for round_ in range(ROUNDS + 1):
        placed = materialise(pack_items(items, left, round_, capacity, cell_items), "placed")
        last = round_ == ROUNDS
        loose = F.col("fill") < LOOSE * capacity
        names = placed.select("uid", F.concat(F.lit(f"r{round_}-"), "cell", F.lit("-"), "bin").alias("container_id"), loose.alias("loose"))
        settled = names.where("not loose") if not last else names
        done = settled if done is None else done.unionByName(settled)
        if last:
            break
        items = placed.where(loose).select("uid", "size")
        left = items.count()
        if not left:
            break
    shared = rest.join(done.drop("loose"), "uid").select(
        "container_id", id_col, whole.alias("part"), (whole * capacity).alias("start"), (F.col("n_tokens") % capacity).alias("n_tokens")
    )
    return full.unionByName(shared)


def utilisation(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(containers, tokens, fewest, unused_share): how well the containers are used."""
    total = F.sum("n_tokens")
    n = F.count_distinct("container_id")
    return packed.agg(n.alias("containers"), total.alias("tokens"), F.ceil(total / capacity).alias("fewest"), F.round(1 - total / (n * capacity), 6).alias("unused_share"))
