"""Cosine search of a stated query set against all rows, block by block.

Queries are the rows whose id is divisible by 100. Both sides form blocks, and
every query block meets every block of rows in one matrix product.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def _unit(rows: pa.Array) -> np.ndarray:
    m = np.array(rows.to_pylist(), dtype=np.float64)
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return m / np.where(norm == 0, 1, norm)


BLOCK = 1024
"""Ids per block of rows; a block of 64 floats each takes a quarter of a megabyte."""
QUERY_EVERY = 100
HARDEST = 6


def _searched(vectors: DataFrame, cols: tuple[str, str, str], kernel: Callable[..., dict[str, np.ndarray]], schema: str) -> DataFrame:
    """``kernel(q, i, q_label, i_label, sims, other)`` over every block of queries and every block of rows.

    ``other`` marks the cells of ``sims`` that are not a query with itself. A
    null label is -1, as one that belongs nowhere; null vectors are left out.
    """
    id_col, vector_col, label_col = cols
    rows = vectors.where(F.col(vector_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.struct(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(label_col).cast("bigint"), F.lit(-1)).alias("label"), F.col(vector_col).alias("v")).alias("r")
    )
    blocks = lambda df, width, p: (
        df.groupBy(F.floor(F.col("r.id") / width).alias("block")).agg(F.sort_array(F.collect_list("r")).alias("r")).select(*(F.col(f"r.{c}").alias(f"{p}_{c}") for c in ("id", "label", "v")))
    )
    pairs = blocks(rows.where(F.col("r.id") % QUERY_EVERY == 0), BLOCK * QUERY_EVERY, "a").join(blocks(rows, BLOCK, "b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                q, i, q_label, i_label = (batch[c][k].values.to_numpy(zero_copy_only=False) for c in ("a_id", "b_id", "a_label", "b_label"))
                sims = _unit(batch["a_v"][k].values) @ _unit(batch["b_v"][k].values).T
                yield pa.RecordBatch.from_pydict(kernel(q, i, q_label, i_label, sims, q[:, None] != i[None, :]))

    return pairs.mapInArrow(run, schema)


def similar_pairs(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, least: float) -> DataFrame:
    """(query, vec_id, similarity, same, adjacent): each query with each other row at ``least`` as similar.

    ``same`` says that both have one label (null when either has none),
    ``adjacent`` that no id lies between them.
    """

    def kernel(q, i, q_label, i_label, sims, other):
        a, b = np.nonzero(other & (sims >= least))
        known = (q_label[a] >= 0) & (i_label[b] >= 0)
        return {"query": q[a], "vec_id": i[b], "similarity": sims[a, b], "same": pa.array(q_label[a] == i_label[b], mask=~known), "adjacent": np.abs(i[b] - q[a]) == 1}

    return _searched(vectors, (id_col, vector_col, label_col), kernel, "query bigint, vec_id bigint, similarity double, same boolean, adjacent boolean")


def nearest(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(query, vec_id, similarity): the nearest other row of each query, the smallest id among equals."""

    def kernel(q, i, q_label, i_label, sims, other):
        s = np.where(other, sims, -2)
        best = s.max(1)
        return {"query": q[best > -2], "vec_id": i[s.argmax(1)][best > -2], "similarity": best[best > -2]}

    each = _searched(vectors, (id_col, vector_col, label_col), kernel, "query bigint, vec_id bigint, similarity double")
    best = each.groupBy("query").agg(F.max(F.struct("similarity", (-F.col("vec_id")).alias("n"))).alias("b"))
    return best.select("query", (-F.col("b.n")).alias("vec_id"), "b.similarity")


def recall_by_threshold(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, thresholds: tuple[float, ...]) -> DataFrame:
    """(threshold, n_wanted, n_recalled, n_above, n_hit, n_crossed, recall, precision) over all labelled pairs of a query and another row.

    Wanted are pairs of one label that are not adjacent; precision is the share
    of one label among all pairs above the threshold.
    """

    def kernel(q, i, q_label, i_label, sims, other):
        known = other & (q_label[:, None] >= 0) & (i_label[None, :] >= 0)
        same = known & (q_label[:, None] == i_label[None, :])
        wanted = same & (np.abs(i[None, :] - q[:, None]) != 1)
        above = [sims >= t for t in thresholds]
        n = lambda m: [int((m & x).sum()) for x in above]
        return {"threshold": list(thresholds), "n_wanted": [int(wanted.sum())] * len(thresholds), "n_recalled": n(wanted), "n_above": n(known), "n_hit": n(same)}

    counts = ("n_wanted", "n_recalled", "n_above", "n_hit")
    each = _searched(vectors, (id_col, vector_col, label_col), kernel, "threshold double, " + ", ".join(f"{c} bigint" for c in counts))
    total = each.groupBy("threshold").agg(*(F.sum(c).alias(c) for c in counts))
    share = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(0.0)
    return total.withColumns({"n_crossed": F.col("n_above") - F.col("n_hit"), "recall": share("n_recalled", "n_wanted"), "precision": share("n_hit", "n_above")})


def hardest_pairs(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, n: int = HARDEST) -> DataFrame:
    """(kind, query, vec_id, similarity): the ``n`` nearest pairs across labels, and the ``n`` farthest wanted ones."""

    def kernel(q, i, q_label, i_label, sims, other):
        known = other & (q_label[:, None] >= 0) & (i_label[None, :] >= 0)
        same = q_label[:, None] == i_label[None, :]
        out = {"kind": [], "query": [], "vec_id": [], "similarity": []}
        for kind, mask, sign in (("crossed", known & ~same, -1), ("missed", known & same & (np.abs(i[None, :] - q[:, None]) != 1), 1)):
            a, b = np.nonzero(mask)
            first = np.lexsort((i[b], q[a], sign * sims[a, b]))[:n]
            out["kind"] += [kind] * len(first)
            out["query"] += q[a][first].tolist()
            out["vec_id"] += i[b][first].tolist()
            out["similarity"] += sims[a, b][first].tolist()
        return {"kind": pa.array(out["kind"], pa.string()), "query": pa.array(out["query"], pa.int64()), "vec_id": pa.array(out["vec_id"], pa.int64()), "similarity": pa.array(out["similarity"], pa.float64())}

    each = _searched(vectors, (id_col, vector_col, label_col), kernel, "kind string, query bigint, vec_id bigint, similarity double")
    top = lambda kind, by: each.where(F.col("kind") == kind).orderBy(by, "query", "vec_id").limit(n)
    return top("crossed", F.col("similarity").desc()).unionByName(top("missed", F.col("similarity").asc()))
