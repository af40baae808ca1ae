import random

import pytest
from helpers import EVENTS, event

from threadloom.operators import forest


def brute(parent):
    out = {}
    for n in parent:
        seen, at, steps = set(), n, 0
        while at not in seen:
            seen.add(at)
            up = parent[at]
            if up is None or up not in parent:
                out[n] = (at, steps)
                break
            at, steps = up, steps + 1
        else:
            out[n] = ("cycle", -1)
    return out


@pytest.mark.parametrize("block", [1, 7, 1000])
@pytest.mark.parametrize("seed", [0])
def test_random_graphs(spark, block, seed):
    rng = random.Random(seed)
    n = 60
    parent = {f"n{i}": rng.choice([None, "gone", *(f"n{rng.randrange(n)}" for _ in range(6))]) for i in range(n)}
    chain = {f"c{i}": f"c{i - 1}" if i else None for i in range(40)}
    parent |= chain
    rows = [event(i, msg_id=k, parent_id=p) for i, (k, p) in enumerate(parent.items())]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, EVENTS)
    got = {r.msg_id: (r.root_id, r.depth) for r in forest.hierarchy(df, block_rows=block).collect()}
    assert got == brute(parent)
    paths = {r.msg_id: r.path for r in forest.paths(df, block_rows=block).collect()}
    for k, (root, depth) in got.items():
        assert paths[k] is None if root == "cycle" else (paths[k][0] == root and paths[k][-1] == k and len(paths[k]) == depth + 1)


def test_first_row_counts_and_blanks(spark):
    rows = [event(2, msg_id="A", parent_id="b"), event(1, msg_id=" a ", parent_id="0"), event(3, msg_id="b", parent_id=" A"), event(4, msg_id=None, parent_id="a"), event(5, msg_id=" "), event(6, msg_id="s", parent_id="S")]
    got = sorted(tuple(r) for r in forest.hierarchy(spark.createDataFrame(rows, EVENTS)).collect())
    assert got == [("a", "a", 0), ("b", "a", 1), ("s", "cycle", -1)]
    assert forest.hierarchy(spark.createDataFrame([], EVENTS)).count() == 0


def test_largest_value_on_the_way(spark):
    nodes = spark.createDataFrame([("a", None, 0, 5), ("b", "a", 1, 3), ("c", "b", 2, 9), ("d", "c", 3, None)], "id string, parent string, pos bigint, value bigint")
    for block in (1, 2, 100):
        assert {r.id: r.most for r in forest.resolve(nodes, block_rows=block).collect()} == {"a": 5, "b": 5, "c": 9, "d": 9}


def walked(parent):
    """(path, first, last) by recursion over children in order of their names."""
    kids, out = {}, {}
    for n, p in parent.items():
        kids.setdefault(p if p in parent else None, []).append(n)

    def visit(n, path, number):
        first = number
        for k in sorted(kids.get(n, [])):
            number = visit(k, [*path, k], number + 1)
        out[n] = (path, first, number)
        return number

    for root in kids.get(None, []):
        visit(root, [root], 1)
    return out


@pytest.mark.parametrize("tree_rows", [5, 1000])
def test_paths_and_descendants(spark, tree_rows):
    rng = random.Random(3)
    parent = {"a": None, "x": "y", "y": "x", "z": "x", "o": "gone"} | {f"n{i}": rng.choice(["a", "o", None, *(f"n{k}" for k in range(i))]) for i in range(60)}
    parent |= {f"c{i}": f"c{i - 1}" if i else None for i in range(50)}
    df = spark.createDataFrame([event(i if i % 5 else None, msg_id=k, parent_id=p) for i, (k, p) in enumerate(parent.items())], EVENTS)
    want = walked(parent)
    paths = {r.msg_id: r.path for r in forest.paths(df, 16, tree_rows).collect()}
    assert paths == {n: want[n][0] if n in want else None for n in parent}
    numbers = {r.msg_id: (r.first, r.last) for r in forest.descendants(df, 16, tree_rows).collect()}
    assert numbers == {n: want[n][1:] if n in want else (None, None) for n in parent}
    assert forest.descendants(df.limit(0)).count() == forest.paths(df.limit(0)).count() == 0


def test_long_paths_come_in_slices(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(forest, "SLICE_ENTRIES", 1000)
    n = 400
    chain = pa.RecordBatch.from_pydict({"id": [f"c{i}" for i in range(n)], "root": ["c0"] * n, "depth": list(range(n)), "up": [None] + [f"c{i}" for i in range(n - 1)]})
    found = list(forest._walk_up(iter([chain])))
    assert max(sum(map(len, b["path"].to_pylist())) for b in found) <= 1000 and len(found) > 50
    assert [p for b in found for p in b["path"].to_pylist()] == [[f"c{k}" for k in range(i + 1)] for i in range(n)]
