"""Near vectors against all pairs."""

import math

import numpy as np
import pytest
from tagtrend.llm import tree_forest
from tagtrend.llm.tree_forest import Union, near_vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, similarity=0.95):
    """(vec_id, n_links, component_id, kept) of every row."""
    good = [(i, v) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    size = max((len(v) for _, v in good), default=0)
    unit = np.zeros((len(good), size))
    for at, (_, v) in enumerate(good):
        unit[at, : len(v)] = np.asarray(v, dtype=np.float32) if isinstance(v[0], float) else v
        unit[at] /= np.linalg.norm(unit[at])
    near = unit @ unit.T >= similarity
    up = list(range(len(good)))

    def root(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in zip(*np.nonzero(near), strict=True):
        x, y = root(int(a)), root(int(b))
        up[max(x, y)] = min(x, y)
    lowest = {}
    for at, (i, _) in enumerate(good):
        lowest[root(at)] = min(lowest.get(root(at), i), i)
    out = [(i, int(near[at].sum()) - 1, lowest[root(at)], i == lowest[root(at)]) for at, (i, _) in enumerate(good)]
    ids = [id(v) for _, v in good]
    return sorted(out + [(i, 0, i, i is not None) for i, v in rows if id(v) not in ids or i is None], key=repr)


def got(frame):
    assert frame.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def planted(count, size, groups, members, angle, seed=1):
    """Random unit vectors, and groups around some of them at cosines from the threshold up."""
    rng = np.random.default_rng(seed)
    rows = rng.standard_normal((count, size))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    more = []
    for g in range(groups):
        for _ in range(members):
            side = rng.standard_normal(size)
            side -= side @ rows[g] * rows[g]
            turn = angle * rng.random()
            more.append(math.cos(turn) * rows[g] + math.sin(turn) * side / np.linalg.norm(side))
    every = np.concatenate([rows, np.array(more).reshape(-1, size)]).astype(np.float32)
    order = rng.permutation(len(every))
    return [(int(i), every[at].tolist()) for i, at in enumerate(order)]


def test_recall_over_many_leaves(spark, monkeypatch):
    """Pairs up to the threshold itself; leaves of 24 rows and two rounds of cuts. All that is found is right."""
    monkeypatch.setattr(tree_forest, "LEVELS", 5)
    rows = planted(4000, 64, 800, 2, math.acos(0.95))
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    want = {r[0]: r for r in brute(rows)}
    found = {r[0]: r for r in got(near_vectors(frame, leaf=24))}
    assert found.keys() == want.keys() and all(found[i][1] <= want[i][1] for i in want)
    recall = sum(r[1] for r in found.values()) / sum(r[1] for r in want.values())
    assert recall >= 0.99, recall
    assert sum(found[i] == want[i] for i in want) >= 0.99 * len(want)


def test_a_crowd_of_near_copies_counts_every_link_once(spark, monkeypatch):
    """A third of the rows are almost one vector, a sixth exactly one: they fill leaves of any size, in blocks."""
    monkeypatch.setattr(tree_forest, "BLOCK", 100)
    rng = np.random.default_rng(4)
    rows = planted(600, 32, 50, 1, 0.2)
    center = rng.standard_normal(32)
    rows += [(1000 + i, (center + 0.02 * rng.standard_normal(32)).astype(np.float32).tolist()) for i in range(400)]
    rows += [(2000 + i, center.astype(np.float32).tolist()) for i in range(200)]
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], SCHEMA)
    assert got(near_vectors(frame, leaf=40)) == brute(rows)


def test_awkward_vectors(spark):
    a = [0.5, -0.25, 0.125]
    rows = [
        (1, a), (2, list(a)), (2, list(a)), (3, [x * 4 for x in a]), (4, [-x for x in a]), (5, None), (6, []), (7, [0.0, 0.0, 0.0]), (8, [1.0, None, 0.0]),
        (9, [1.0, float("nan"), 0.0]), (10, [float("inf"), 0.0, 0.0]), (None, list(a)), (None, None), (11, [1.0]), (12, [2.0, 0.0]), (13, [-0.0, 1.0]),
        (13, [0.0, 0.0, 1.0]), (14, [3e38, 0.0, 0.0]), (15, [1e-38, 0.0, 0.0]),
    ]
    frame = spark.createDataFrame([(i, v, None) for i, v in rows], SCHEMA)
    for leaf in (256, 2):
        assert got(near_vectors(frame, leaf=leaf)) == brute(rows)
    clash = frame.selectExpr("vec_id", "embedding", "1 AS class", "2 AS vector", "3 AS node", "4 AS n")
    assert got(near_vectors(clash)) == brute(rows)
    assert got(near_vectors(frame.where("false"))) == []
    assert got(near_vectors(frame.where("vec_id IN (5, 6)"))) == [(5, 0, 5, True), (6, 0, 6, True)]


def test_union_keeps_a_spanning_forest():
    rng = np.random.default_rng(2)
    sets, pairs = Union(300), rng.integers(0, 300, (200, 2))
    for part in np.array_split(pairs[pairs[:, 0] != pairs[:, 1]], 4):
        sets.join(part[:, 0], part[:, 1])
    up = list(range(300))
    for a, b in pairs:
        x = {up[a], up[b]}
        up = [min(x) if u in x else u for u in up]
    assert sets.up.tolist() == up
    assert len(np.concatenate(sets.edges)) == 300 - len(set(up))


@pytest.mark.parametrize("tables", ["/root/testdata/sf0.01"])
def test_given_vectors(spark, tables):
    frame = spark.read.parquet(f"{tables}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in frame.collect()]
    assert got(near_vectors(frame, similarity=0.5)) == brute(rows, 0.5)
