"""Hard negatives against all scores."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from tagtrend.llm import anchor_bounds
from tagtrend.llm.anchor_bounds import Block, Walk, hard_negatives, spanning_tree

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute(rows, every=10):
    """All results as tuples, from Python integers."""
    good = [(i, lab, [math.floor(256.0 * x) for x in v]) for i, v, lab in rows if i is not None and lab is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: min(max(sum(x * y for x, y in zip(a, b, strict=False)), -(2**63)), 2**63 - 1)
    anchors = {}
    for i, lab, q in good:
        if i % every == 0:
            anchors[i] = min(anchors.get(i, (lab, q)), (lab, q))
    out = []
    for a, (lab, q) in anchors.items():
        scored = sorted(((-dot(q, x), i, y) for i, y, x in good if i != a), key=lambda t: t[:2])
        for p, i, _ in [s for s in scored if s[2] == lab][:5]:
            inside = [(-n, j) for n, j, y in scored if y != lab and 80 * -p <= 100 * -n <= 100 * -p][:5]
            out += [(a, i, k, j, -p, n) for k, (n, j) in enumerate(inside, 1)]
    return sorted(out)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def got(frame, every=10):
    out = hard_negatives(frame, F.col("vec_id") % every == 0)
    assert out.columns == COLUMNS
    return sorted(tuple(r) for r in out.collect())


def clustered(count, size, seed, spread=0.3):
    rng = np.random.default_rng(seed)
    centers = rng.standard_normal((6, size))
    of = rng.integers(0, 6, count)
    points = centers[of] + spread * rng.standard_normal((count, size))
    label = np.where(rng.random(count) < 0.3, rng.integers(0, 6, count), of)
    return [(i, (points[i] / np.linalg.norm(points[i])).tolist(), int(label[i])) for i in range(count)]


@pytest.mark.parametrize("blocks", [(2048, 16384), (16, 150)])
def test_against_all_scores(spark, monkeypatch, blocks):
    monkeypatch.setattr(anchor_bounds, "ANCHORS", blocks[0])
    monkeypatch.setattr(anchor_bounds, "ROWS", blocks[1])
    for spread in (0.05, 0.4):
        rows = clustered(900, 24, 3, spread)
        assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_given_vectors(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in frame.collect()]
    assert got(frame, 20) == brute(rows, 20)


def test_ties_and_awkward_rows(spark):
    a, b = [0.5, -0.25, 0.1], [0.5, -0.25, 0.11]
    rows = [(i, a if i % 3 else b, i % 2) for i in range(40)]
    rows += [(40, None, 1), (41, [], 1), (50, [], 0), (42, [0.0, None, 1.0], 1), (43, [float("nan"), 0.0, 0.0], 0), (44, [float("inf"), 0.0, 0.0], 0), (60, a, None)]
    rows += [(None, a, 1), (45, [1.0], 1), (46, [1.0, 1.0, 1.0, 1.0], 0), (70, [-0.5, 0.25, 0.1], 5), (80, a, 1), (80, b, 0), (81, a, 1), (81, a, 1), (-10, b, 0)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert got(frame) == brute(rows)
    clash = frame.selectExpr("vec_id", "embedding", "label", "1 AS place", "2 AS score", "3 AS vector", "4 AS chosen", "5 AS anchor_id")
    assert got(clash) == brute(rows)
    assert got(frame.where("false")) == [] and got(frame.where("vec_id = 1")) == []


def test_scores_beyond_double_and_long(spark):
    rng = np.random.default_rng(1)
    rows = [(i, (10.0 ** rng.integers(3, 12) * rng.standard_normal(5)).tolist(), int(i % 3)) for i in range(120)]
    assert got(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_spanning_tree_is_the_shortest_and_few_bounds_are_held():
    rng = np.random.default_rng(5)
    points = np.floor(256 * rng.standard_normal((300, 8)))
    order, parent, length = spanning_tree(points)
    place = {x: i for i, x in enumerate(order.tolist())}
    assert len(place) == 300 and all(parent[i] < 0 or place[int(parent[i])] < place[i] for i in range(300))
    away = sorted((float(np.linalg.norm(points[i] - points[j])), i, j) for i in range(300) for j in range(i))
    up, total = list(range(300)), 0.0
    for d, i, j in away:  # Kruskal
        if up[i] != up[j]:
            total += d
            old = up[i]
            up = [up[j] if u == old else u for u in up]
    assert length[np.isfinite(length)].sum() == pytest.approx(total)
    above = np.where(parent < 0, -1, np.array([place[max(int(p), 0)] for p in parent]))[order]
    walk = Walk(points[order], above, length[order], Block(np.arange(4), np.zeros(4), points[:4]))
    held = 0
    for i in range(300):
        walk.arrive(i)
        held = max(held, len(walk.bounds))
    assert held <= 10 and not walk.bounds


def test_bounds_hold_and_save_scores():
    rows = clustered(2000, 24, 7, 0.03)
    points = np.floor(256 * np.array([v for _, v, _ in rows]))
    order, parent, length = spanning_tree(points[:100])
    place = np.empty(100, dtype=int)
    place[order] = np.arange(100)
    above = np.where(parent < 0, -1, place[np.maximum(parent, 0)])[order]
    block = Block(np.arange(2000), np.array([c for _, _, c in rows]), points)
    walk = Walk(points[order], above, length[order], block)
    for i in range(100):
        walk.arrive(i)
        true = points @ points[order][i]
        assert (walk.low <= true).all() and (true <= walk.high).all()
        walk.score(i, walk.high >= np.partition(walk.low, -50)[-50])
    assert walk.scored < 0.5 * 100 * 2000
