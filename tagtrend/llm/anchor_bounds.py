"""Hard negatives of many anchors by bounds along a spanning tree of the anchors.

The score of a row for an anchor is an integer inner product. For two anchors a and b the scores of a row x differ by
at most |a - b| |x|, so a row's score for an anchor lies between that for the anchor's parent in the tree, minus and
plus the length of the edge times the row's norm. Only rows whose bounds meet the window that an anchor asks for are
scored anew; the others hand their bounds, widened, to the anchor's children. The tree is the shortest spanning tree of
a block of anchors, walked so that a child with the largest subtree comes last, which leaves the bounds of a handful of
anchors in memory, whatever the shape of the tree.

Two passes use it: the best rows of the same label (a row's lower bounds say which score is surely reached, rows with
an upper bound below that are left alone), and, with the windows that these positives give, the rows of other labels
that are nearly as close but not closer.

The anchors are a query set; blocks of anchors meet blocks of rows, each pair of blocks is one task, and only the best
few rows of each anchor leave it. Neither is held whole anywhere.

Defined results: rows without an id, a label or a vector, or with a null or non-finite component, take no part; shorter
vectors are read with zeros added; rows that share an id are not each other's candidates, and otherwise count as often
as they occur; of several with the id of an anchor the smallest by label and vector is the anchor; a score beyond a long
is its end; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagtrend.llm.store import stage

SCALE = 256.0
POSITIVES = 5
NEGATIVES = 5
WINDOW = (80, 100)  # per cent of the positive's score
ANCHORS = 2_048  # of a block
ROWS = 16_384  # of a block
_EXACT = float(1 << 53)  # integers below it are exact in double precision
_LONG = np.iinfo(np.int64)


def scaled(vectors: pa.Array, size: int) -> np.ndarray:
    """floor(256 x) of every component, whole numbers in double precision, with zeros added up to `size`."""
    counts = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(vectors), size))
    row = np.repeat(np.arange(len(counts)), counts)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)] = np.floor(SCALE * flat)
    return out


def spanning_tree(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The shortest spanning tree: an order of the points in which parents come before children and the largest subtree
    of each comes last, and per point its parent (-1 for the root) and the length of that edge."""
    n = len(points)
    parent, length = np.full(n, -1), np.full(n, np.inf)
    left, here, reached = np.ones(n, dtype=bool), 0, [0]
    left[0] = False
    for _ in range(n - 1):
        away = np.linalg.norm(points - points[here], axis=1)
        closer = left & (away < length)
        length[closer], parent[closer] = away[closer], here
        rest = np.flatnonzero(left)
        here = int(rest[np.argmin(length[rest])])
        parent[here] = max(parent[here], 0)  # no finite length: hang it on the root
        left[here] = False
        reached.append(here)
    below, children = np.ones(n, dtype=np.int64), [[] for _ in range(n)]
    for i in reversed(reached[1:]):
        below[parent[i]] += below[i]
        children[parent[i]].append(i)
    order, todo = [], [0]
    while todo:
        i = todo.pop()
        order.append(i)
        todo += sorted(children[i], key=lambda c: below[c], reverse=True)
    return np.array(order), parent, length


@dataclass
class Block:
    """Rows of a block: ids, labels, scaled vectors and their norms."""

    ids: np.ndarray
    labels: np.ndarray
    points: np.ndarray

    def __post_init__(self):
        self.norms = np.linalg.norm(self.points, axis=1)
        self.largest = np.abs(self.points).max(initial=0.0)
        self._whole: np.ndarray | None = None

    def scores(self, anchor: np.ndarray, which: np.ndarray | slice) -> np.ndarray:
        """Inner products as longs: in double precision where that is exact, otherwise from Python integers."""
        if self.exact(anchor):
            return (self.points[which] @ anchor).astype(np.int64)
        if self._whole is None:
            self._whole = np.array([[int(x) for x in row] for row in self.points], dtype=object).reshape(self.points.shape)
        found = self._whole[which] @ np.array([int(x) for x in anchor], dtype=object)
        return np.array([min(max(int(x), _LONG.min), _LONG.max) for x in found], dtype=np.int64)

    def exact(self, anchors: np.ndarray) -> bool:
        """Whether double precision holds every sum of these products."""
        return self.largest * np.abs(anchors).max(initial=0.0) * max(1, anchors.shape[-1]) < _EXACT


class Walk:
    """The anchors of a block in tree order, each with bounds on the scores of all rows of another block."""

    def __init__(self, anchors: np.ndarray, parent: np.ndarray, length: np.ndarray, rows: Block):
        self.anchors, self.parent, self.length, self.rows = anchors, parent, length, rows
        self.children = np.bincount(parent[parent >= 0], minlength=len(anchors))
        self.bounds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.bounded, self.scored = rows.exact(anchors), 0

    def arrive(self, anchor: int) -> None:
        """The bounds that the parent hands on."""
        rows, parent = self.rows, int(self.parent[anchor])
        norm = np.linalg.norm(self.anchors[anchor])
        known = self.bounds.get(parent) if self.bounded else None
        if known is None:
            self.low, self.high = np.full(len(rows.ids), -np.inf), np.full(len(rows.ids), np.inf)
        else:
            # a margin for rounding
            step = self.length[anchor] * rows.norms + 1e-9 * norm * rows.norms + 1
            self.low, self.high = known[0] - step, known[1] + step
        if parent >= 0:
            self.children[parent] -= 1
            if not self.children[parent]:
                self.bounds.pop(parent, None)
        if self.children[anchor]:
            self.bounds[anchor] = (self.low, self.high)

    def score(self, anchor: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows that may be wanted and their scores, which become their bounds. Where most have to be scored, all
        are, which makes the bounds of all children narrow again."""
        which = np.flatnonzero(wanted)
        self.scored += len(which)
        if 2 * len(which) < len(wanted):
            found = self.rows.scores(self.anchors[anchor], which)
            self.low[which] = self.high[which] = found.astype(np.float64)
            return which, found
        every = self.rows.scores(self.anchors[anchor], slice(None))
        self.low[:] = self.high[:] = every.astype(np.float64)
        return which, every[which]


def best(scores: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Order by falling score, then rising id."""
    return np.lexsort((ids, ~scores))


def _positives(walk: Walk, anchor: int, own: int, label: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the block that can be among the first `count` of the anchor's label, and their scores."""
    mates = (walk.rows.labels == label) & (walk.rows.ids != own)
    if mates.sum() > count:
        # so many rows surely reach this
        mates &= walk.high >= np.partition(walk.low[mates], -count)[-count]
    which, scores = walk.score(anchor, mates)
    order = best(scores, walk.rows.ids[which])[:count]
    return which[order], scores[order]


def _negatives(walk: Walk, anchor: int, own: int, label: int, positives: list[int], count: int, window: tuple[int, int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per positive the first `count` rows of the block of other labels in its window, and their scores."""
    if not positives:
        return
    low, high = window
    lows, highs = [low * p / 100 for p in positives], [high * p / 100 for p in positives]
    wanted = (walk.rows.labels != label) & (walk.rows.ids != own) & (walk.high >= min(lows) - 1) & (walk.low <= max(highs) + 1)
    which, scores = walk.score(anchor, wanted)
    order = best(scores, walk.rows.ids[which])
    which, scores = which[order], scores[order]
    whole = scores.astype(object) if len(scores) and np.abs(scores.astype(np.float64)).max() > _EXACT else scores
    for place, p in enumerate(positives):
        inside = np.flatnonzero((100 * whole <= high * p) & (100 * whole >= low * p))[:count]
        yield place, which[inside], scores[inside]


def _one(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def _tree_of(size: int):
    """A block of anchors with each one's place in the tree's order, its parent's id and the length of the edge."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("anchor_id")
        points = scaled(_one(table.column("anchor")), size)
        order, parent, length = spanning_tree(points)
        place = np.empty(len(order), dtype=np.int32)
        place[order] = np.arange(len(order))
        above = np.where(parent < 0, -1, place[np.maximum(parent, 0)]).astype(np.int32)
        return table.append_column("place", pa.array(place)).append_column("above", pa.array(above)).append_column("edge", pa.array(length))

    return run


def _walked(size: int, step):
    """A block of anchors and a block of rows -> what `step` yields for each anchor, as columns."""
    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        anchors = anchors.sort_by("place")
        points, block = scaled(_one(anchors.column("anchor")), size), Block(
            rows.column("vec_id").to_numpy(), rows.column("label").to_numpy(), scaled(_one(rows.column("vector")), size)
        )
        walk = Walk(points, anchors.column("above").to_numpy(), anchors.column("edge").to_numpy(), block)
        own, labels = anchors.column("anchor_id").to_numpy(), anchors.column("anchor_label").to_numpy()
        wanted = anchors.column("positives").to_pylist() if "positives" in anchors.column_names else [None] * len(own)
        out: list[tuple[int, int, np.ndarray, np.ndarray]] = []
        for i in range(len(own)):
            walk.arrive(i)
            out += [(int(own[i]), place, block.ids[which], scores) for place, which, scores in step(walk, i, int(own[i]), int(labels[i]), wanted[i])]
        count = np.array([len(ids) for _, _, ids, _ in out], dtype=np.int64)
        return pa.table({
            "anchor_id": np.repeat(np.array([a for a, _, _, _ in out], dtype=np.int64), count),
            "place": np.repeat(np.array([p for _, p, _, _ in out], dtype=np.int32), count),
            "found_id": np.concatenate([np.zeros(0, dtype=np.int64), *(ids for _, _, ids, _ in out)]),
            "score": np.concatenate([np.zeros(0, dtype=np.int64), *(scores for _, _, _, scores in out)]),
        })

    return run


_FOUND = "anchor_id long, place int, found_id long, score long"


def _met(anchors: DataFrame, rows: DataFrame, blocks: tuple[int, int], size: int, step) -> DataFrame:
    """Every block of anchors with every block of rows, one pair per group."""
    of_anchors, of_rows = blocks
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumn("row_block", numbers(of_rows)).groupBy("anchor_block", "row_block")
    right = rows.withColumn("anchor_block", numbers(of_anchors)).groupBy("anchor_block", "row_block")
    return left.cogroup(right).applyInArrow(_walked(size, step), _FOUND)


def _first(found: DataFrame, count: int, *keys: str) -> DataFrame:
    """The first `count` rows per key by falling score and rising id, numbered from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "found_id")
    return found.withColumn("number", F.row_number().over(order)).where(F.col("number") <= count)


def hard_negatives(
    vectors: DataFrame, is_anchor: Column, label: Column | str = "label", vector: str = "embedding", positives: int = POSITIVES,
    negatives: int = NEGATIVES, window: tuple[int, int] = WINDOW,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score: for every row with `is_anchor` and
    each of its first `positives` rows of the same label, the first `negatives` rows of other labels whose score is
    within `window` per cent of the positive's."""
    spark = vectors.sparkSession
    label = F.col(label) if isinstance(label, str) else label
    source = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(vector).alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("chosen")
    )
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    rows = source.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    total, chosen, size = rows.agg(F.count("*"), F.count_if("chosen"), F.max(F.size("vector"))).first()
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not chosen:
        return spark.createDataFrame([], result)
    blocks = -(-chosen // ANCHORS), -(-total // ROWS)
    dealt = lambda n, column: F.pmod(F.xxhash64(column), F.lit(n)).cast("int")
    parts = rows.select("vec_id", "label", "vector").withColumn("row_block", dealt(blocks[1], "vec_id"))
    first = F.min(F.struct("label", "vector"))
    anchors = rows.where("chosen").groupBy(F.col("vec_id").alias("anchor_id")).agg(first.alias("own")).select(
        "anchor_id", F.col("own.label").alias("anchor_label"), F.col("own.vector").alias("anchor"), dealt(blocks[0], "anchor_id").alias("anchor_block")
    )
    kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in anchors.schema)
    trees = stage(anchors.groupBy("anchor_block").applyInArrow(_tree_of(size), f"{kind}, place int, above int, edge double"), "anchor-trees")

    def mates(walk, i, own, of, _):
        yield (0, *_positives(walk, i, own, of, positives))

    def others(walk, i, own, of, wanted):
        return _negatives(walk, i, own, of, wanted, negatives, window)

    closest = stage(_first(_met(trees, parts, blocks, size, mates), positives, "anchor_id"), "anchor-positives")
    lists = closest.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("number", "found_id", "score"))).alias("found"))
    known = trees.join(lists, "anchor_id", "left").withColumn("positives", F.coalesce(F.transform("found", lambda x: x["score"]), F.array().cast("array<long>")))
    # anchors without a positive stay in the tree but ask for nothing
    asking = known.drop("found")
    near = _first(_met(asking, parts, blocks, size, others), negatives, "anchor_id", "place")
    return near.join(lists, "anchor_id").select(
        "anchor_id", F.element_at("found", F.col("place") + 1)["found_id"].alias("positive_id"), F.col("number").alias("rank"),
        F.col("found_id").alias("negative_id"), F.element_at("found", F.col("place") + 1)["score"].alias("positive_score"), F.col("score").alias("negative_score"),
    )
