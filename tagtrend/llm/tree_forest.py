"""Near-duplicate vectors by a forest of random-projection trees with spill.

A tree cuts the unit vectors again and again at the median of their projections on a random direction; what lies close
to a cut goes to both sides, so that close vectors part at few cuts, and many trees with other directions let hardly a
pair part in all of them. Vectors are compared within the leaves; a pair is counted in the first leaf that it shares,
verified by its cosine, and joined by union.

The trees grow in rounds. A round takes the nodes with more rows than a leaf may have, draws a bounded number of rows
of each by a hash, cuts the node on these up to `LEVELS` times, and sends its rows down. So no tree is built on one
machine, every vector is indexed, and the depth follows the number of rows. Directions come from a seed; the cuts are a
table that is joined to the rows by node; between rounds a row is its class and a node, without its vector. A cut moves off the median where too much lies close to it. What no cut can
part (many vectors almost alike) stays a leaf of any size: its rows are dealt into blocks, every two blocks are one
task's matrix product, and only counts and a spanning forest of the links leave the task, never the pairs.

Equal vectors are one row of the forest, with their number. Links are verified on the vectors in double precision.

Defined results: rows without an id, and vectors that are null, empty, zero, or hold null or non-finite components link
with nothing and are their own component; shorter vectors are read with zeros added; rows that share an id, repeated
rows included, are vectors of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtrend.llm.components import components
from tagtrend.llm.store import stage
from tagtrend.llm.words import mix

SIMILARITY = 0.95
TREES = 8
LEAF = 512  # rows beyond which a node is cut
LEVELS = 8  # cuts one below the other in a round
SAMPLE = 16_384  # rows of a node that a round draws, on average
SPILL = 0.25  # of the distance of two linked vectors along a direction
CROWDED = 0.15  # of the rows that may lie close to the median
LOPSIDED = 0.85  # of the rows on one side: the cut is not worth it
BLOCK = 2_048  # rows of a side of a matrix product
SEED = 71
TREE_BITS = 56  # below the number of the tree in a node's name
_SLICE = 4_096
_PLACES = (0.5, 0.42, 0.58, 0.34, 0.66, 0.26, 0.74, 0.2, 0.8)


def directions(tree: int, depth: int, size: int) -> np.ndarray:
    """The unit direction of each of the cuts of a round that starts at this depth of a tree, one per column."""
    out = np.random.Generator(np.random.PCG64([SEED, tree, depth])).standard_normal((size, LEVELS))
    return out / np.linalg.norm(out, axis=0)


def _one(column: pa.ChunkedArray | pa.Array) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def unit_rows(vectors: pa.Array, size: int) -> np.ndarray:
    """Unit rows in double precision, with zeros added up to `size`."""
    counts = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(vectors), size))
    row = np.repeat(np.arange(len(counts)), counts)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(counts) - counts, counts)] = flat
    top = np.abs(out).max(axis=1, initial=0, keepdims=True)
    out /= np.where(top == 0, 1, top)  # so that no square overflows or vanishes
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _place(values: np.ndarray, margin: float) -> float | None:
    """Where to cut: at the median, or where least lies close if much lies there; None if no cut parts the values."""
    values, best = np.sort(values), (2.0, None)
    for share in _PLACES:
        cut = float(values[min(len(values) - 1, int(share * len(values)))])
        low, high = np.searchsorted(values, [cut - margin, cut + margin], side="right") / len(values)
        if max(high, 1 - low) <= LOPSIDED:
            if share == 0.5 and high - low <= CROWDED:
                return cut
            best = min(best, (high - low, cut))
    return best[1]


def _cuts(size: int, margin: float, leaf: int):
    """Drawn rows of a node -> its cuts as a heap. NaN stands where no cut would part the rows, infinity where the rows
    are few enough without one."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        node, depth, of_node = (x.as_py() for x in key)
        along = unit_rows(_one(table.column("vector")), size) @ directions(node >> TREE_BITS, depth, size)
        heap, parts = np.full((1 << LEVELS) - 1, np.inf), {0: np.arange(len(along))}
        for at in range(len(heap)):
            mine = parts.pop(at, None)
            if mine is None or len(mine) * of_node <= leaf / 2 * len(along):
                continue
            values = along[mine, (at + 1).bit_length() - 1]
            cut = _place(values, margin) if len(mine) > 1 else None
            heap[at] = np.nan if cut is None else cut
            if cut is not None:
                parts[2 * at + 1], parts[2 * at + 2] = mine[values <= cut + margin], mine[values > cut - margin]
        return pa.table({"node": pa.array([node], pa.int64()), "cuts": pa.array([heap], pa.list_(pa.float64()))})

    return run


def _below(node: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The name of the node at a place of a round's heap: the tree, and a hash of the path from its root."""
    path = mix(mix(node.astype(np.uint64), 1) ^ at.astype(np.uint64), 2) >> np.uint64(64 - TREE_BITS)
    return ((node >> TREE_BITS) << TREE_BITS) | path.astype(np.int64)


def _descended(size: int, margin: float):
    """Rows with the cuts of their node -> each node below that a row reaches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, _SLICE) for b in batches for i in range(0, b.num_rows, _SLICE)):
            rows, along = unit_rows(batch.column("vector"), size), np.empty((batch.num_rows, LEVELS))
            heaps = batch.column("cuts").flatten().to_numpy().reshape(batch.num_rows, -1)
            nodes, depths = batch.column("node").to_numpy(), batch.column("depth").to_numpy()
            trees = nodes >> TREE_BITS
            for tree, depth in {*zip(trees.tolist(), depths.tolist(), strict=True)}:
                mine = (trees == tree) & (depths == depth)
                along[mine] = rows[mine] @ directions(tree, depth, size)
            who, at, ended = np.arange(len(rows)), np.zeros(len(rows), dtype=np.int64), []
            for level in range(LEVELS):
                cut = heaps[who, at]
                go = np.isfinite(cut)
                ended.append((who[~go], at[~go], np.isnan(cut[~go])))
                who, at, cut = who[go], at[go], cut[go]
                left, right = along[who, level] <= cut + margin, along[who, level] > cut - margin
                who, at = np.concatenate([who[left], who[right]]), np.concatenate([2 * at[left] + 1, 2 * at[right] + 2])
            who, at, whole = (np.concatenate(x) for x in zip(*ended, (who, at, np.zeros(len(who), dtype=bool)), strict=True))
            taken = batch.select(["class", "key"]).take(pa.array(who))
            columns = [*taken.columns, pa.array(_below(nodes[who], at)), pa.array((depths[who] + LEVELS).astype(np.int32)), pa.array(whole)]
            yield pa.RecordBatch.from_arrays(columns, names=["class", "key", "node", "depth", "whole"])

    return run


def leaves(classes: DataFrame, size: int, margin: float, trees: int, leaf: int) -> DataFrame:
    """class, node and of_node (the node's rows) for every leaf that a class (class, key, vector) reaches; a node's
    upper bits are its tree."""
    roots = F.explode(F.array(*[F.lit(t << TREE_BITS).cast("long") for t in range(trees)]))
    here = classes.select("class", "key", roots.alias("node"), F.lit(0).alias("depth"), F.lit(False).alias("whole"))
    vectors, done = classes.select("class", "vector"), None
    while True:
        sizes = here.groupBy("node").agg(F.count("*").alias("of_node"), F.max("whole").alias("closed"))
        sizes = stage(sizes.withColumn("closed", F.col("closed") | (F.col("of_node") <= leaf)), "forest-sizes")
        sized = here.drop("whole").join(sizes, "node")
        closed = sized.where("closed").select("class", "node", "of_node")
        done = closed if done is None else done.unionByName(closed)
        if sizes.where("NOT closed").isEmpty():
            return done
        more = sized.where("NOT closed").join(vectors, "class")
        # a part of the node's rows by a hash of the row
        drawn = F.pmod(F.xxhash64("key", "node"), F.lit(1 << 30)) * F.col("of_node") < F.lit(SAMPLE << 30)
        cuts = more.where(drawn).groupBy("node", "depth", "of_node").applyInArrow(_cuts(size, margin, leaf), "node long, cuts array<double>")
        whole = F.array_repeat(F.lit(float("nan")), (1 << LEVELS) - 1)
        known = more.join(stage(cuts, "forest-cuts"), "node", "left").select("class", "key", "vector", "node", "depth", F.coalesce("cuts", whole).alias("cuts"))
        here = stage(known.mapInArrow(_descended(size, margin), "class long, key long, node long, depth int, whole boolean"), "forest-rows")


class Union:
    """Sets of numbers below `size`, joined by arrays of pairs; only pairs that join two sets are kept as edges."""

    def __init__(self, size: int):
        self.up = np.arange(size)
        self.edges: list[np.ndarray] = []

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.up[a], self.up[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            if not len(a):
                return
            # of each set, the pair that leads to the smallest other; larger ones hang on smaller ones, so without a ring
            high, low = np.maximum(x, y), np.minimum(x, y)
            order = np.lexsort((low, high))
            first = order[np.flatnonzero(np.diff(high[order], prepend=-1))]
            self.edges.append(np.stack([a[first], b[first]], axis=1))
            self.up[high[first]] = low[first]
            while True:
                up = self.up[self.up]
                if np.array_equal(up, self.up):
                    break
                self.up = up


def _met_before(node: int, lists: pa.Array) -> np.ndarray:
    """Per row a bit for each leaf before this one, in order of tree and name, that two rows or more of it share."""
    at = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy(zero_copy_only=False))
    names = lists.flatten().to_numpy(zero_copy_only=False)
    earlier = names < node
    _, number, count = np.unique(names[earlier], return_inverse=True, return_counts=True)
    shared = np.cumsum(count > 1) - 1
    use = count[number] > 1
    bits = np.zeros((len(lists), 64 * (int(shared[-1]) // 64 + 1 if len(shared) else 1)), dtype=bool)
    bits[at[earlier][use], shared[number[use]]] = True
    return np.packbits(bits, axis=1).view(np.uint64)


def _links_within(size: int, similarity: float):
    """The rows of two blocks of a leaf -> per class the number of its links that meet here first (a = b), and a
    spanning forest of these links (links = 0)."""
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        node, one, two = (x.as_py() for x in key)
        rows = unit_rows(_one(table.column("vector")), size)
        block, classes, n = (_one(table.column(c)).to_numpy() for c in ("block", "class", "n"))
        before = None
        first, second = np.flatnonzero(block == one), np.flatnonzero(block == two)
        links, sets = np.zeros(len(rows), dtype=np.int64), Union(len(rows))
        for start in range(0, len(first), 128):
            a, b = np.nonzero(rows[first[start : start + 128]] @ rows[second].T >= similarity)
            a, b = first[start + a], second[b]
            if one == two:
                a, b = a[a < b], b[a < b]
            if not len(a):
                continue
            if before is None:
                before = _met_before(node, _one(table.column("leaves")))
            new = np.ones(len(a), dtype=bool)
            for word in range(before.shape[1]):
                new &= (before[a, word] & before[b, word]) == 0
            a, b = a[new], b[new]
            np.add.at(links, a, n[b])
            np.add.at(links, b, n[a])
            sets.join(a, b)
        hit, edges = np.flatnonzero(links), np.concatenate([np.zeros((0, 2), dtype=np.int64), *sets.edges])
        return pa.table({
            "a": np.concatenate([classes[hit], classes[edges[:, 0]]]), "b": np.concatenate([classes[hit], classes[edges[:, 1]]]),
            "links": np.concatenate([links[hit], np.zeros(len(edges), dtype=np.int64)]),
        })

    return run


def _usable(column: str) -> Column:
    """Whether a vector has a component other than zero, and all of them are finite."""
    finite = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(column, lambda x: x != 0), F.lit(False))


def near_vectors(vectors: DataFrame, vector: str = "embedding", similarity: float = SIMILARITY, trees: int = TREES, leaf: int = LEAF) -> DataFrame:
    """vec_id, n_links, component_id (the smallest vec_id reachable by links) and kept of every row."""
    source = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    usable = F.col("vec_id").isNotNull() & _usable("vector")
    apart = source.where(~usable).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept")
    )
    rows = source.where(usable)
    classes = rows.groupBy("vector").agg(F.min("vec_id").alias("lowest"), F.count("*").alias("n"))
    classes = classes.withColumns({"class": F.monotonically_increasing_id(), "key": F.xxhash64("lowest", "vector")})
    classes = stage(classes, "forest-classes")  # the class is a number as written, so for good
    size, n = classes.agg(F.max(F.size("vector")), F.count("*")).first()
    if size is None:
        return apart
    # linked vectors are at most this far apart, and a root of the dimensions less along a random direction
    margin = SPILL * float(np.sqrt(2 * max(0.0, 1 - similarity) / size))
    found = stage(leaves(classes, size, margin, trees if n > leaf else 1, leaf), "forest-leaves").where("of_node > 1")
    own = found.groupBy("class").agg(F.collect_list(F.struct("node", "of_node")).alias("reached"))  # a few per tree
    each = classes.select("class", "key", "vector", "n").join(own, "class").select(
        "class", "key", "vector", "n", F.col("reached")["node"].alias("leaves"), F.explode("reached").alias("leaf")
    )
    blocks = F.ceil(F.col("leaf.of_node") / BLOCK).cast("int")
    dealt = each.withColumn("blocks", blocks).withColumn("block", F.pmod("key", "blocks").cast("int"))
    beside = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda x: F.struct(F.least(x, "block").alias("one"), F.greatest(x, "block").alias("two")))
    sides = dealt.withColumn("pair", F.explode(beside)).select("leaf.node", "pair.one", "pair.two", "block", "class", "n", "vector", "leaves")
    met = stage(sides.groupBy("node", "one", "two").applyInArrow(_links_within(size, similarity), "a long, b long, links long"), "forest-links")

    links = met.where("links > 0").groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links"))
    roots = components(met.where("links = 0"), "a", "b", "forest").withColumnRenamed("node", "class")
    rooted = classes.join(roots, "class", "left").join(links, "class", "left").select(
        "vector", "lowest", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("root", "class").alias("root")
    )
    rooted = stage(rooted, "forest-rooted")
    lowest = rooted.groupBy("root").agg(F.min("lowest").alias("component_id"))
    known = rooted.join(lowest, "root").select("vector", "n_links", "component_id")
    joined = rows.join(known, "vector").select("vec_id", "n_links", "component_id", (F.col("vec_id") == F.col("component_id")).alias("kept"))
    return joined.unionByName(apart)
