"""A cosine index on disk: an inverted file over k-means cells.

Centres are fitted on a bounded sample of the unit vectors, every vector is written into the cell of its nearest centre,
and each cell keeps its number of rows and the angle to its farthest row. A search probes the cells nearest to a query
first. By the triangle inequality on angles no row of a cell can be closer to the query than its centre's angle less the
cell's radius, so once that is farther than the k-th hit the cell need not be read: `exact` goes on until all remaining
cells are ruled out, and then equals the search over all rows. Without it the probing stops at a share of the rows.

The table is partitioned by cell, so a search reads the folders that its queries probe and no others. What meets is cut
into blocks by `top_k_similar`, so a crowded cell is more tasks, and no pair of rows is emitted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagtrend.operators.neighbours import top_k_similar, unit_rows
from tagtrend.session import stage

SAMPLE = 65_536  # rows on which centres are fitted, at most
MAX_CELLS = 4_096  # bounds the table of centres, which every task gets
ROWS_PER_CELL = 3  # until there are as many cells as that
STEPS = 12
SHARE = 0.28  # of the rows that a query compares unless the search is exact
_SLICE = 2_048
_PROBES = 16_384  # of a record batch, as each carries its query's vector


def fit_centres(rows: np.ndarray, cells: int, steps: int = STEPS, seed: int = 7) -> np.ndarray:
    """Unit centres of spherical k-means, from distinct rows of the sample."""
    rows = rows[np.linalg.norm(rows, axis=1) > 0]
    pick = np.random.Generator(np.random.PCG64(seed)).permutation(len(rows))[:cells]
    centres = rows[np.sort(pick)]
    for _ in range(steps if len(centres) else 0):
        near = np.concatenate([(rows[i : i + _SLICE] @ centres.T).argmax(axis=1) for i in range(0, len(rows), _SLICE)])
        sums = np.zeros_like(centres)
        np.add.at(sums, near, rows)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        moved = np.where(size > 0, sums / np.where(size > 0, size, 1), centres)
        if np.array_equal(moved, centres):
            break
        centres = moved
    return centres


@dataclass
class Cells:
    """The centres of an index with the cosine of each cell's farthest row and its number of rows."""

    centres: np.ndarray
    farthest: np.ndarray
    rows: np.ndarray

    def order(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cells nearest first for each query, and the greatest cosine that any row in each cell can have."""
        cosines = np.clip(unit @ self.centres.T, -1, 1)
        inside = cosines >= self.farthest
        edge = np.cos(np.maximum(0, np.arccos(cosines) - np.arccos(self.farthest)))
        return np.argsort(-cosines, axis=1, kind="stable"), np.where(inside, 1.0, edge)


def _usable(vector: str):
    """A vector of finite numbers other than zero; others have no direction."""
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(vector, lambda x: x != 0)
    return F.coalesce(good, F.lit(False))


def build_cells(rows: DataFrame, path: str, *, row_id: str, vector: str, cells: int | None = None, sample: int = SAMPLE) -> None:
    """Write the index of `rows` to `path`, and its centres beside it. Rows whose vector is null, empty, zero or not
    finite have no direction and are left out."""
    spark = rows.sparkSession
    given = rows.select(F.col(row_id).alias("id"), F.col(vector).cast("array<double>").alias("vector")).where(_usable(vector))
    n = given.count()
    wanted = max(1, min(MAX_CELLS, n // ROWS_PER_CELL)) if cells is None else min(cells, MAX_CELLS)
    # the rows of smallest hash, as many as the bound
    drawn = given.orderBy(F.xxhash64("vector"), "id").limit(sample).select("vector").toArrow()
    centres = fit_centres(unit_rows(drawn.column("vector")), wanted) if drawn.num_rows else np.zeros((0, 0))
    shared = spark.sparkContext.broadcast(centres)
    kind = given.schema["id"].dataType.simpleString()

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in (b.slice(i, 512) for b in batches for i in range(0, b.num_rows, 512)):
            cosines = unit_rows(batch.column("vector")) @ known.T
            cell = cosines.argmax(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(cosines[np.arange(len(cell)), cell])], names=["id", "vector", "cell", "cosine"]
            )

    assigned = stage(given.mapInArrow(placed, f"id {kind}, vector array<double>, cell int, cosine double"), "cells")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # ranged, so that a crowded cell is spread over tasks and a task writes few cells
    ranged = assigned.repartitionByRange(tasks, "cell", F.xxhash64("id")).sortWithinPartitions("cell")
    ranged.select("id", "vector", "cell").write.mode("overwrite").partitionBy("cell").parquet(path)
    sizes = assigned.groupBy("cell").agg(F.count("*").alias("rows"), F.min("cosine").alias("farthest"))
    table = spark.createDataFrame([(i, [float(x) for x in c]) for i, c in enumerate(centres)], "cell int, centre array<double>")
    table.join(sizes, "cell").coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}.centres")


def read_cells(spark: SparkSession, path: str) -> Cells:
    """The centres, at most `MAX_CELLS` rows."""
    found = spark.read.parquet(f"{path.rstrip('/')}.centres").orderBy("cell").toArrow()
    number = found.column("cell").to_numpy()
    whole = int(number.max()) + 1 if len(number) else 0
    centres = np.zeros((whole, len(found.column("centre")[0]) if whole else 0))
    farthest, rows = np.ones(whole), np.zeros(whole, dtype=np.int64)
    if whole:
        centres[number] = unit_rows(found.column("centre"))
        # a margin for rounding
        farthest[number] = np.clip(found.column("farthest").to_numpy() - 1e-9, -1, 1)
        rows[number] = found.column("rows").to_numpy()
    return Cells(centres, farthest, rows)


def _probed(shared, share: float, exact: bool):
    """Queries -> one row per cell to read: those up to the share of the rows, or (`exact`, with the score of the k-th
    hit so far) those behind them that may hold a closer row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells: Cells = shared.value
        total = int(cells.rows.sum())
        for batch in (b.slice(i, 64) for b in batches for i in range(0, b.num_rows, 64)):
            order, bound = cells.order(unit_rows(batch.column("vector")))
            read = np.cumsum(cells.rows[order], axis=1)
            first = read <= max(1.0, share * total)
            first[:, 0] = True
            if exact:
                kth = batch.column("kth").to_numpy(zero_copy_only=False)[:, None]
                take = ~first & (np.take_along_axis(bound, order, axis=1) >= kth - 1e-8)
            else:
                take = first
            take &= cells.rows[order] > 0
            query, place = np.nonzero(take)
            for at in range(0, len(query), _PROBES):
                some = slice(at, at + _PROBES)
                taken = batch.select(["query", "vector"]).take(pa.array(query[some]))
                yield pa.RecordBatch.from_arrays([*taken.columns, pa.array(order[query[some], place[some]].astype(np.int32))], names=["query", "vector", "cell"])

    return run


def search_cells(
    spark: SparkSession, path: str, queries: DataFrame, k: int = 5, *, query_id: str, query_vector: str, exact: bool = False, share: float = SHARE,
) -> DataFrame:
    """`query_id, rank, id, score`: the `k` rows of greatest cosine per query, ties to the smaller id.

    Without `exact` a query reads its nearest cells up to `share` of the rows; with it also every other cell that the
    bound does not rule out. Queries without a direction get no rows.
    """
    cells = read_cells(spark, path)
    given = queries.select(F.col(query_id).alias("query"), F.col(query_vector).cast("array<double>").alias("vector")).where(_usable(query_vector))
    kind = given.schema["query"].dataType.simpleString()
    if not cells.rows.sum():
        return spark.createDataFrame([], f"{query_id} {kind}, rank int, id {kind}, score double")
    shared = spark.sparkContext.broadcast(cells)
    made = f"query {kind}, vector array<double>, cell int"

    def searched(probes: DataFrame) -> DataFrame:
        probes = stage(probes, "probes")
        wanted = [r["cell"] for r in probes.select("cell").distinct().collect()]  # at most MAX_CELLS numbers
        rows = spark.read.parquet(path)
        rows = rows if len(wanted) == int((cells.rows > 0).sum()) else rows.where(F.col("cell").isin(wanted))
        return top_k_similar(probes, rows, k, query_id="query", query_vector="vector", row_id="id", row_vector="vector", on=[("cell", "cell")])

    found = searched(given.mapInArrow(_probed(shared, share, False), made))
    if exact:
        found = stage(found, "nearest")
        kth = found.where(F.col("rank") == k).select("query", F.col("score").alias("kth"))
        open_ = given.join(kth, "query", "left").withColumn("kth", F.coalesce("kth", F.lit(-2.0)))
        found = found.unionByName(searched(open_.mapInArrow(_probed(shared, share, True), made)))
        best = Window.partitionBy("query").orderBy(F.desc("score"), "id")
        found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return found.select(F.col("query").alias(query_id), "rank", "id", "score")


def compared(spark: SparkSession, path: str, queries: DataFrame, *, query_vector: str, share: float = SHARE) -> DataFrame:
    """One row: how many rows the queries compare without `exact`, and how many all rows would be."""
    cells = read_cells(spark, path)
    shared = spark.sparkContext.broadcast(cells)
    given = queries.select(F.lit(0).alias("query"), F.col(query_vector).cast("array<double>").alias("vector")).where(_usable(query_vector))
    probes = given.mapInArrow(_probed(shared, share, False), "query int, vector array<double>, cell int")
    sizes = spark.createDataFrame([(i, int(n)) for i, n in enumerate(cells.rows)], "cell int, rows long")
    whole = given.agg(F.count("*") * F.lit(int(cells.rows.sum()))).scalar()
    return probes.join(F.broadcast(sizes), "cell").agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("compared")).select("compared", whole.alias("all_rows"))
