"""Exact top-k similarity between a query table and a vector collection."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BLOCK = 32_768
QUERIES_PER_BLOCK = 4_096
MAX_BROADCAST_KEYS = 100_000
_SCORES = 1 << 20  # of a slice of queries
_SPARSE_SLICE = 64


def unit_rows(vectors: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Unit rows of an Arrow list column, read as one flat buffer."""
    chunks = vectors.chunks if isinstance(vectors, pa.ChunkedArray) else [vectors]
    flat = pa.concat_arrays([chunk.flatten() for chunk in chunks])
    matrix = flat.to_numpy(zero_copy_only=False).astype("float64", copy=False).reshape(len(vectors), -1)
    norms = np.sqrt((matrix * matrix).sum(axis=1, keepdims=True))
    return matrix / np.where(norms == 0, 1.0, norms)


def _sparse(vectors: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, slot and value of every entry of a column of (indices, values), in unit rows."""
    whole = pa.concat_arrays(vectors.chunks)
    slots, values = whole.field("indices"), whole.field("values")
    row = np.repeat(np.arange(len(whole)), slots.value_lengths().fill_null(0).to_numpy())
    value = values.flatten().to_numpy().astype("float64")
    norms = np.sqrt(np.bincount(row, value * value, len(whole)))
    return row, slots.flatten().to_numpy(), value / np.where(norms == 0, 1.0, norms)[row]


def _scores(queries: pa.ChunkedArray, rows: pa.ChunkedArray) -> Iterator[np.ndarray]:
    """Cosines of a slice of queries with all rows, slice by slice."""
    if not pa.types.is_struct(queries.type):
        wanted, collection = unit_rows(queries), unit_rows(rows)
        step = max(1, _SCORES // len(collection))
        for start in range(0, len(wanted), step):
            scores = wanted[start : start + step] @ collection.T
            yield np.round(scores, 9, out=scores)
        return
    q_row, q_slot, q_value = _sparse(queries)
    row, slot, value = _sparse(rows)
    for start in range(0, len(queries), _SPARSE_SLICE):
        mine = slice(*np.searchsorted(q_row, [start, start + _SPARSE_SLICE]))
        n = min(_SPARSE_SLICE, len(queries) - start)
        slots, at = np.unique(q_slot[mine], return_inverse=True)
        weight = np.zeros((len(slots), n))
        weight[at, q_row[mine] - start] = q_value[mine]
        # entries in slots that no query of the slice has add nothing
        place = np.full(int(max(slot.max(initial=0), slots.max(initial=0))) + 1, -1)
        place[slots] = np.arange(len(slots))
        hit = np.flatnonzero(place[slot] >= 0)
        scores = np.zeros((len(rows), n))
        np.add.at(scores, row[hit], value[hit][:, None] * weight[place[slot[hit]]])
        yield np.round(scores.T, 9)


def _block_top_k(queries: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    """Best `k` rows of one block for each query of one block; ties go to the smaller id."""
    places, near, near_scores, place = [], [], [], 0
    if queries.num_rows and rows.num_rows:
        # ids stand in order, so that a smaller place is a smaller id
        order = pc.sort_indices(rows["_id"])
        rows, k = rows.take(order), min(k, rows.num_rows)
        for scores in _scores(queries["_vector"], rows["_vector"]):
            for score in scores:
                floor = np.partition(score, len(score) - k)[len(score) - k]
                best = np.flatnonzero(score >= floor)
                best = best[np.lexsort((best, -score[best]))[:k]]
                places.append(place)
                place += 1
                near.append(best)
                near_scores.append(score[best])
    picked = pa.array(np.repeat(np.array(places, dtype="int64"), k), pa.int64())
    return pa.table({
        "_query": queries["_query"].take(picked),
        "_id": rows["_id"].take(pa.array(np.concatenate(near) if near else [], pa.int64())),
        "score": pa.array(np.concatenate(near_scores) if near_scores else [], pa.float64()),
    })


def _large_keys(side: DataFrame, on: Sequence[str], rows: int, block: int, name: str) -> DataFrame | None:
    """Keys with more rows than a block, and their number of blocks; `None` where one block holds the side.

    There are at most rows / block such keys. Up to `MAX_BROADCAST_KEYS` of them the table is broadcast,
    beyond that it is joined like any other.
    """
    if rows <= block:
        return None
    sizes = side.groupBy(*on).agg(F.count("*").alias("_n")).where(F.col("_n") > block)
    large = sizes.select(*on, F.ceil(F.col("_n") / block).cast("long").alias(name))
    return F.broadcast(large) if rows // block <= MAX_BROADCAST_KEYS else large


def _with_blocks(
    df: DataFrame, ident: str, on: Sequence[str], own_sizes: DataFrame | None, other_sizes: DataFrame | None,
    own: str, other: str,
) -> DataFrame:
    """Give each row its block within its key, and a copy for every block of the other side."""
    one = F.lit(1).cast("long")
    if own_sizes is None:
        df = df.withColumn(own, one - 1)
    else:
        df = df.join(own_sizes.withColumnRenamed(own, "_own"), list(on), "left")
        df = df.withColumn(own, F.pmod(F.xxhash64(ident), F.coalesce("_own", one))).drop("_own")
    if other_sizes is None:
        return df.withColumn(other, one - 1)
    df = df.join(other_sizes.withColumnRenamed(other, "_across"), list(on), "left")
    return df.withColumn(other, F.explode(F.sequence(one - 1, F.coalesce("_across", one) - 1))).drop("_across")


def top_k_similar(
    queries: DataFrame,
    collection: DataFrame,
    k: int = 5,
    *,
    query_id: str,
    query_vector: str,
    row_id: str,
    row_vector: str,
    on: Sequence[tuple[str, str]] = (),
    rows_per_block: int = ROWS_PER_BLOCK,
    queries_per_block: int = QUERIES_PER_BLOCK,
) -> DataFrame:
    """`query_id, rank, row_id, score`: the `k` rows of greatest cosine per query, ties to the smaller id.

    `on` pairs a query column with a collection column that must be equal (the metadata filter); a query
    whose filter matches nothing, or is null, gets no rows. The search is exact: both sides are cut into blocks of
    bounded size per filter value, each pair of blocks is one matrix product in a task, and only the best
    `k` per query leave the task. No pair of rows is ever emitted, a hot filter value is just more blocks,
    and no task holds more than one block of each side. Vectors are arrays, or structs of indices and values where they
    are sparse.
    """
    keys = [f"_on{i}" for i in range(len(on))] or ["_on0"]
    q_on = [F.col(q).alias(n) for (q, _), n in zip(on, keys)] or [F.lit(0).alias("_on0")]
    c_on = [F.col(c).alias(n) for (_, c), n in zip(on, keys)] or [F.lit(0).alias("_on0")]
    q = queries.select(F.col(query_id).alias("_query"), F.col(query_vector).alias("_vector"), *q_on)
    c = collection.select(F.col(row_id).alias("_id"), F.col(row_vector).alias("_vector"), *c_on)
    if on:
        # a null filter value equals nothing
        q, c = q.dropna(subset=keys), c.dropna(subset=keys)
    q_sizes = _large_keys(q, keys, q.count(), queries_per_block, "_qb")
    c_sizes = _large_keys(c, keys, c.count(), rows_per_block, "_cb")
    q_blocks = _with_blocks(q, "_query", keys, q_sizes, c_sizes, "_qb", "_cb")
    c_blocks = _with_blocks(c, "_id", keys, c_sizes, q_sizes, "_cb", "_qb")
    id_type, row_type = (side.schema[c].dataType.simpleString() for side, c in ((q, "_query"), (c, "_id")))
    cell = [*keys, "_qb", "_cb"]
    partial = (
        q_blocks.groupBy(*cell)
        .cogroup(c_blocks.groupBy(*cell))
        .applyInArrow(lambda a, b: _block_top_k(a, b, k), f"_query {id_type}, _id {row_type}, score double")
    )
    best = Window.partitionBy("_query").orderBy(F.desc("score"), "_id")
    return (
        partial.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select(F.col("_query").alias(query_id), "rank", F.col("_id").alias(row_id), "score")
    )
