"""Principal components of narrow rows exactly and of wide sparse rows by a randomised range finder.

Narrow rows give their covariance in one scan. For wide ones a thin random matrix is carried through the rows and back a
few times (each scan multiplies the rows with a matrix of a few columns, a task sends one sum of the width of the
vocabulary, and a small QR on the driver keeps the columns apart); the components are those of the rows within that
space. The mean is taken off in the products, so sparse rows stay sparse, and the coordinates are centred.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagtrend.operators.lloyd import Rows, Scan, _read, read_blocks

NARROW = 512  # columns up to which the covariance is held
EXTRA = 8  # columns beyond the wanted ones
PASSES = 4


def _parts(shared, width: int):
    """Rows times a thin matrix, and back: per task, the sums of the rows, of the products, of the products' squares, and
    of the rows times the products."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        thin = shared.value
        n, rows_sum, sums, squares, back = 0, np.zeros((1, width)), np.zeros(thin.shape[1]), np.zeros((thin.shape[1],) * 2), np.zeros(thin.shape[::-1])
        for rows in read_blocks(batches, width):
            along = rows.times(thin)
            n += rows.n
            _add_transposed(rows_sum, rows, np.ones((rows.n, 1)))
            sums += along.sum(axis=0)
            squares += along.T @ along
            _add_transposed(back, rows, along)
        if n:
            whole = np.concatenate([[float(n)], rows_sum[0], sums, squares.ravel(), back.T.ravel()])
            for at in range(0, len(whole), 1 << 16):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at // (1 << 16)], pa.int32()), pa.array([whole[at : at + (1 << 16)].tobytes()], pa.binary())], names=["piece", "sum"]
                )

    return run


def _add_transposed(total: np.ndarray, rows: Rows, right: np.ndarray) -> None:
    """Add the rows' matrix, turned, times another with as many rows; the total has a line per column of the other."""
    if not rows.sparse:
        total += right.T @ rows.dense
        return
    for line, column in zip(total, right.T, strict=True):
        np.add.at(line, rows.slot, rows.value * column[rows.row])


def _added(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = None
    for batch in batches:
        for x in batch.column("sum"):
            part = np.frombuffer(x.as_buffer())
            total = part.copy() if total is None else total + part
    yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["piece", "sum"])


def _carried(scan: Scan, thin: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """The number of rows, their mean, and of the centred rows: the products' squares and the rows times the products."""
    width, few = thin.shape
    shared = scan.spark.sparkContext.broadcast(thin)
    parts = scan.blocks.mapInArrow(_parts(shared, width), "piece int, sum binary")
    found = parts.groupBy("piece").applyInArrow(_added, "piece int, sum binary").orderBy("piece").toArrow()
    whole = np.concatenate([np.frombuffer(x) for x in found.column("sum").to_pylist()])
    n, rows_sum, sums = int(whole[0]), whole[1 : 1 + width], whole[1 + width : 1 + width + few]
    squares, back = whole[1 + width + few :][: few * few].reshape(few, few), whole[1 + width + few + few * few :].reshape(width, few)
    mean = rows_sum / n
    return n, mean, squares - np.outer(sums, sums) / n, back - np.outer(mean, sums)


def components(scan: Scan, k: int = 2, seed: int = 5, passes: int = PASSES) -> tuple[np.ndarray, np.ndarray]:
    """The mean of the rows, and their first `k` components, one per column, the largest entry of each positive."""
    width = scan.space.width
    if width <= NARROW:
        _, mean, covariance, _ = _carried(scan, np.eye(width))
        found = np.linalg.eigh(covariance)[1][:, ::-1][:, :k]
    else:
        thin = np.linalg.qr(np.random.Generator(np.random.PCG64(seed)).standard_normal((width, k + EXTRA)))[0]
        for _ in range(passes):
            thin = np.linalg.qr(_carried(scan, thin)[3])[0]
        _, mean, squares, _ = _carried(scan, thin)
        found = thin @ np.linalg.eigh(squares)[1][:, ::-1][:, :k]
    top = found[np.abs(found).argmax(axis=0), np.arange(found.shape[1])]
    return mean, found * np.where(top < 0, -1, 1)


def project(df: DataFrame, vector: str, names: tuple[str, ...] = ("x", "y")) -> DataFrame:
    """Add the coordinates of every row on its first components, around the mean, in place of the vector; null for a null
    vector, and zero where there are fewer components than names."""
    scan = Scan(df, vector)
    spark, width = df.sparkSession, scan.space.width
    none = not width or scan.rows.isEmpty()
    mean, found = (np.zeros(0), np.zeros((0, 0))) if none else components(scan, len(names))
    shared, place = spark.sparkContext.broadcast((mean, found)), scan.place
    kept = [c for c in df.columns if c != vector]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centre, across = shared.value
        for whole in batches:
            good = whole.column(vector).is_valid().to_numpy(zero_copy_only=False)
            out = np.zeros((whole.num_rows, len(names)))
            if good.any() and across.size:
                parts = [rows.times(across) for _, rows in _read(iter([whole.select([vector]).rename_columns(["vector"]).filter(pa.array(good))]), place.value, width)]
                out[np.flatnonzero(good), : across.shape[1]] = np.concatenate(parts) - centre @ across
            columns = [pa.array(out[:, i], mask=~good) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([*(whole.column(c) for c in kept), *columns], names=[*kept, *names])

    fields = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in kept] + [f"`{n}` double" for n in names])
    return df.select(*kept, F.col(vector)).mapInArrow(run, fields)
