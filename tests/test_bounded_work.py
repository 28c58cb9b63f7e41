"""What a task holds or sends does not grow with its rows."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from tagtrend.operators import cells, lloyd, neighbours, projection

RNG = np.random.Generator(np.random.PCG64(1))


def lists(x):
    return pa.array(x.tolist(), pa.list_(pa.float64()))


def test_probes_leave_in_bounded_batches():
    centres = neighbours.unit_rows(lists(RNG.standard_normal((1_000, 4))))
    shared = SimpleNamespace(value=cells.Cells(centres, np.full(1_000, 0.9), np.full(1_000, 3)))
    asked = pa.RecordBatch.from_arrays([pa.array(range(100)), lists(RNG.standard_normal((100, 4)))], names=["query", "vector"])
    found = list(cells._probed(shared, 1.0, False)(iter([asked])))
    assert sum(b.num_rows for b in found) == 100_000 and max(b.num_rows for b in found) <= cells._PROBES
    assert pa.Table.from_batches(found).group_by("query").aggregate([("cell", "count_distinct")]).column("cell_count_distinct").unique().to_pylist() == [1_000]


def test_scores_are_made_in_bounded_slices():
    queries, rows = RNG.standard_normal((300, 3)), RNG.standard_normal((20_000, 3))
    found = list(neighbours._scores(pa.chunked_array([lists(queries)]), pa.chunked_array([lists(rows)])))
    assert max(s.size for s in found) <= 1 << 20
    unit = [x / np.linalg.norm(x, axis=1, keepdims=True) for x in (queries, rows)]
    assert np.allclose(np.concatenate(found), unit[0] @ unit[1].T, atol=1e-9)


def sparse_rows(n, width):
    first = np.arange(n + 1) * 5
    return lloyd.Rows(n, width, first, RNG.integers(0, width, 5 * n), RNG.standard_normal(5 * n))


def test_sums_of_wide_sparse_rows_make_no_table_per_slice():
    rows, labels = sparse_rows(200, 200_000), RNG.integers(0, 9, 200)
    total, thin, back = np.zeros((9, rows.width)), RNG.standard_normal((200, 2)), np.zeros((2, rows.width))
    tracemalloc.start()
    rows.add_to(total, labels)
    projection._add_transposed(back, rows, thin)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1 << 20
    dense = np.stack([rows.take(i) if len(set(rows.slot[5 * i : 5 * i + 5])) == 5 else np.bincount(rows.slot[5 * i : 5 * i + 5], rows.value[5 * i : 5 * i + 5], rows.width) for i in range(200)])
    assert np.allclose(total, [dense[labels == c].sum(axis=0) for c in range(9)]) and np.allclose(back, thin.T @ dense)


def test_packed_rows_come_back():
    for rows in (sparse_rows(50, 1_000), lloyd.Rows(4, 3, None, None, RNG.standard_normal(12))):
        again = lloyd.Rows.unpacked(rows.n, rows.width, *(pa.scalar(x, pa.binary()) for x in rows.packed()))
        across = RNG.standard_normal((rows.width, 40))
        assert np.array_equal(rows.times(across), again.times(across)) and np.array_equal(rows.squares, again.squares)
