"""Quality classifier: random-indexing word vectors pooled per document, and a two-layer network.

Tokens are runs of letters and digits, or runs of other marks, as written. Every token owns a sparse random index
vector; a token's word vector is the normalised sum of the index vectors of its neighbours in the training texts,
kept in a table of a fixed number of hashed rows. A document is pooled to the mean and the spread of its tokens' word
vectors and of their index vectors, with a few shares of the tokens. The network is trained in numpy on the driver on
at most `max_labelled` labelled documents, chosen by a hash of their id, which tasks pool, so that no text reaches the
driver; table and weights have a fixed size and are broadcast. Logits are divided by a temperature fitted on held-back training rows.

Defined results: null and empty texts pool to zeros and get the score of that; without labels of both kinds every
score is the share of good labels, or one half; of several labels of a document the smallest counts, of several texts
with one id the smallest is learned from; rows without an id are scored, and give words, never labels; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tagtrend.llm.words import BLANK, BYTE_VALUE, bytes_of, mix, slices, span_hash

MAX_LABELLED = 6_000
ROWS = 1 << 16
DIMENSIONS = 24
NONZEROS = 4
REACH = 2
HIDDEN = 32
STEPS = 1_500
SLICE_BYTES = 1 << 19
_CLASS = np.full(256, 2, dtype=np.uint8)  # 0 blank, 1 letter or digit, 2 mark
_CLASS[BLANK] = 0
for _a, _b in ((48, 58), (65, 91), (97, 123), (128, 256)):
    _CLASS[_a:_b] = 1
_FEATURES = 5


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash and class of every token of a slice, and where each text's tokens begin."""
    data, offsets = bytes_of(texts.fill_null(""))
    kind = _CLASS[data]
    new = np.ones(len(data), dtype=bool)
    np.not_equal(kind[1:], kind[:-1], out=new[1:])
    new[offsets[offsets < len(data)]] = True
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(data))
    solid = kind[starts] > 0 if len(starts) else np.zeros(0, dtype=bool)
    starts, ends = starts[solid], ends[solid]
    kind = kind[starts] + ((data[starts] >= 65) & (data[starts] < 91) & (data[ends - 1] >= 65) & (data[ends - 1] < 91)) * 2
    return span_hash(BYTE_VALUE[data], starts, ends), kind, np.searchsorted(starts, offsets)


def index_vectors(names: np.ndarray) -> np.ndarray:
    """The sparse random vector of each token: a few entries of +1 or -1."""
    out = np.zeros((len(names), DIMENSIONS), dtype=np.float32)
    row = np.arange(len(names))
    for k in range(NONZEROS):
        h = mix(names, 71 + k)
        out[row, (h % np.uint64(DIMENSIONS)).astype(np.int64)] += np.where(h >> np.uint64(63), np.float32(1), np.float32(-1))
    return out


INDEX_TABLE = index_vectors(mix(np.arange(ROWS, dtype=np.uint64), 5))


def neighbour_sums(texts: Iterator[pa.Array]) -> np.ndarray:
    """For each row of the table, the sum of the index vectors of its tokens' neighbours. Whole numbers, so that the
    order of adding does not matter."""
    total = np.zeros((DIMENSIONS, ROWS), dtype=np.float64)
    for part in texts:
        names, _, first = tokens(part)
        row = (names % np.uint64(ROWS)).astype(np.int64)
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        # what stands around each token is summed first, so that the table is touched once per dimension
        around = np.zeros((DIMENSIONS, len(row)), dtype=np.float32)
        vectors = np.ascontiguousarray(INDEX_TABLE[row].T)
        for step in range(1, REACH + 1):
            same = text[step:] == text[:-step]
            around[:, :-step] += vectors[:, step:] * same
            around[:, step:] += vectors[:, :-step] * same
        for d in range(DIMENSIONS):
            total[d] += np.bincount(row, around[d], ROWS)
    return total.T


def normalised(total: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(total, axis=1, keepdims=True)
    return (total / np.maximum(norm, 1e-9)).astype(np.float32)


def word_vectors(texts: DataFrame) -> np.ndarray:
    """The table of word vectors of all texts: a task sums its own, rows are added up by number. What reaches the driver
    is the table, whose size no corpus changes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = neighbour_sums(b.column("text") for b in slices(batches, limit=SLICE_BYTES))
        used = np.flatnonzero(total.any(axis=1))
        columns = [pa.array(used.astype(np.int32)), *(pa.array(total[used, d].astype(np.int64)) for d in range(DIMENSIONS))]
        yield pa.RecordBatch.from_arrays(columns, names=["row", *parts])

    parts = [f"d{d}" for d in range(DIMENSIONS)]
    sums = texts.select("text").mapInArrow(run, ", ".join(["row int", *(f"{d} long" for d in parts)]))
    found = sums.groupBy("row").agg(*[F.sum(d).alias(d) for d in parts]).toArrow()
    total = np.zeros((ROWS, DIMENSIONS))
    total[found.column("row").to_numpy()] = np.stack([found.column(d).to_numpy() for d in parts], axis=1)
    return normalised(total)


def pooled(texts: pa.Array, table: np.ndarray) -> np.ndarray:
    """One row per text: mean and spread of word vectors, spread of index vectors, and shares of the token classes."""
    names, kind, first = tokens(texts)
    count = np.diff(first)
    width = 2 * DIMENSIONS + 1 + _FEATURES
    out = np.zeros((len(count), width), dtype=np.float32)
    full = np.flatnonzero(count)
    if not len(full):
        return out
    row = (names % np.uint64(ROWS)).astype(np.int64)
    at, n = first[full], count[full][:, None].astype(np.float32)
    vectors = table[row]
    mean = np.add.reduceat(vectors, at, axis=0) / n
    spread = np.sqrt(np.maximum(np.add.reduceat(vectors * vectors, at, axis=0) / n - mean * mean, 0))
    index = np.add.reduceat(INDEX_TABLE[row], at, axis=0) / n
    text = np.repeat(np.arange(len(count)), count)
    order = np.lexsort((names, text))
    new = np.ones(len(names), dtype=bool)
    new[1:] = (names[order][1:] != names[order][:-1]) | (text[order][1:] != text[order][:-1])
    distinct = np.bincount(text[order][new], minlength=len(count))[full][:, None]
    share = [np.add.reduceat((kind == k).astype(np.float32), at)[:, None] / n for k in (2, 3)]
    out[full] = np.hstack([
        mean, spread, np.linalg.norm(index, axis=1, keepdims=True), *share, distinct / n, np.log1p(n), distinct / np.sqrt(n) / 10
    ])
    return out


@dataclass
class Model:
    """Everything a task needs to score: table, scaling, two layers, temperature."""

    table: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]
    temperature: float
    constant: float | None = None

    def logits(self, features: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        x = (features.astype(np.float64) - self.centre) / self.scale
        return (np.tanh(x @ w1 + b1) @ w2 + b2)[:, 0]

    def scores(self, texts: pa.Array) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(texts), self.constant)
        z = self.logits(pooled(texts, self.table)) / self.temperature
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


def _loss(z: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, z) - y * z))


def train(features: np.ndarray, labels: np.ndarray, held: np.ndarray, table: np.ndarray, seed: int = 7) -> Model:
    """Full-batch Adam on the rows that are not held back, the temperature on those that are."""
    x0, y0 = features[~held].astype(np.float64), labels[~held].astype(np.float64)
    centre, scale = x0.mean(axis=0), x0.std(axis=0) + 1e-3
    x = (x0 - centre) / scale
    rng = np.random.Generator(np.random.PCG64(seed))
    params = [rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, (HIDDEN, 1)), np.zeros(1)]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, STEPS + 1):
        rows = rng.integers(0, len(x), min(len(x), 512))
        xb, yb = x[rows], y0[rows][:, None]
        hidden = np.tanh(xb @ params[0] + params[1])
        out = 1 / (1 + np.exp(-np.clip(hidden @ params[2] + params[3], -60, 60)))
        delta = (out - yb) / len(rows)
        back = (delta @ params[2].T) * (1 - hidden * hidden)
        grads = [xb.T @ back, back.sum(axis=0), hidden.T @ delta, delta.sum(axis=0)]
        for i, g in enumerate(grads):
            g = g + 1e-4 * params[i]
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            params[i] = params[i] - 0.01 * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    model = Model(table, centre, scale, tuple(params), 1.0)
    if held.any():
        z, y = model.logits(features[held]), labels[held].astype(np.float64)
        grid = np.exp(np.linspace(np.log(0.25), np.log(16), 121))
        model.temperature = float(min(grid, key=lambda t: _loss(z / t, y)))
    return model


def fit(documents: DataFrame, labels: DataFrame, learn_from: Column, max_labelled: int = MAX_LABELLED) -> Model:
    """Learn from the labelled documents that satisfy `learn_from`, a condition on doc_id. At most `max_labelled` of
    them, by the smallest hash of the id, reach the driver."""
    marked = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & learn_from).groupBy("doc_id").agg(F.min("quality").alias("quality"))
    chosen = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labelled)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))
    kinds = {r["quality"] for r in rows.select(F.col("quality").cast("boolean").alias("quality")).distinct().collect()}
    if len(kinds) < 2:
        empty = np.zeros(0)
        return Model(empty, empty, empty, (empty,) * 4, 1.0, float(kinds.pop()) if kinds else 0.5)
    table = word_vectors(texts)
    shared = documents.sparkSession.sparkContext.broadcast(table)

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SLICE_BYTES):
            features = pooled(batch.column("text"), shared.value)
            of_list = pa.ListArray.from_arrays(np.arange(len(features) + 1, dtype=np.int32) * features.shape[1], pa.array(features.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("good"), of_list], names=["doc_id", "good", "features"])

    marked_texts = rows.select("doc_id", "text", F.col("quality").cast("boolean").alias("good"))
    rows = marked_texts.mapInArrow(pool, "doc_id long, good boolean, features array<float>").toArrow().sort_by("doc_id").combine_chunks()
    good = rows.column("good").to_numpy().astype(bool)
    features = rows.column("features").combine_chunks().values.to_numpy().reshape(len(good), -1)
    held = (mix(rows.column("doc_id").to_numpy().astype(np.int64).view(np.uint64), 3) % np.uint64(5)) == 0
    if not (good[~held].any() and not good[~held].all()):
        held[:] = False
    return train(features, good, held, table)


def scored(documents: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """The documents, all other columns kept, with the probability that the quality is good in column `name`."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.drop(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, limit=SLICE_BYTES):
            yield batch.append_column(name, pa.array(shared.value.scores(batch.column("text")), pa.float64()))

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(name, DoubleType())]))
