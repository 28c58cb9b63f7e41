"""Benchmark decontamination by greedy string tiling.

Benchmark and documents are compared as lower-cased words. Karp-Rabin hashes of `seed` words find where an item and a
document agree; the items that the seeds could cover far enough go to the tiling: repeatedly the longest run of
unmarked words that both share becomes a tile and is marked on both sides, until no run of `seed` words is left. As
tiles may lie in any order, a passage whose sentences were moved is still covered. A document is contaminated by an
item if the tiles cover at least `coverage` of the item's words.

The benchmark is a stated query set: it is broadcast in blocks of a bounded number of words, each against all
documents in one pass, so its size does not change the method. The documents are never shuffled.

Defined results: null texts have no words; items shorter than a seed match nothing, as a common word is no leak;
repeated items match separately, rows without an id match like others; an empty side gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagtrend.llm.store import fresh, small_side
from tagtrend.llm.words import Words, slices, window_hash, words_of

SEED = 5
COVERAGE = 0.6
BLOCK_WORDS = 200_000
CHUNK_HITS = 1 << 20
PAIR_HITS = 1 << 18  # beyond it a pair's tiles are found by length; they are the same
_FILTER_BITS = 20
MAX_BROADCAST = 500_000  # names of rows, 8 bytes each; beyond it the join shuffles
MATCH = "doc_id long, item_id long, n_words int, n_covered int, tiles array<struct<item_start:int,doc_start:int,length:int>>"
_TILES = pa.list_(pa.struct([("item_start", pa.int32()), ("doc_start", pa.int32()), ("length", pa.int32())]))


class Items:
    """A block of the benchmark with its seeds in order of hash, and a bit table that rejects most other hashes."""

    def __init__(self, ids: list[int], texts: list[str | None], seed: int):
        words = words_of(pa.array(texts, pa.string()), lower=True)
        self.ids, self.names, self.first = ids, words.names, words.first
        at, of = seed_places(words, seed)
        hashes = window_hash(words.names, seed)[at] if len(at) else np.zeros(0, dtype=np.uint64)
        order = np.argsort(hashes, kind="stable")
        self.hashes, self.item, self.at = hashes[order], of[order], (at - words.first[of])[order]
        self.known = np.zeros(1 << _FILTER_BITS, dtype=bool)
        self.known[(self.hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True


def seed_places(words: Words, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which `seed` words of one text start, and their texts."""
    of = np.repeat(np.arange(len(words.first) - 1), words.counts)
    at = np.flatnonzero(np.arange(len(of)) + seed <= words.first[1:][of])
    return at, of[at]


def tiles(item: np.ndarray, doc: np.ndarray, item_at: np.ndarray, doc_at: np.ndarray, seed: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two word sequences from the places where their seeds agree: (item, document, length),
    longest first; of equal lengths the earlier in the item, then in the document."""
    order = np.lexsort((item_at, doc_at - item_at))
    a, b = item_at[order], doc_at[order]
    new = np.ones(len(a), dtype=bool)
    new[1:] = ((b - a)[1:] != (b - a)[:-1]) | (a[1:] != a[:-1] + 1)
    begin = np.flatnonzero(new)
    length = np.diff(np.append(begin, len(a))) + seed - 1
    heap = [(-int(n), int(a[i]), int(b[i])) for i, n in zip(begin, length, strict=True)]
    heapq.heapify(heap)
    item_free, doc_free, found = np.ones(len(item), dtype=bool), np.ones(len(doc), dtype=bool), []
    while heap:
        n, i, j = heapq.heappop(heap)
        free = item_free[i : i - n] & doc_free[j : j - n] & (item[i : i - n] == doc[j : j - n])
        if free.all():
            item_free[i : i - n] = doc_free[j : j - n] = False
            found.append((i, j, -n))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate([[False], free, [False]]).astype(np.int8)))
        for start, stop in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if stop - start >= seed:
                heapq.heappush(heap, (start - stop, i + start, j + start))
    return found


def tiles_by_length(item: np.ndarray, doc: np.ndarray, seed: int) -> list[tuple[int, int, int]]:
    """`tiles` in memory of the two sequences alone, however often their seeds agree: the longest length at which
    Karp-Rabin hashes of unmarked runs meet is found by halving, its tiles are marked, and the search goes on below."""
    item_free, doc_free, found = np.ones(len(item), dtype=bool), np.ones(len(doc), dtype=bool), []

    def windows(values: np.ndarray, free: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        before = np.concatenate([[0], np.cumsum(free)])
        at = np.flatnonzero(before[n:] - before[:-n] == n)
        return at, window_hash(values, n)[at]

    high = min(len(item), len(doc))
    while high >= seed:
        low = seed - 1  # runs of `low` words are shared, or nothing is known of them; longer ones than `high` are not
        while low < high:
            middle = (low + high + 1) // 2
            if np.isin(windows(item, item_free, middle)[1], windows(doc, doc_free, middle)[1]).any():
                low = middle
            else:
                high = middle - 1
        n = low
        if n < seed:
            break
        (at, names), (place, hashes) = windows(item, item_free, n), windows(doc, doc_free, n)
        order = np.argsort(hashes, kind="stable")
        place, hashes = place[order], hashes[order]
        first, last = np.searchsorted(hashes, names, "left"), np.searchsorted(hashes, names, "right")
        tried: dict[int, int] = {}  # per hash: the places before this one are taken for good
        for i, a, b in zip(at.tolist(), first.tolist(), last.tolist(), strict=True):
            if a == b or not item_free[i : i + n].all():
                continue
            k = tried.get(a, a)
            while k < b and not doc_free[place[k] : place[k] + n].all():
                k += 1
            tried[a] = k
            if k < b:
                j = int(place[k])
                item_free[i : i + n] = doc_free[j : j + n] = False
                found.append((i, j, n))
        high = n - 1
    return found


def _ramp(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """start[i], start[i] + 1, ... of the given counts, one after the other."""
    return np.arange(int(count.sum())) + np.repeat(start - (np.cumsum(count) - count), count)


def _search(items: Items, words: Words, seed: int, coverage: float) -> Iterator[tuple[int, int, int, list[tuple[int, int, int]]]]:
    """(text of the slice, item, covered words, tiles) of every match. A text meets each seed of the benchmark once,
    however often it repeats; pairs of places are listed only for items that these seeds cover, and only if few."""
    at, of = seed_places(words, seed)
    if not len(at) or not len(items.hashes):
        return
    hashes = window_hash(words.names, seed)[at]
    maybe = np.flatnonzero(items.known[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
    low, high = np.searchsorted(items.hashes, hashes[maybe], "left"), np.searchsorted(items.hashes, hashes[maybe], "right")
    order = np.lexsort((low, of[maybe]))
    order = order[(high > low)[order]]
    if not len(order):
        return
    place, low, high = maybe[order], low[order], high[order]
    new = np.ones(len(place), dtype=bool)
    new[1:] = (of[place][1:] != of[place][:-1]) | (low[1:] != low[:-1])
    begin = np.flatnonzero(new)  # one for each text and seed, with its places behind it
    repeats = np.diff(np.append(begin, len(place)))
    text, low, hits = of[place[begin]], low[begin], (high - low)[begin]
    # texts together up to a number of meetings; those of one text are at most the seeds of the block
    share = (np.cumsum(hits) - hits)[np.searchsorted(text, text)] // CHUNK_HITS
    edges = np.flatnonzero(np.diff(share)) + 1
    for g, h in zip([0, *edges], [*edges, len(text)], strict=True):
        pick, group = _ramp(low[g:h], hits[g:h]), np.repeat(np.arange(g, h), hits[g:h])
        order = np.lexsort((items.item[pick], text[group]))
        pick, group = pick[order], group[order]
        doc, item = text[group], items.item[pick]
        cuts = np.flatnonzero((np.diff(doc) != 0) | (np.diff(item) != 0)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(doc)], strict=True):
            d, i, starts = int(doc[a]), int(item[a]), items.at[pick[a:b]]
            size = int(items.first[i + 1] - items.first[i])
            reach = np.zeros(size + 1, dtype=np.int32)
            reach[starts] += 1
            reach[starts + seed] -= 1
            if np.count_nonzero(np.cumsum(reach)[:size]) < coverage * size:
                continue
            names, inside, count = items.names[items.first[i] : items.first[i + 1]], words.names[words.text(d)], repeats[group[a:b]]
            if int(count.sum()) > PAIR_HITS:
                found = tiles_by_length(names, inside, seed)
            else:
                places = at[place[_ramp(begin[group[a:b]], count)]] - words.first[d]
                found = tiles(names, inside, np.repeat(starts, count), places, seed)
            covered = sum(n for _, _, n in found)
            if covered >= coverage * size:
                yield d, i, covered, found


def matches(documents: DataFrame, benchmark: DataFrame, seed: int = SEED, coverage: float = COVERAGE, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row for each document and benchmark item whose tiles cover enough of the item."""
    spark = documents.sparkSession
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    # an upper bound of the words; blocks are equal shares by hash
    bound = items.agg(F.sum(F.size(F.split("text", r"[ \t-\r]+"))).alias("n")).first()["n"] or 0
    blocks = max(1, -(-bound // block_words))

    def against(block: int) -> DataFrame:
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        shared = spark.sparkContext.broadcast(Items([r["item_id"] for r in rows], [r["text"] for r in rows], seed))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = shared.value
            for batch in slices(batches):
                words = words_of(batch.column("text"), lower=True)
                found = list(_search(known, words, seed, coverage))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").take(pa.array([d for d, _, _, _ in found])),
                            pa.array([known.ids[i] for _, i, _, _ in found], pa.int64()),
                            pa.array([int(known.first[i + 1] - known.first[i]) for _, i, _, _ in found], pa.int32()),
                            pa.array([n for _, _, n, _ in found], pa.int32()),
                            pa.array([[dict(zip(("item_start", "doc_start", "length"), t, strict=True)) for t in x] for _, _, _, x in found], _TILES),
                        ],
                        names=["doc_id", "item_id", "n_words", "n_covered", "tiles"],
                    )

        return narrow.mapInArrow(run, MATCH)

    return reduce(DataFrame.unionByName, [against(b) for b in range(blocks)])


def decontaminate(documents: DataFrame, benchmark: DataFrame, seed: int = SEED, coverage: float = COVERAGE) -> DataFrame:
    """The documents that no benchmark item contaminates, with all their columns; rows without an id are judged by a
    name of their text. The names of the leaked rows are broadcast if they are few, so that no text is shuffled."""
    row = fresh("_row", documents.columns)
    named = documents.withColumn(row, F.xxhash64("doc_id", "text"))
    leaked = matches(named.select(F.col(row).alias("doc_id"), "text"), benchmark, seed, coverage)
    gone = small_side(leaked.select(F.col("doc_id").alias(row)).distinct(), MAX_BROADCAST)
    return named.join(gone, row, "left_anti").select(*documents.columns)
