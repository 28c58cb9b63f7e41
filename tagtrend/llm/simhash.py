"""SimHash near-duplicates by meet-in-the-middle ball hashing.

A fingerprint bit is set where more than half of the shingle hashes (XXH64, seed 42, repeats included) set it. Two
fingerprints within `radius` bits share a variant within half the radius of both: every distinct fingerprint emits
that ball, the variants meet in one shuffle, and the pairs that collide are deduplicated and verified. A bucket never
holds more fingerprints than a ball has, whatever the number of documents, and all in it are within the radius of
each other, so linking each to the smallest keeps every component without listing all pairs.

Defined results: null and empty texts have the fingerprint zero and link like any other; texts with fewer words than
a shingle hash the whole sequence; documents without an id take part and get the smallest id of their component;
repeated rows stay repeated; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagtrend.llm.components import components
from tagtrend.llm.store import fresh, small_side, stage
from tagtrend.llm.words import BLANK, Words, slices, words_of

BITS = 64
SEED = 42
RADIUS = 2
SHINGLE = 3
MAX_BROADCAST = 500_000  # names of rows, 8 bytes each; beyond it the join shuffles
# fixed values: the five primes of XXH64
_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(x) for x in (11400714785074694791, 14029467366897019727, 1609587929392839161, 9650029242287828579, 2870177450012600261)
)
_ALL = (1 << 64) - 1


def _rotated(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def _lane(acc: np.ndarray, value: np.ndarray) -> np.ndarray:
    return _rotated(acc + value * _P2, 31) * _P1


def xxh64(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = SEED) -> np.ndarray:
    """XXH64 of many byte spans at once; the steps are those of the published algorithm, taken by all spans together."""
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    eight = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
    at, left = starts.astype(np.int64), (ends - starts).astype(np.int64)
    size, seeded = left.astype(np.uint64), np.uint64(seed)
    acc = np.full(len(at), seeded + _P5, dtype=np.uint64)
    long = np.flatnonzero(left >= 32)
    if len(long):
        lanes = [np.full(len(long), np.uint64(x & _ALL)) for x in (seed + int(_P1) + int(_P2), seed + int(_P2), seed, seed - int(_P1))]
        go = np.arange(len(long))
        while len(go):
            here = long[go]
            for i in range(4):
                lanes[i][go] = _lane(lanes[i][go], eight[at[here] + 8 * i])
            at[here] += 32
            left[here] -= 32
            go = go[left[here] >= 32]
        merged = sum(_rotated(x, n) for x, n in zip(lanes, (1, 7, 12, 18), strict=True))
        for x in lanes:
            merged = (merged ^ _lane(np.zeros_like(x), x)) * _P1 + _P4
        acc[long] = merged
    acc += size
    go = np.flatnonzero(left >= 8)
    while len(go):
        acc[go] = _rotated(acc[go] ^ _lane(np.zeros(len(go), dtype=np.uint64), eight[at[go]]), 27) * _P1 + _P4
        at[go] += 8
        left[go] -= 8
        go = go[left[go] >= 8]
    go = np.flatnonzero(left >= 4)
    acc[go] = _rotated(acc[go] ^ ((eight[at[go]] & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
    at[go] += 4
    left[go] -= 4
    go = np.flatnonzero(left > 0)
    while len(go):
        acc[go] = _rotated(acc[go] ^ (padded[at[go]].astype(np.uint64) * _P5), 11) * _P1
        at[go] += 1
        left[go] -= 1
        go = go[left[go] > 0]
    acc = (acc ^ (acc >> np.uint64(33))) * _P2
    acc = (acc ^ (acc >> np.uint64(29))) * _P3
    return acc ^ (acc >> np.uint64(32))


def majority(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per group hashes[first[i]:first[i + 1]]: the bits set in more than half of it; zero for an empty group."""
    counts = np.diff(first)
    out = np.zeros(len(counts), dtype=np.uint64)
    full = np.flatnonzero(counts)
    if len(full):
        bits = np.unpackbits(hashes.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        sums = np.add.reduceat(bits, first[full], axis=0, dtype=np.int32)
        out[full] = np.packbits(2 * sums > counts[full, None], axis=1).view(">u8").ravel()
    return out


def spaced(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The words of a slice joined by one space, and where each begins in that."""
    size = words.ends - words.starts
    begin = np.cumsum(size + 1) - size - 1
    out = np.full(int((size + 1).sum()), 32, dtype=np.uint8)
    inside = np.ones(len(out), dtype=bool)
    inside[begin + size] = False
    out[inside] = words.data[~BLANK[words.data]]
    return out, begin


def shingle_hashes(words: Words, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every shingle of every text of a slice, and where each text's begin; a shorter text is one shingle."""
    data, begin = spaced(words)
    counts = words.counts
    grams = np.where(counts > shingle, counts - shingle + 1, np.minimum(counts, 1))
    first = np.concatenate([[0], np.cumsum(grams)])
    head = np.arange(first[-1]) - np.repeat(first[:-1], grams) + np.repeat(words.first[:-1], grams)
    tail = np.minimum(head + shingle, np.repeat(words.first[1:], grams)) - 1
    return xxh64(data, begin[head], begin[tail] + (words.ends - words.starts)[tail]), first


def fingerprints(documents: DataFrame, shingle: int = SHINGLE, carried: str | None = None) -> DataFrame:
    """doc_id and fingerprint (as a signed long) of every row, and a long column `carried` along if it is named."""
    names = ["doc_id", "fingerprint"] + [carried] * bool(carried)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = majority(*shingle_hashes(words_of(batch.column("text"), lower=True), shingle))
            kept = [batch.column("doc_id"), pa.array(found.view(np.int64))] + [batch.column(n) for n in names[2:]]
            yield pa.RecordBatch.from_arrays(kept, names=names)

    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *names[2:])
    return narrow.mapInArrow(run, ", ".join(f"`{n}` long" for n in names))


def ball(half: int) -> list[int]:
    """All masks of at most `half` of the 64 bits, as signed longs."""
    masks = [sum(1 << b for b in bits) for n in range(half + 1) for bits in combinations(range(BITS), n)]
    return [m - (1 << BITS) if m >= 1 << (BITS - 1) else m for m in masks]


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b) pairs of distinct fingerprints within the radius; their closure holds every such pair."""
    if radius < 0 or radius % 2:
        raise ValueError("the radius is even: only then is every bucket within the radius of itself")
    distinct = prints.select("fingerprint").distinct()
    masks = F.lit(ball(radius // 2)).cast("array<long>")
    variants = distinct.select(
        "fingerprint", F.explode(F.transform(masks, lambda m: F.col("fingerprint").bitwiseXOR(m))).alias("variant")
    )
    smallest = F.min("fingerprint").over(Window.partitionBy("variant"))
    pairs = variants.select(F.col("fingerprint").alias("a"), smallest.alias("b")).where("a <> b").distinct()
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def _rooted(prints: DataFrame, radius: int) -> DataFrame:
    """The smallest fingerprint reachable from each row's own as `root`."""
    roots = components(links(prints, radius), "a", "b", "simhash")
    return prints.join(roots.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").withColumn(
        "root", F.coalesce("root", "fingerprint")
    )


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (long) and component_id, the smallest doc_id of the documents reachable by links."""
    rooted = _rooted(stage(fingerprints(documents, shingle), "simhash-prints"), radius)
    lowest = rooted.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    return rooted.join(lowest, "root").select("doc_id", "fingerprint", "component_id")


def one_of_each(documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The documents of which each component keeps the one with the smallest id, with all their columns.

    A row is known by the hash of its id and text, so that rows which share an id but not a text are judged apart;
    repeated rows are one document and stay together. Rows without an id stay only where their whole component has
    none, the one of smallest hash. The names of the rows that go are broadcast if they are few, so that no text is
    shuffled; otherwise they are joined by a shuffle.
    """
    row = fresh("_row", documents.columns)
    named = documents.withColumn(row, F.xxhash64("doc_id", "text"))
    rooted = stage(_rooted(stage(fingerprints(named, shingle, row), "simhash-prints"), radius), "simhash-rooted")
    first = rooted.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", row))[row].alias("first"))
    gone = rooted.join(first, "root").where(F.col(row) != F.col("first")).select(row).distinct()
    return named.join(small_side(gone, MAX_BROADCAST), row, "left_anti").select(*documents.columns)


def hexadecimal(column: str) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))
