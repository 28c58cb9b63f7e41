"""Word sequences that occur in several documents: the steps that suffix and recompression dedup share.

An operator supplies *anchors*: every window of `width` words of a document belongs to one anchor, whose key depends
on the words of the window alone, so that equal windows have equal keys. Sorting by key brings documents that may
share a window together; only their windows are then named by content and compared.

Nothing is gathered: the sort is ranged by (key, text, document), so a key of any size is spread over tasks, exact
copies of a text take part once, and the windows meet in an aggregate with map-side combining and a join that
adaptive execution can split. Texts are shuffled once, by document; both uses read that shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagtrend.llm.store import shuffle_tasks, stage
from tagtrend.llm.words import Words, slices, window_hash, words_of

Anchors = Callable[[Words], tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
CHUNK_WINDOWS = 100_000


def window_starts(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which a whole window of one document starts, and each position's document."""
    doc = np.repeat(np.arange(len(words.first) - 1), words.counts)
    last = words.first[1:][doc] - width
    return np.flatnonzero(np.arange(len(doc)) <= last), doc


def _anchor_rows(find: Anchors) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in slices(batches):
            words = words_of(batch.column("text"))
            key, doc, start, n = find(words)
            if len(key):
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key.view(np.int64)),
                        batch.column("copy").take(pa.array(doc)),
                        batch.column("doc_id").take(pa.array(doc)),
                        pa.array((start - words.first[doc]).astype(np.int32)),
                        pa.array(n.astype(np.int32)),
                    ],
                    names=["key", "copy", "doc_id", "start", "n"],
                )

    return run


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by (key, copy, doc_id): those of the first document of each text, where another text has the
    key as well. A key that reaches the border of the task counts as shared, which only adds work later."""
    held: list[pa.RecordBatch] = []
    last: tuple[int, int, int] | None = None  # key, text and document in hand
    border, shared = True, True
    for batch in batches:
        if not batch.num_rows:
            continue
        key, copy, doc = (batch.column(i).to_numpy() for i in range(3))
        n = len(key)
        new_key = np.ones(n, dtype=bool)
        new_key[1:] = key[1:] != key[:-1]
        new_text = new_key.copy()
        new_text[1:] |= copy[1:] != copy[:-1]
        if last is not None:
            new_key[0] = key[0] != last[0]
            new_text[0] = new_key[0] or copy[0] != last[1]
        else:
            new_key[0] = new_text[0] = True
        # the first document of the text each row belongs to
        at = np.maximum.accumulate(np.where(new_text, np.arange(n), -1))
        own_doc = np.where(at >= 0, doc[np.maximum(at, 0)], last[2] if last else 0)
        keep = doc == own_doc
        group = np.cumsum(new_key)  # 0: the key in hand
        two = np.zeros(group[-1] + 1, dtype=bool)
        two[group[new_text & ~new_key]] = True
        if last is None:
            two[group[0]] = True
        elif shared:
            two[0] = True
        if group[0] == 0 and held and two[0]:
            yield from held
            held = []
        elif held and group[-1] > 0:
            held = []
        closed = two[group] & keep
        tail = (group == group[-1]) & keep & ~two[group]
        if closed.any():
            yield batch.filter(pa.array(closed))
        if tail.any():
            held = (held if group[-1] == 0 else []) + [batch.filter(pa.array(tail))]
        shared = bool(two[-1])
        last = (int(key[-1]), int(copy[-1]), int(own_doc[-1]))
    yield from held  # the last key of the task


def _window_rows(width: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Documents with spans -> one row per document and distinct window in its spans: two names by content."""
    def run(batches):
        for batch in slices(batches):
            words = words_of(batch.column("text"))
            if len(words.names) < width:
                continue
            spans = batch.column("spans")
            of = np.repeat(np.arange(batch.num_rows), spans.value_lengths().to_numpy())
            flat = spans.flatten()
            begin = flat.field("start").to_numpy().astype(np.int64) + words.first[of]
            n = flat.field("n").to_numpy().astype(np.int64)
            at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin, n)
            doc = np.repeat(of, n)
            whole = at + width <= words.first[1:][doc]
            at, doc = at[whole], doc[whole]
            if not len(at):
                continue
            one, two = window_hash(words.names, width, 0)[at], window_hash(words.names, width, 1)[at]
            order = np.lexsort((one, doc))
            new = np.ones(len(order), dtype=bool)
            new[1:] = (np.diff(one[order]) != 0) | (np.diff(doc[order]) != 0)
            keep = order[new]
            for i in range(0, len(keep), CHUNK_WINDOWS):
                j = keep[i : i + CHUNK_WINDOWS]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(one[j].view(np.int64)), pa.array((two[j] >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                        batch.column("doc_id").take(pa.array(doc[j])),
                    ],
                    names=["one", "two", "doc_id"],
                )

    return run


def _cover(width: int, carry: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Documents with the names of their repeated windows -> what is left of each."""
    def run(batches):
        for batch in slices(batches):
            texts = batch.column("text").fill_null("")
            words = words_of(texts)
            repeated = batch.column("repeated")
            hashes = window_hash(words.names, width, 0) if repeated.null_count < len(repeated) else None
            out = {"n_removed": [], "kept_sha256": [], "spans": [], "kept": []}
            rows = zip(texts.cast(pa.binary()).to_pylist(), batch.column("is_copy").to_pylist(), repeated, strict=True)
            for i, (text, copy, names) in enumerate(rows):
                part = words.text(i)
                n, gone = part.stop - part.start, None
                if copy and n >= width:
                    gone = np.ones(n, dtype=bool)
                elif names.is_valid and n >= width:
                    hit = np.isin(hashes[part.start : part.stop - width + 1], names.values.to_numpy().view(np.uint64))
                    gone = np.convolve(hit, np.ones(width, dtype=np.int64)) > 0
                if gone is None or not gone.any():
                    spans, kept, left, removed = [], text, text.split(), 0
                else:
                    edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8))).reshape(-1, 2)
                    spans, removed = edges.tolist(), int(gone.sum())
                    left = list(compress(text.split(), (~gone).tolist()))
                    # the bytes of a span go, those around it stay
                    zero = words.starts[part.start] - (len(text) - len(text.lstrip()))
                    cuts = [0]
                    for a, b in spans:
                        cuts += [int(words.starts[part.start + a] - zero), int(words.ends[part.start + b - 1] - zero)]
                    cuts.append(len(text))
                    kept = b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2], strict=True))
                out["n_removed"].append(removed)
                out["kept_sha256"].append(hashlib.sha256(b" ".join(left)).hexdigest())
                out["spans"].append([{"first": a, "last": b} for a, b in spans])
                out["kept"].append(kept.decode())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(words.counts, pa.int64()), pa.array(out["n_removed"], pa.int64()),
                    pa.array(out["kept_sha256"], pa.string()), pa.array(out["spans"], _SPANS), pa.array(out["kept"], pa.string()),
                    *(batch.column(c) for c in carry),
                ],
                names=["doc_id", "n_words", "n_removed", "kept_sha256", "spans", "kept", *carry],
            )

    return run


_SPANS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
REMOVED = "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<struct<first:int,last:int>>, kept string"
ANCHOR = "key long, copy long, doc_id long, start int, n int"


def repeated_spans(documents: DataFrame, find: Anchors, width: int, name: str, carry: Sequence[str] = ()) -> DataFrame:
    """Per document: its words, those covered by a window that also starts in a document with a smaller doc_id, the
    spans [first, last) they form, the text without them and the digest of its words; and the columns in `carry`."""
    spark = documents.sparkSession
    tasks, carried = shuffle_tasks(spark), {f"_c{i}": c for i, c in enumerate(carry)}
    source = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        *[F.col(c).alias(k) for k, c in carried.items()],
    )
    rows = source.where(F.col("doc_id").isNotNull())
    anchors = rows.select("doc_id", "text", F.xxhash64("text").alias("copy")).mapInArrow(_anchor_rows(find), ANCHOR)
    ranged = anchors.repartitionByRange(tasks, "key", "copy", "doc_id").sortWithinPartitions("key", "copy", "doc_id")
    near = ranged.mapInArrow(_neighbours, ANCHOR)
    spans = stage(near.groupBy("doc_id").agg(F.collect_list(F.struct("start", "n")).alias("spans")), f"{name}-spans")

    by_doc = rows.repartition(tasks, "doc_id")
    windows = by_doc.join(spans.hint("shuffle_hash"), "doc_id").mapInArrow(_window_rows(width), "one long, two int, doc_id long")
    lowest = windows.groupBy("one", "two").agg(F.min("doc_id").alias("lowest"), F.max("doc_id").alias("highest"))
    # written, so that the join below stands on two plain shuffles, whose large partitions can be split
    shared = stage(lowest.where("lowest < highest").drop("highest"), f"{name}-shared")
    again = windows.join(shared, ["one", "two"]).where("doc_id > lowest")
    repeated = again.groupBy("doc_id").agg(F.collect_list("one").alias("repeated"))
    digests = rows.select("doc_id", F.md5("text").alias("digest"))
    first = digests.groupBy("digest").agg(F.min("doc_id").alias("first"))
    copies = digests.join(first, "digest").where("doc_id > first").select("doc_id").distinct().withColumn("is_copy", F.lit(True))
    marks = repeated.join(copies, "doc_id", "full_outer")
    columns = ["doc_id", "text", *carried]
    known = by_doc.join(marks, "doc_id", "left").select(*columns, F.coalesce("is_copy", F.lit(False)).alias("is_copy"), "repeated")
    unknown = source.where(F.col("doc_id").isNull()).select(
        *columns, F.lit(False).alias("is_copy"), F.lit(None).cast("array<long>").alias("repeated")
    )
    kinds = {f.name: f.dataType.simpleString() for f in source.schema}
    schema = ", ".join([REMOVED, *(f"{k} {kinds[k]}" for k in carried)])
    found = known.unionByName(unknown).mapInArrow(_cover(width, list(carried)), schema)
    return found.select(*REMOVED_COLUMNS, *[F.col(k).alias(c) for k, c in carried.items()])


REMOVED_COLUMNS = ["doc_id", "n_words", "n_removed", "kept_sha256", "spans", "kept"]


def without_repeats(documents: DataFrame, find: Anchors, width: int, name: str) -> DataFrame:
    """The documents with the repeated words cut out of their texts, all columns kept; a document of which nothing is
    left goes, one that had no word before stays."""
    other = [c for c in documents.columns if c not in ("doc_id", "text")]
    named = documents.select("doc_id", "text", F.struct(*other).alias("_other") if other else F.lit(None).cast("int").alias("_other"))
    left = repeated_spans(named, find, width, name, ["_other"]).where("n_removed < n_words OR n_words = 0")
    found = {"doc_id": F.col("doc_id"), "text": F.col("kept").alias("text")}
    return left.select(*[found.get(c, F.col("_other").getField(c).alias(c)) for c in documents.columns])
