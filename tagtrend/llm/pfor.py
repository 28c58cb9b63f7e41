"""Token ids in patched frame-of-reference blocks.

A segment holds the ids of consecutive documents. Its ids are cut into blocks; each block subtracts its minimum and
packs the differences at the width that a percentile of them needs; larger ones are patched from an exception list.
An index of block starts lets a reader decode any range of ids alone.

Segment layout, little-endian: header (ids u64, ids per block u32, blocks u32), then per block an index entry (offset
of its data u64, minimum u32, exceptions u32, width u32), then per block the packed differences, the exceptions'
positions (u32) and their differences (u32).

Documents are ranged by doc_id, so the segments in order hold the ids in ascending doc_id order; a task never holds
more than one segment and one slice of texts. The segments are rows of a Parquet table in the shared folder, written
under Spark's commit protocol, so a lost executor leaves no half file.

Defined results: null text is empty and gets the end id alone; rows with equal ids stand in the order of their text;
null ids come first; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagtrend.llm.store import PACKED, shuffle_tasks, stage
from tagtrend.llm.words import Known, Recent, bounds, bytes_of, distinct, flat, joined, looked_up, lowered, sixteen, slices, spans

BLOCK = 512
PERCENTILE = 95.0
SEGMENT_IDS = 1 << 18
KEPT_WORDS = 1 << 20
KEPT_PARTS = 250_000
LONGEST_KEPT = 256
CALL_PARTS = 20_000
SLICE_BYTES = 4 << 20
_HEADER = np.dtype([("ids", "<u8"), ("block", "<u4"), ("blocks", "<u4")])
_ENTRY = np.dtype([("offset", "<u8"), ("low", "<u4"), ("patches", "<u4"), ("width", "<u4")])
_PRINTABLE, _CLOSED = re.compile(rb"[!-~]+"), re.compile(rb"[A-Za-z]+|[0-9]|[^A-Za-z0-9]+")
# the character by which a byte-level model names each byte; the space here parts the words
_CHARACTER = np.arange(256, dtype="<u4")
_UNNAMED = [*range(33), *range(127, 161), 173]
_CHARACTER[_UNNAMED] = 256 + np.arange(len(_UNNAMED))
_CHARACTER[32] = 32
_MARK = np.zeros(256, dtype=bool)
for _a, _b in ((33, 48), (58, 65), (91, 97), (123, 127)):
    _MARK[_a:_b] = True


def _planes(rows: np.ndarray) -> np.ndarray:
    """The columns of a table by their number modulo eight, each class one after the other; zeros fill it up."""
    padded = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), dtype=rows.dtype)
    padded[:, : rows.shape[1]] = rows
    return np.ascontiguousarray(padded.reshape(-1, 8).T)


def _packed(rows: np.ndarray, width: int) -> np.ndarray:
    """Rows of numbers as rows of bytes, `width` bits a number from the lowest on: eight numbers fill `width` bytes."""
    numbers = _planes(rows)
    out = np.zeros((width, numbers.shape[1]), dtype=np.uint8)
    for b in range(width):
        for i in range(8 * b // width, (8 * b + 7) // width + 1):
            shift = i * width - 8 * b
            out[b] |= (numbers[i] << np.uint32(shift) if shift > 0 else numbers[i] >> np.uint32(-shift)).astype(np.uint8)
    return out.T.reshape(len(rows), -1)[:, : -(-rows.shape[1] * width // 8)]


def _unpacked(body: np.ndarray, block: int, width: int) -> np.ndarray:
    """The numbers of rows that `_packed` made."""
    padded = np.zeros((len(body), -(-block // 8) * width), dtype=np.uint8)
    padded[:, : body.shape[1]] = body
    data = np.ascontiguousarray(padded.reshape(-1, width).T).astype(np.uint32)
    out = np.zeros((8, data.shape[1]), dtype=np.uint32)
    for i in range(8):
        for b in range(i * width // 8, (i * width + width - 1) // 8 + 1):
            shift = 8 * b - i * width
            out[i] |= data[b] << np.uint32(shift) if shift > 0 else data[b] >> np.uint32(-shift)
    return (out & np.uint32((1 << width) - 1)).T.reshape(len(body), -1)[:, :block]


def pack(ids: np.ndarray, block: int = BLOCK, percentile: float = PERCENTILE) -> bytes:
    """One segment."""
    n, blocks = len(ids), -(-len(ids) // block)
    grid = np.zeros(blocks * block, dtype=np.uint32)
    grid[:n] = ids
    if n:
        grid[n:] = ids[-1]
    grid = grid.reshape(blocks, block)
    low = grid.min(axis=1) if blocks else np.zeros(0, dtype=np.uint32)
    deltas = grid - low[:, None]
    rank = math.ceil((block - 1) * percentile / 100)
    cut = np.partition(deltas, rank, axis=1)[:, rank]
    width = np.frexp(cut.astype(np.float64))[1].astype(np.uint32)
    over = deltas > ((np.uint64(1) << width.astype(np.uint64)) - np.uint64(1)).astype(np.uint32)[:, None]
    index = np.zeros(blocks, dtype=_ENTRY)
    index["low"], index["width"], index["patches"] = low, width, over.sum(axis=1)
    packed: list[bytes] = [b""] * blocks
    for w in np.unique(width):
        rows = np.flatnonzero(width == w)
        if w:
            small = deltas[rows] & np.uint32((1 << int(w)) - 1)
            for r, data in zip(rows, _packed(small, int(w)), strict=True):
                packed[r] = data.tobytes()
    patches, values = np.nonzero(over)[1].astype("<u4").tobytes(), deltas[over].astype("<u4").tobytes()
    ends = np.cumsum(index["patches"], dtype=np.int64) * 4
    sizes = -(-block * width.astype(np.int64) // 8) + 8 * index["patches"].astype(np.int64)
    index["offset"] = _HEADER.itemsize + index.nbytes + np.cumsum(sizes) - sizes
    parts, a = [], 0
    for body, b in zip(packed, ends.tolist(), strict=True):
        parts += [body, patches[a:b], values[a:b]]
        a = b
    return np.array([(n, block, blocks)], dtype=_HEADER).tobytes() + index.tobytes() + b"".join(parts)


def unpack(segment: bytes, start: int = 0, stop: int | None = None) -> np.ndarray:
    """The ids [start, stop) of a segment; only the blocks that hold them are read."""
    head = np.frombuffer(segment, dtype=_HEADER, count=1)[0]
    n, block, blocks = int(head["ids"]), int(head["block"]), int(head["blocks"])
    stop = n if stop is None else min(stop, n)
    if start >= stop:
        return np.zeros(0, dtype=np.uint32)
    index = np.frombuffer(segment, dtype=_ENTRY, count=blocks, offset=_HEADER.itemsize)
    first, last = start // block, -(-stop // block)
    chosen = index[first:last]
    out = np.zeros((last - first, block), dtype=np.uint32)
    for w in np.unique(chosen["width"]):
        rows = np.flatnonzero(chosen["width"] == w)
        if w:
            size = -(-block * int(w) // 8)
            body = b"".join([segment[a : a + size] for a in chosen["offset"][rows].tolist()])
            out[rows] = _unpacked(np.frombuffer(body, dtype=np.uint8).reshape(len(rows), size), block, int(w))
    for r in np.flatnonzero(chosen["patches"]):
        e = chosen[r]
        at, k = int(e["offset"]) + -(-block * int(e["width"]) // 8), int(e["patches"])
        out[r, np.frombuffer(segment, "<u4", k, at)] = np.frombuffer(segment, "<u4", k, at + 4 * k)
    out += chosen["low"][:, None]
    return out.ravel()[start - first * block : stop - first * block]


class WordIds:
    """Texts to ids by the tokenizer. White space ends every token of this tokenizer, and so does the border between
    ASCII letters and the ASCII punctuation at a word's end, so the distinct parts of a slice's words are encoded
    together, once, and those seen before are kept: up to sixteen bytes in a table, longer ones by name."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer, self.known, self.kept = Tokenizer.from_file(path), Known(KEPT_WORDS), Recent(KEPT_PARTS)
        self.tokenize = self.tokenizer.model.tokenize
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        vocabulary = self.tokenizer.get_vocab()
        self.closing = np.zeros(max(vocabulary.values(), default=-1) + 1, dtype=bool)
        self.closing[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True

    def _letters(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words of `letters`, each with a space behind it, and how many each has. In lower case such a word is
        one piece for the tokenizer's model, so it goes there at once, its bytes written as the model names them."""
        upper = np.flatnonzero((data[:-1] == 0xC3) & (data[1:] < 0x9F)) + 1
        data[upper] += 32
        words, ids, counts = _CHARACTER[data].tobytes().decode("utf-32-le").split(" ")[:-1], [], []
        for start in range(0, len(words), CALL_PARTS):
            some = [[token.id for token in self.tokenize(w)] for w in words[start : start + CALL_PARTS]]
            counts.append(np.fromiter(map(len, some), dtype=np.int64, count=len(some)))
            ids.append(np.fromiter(chain.from_iterable(some), dtype="<u4", count=int(counts[-1].sum())))
        return np.concatenate(ids), np.concatenate(counts)

    def _plain(self, parts: list[bytes], closings: list[int]) -> list[bytes] | None:
        """The ids of parts that are known to end at their so many-th closing token; None if the numbers disagree."""
        done = self.tokenizer.encode_batch_fast([b" ".join(parts).decode()], add_special_tokens=False)[0]
        ids = np.array(done.ids, dtype="<u4")
        ends, last = np.flatnonzero(self.closing[ids]) + 1, np.cumsum(closings)
        if len(ends) != last[-1]:
            return None
        raw, cuts = ids.tobytes(), (ends[last - 1] * 4).tolist()
        return [raw[a:b] for a, b in zip([0, *cuts], cuts, strict=False)]

    def _encoded(self, parts: list[bytes]) -> list[bytes]:
        """The ids of each part: one call for all, parted by spaces, and each token given to the part it starts in."""
        texts = [p.decode() for p in parts]
        done = self.tokenizer.encode(" ".join(texts), add_special_tokens=False)
        begin = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
        owner = np.searchsorted(begin, np.array([a for a, _ in done.offsets], dtype=np.int64), side="right") - 1
        cuts = np.searchsorted(owner, np.arange(len(texts) + 1)) * 4
        raw = np.array(done.ids, dtype="<u4").tobytes()
        return [raw[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist(), strict=False)]

    def tokens(self, parts: list[bytes]) -> list[bytes]:
        """The ids of each part by the tokenizer."""
        found: list[bytes] = [b""] * len(parts)
        plain: list[tuple[int, int]] = []
        others: list[int] = []
        for i, part in enumerate(parts):
            n = 1 if part.decode().isalpha() else closings(part)
            if n:
                plain.append((i, n))
            else:
                others.append(i)
        for start in range(0, len(plain), CALL_PARTS):
            some, n = zip(*plain[start : start + CALL_PARTS], strict=True)
            texts = [parts[i] for i in some]
            _put(found, some, self._plain(texts, n) or self._encoded(texts))
        for start in range(0, len(others), CALL_PARTS):
            some = others[start : start + CALL_PARTS]
            _put(found, some, self._encoded([parts[i] for i in some]))
        return found

    def parts(self, parts: list[bytes]) -> list[bytes]:
        """The ids of each part: those kept, and the others by the tokenizer."""
        found = self.kept.find_all(parts)
        missing = [i for i, ids in enumerate(found) if ids is None]
        texts = [parts[i] for i in missing]
        ids = self.tokens(texts)
        _put(found, missing, ids)
        self.kept.keep_all([(t, x) for t, x in zip(texts, ids, strict=True) if len(t) <= LONGEST_KEPT])
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts of a slice, one after the other, and how many each text has."""
        data, offsets = bytes_of(texts.fill_null(""))
        data, starts, ends = word_parts(data, *bounds(data, offsets))
        size = ends - starts
        low, high = sixteen(data, starts, size)
        entry = self.known.find(low, high, size)
        new, long = np.flatnonzero((entry == 0) & (size <= 16)), np.flatnonzero(size > 16)
        if len(new):
            first, of = distinct(data, starts[new], ends[new])
            one = new[first]
            words, plain = letters(data, starts[one], ends[one])
            number = np.empty(len(one), dtype=np.int64)
            if len(words):
                some = one[plain]
                number[plain] = self.known.add(low[some], high[some], size[some], *self._letters(words))
            if len(rest := one[~plain]):
                found = self.tokens(spans(data, starts[rest], ends[rest]))
                number[~plain] = self.known.add(low[rest], high[rest], size[rest], *flat(found))
            entry[new] = number[of]
        ids, counts = self.known.ids_of(entry)
        if len(long):  # these have no entry, and no ids so far
            before = np.cumsum(counts)[long]
            more, counts[long] = looked_up(data, starts[long], ends[long], self.parts)
            ids = np.insert(ids, np.repeat(before, counts[long]), more)
        total = np.concatenate([[0], np.cumsum(counts)])
        return ids, np.diff(total[np.searchsorted(starts, offsets)])


def _put(found: list, some: Sequence[int], ids: list[bytes]) -> None:
    for i, one in zip(some, ids, strict=True):
        found[i] = one


def letters(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The words that consist of lower-case ASCII letters and Latin-1 letters, each with a space behind it, and which of
    the words these are."""
    inside, first = joined(np.append(data, np.uint8(32)), starts, ends + 1)
    inside[first[1:] - 1] = 32
    known = (inside == 32) | ((inside >= 97) & (inside <= 122))
    second = inside[1:]
    pair = (inside[:-1] == 0xC3) & (second >= 0x80) & (second != 0x97) & (second != 0xB7)
    known[:-1] |= pair
    known[1:] |= pair
    plain = np.logical_and.reduceat(known, first[:-1])
    return inside[np.repeat(plain, np.diff(first))], plain


def closings(part: bytes) -> int:
    """How many tokens of a part of printable ASCII close a word (one for each run of letters, digit and run of marks);
    0 for other parts and those that may hold a contraction or a special token."""
    if not _PRINTABLE.fullmatch(part) or b"'" in part or b"<|" in part:
        return 0
    return len(_CLOSED.findall(part))


def word_parts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words cut into their letters and their tail of marks, in lower case, which the tokenizer drops anyway; words
    that may hold a contraction, a special token or a combining mark (U+0300 to U+037F) stay whole and as written: some
    marks join a small letter and not the capital, and the tokenizer joins them before it lowers the case."""
    if not len(starts):
        return data, starts, ends
    special = (data == 39) | (data & np.uint8(0xFE) == 0xCC)
    special[:-1] |= (data[:-1] == 60) & (data[1:] == 124)
    special = np.flatnonzero(special)
    owner = np.maximum(np.searchsorted(starts, special, side="right") - 1, 0)
    whole = np.zeros(len(starts), dtype=bool)
    whole[owner[(starts[owner] <= special) & (special < ends[owner])]] = True
    low = lowered(data)
    for a, b in zip(starts[whole].tolist(), ends[whole].tolist(), strict=True):
        low[a:b] = data[a:b]
    # where each word's last byte that is no mark stands, or a place before the word; most tails are short
    last = ends - 1
    tail = np.flatnonzero(~whole & _MARK[data[last]])
    for _ in range(4):
        last[tail] -= 1
        tail = tail[last[tail] >= starts[tail]]
        tail = tail[_MARK[data[last[tail]]]]
    if len(tail):
        solid = np.concatenate([[-1], np.flatnonzero(~_MARK[data])])
        last[tail] = solid[np.searchsorted(solid, last[tail], side="right") - 1]
    cut = ~whole & (last >= starts) & (last < ends - 1) & (low[last] >= 97) & (low[last] <= 122)
    tails = last[cut] + 1
    at = np.arange(len(starts)) + np.cumsum(cut) - cut
    begin, end = (np.empty(len(starts) + len(tails), dtype=np.int64) for _ in range(2))
    begin[at], end[at] = starts, np.where(cut, last + 1, ends)
    begin[at[cut] + 1], end[at[cut] + 1] = tails, ends[cut]
    return low, begin, end


@lru_cache(maxsize=2)
def word_ids(path: str) -> WordIds:
    return WordIds(path)


_DOCS = pa.list_(pa.struct([("doc_id", pa.int64()), ("start", pa.int64()), ("n", pa.int64())]))
SEGMENT = "task int, number int, first long, ids long, docs array<struct<doc_id:long,start:long,n:long>>, payload binary"


def _segments(path: str, end_id: int, segment_ids: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, task = word_ids(path), TaskContext.get().partitionId()
        end = np.array([end_id], dtype="<u4").tobytes()
        docs, parts, held, number, first = [], [], 0, 0, 0

        def flush():
            payload = pack(np.frombuffer(b"".join(parts), dtype="<u4"))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([task], pa.int32()), pa.array([number], pa.int32()), pa.array([first], pa.int64()),
                    pa.array([held], pa.int64()), pa.array([docs], _DOCS), pa.array([payload], pa.binary()),
                ],
                names=["task", "number", "first", "ids", "docs", "payload"],
            )

        for batch in slices(batches, limit=SLICE_BYTES):
            ids, counts = coder.encode(batch.column("text"))
            cuts = np.concatenate([[0], np.cumsum(counts)]).tolist()
            for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), cuts, cuts[1:], strict=False):
                docs.append({"doc_id": doc_id, "start": held, "n": b - a + 1})
                parts += [ids[a:b].tobytes(), end]
                held += b - a + 1
                if held >= segment_ids:
                    yield flush()
                    first, number = first + held, number + 1
                    docs, parts, held = [], [], 0
        if docs:
            yield flush()

    return run


def write_segments(documents: DataFrame, path: str, end_id: int = 1, segment_ids: int = SEGMENT_IDS) -> DataFrame:
    """Encode every text, append `end_id`, and write the segments in ascending doc_id order; `path` names the
    tokenizer's file. `first` becomes the number of ids before the segment."""
    spark = documents.sparkSession
    narrow = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ordered = narrow.repartitionByRange(shuffle_tasks(spark), "doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", "text")
    written = stage(ordered.mapInArrow(_segments(path, end_id, segment_ids), SEGMENT), "pfor-segments", **PACKED)
    # one row per task: their running total is small, and it is joined to the segments, not computed over them
    sizes = written.groupBy("task").agg(F.sum("ids").alias("size"))
    before = sizes.select("task", (F.sum("size").over(Window.orderBy("task")) - F.col("size")).alias("before"))
    return written.join(F.broadcast(before), "task").withColumn("first", F.col("first") + F.col("before")).drop("before")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            one = batch.slice(row, 1)
            docs, first = one.column("docs").flatten(), one.column("first")[0].as_py()
            ids = unpack(one.column("payload")[0].as_py())
            ends = np.concatenate([[0], np.cumsum(docs.field("n").to_numpy())]).astype(np.int32)
            for i in range(0, len(docs), 1024):
                part = docs.slice(i, 1024)
                cuts = ends[i : i + len(part) + 1]
                lists = pa.ListArray.from_arrays(pa.array(cuts - cuts[0]), pa.array(ids[cuts[0] : cuts[-1]].view(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [part.field("doc_id"), pa.array(part.field("start").to_numpy() + first), lists], names=["doc_id", "start", "ids"]
                )


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in _read(batches):
        lists = batch.column("ids")
        data, ends = lists.flatten().to_numpy().astype("<i4"), np.cumsum([0, *lists.value_lengths().to_pylist()])
        crc = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(ends, ends[1:], strict=False)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("start"), pa.array(np.diff(ends), pa.int64()), pa.array(crc, pa.int64())],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )


def read_documents(segments: DataFrame) -> DataFrame:
    """doc_id, start and ids (array of int) of every document in the segments."""
    return segments.select("first", "docs", "payload").mapInArrow(_read, "doc_id long, start long, ids array<int>")


def digests(segments: DataFrame) -> DataFrame:
    """Per document read from the segments: its ids' number and their CRC-32 as little-endian unsigned 32-bit integers."""
    return segments.select("first", "docs", "payload").mapInArrow(_digested, "doc_id long, start long, n_tokens long, ids_crc32 long")
