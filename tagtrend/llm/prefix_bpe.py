"""Byte-level BPE by dynamic programming over prefixes.

Every prefix of a byte string has exactly one last token in its BPE encoding, so one token per prefix is the whole
state: token t may end a prefix if it fits after the last token of what precedes it. `PrefixTable` keeps that array;
appending bytes extends it and never changes it, and an edit recomputes from the edited byte until the table falls
in step with the old one again. Two tokens fit if merging their bytes by rank would keep the seam between them, which
is decided by walking down the merges that made them.

Texts are cut by the pattern first. In a text whose only white space is space and newline the cut never joins what
stands on both sides of a word's end, so each distinct "white space and word" of a slice is cut once, all of them in one
search. The tables of all short pieces of a slice grow together, prefix length by prefix length, as arrays; long pieces
grow one by one. Pieces used of late are kept per worker.

Defined results: null is the empty text (no tokens); repeated rows and null ids pass through; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagtrend.llm.words import BLANK, BYTE_VALUE, Recent, bounds, bytes_of, distinct, joined, mix, slices, spread

KEPT_PIECES = 200_000
KEPT_SEAMS = 1_000_000
LONGEST_KEPT = 256
TOGETHER = 64  # bytes of a piece that grows together with others
DECODED_ROWS = 256
SLICE_BYTES = 2 << 20
_BASE, _WORD = int(mix(np.array([9], dtype=np.uint64))[0]) | 1, (1 << 64) - 1
_ID = next(c for c in "IL" if array(c).itemsize == 4)
_OTHER_SPACE = regex.compile(r"[^\S \n]")
_ASCII_SPACE = [bytes([x]) for x in (9, 11, 12, 13, 28, 29, 30, 31)]
_WIDE_SPACE = [b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a", b"\xe2\x80", b"\xe2\x81", b"\xe3\x80"]  # how the others begin in UTF-8


class Names:
    """Numbers under 64-bit keys, for arrays of keys; a bit table turns most strangers away."""

    BITS = 20

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order]
        self.known = np.zeros(1 << self.BITS, dtype=bool)
        self.known[self._slot(self.keys)] = True

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the keys are known, and their numbers."""
        maybe = np.flatnonzero(self.known[self._slot(keys)])
        at = np.searchsorted(self.keys, keys[maybe])
        right = self.keys[np.minimum(at, len(self.keys) - 1)] == keys[maybe]
        return maybe[right], self.values[at[right]]


class Vocabulary:
    """Ranks, the two parts each token was merged from, and which tokens encode as themselves."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.token = {i: t for t, i in ranks.items()}
        self.pair: dict[tuple[int, int], int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.longest = max(map(len, ranks), default=0)
        self.usable = {t: i for t, i in ranks.items() if self._learn(t, i)}
        self.known: dict[tuple[int, int], bool] = {}
        size = max(self.token, default=-1) + 1
        self.size = np.zeros(size, dtype=np.int64)
        for i, t in self.token.items():
            self.size[i] = len(t)
        self.begin = np.cumsum(self.size) - self.size
        self.bytes = np.frombuffer(b"".join(self.token.get(i, b"") for i in range(size)), dtype=np.uint8)
        self.left, self.right = np.full(size, -1, dtype=np.int64), np.full(size, -1, dtype=np.int64)
        for i, (a, b) in self.parts.items():
            self.left[i], self.right[i] = a, b
        merged = np.fromiter(self.pair.values(), dtype=np.int64, count=len(self.pair))
        self.merges = Names(_seam_key(self.left[merged], self.right[merged]), merged)
        names = np.zeros(len(self.usable), dtype=np.uint64)
        for i, t in enumerate(self.usable):
            name = 0
            for x in t:
                name = (name * _BASE + int(BYTE_VALUE[x])) & _WORD
            names[i] = name
        self.names = Names(names, np.fromiter(self.usable.values(), dtype=np.int64, count=len(names)))

    def merged(self, piece: bytes) -> list[bytes]:
        """Plain BPE: merge the leftmost pair of the lowest rank until none is left."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            rank, at = min((self.ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)))
            if rank == 1 << 60:
                break
            self._made = (parts[at], parts[at + 1])
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _learn(self, token: bytes, rank: int) -> bool:
        if len(token) > 1:
            if self.merged(token) != [token]:
                return False
            self.parts[rank] = tuple(self.ranks[p] for p in self._made)
            self.pair[self.parts[rank]] = rank
        return True

    def fits(self, seam: tuple[int, int]) -> bool:
        """Whether BPE of two tokens' bytes gives these two tokens; answers are kept."""
        if len(self.known) > KEPT_SEAMS:
            self.known.clear()
        fit = self.known[seam] = self._seam(*seam)
        return fit

    def _seam(self, left: int, right: int) -> bool:
        # Undo the later merge of the two sides, step by step; at each step the tokens at the seam stand there until
        # the rank `until`, and a merge across the seam with a lower rank would have come first. Of equal ranks the
        # merge further left comes first.
        until, pair, parts = 1 << 60, self.pair, self.parts
        while True:
            across = pair.get((left, right))
            if across is not None and across < until:
                return False
            a = parts.get(left)
            if a is None or left <= right:
                b = parts.get(right)
                if b is not None:
                    until, right = right + 1, b[0]
                    continue
                if a is None:
                    return True
            until, left = left, a[1]

    def all_fit(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """`fits` of many seams."""
        fit, live = np.ones(len(left), dtype=bool), np.arange(len(left))
        until = np.full(len(left), 1 << 60)
        while len(live):
            stay = np.ones(len(live), dtype=bool)
            at, across = self.merges.find(_seam_key(left, right))
            early = at[across < until[at]]
            fit[live[early]] = stay[early] = False
            inner, outer = self.right[left], self.left[right]
            stay &= (inner >= 0) | (outer >= 0)
            second = (outer >= 0) & ((inner < 0) | (left <= right))
            until, left, right = np.where(second, right + 1, left), np.where(second, left, inner), np.where(second, outer, right)
            live, until, left, right = live[stay], until[stay], left[stay], right[stay]
        return fit


def _seam_key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)


def last_tokens(v: Vocabulary, data: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The last token of every prefix of the pieces data[first[i]:first[i + 1]], all lengths of prefix in turn."""
    if not len(data):
        return np.zeros(0, dtype=np.int64)
    begin, end = np.repeat(first[:-1], np.diff(first)), np.repeat(first[1:], np.diff(first))
    values, live = BYTE_VALUE[data], np.arange(len(data))
    name = np.zeros(len(data), dtype=np.uint64)
    found = []
    for length in range(1, min(v.longest, int(np.diff(first).max(initial=0))) + 1):
        stays = live + length <= end[live]
        live, name = live[stays], name[stays]
        name = name * np.uint64(_BASE) + values[live + length - 1]
        at, token = v.names.find(name)
        found.append((live[at], live[at] + length, token))
    start, stop, token = (np.concatenate(x) for x in zip(*found, strict=True))
    size = stop - begin[start]
    order = np.argsort(size, kind="stable")
    start, stop, token = start[order], stop[order], token[order]
    cuts = np.searchsorted(size[order], np.arange(1, int(size.max(initial=0)) + 2))
    last = np.full(len(data), -1, dtype=np.int64)
    for a, b in zip(cuts, cuts[1:], strict=False):
        s, e, t = start[a:b], stop[a:b], token[a:b]
        whole = s == begin[s]
        last[e[whole] - 1] = t[whole]
        # a prefix that is a token by itself needs no other candidate
        rest = np.flatnonzero(last[e - 1] < 0)
        rest = rest[v.all_fit(last[s[rest] - 1], t[rest])]
        last[e[rest] - 1] = t[rest]
    if last.min() < 0:
        raise ValueError("the vocabulary lacks a byte")
    return last


def tokens_of(v: Vocabulary, data: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of the pieces, one after the other, and how many each has, read backwards from their tables."""
    last, count = last_tokens(v, data, first), np.zeros(len(first) - 1, dtype=np.int64)
    live, at, steps = np.arange(len(count)), first[1:], []
    while True:
        more = at > first[live]
        live, at = live[more], at[more]
        if not len(live):
            break
        token = last[at - 1]
        steps.append((live, count[live], token))
        count[live] += 1
        at = at - v.size[token]
    ends = np.cumsum(count)
    out = np.zeros(int(count.sum()), dtype="<u4")
    for piece, behind, token in steps:
        out[ends[piece] - 1 - behind] = token
    return out, count


class PrefixTable:
    """The last token of every prefix of a growing or edited byte string (one piece of the pattern)."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary, self.data, self.last = vocabulary, b"", []
        self.append(data)

    def _grow(self, end: int) -> None:
        """Add the tokens that end the prefixes up to data[:end]; of those that fit there is one per prefix."""
        v, data, last = self.vocabulary, self.data, self.last
        usable, known, fits, longest = v.usable, v.known, v.fits, v.longest
        for stop in range(len(last) + 1, end + 1):
            for start in range(max(0, stop - longest), stop):
                token = usable.get(data[start:stop])
                if token is not None:
                    if not start:
                        break
                    seam = (last[start - 1], token)
                    fit = known.get(seam)
                    if fit or (fit is None and fits(seam)):
                        break
            else:
                raise ValueError("the vocabulary lacks a byte")
            last.append(token)

    def append(self, more: bytes) -> None:
        self.data += more
        self._grow(len(self.data))

    def splice(self, start: int, stop: int, new: bytes) -> int:
        """Replace data[start:stop]; returns how many prefixes were computed anew.

        Past the edit a prefix depends on the table entries at most one longest token back, so once that many entries
        in a row equal the old ones the rest of the old table holds.
        """
        old = self.last
        self.data = self.data[:start] + new + self.data[stop:]
        self.last = old[:start]
        shift, same, reach = len(new) - (stop - start), 0, self.vocabulary.longest
        for end in range(start + 1, len(self.data) + 1):
            self._grow(end)
            past = end - start - len(new)
            if past > 0:
                same = same + 1 if old[end - 1 - shift] == self.last[-1] else 0
                if same >= reach and past >= reach:
                    self.last.extend(old[end - shift :])
                    return end - start
        return len(self.data) - start

    def tokens(self) -> list[int]:
        out, end = [], len(self.data)
        while end:
            out.append(self.last[end - 1])
            end -= len(self.vocabulary.token[out[-1]])
        return out[::-1]


class Encoder:
    """Texts to ids as little-endian bytes; pieces are kept."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.pieces = vocabulary, Recent(KEPT_PIECES)

    def _pieces(self, pieces: list[bytes]) -> list[bytes]:
        """The ids of each piece: whole tokens and kept pieces, and the others by their tables."""
        v, ranks = self.vocabulary, self.vocabulary.ranks
        found = self.pieces.find_all(pieces)
        short = []
        for i, piece in enumerate(pieces):
            if found[i] is None:
                whole = ranks.get(piece)
                if whole is not None:
                    found[i] = array(_ID, [whole]).tobytes()
                elif len(piece) > TOGETHER:
                    found[i] = array(_ID, PrefixTable(v, piece).tokens()).tobytes()
                    if len(piece) <= LONGEST_KEPT:
                        self.pieces.keep(piece, found[i])
                else:
                    short.append(i)
        data = b"".join([pieces[i] for i in short])
        first = np.concatenate([[0], np.cumsum([len(pieces[i]) for i in short], dtype=np.int64)])
        ids, counts = tokens_of(v, np.frombuffer(data, dtype=np.uint8), first)
        cuts, raw = (np.concatenate([[0], np.cumsum(counts)]) * 4).tolist(), ids.tobytes()
        for i, a, b in zip(short, cuts, cuts[1:], strict=False):
            found[i] = raw[a:b]
        self.pieces.keep_all([(pieces[i], found[i]) for i in short])
        return found

    def _cut(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, ...]:
        """The bytes of the units again, in another order, where units and pieces begin in them, and the order."""
        # white space in front and a word at the end: no piece reaches over the seam of two such units
        plain = ~odd & BLANK[data[starts]] & ~BLANK[data[ends - 1]]
        order = np.argsort(~plain, kind="stable")
        raw, first = joined(data, starts[order], ends[order])
        n, text = int(plain.sum()), raw.tobytes()
        cut = self.vocabulary.pattern.findall
        found = cut(text[: first[n]].decode())
        for a, b in zip(first[n:].tolist(), first[n + 1 :].tolist(), strict=False):
            found += cut(text[a:b].decode())
        _, begin = bytes_of(pa.array(found, pa.large_string()))
        return raw, first, begin, order

    def _units(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of distinct units, and how many each has."""
        raw, first, begin, order = self._cut(data, starts, ends, odd)
        one, of = distinct(raw, begin[:-1], begin[1:])
        text = raw.tobytes()
        found = self._pieces([text[a:b] for a, b in zip(begin[:-1][one].tolist(), begin[1:][one].tolist(), strict=True)])
        ids, counts = spread(found, of)
        total = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(begin, first)]
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        flat, cuts = joined(ids, total[:-1][place], total[1:][place])
        return flat, np.diff(cuts)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the texts of a slice, one after the other, and how many each text has."""
        data, offsets = bytes_of(texts.fill_null(""))
        _, ends = bounds(data, offsets)
        # a unit ends where a word ends, or with the text; all units together are the text
        ends = np.union1d(ends, offsets[1:][np.diff(offsets) > 0])
        starts = np.concatenate([[0], ends[:-1]])[: len(ends)]
        odd = np.flatnonzero([_odd(t) for t in texts.cast(pa.binary()).to_pylist()])
        if len(odd):
            text = np.searchsorted(offsets, starts, side="right") - 1
            plain = ~np.isin(text, odd)
            starts, ends = np.append(starts[plain], offsets[odd]), np.append(ends[plain], offsets[odd + 1])
            order = np.argsort(starts, kind="stable")
            starts, ends = starts[order], ends[order]
        if not len(starts):
            return np.zeros(0, dtype="<u4"), np.zeros(len(texts), dtype=np.int64)
        whole = np.isin(starts, offsets[odd])
        one, of = distinct(data, starts, ends)
        ids, counts = self._units(data, starts[one], ends[one], whole[one])
        cuts = np.cumsum(counts) - counts
        ids, first = joined(ids, cuts[of], (cuts + counts)[of])
        counts = np.diff(first)
        total = np.concatenate([[0], np.cumsum(counts)])
        return ids, np.diff(total[np.searchsorted(starts, offsets)])


def _odd(text: bytes | None) -> bool:
    """Whether a text has white space other than space and newline, which can join what it stands between."""
    if not text or not (any(x in text for x in _ASCII_SPACE) or any(x in text for x in _WIDE_SPACE)):
        return False
    return _OTHER_SPACE.search(text.decode()) is not None


@lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    """The encoder of a rank file, once per worker."""
    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return Encoder(Vocabulary(ranks, pattern))


Batches = Iterator[pa.RecordBatch]


def _encoded(batches: Batches, path: str, pattern: str) -> Batches:
    """doc_id, text -> doc_id, ids."""
    coder = encoder(path, pattern)
    for batch in slices(batches, limit=SLICE_BYTES):
        ids, counts = coder.encode(batch.column("text"))
        ends = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.view("<i4")))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "ids"])


def _decoded(batches: Batches, path: str, pattern: str) -> Batches:
    """doc_id, ids -> doc_id, ids, bytes."""
    v = encoder(path, pattern).vocabulary
    for batch in batches:
        for i in range(0, batch.num_rows, DECODED_ROWS):
            part = batch.slice(i, DECODED_ROWS)
            lists = part.column("ids")
            counts = lists.value_lengths().fill_null(0).to_numpy()
            ids = lists.flatten().to_numpy().astype(np.int64)
            size = v.size[ids]
            ends = np.cumsum(size)
            at = np.arange(int(size.sum())) + np.repeat(v.begin[ids] - (ends - size), size)
            cuts = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(counts)])].astype(np.int32)
            data = [None, pa.py_buffer(cuts.tobytes()), pa.py_buffer(v.bytes[at].tobytes())]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), lists, pa.Array.from_buffers(pa.binary(), part.num_rows, data)], names=["doc_id", "ids", "bytes"]
            )


def _digested(batches: Batches) -> Batches:
    for batch in batches:
        lists = batch.column("ids")
        data, ends = lists.flatten().to_numpy().astype("<i4"), np.cumsum([0, *lists.value_lengths().to_pylist()])
        ids = [hashlib.sha256(data[a:b].tobytes()).hexdigest() for a, b in zip(ends, ends[1:], strict=False)]
        texts = [hashlib.sha256(x).hexdigest() for x in batch.column("bytes").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(np.diff(ends), pa.int64()), pa.array(ids, pa.string()), pa.array(texts, pa.string())],
            names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
        )


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def encode(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id and ids (array of int) of every row; `path` is the rank file, readable by every executor."""
    return _texts(documents).mapInArrow(lambda x: _encoded(x, path, pattern), "doc_id long, ids array<int>")


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, ids and the bytes that the ids stand for; a null list gives no bytes."""
    return tokens.select("doc_id", "ids").mapInArrow(lambda x: _decoded(x, path, pattern), "doc_id long, ids array<int>, bytes binary")


def round_trip(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """`decode` of `encode` in one pass of the tasks: doc_id, ids, bytes."""
    return _texts(documents).mapInArrow(
        lambda x: _decoded(_encoded(x, path, pattern), path, pattern), "doc_id long, ids array<int>, bytes binary"
    )


def digests(documents: DataFrame, path: str, pattern: str) -> DataFrame:
    """Per document of `round_trip`: the number of ids, and the SHA-256 of them (little-endian unsigned 32-bit) and of
    the decoded bytes. Only the digests leave the task."""
    return _texts(documents).mapInArrow(
        lambda x: _digested(_decoded(_encoded(x, path, pattern), path, pattern)),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string",
    )
