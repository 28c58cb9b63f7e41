"""Words of many texts as flat numpy arrays: byte spans, 64-bit names, rolling window hashes.

A word is a maximal run of bytes other than space and 09-0D. Everything works on slices of a bounded number of
bytes, so that a task holds a few tens of megabytes however large its partition is; a single text has to fit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
SLICE_ROWS = 4096
BLANK = np.zeros(256, dtype=bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_RANDOM = np.random.Generator(np.random.PCG64(20011))
BYTE_VALUE = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
BASES = tuple(int(x) | 5 for x in _RANDOM.integers(2**62, 2**63, 3, dtype=np.uint64))
_MASK = (1 << 64) - 1


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective 64-bit finaliser (splitmix64) of a uint64 array."""
    x = x + np.uint64((seed * 0x9E3779B97F4A7C15 + 0x9E3779B97F4A7C15) & _MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=16)
def _steps(base: int, stride: int, size: int) -> np.ndarray:
    out = np.full(size, pow(base, stride, 1 << 64), dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(base: int, at: np.ndarray) -> np.ndarray:
    """base ** at modulo 2^64, from two short tables."""
    high = at >> 12
    size = 256
    while len(high) and size <= high.max():
        size *= 4
    return _steps(base, 1 << 12, size)[high] * _steps(base, 1, 1 << 12)[at & 4095]


def span_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, which: int = 0) -> np.ndarray:
    """Karp-Rabin hash (base odd, modulo 2^64) of values[start:end] for many spans, by one prefix sum."""
    base = BASES[which]
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    for i in range(0, len(values), 1 << 16):
        part = values[i : i + (1 << 16)]
        np.cumsum(part * powers(base, np.arange(i, i + len(part))), out=total[i + 1 : i + 1 + len(part)])
        total[i + 1 : i + 1 + len(part)] += total[i]
    return mix((total[ends] - total[starts]) * powers(pow(base, -1, 1 << 64), starts), which)


def window_hash(values: np.ndarray, width: int, which: int = 0) -> np.ndarray:
    """Hash of every run of `width` consecutive values, one per start."""
    starts = np.arange(max(0, len(values) - width + 1))
    return span_hash(values, starts, starts + width, which)


@dataclass
class Words:
    """Words of consecutive texts; the words of text i are those from first[i] to first[i + 1]."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    names: np.ndarray
    first: np.ndarray

    def text(self, i: int) -> slice:
        return slice(int(self.first[i]), int(self.first[i + 1]))

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column without nulls, and where each text begins."""
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of consecutive texts begin and end."""
    solid = np.zeros(len(data) + 2, dtype=bool)
    np.logical_and(data != 32, data - np.uint8(9) > 4, out=solid[1:-1])
    begin = solid[1:-1] & ~solid[:-2]
    end = solid[1:-1] & ~solid[2:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    begin[inner] |= solid[1:-1][inner]
    end[inner - 1] |= solid[1:-1][inner - 1]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    """Split a slice of texts (null: no words) and name each word by its bytes."""
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if not len(texts):
        none = np.zeros(0, dtype=np.int64)
        return Words(np.zeros(0, dtype=np.uint8), none, none, none.astype(np.uint64), np.zeros(1, dtype=np.int64))
    data, offsets = bytes_of(texts)
    if lower:
        data = LOWER[data]
    starts, ends = bounds(data, offsets)
    names = span_hash(BYTE_VALUE[data], starts, ends)
    return Words(data, starts, ends, names, np.searchsorted(starts, offsets))


def joined(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The spans of an array one after the other, and where each begins (one more: the end)."""
    size = ends - starts
    first = np.concatenate([[0], np.cumsum(size)])
    return values[np.arange(int(first[-1])) + np.repeat(starts - first[:-1], size)], first


def lowered(data: np.ndarray) -> np.ndarray:
    """The bytes with A-Z in lower case."""
    return data | ((data - np.uint8(65) < 26).view(np.uint8) << np.uint8(5))


def sixteen(data: np.ndarray, starts: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first eight bytes of each span and the next eight as numbers, zero behind its end."""
    room = np.zeros(len(data) // 8 + 4, dtype="<u8")
    room.view(np.uint8)[: len(data)] = data
    mask = np.append((np.uint64(1) << np.arange(0, 64, 8, dtype=np.uint64)) - np.uint64(1), np.uint64(_MASK))

    def eight(starts, size):
        at, shift = starts >> 3, ((starts & 7) << 3).astype(np.uint64)
        return ((room[at] >> shift) | (room[at + 1] << np.uint64(1) << (np.uint64(63) - shift))) & mask[np.minimum(size, 8)]

    high, longer = np.zeros(len(starts), dtype=np.uint64), np.flatnonzero(size > 8)
    high[longer] = eight(starts[longer] + 8, size[longer] - 8)
    return eight(starts, size), high


def distinct(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One span of each distinct content, and which of these each span is; told apart by their length and by their
    bytes, where there are more than sixteen by two 64-bit names."""
    size = ends - starts
    low, high = sixteen(data, starts, size)
    long = np.flatnonzero(size > 16)
    if len(long):
        inside, first = joined(data, starts[long], ends[long])
        values = BYTE_VALUE[inside]
        low[long], high[long] = (span_hash(values, first[:-1], first[1:], which) for which in (0, 1))
    of = pa.array(mix(mix(low, 41) ^ mix(high ^ (size.astype(np.uint64) << np.uint64(32)), 43), 47)).dictionary_encode().indices.to_numpy()
    first = np.empty(int(of.max(initial=-1)) + 1, dtype=np.int64)
    first[of[::-1]] = np.arange(len(of) - 1, -1, -1)
    if not all(np.array_equal(x[first][of], x) for x in (low, high, size)):
        first = of = np.arange(len(size))
    return first, of


def flat(found: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The ids (little-endian bytes) of a list's entries, one after the other, and how many each has."""
    return np.frombuffer(b"".join(found), dtype="<u4"), np.fromiter(map(len, found), dtype=np.int64, count=len(found)) // 4


def spread(found: list[bytes], of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids (little-endian bytes) of the entries `of` of a list, one after the other, and how many each has."""
    ids, size = flat(found)
    begin = np.cumsum(size) - size
    ids, first = joined(ids, begin[of], (begin + size)[of])
    return ids, np.diff(first)


def spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def looked_up(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, find: Callable[[list[bytes]], list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of many byte spans, one after the other, and how many each has. `find` gives the ids of distinct spans
    as little-endian bytes."""
    first, of = distinct(data, starts, ends)
    return spread(find(spans(data, starts[first], ends[first])), of)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Record batches cut so that each holds about `limit` bytes of text, or one longer text, and few enough rows."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(sizes) // limit + np.arange(batch.num_rows) // SLICE_ROWS
        cuts = np.flatnonzero(np.diff(part)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
            yield batch.slice(int(a), int(b - a))


def runs(values: np.ndarray, breaks: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Start and length of each run of equal values; a position in `breaks` always starts a run."""
    if not len(values):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    new = np.ones(len(values), dtype=bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    if breaks is not None:
        new[breaks[breaks < len(values)]] = True
    starts = np.flatnonzero(new)
    return starts, np.diff(np.append(starts, len(values)))


class Recent(dict):
    """Keeps what was used of late: two generations of at most twice `limit` entries."""

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.older = limit, {}

    def find(self, key: bytes) -> bytes | None:
        found = self.get(key)
        if found is None and key in self.older:
            found = self.older[key]
            self.keep(key, found)
        return found

    def find_all(self, keys: list[bytes]) -> list[bytes | None]:
        out = list(map(self.get, keys))
        if self.older:
            missing = [i for i, found in enumerate(out) if found is None]
            again = []
            for i, found in zip(missing, map(self.older.get, [keys[i] for i in missing]), strict=True):
                if found is not None:
                    out[i] = found
                    again.append((keys[i], found))
            self.keep_all(again)
        return out

    def keep_all(self, items: list[tuple[bytes, bytes]]) -> None:
        for a in range(0, len(items), self.limit):
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self.update(items[a : a + self.limit])

    def keep(self, key: bytes, value: bytes) -> None:
        if len(self) >= self.limit:
            self.older = dict(self)
            self.clear()
        self[key] = value


class Known:
    """The ids of spans of at most sixteen bytes, found by those bytes and their number for a whole slice at a time.

    Entries are numbered from 1 and kept in arrays; `slots` has the number of an entry at the place that its hash names,
    or at the next free one. Entry 0 stands for none and has no ids. With `limit` entries the table starts anew."""

    def __init__(self, limit: int):
        self.limit = limit
        self.clear()

    def clear(self) -> None:
        self.low, self.high = np.zeros((2, 1), dtype=np.uint64)
        self.size, self.begin, self.count = np.array([-1], dtype=np.int8), np.zeros(1, dtype=np.int32), np.zeros(1, dtype=np.int32)
        self.ids, self.slots = np.zeros(0, dtype="<u4"), np.zeros(1 << 12, dtype=np.int32)
        self.entries, self.filled = 1, 0

    def _place(self, low: np.ndarray, high: np.ndarray, size: np.ndarray) -> np.ndarray:
        name = mix(low ^ (high * np.uint64(BASES[0])) ^ (size.astype(np.uint64) * np.uint64(BASES[1])))
        return (name & np.uint64(len(self.slots) - 1)).astype(np.int64)

    def find(self, low: np.ndarray, high: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The entry of each span, given by what `sixteen` makes of it and its size."""
        at = self._place(low, high, size)
        out = self.slots[at]
        other = (self.low[out] != low) | (self.high[out] != high) | (self.size[out] != size)
        left = np.flatnonzero(other & (out != 0))
        out[other] = 0
        at = at[left]
        while len(left):
            at = (at + 1) & (len(self.slots) - 1)
            entry = self.slots[at]
            same = (self.low[entry] == low[left]) & (self.high[entry] == high[left]) & (self.size[entry] == size[left])
            out[left[same]] = entry[same]
            on = ~same & (entry != 0)
            left, at = left[on], at[on]
        return out

    def add(self, low: np.ndarray, high: np.ndarray, size: np.ndarray, ids: np.ndarray, count: np.ndarray) -> np.ndarray:
        """New entries for distinct spans that have none, with their ids one after the other and how many each has; the
        entries' numbers, which hold until the next `ids_of`."""
        new = np.arange(self.entries, self.entries + len(low))
        for name, values in (("low", low), ("high", high), ("size", size), ("count", count), ("begin", self.filled + np.cumsum(count) - count)):
            setattr(self, name, _extended(getattr(self, name), self.entries, values))
        self.ids = _extended(self.ids, self.filled, ids)
        self.entries, self.filled = self.entries + len(low), self.filled + len(ids)
        if 2 * self.entries > len(self.slots):
            self.slots = np.zeros(1 << (3 * self.entries).bit_length(), dtype=np.int32)
            self._seat(np.arange(1, self.entries))
        else:
            self._seat(new)
        return new

    def _seat(self, entry: np.ndarray) -> None:
        at = self._place(self.low[entry], self.high[entry], self.size[entry])
        while len(entry):
            free = self.slots[at] == 0
            self.slots[at[free]] = entry[free]
            left = self.slots[at] != entry
            entry, at = entry[left], (at[left] + 1) & (len(self.slots) - 1)

    def ids_of(self, entry: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the entries, one after the other, and how many each has."""
        begin, count = self.begin[entry], self.count[entry].astype(np.int64)
        ids, _ = joined(self.ids, begin, begin + count)
        if self.entries > self.limit:
            self.clear()
        return ids, count


def _extended(values: np.ndarray, filled: int, more: np.ndarray) -> np.ndarray:
    """`more` put behind the first `filled` values, in an array with room to spare."""
    if filled + len(more) > len(values):
        values = np.concatenate([values[:filled], np.empty(len(more) + (filled + len(more)) // 4, dtype=values.dtype)])
    values[filled : filled + len(more)] = more
    return values
