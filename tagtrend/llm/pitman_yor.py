"""Language-model scoring by a hierarchical Pitman-Yor model.

Tokens are lower-cased words and one end per document. Each context, which is the token before (or the start of a
document), has a restaurant of its own that seats the tokens that follow it; its tables are customers of the one
restaurant that all contexts share, whose own parent is uniform over the vocabulary and one unknown word. A sweep of the
Gibbs sampler takes the customers of every dish out and seats them again, one after another, in the Chinese restaurant
process given everything else as the sweep before left it (large dishes in growing leaps). Several seatings after the
first sweeps are averaged into the predictive probabilities; each uses discounts, tables and totals of that seating
alone, so the probabilities of a context add up to one.

Spark deals the tokens out once, by word: a part holds all occurrences of its words as packed arrays, so the seating
of a word and its share of the parent are local. What parts owe each other are totals per context. Those of the 65,535
commonest contexts, which nearly every part meets, are a fixed number and summed after each sweep. All other contexts go
by name: each has a home, to which the parts that meet it send their tables and which returns the sum, packed and
shuffled by home and back by part. Their number follows the vocabulary, and none of it passes the driver. The counts of
the pairs are written once; a task that needs the seating after some sweep repeats the sweeps from there with the totals
and random numbers they had. Words that make up a 256th of the corpus or more (512 at most) are spread: after the 1,024
commonest contexts over all parts, where only their counts are joined, after others by context; no other word can
overload a part. Scores return as partial sums per document. Parts, homes and blocks follow the size of the input.

Defined results: null text is empty and has the end token alone; rows without an id are scored and never learned from;
repeated rows are learned from as often as they occur; with nothing to learn from all counts are zero; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagtrend.llm.store import PACKED, shuffles_freed, stage, stage_by
from tagtrend.llm.words import mix, slices, words_of

CLASSES = 1024  # the commonest contexts, whose counts with spread words are joined
NAMED = (1 << 16) - 1  # contexts from here on have a name in place of a number
HOME_PARTS = 4
PART_BYTES = 6 << 20
HELD_DOCS = 1 << 20
BLOCK_TOKENS = 1_000_000
BLOCK_DOCS = 60_000
HOT_SHARE = 256
BURN_IN = 2
SAMPLES = 3
STRENGTH = 1.0
END = np.uint64(0x9D3F0C6B5A7E1143)
START = np.uint64(0x51A7B3C99D02EE67)


def token_names(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Name, context (name of the token before) and document of every token of a slice; each document ends in the end
    token."""
    words = words_of(texts, lower=True)
    count = words.counts + 1
    ends = np.cumsum(count) - 1
    names = np.full(int(count.sum()), END, dtype=np.uint64)
    inner = np.ones(len(names), dtype=bool)
    inner[ends] = False
    names[inner] = words.names
    before = np.empty_like(names)
    before[1:] = names[:-1]
    before[np.concatenate([[0], ends[:-1] + 1])] = START
    return names, before, np.repeat(np.arange(len(count)), count)


def numbered(before: np.ndarray, common: np.ndarray) -> np.ndarray:
    """The numbers of contexts, which are their places in `common`; `NAMED` for those that are not in it."""
    order = np.argsort(common)
    at = np.minimum(np.searchsorted(common, before, sorter=order), len(common) - 1)
    return np.where(common[order[at]] == before, order[at], NAMED).astype(np.uint16)


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens that a slice has twice, or that make up half the hot share of it, with their counts; 0: all tokens."""
    for batch in slices(batches):
        names, _, _ = token_names(batch.column("text"))
        name, n = np.unique(names, return_counts=True)
        often = (n > 1) | (n * 2 * HOT_SHARE >= len(names))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(name[often].view(np.int64), 0)), pa.array(np.append(n[often], len(names)))], names=["name", "n"]
        )


def packed(data: bytes) -> bytes:
    """Compressed, behind the length."""
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unpacked(data: pa.Buffer) -> pa.Buffer:
    return pa.decompress(data.slice(8), int.from_bytes(data.slice(0, 8).to_pybytes(), "little"), codec="zstd")


_DOC = pa.list_(pa.struct([("doc_id", pa.int64()), ("held", pa.bool_()), ("n", pa.int64())]))
BLOCK = "part int, block long, payload binary, docs array<struct<doc_id:long,held:boolean,n:long>>"


def _blocks(parts: int, hot: np.ndarray, common: Broadcast):
    """Pack the tokens of consecutive documents by the part of their word: the words, their numbers of occurrences,
    and per occurrence the number of the context, the document in the block (shifted by one) and whether it is held out
    (lowest bit); last the contexts that have no number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        docs: list[dict] = []

        def flush():
            block = (task << 32) + number
            names, classes, doc, before = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            # where the names of contexts without a number stand; others have the last place before theirs, or 0
            place = np.maximum(np.cumsum(classes == NAMED, dtype=np.int32) - 1, 0)
            before = before if len(before) else np.zeros(1, dtype=np.uint64)
            part = (mix(names, 23) % np.uint64(parts)).astype(np.int64)
            spread = np.isin(names, hot)
            rare = spread & (classes >= CLASSES)
            spread &= ~rare
            part[spread] = (part[spread] + number + task) % parts
            part[rare] = (mix(np.where(classes[rare] == NAMED, before[place[rare]], classes[rare]), 29) % np.uint64(parts)).astype(np.int64)
            order = np.lexsort((names, part))
            names, classes, doc, part, place = (x[order] for x in (names, classes, doc, part, place))
            cuts = np.searchsorted(part, np.arange(parts + 1))
            for p in range(parts):
                a, b = cuts[p], cuts[p + 1]
                if a < b:
                    word, n = np.unique(names[a:b], return_counts=True)
                    body = [np.array([len(word), b - a], dtype="<u4"), word, n.astype("<u4"), classes[a:b], doc[a:b]]
                    body.append(before[place[a:b][classes[a:b] == NAMED]])
                    payload = packed(b"".join(x.tobytes() for x in body))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([p], pa.int32()), pa.array([block]), pa.array([payload]), pa.array([None], _DOC)],
                        names=["part", "block", "payload", "docs"],
                    )
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1 - block % 64], pa.int32()), pa.array([block]), pa.array([b""]), pa.array([docs], _DOC)],
                names=["part", "block", "payload", "docs"],
            )

        size = 0
        for batch in slices(batches):
            names, before, doc = token_names(batch.column("text"))
            out = batch.column("held").to_numpy(zero_copy_only=False).astype(bool)
            classes = numbered(before, common.value)
            held.append((names, classes, ((doc + len(docs)) * 2 + out[doc]).astype("<u4"), before[classes == NAMED]))
            n = np.bincount(doc, minlength=batch.num_rows).tolist()
            docs += [{"doc_id": d, "held": h, "n": k} for d, h, k in zip(batch.column("doc_id").to_pylist(), out.tolist(), n, strict=True)]
            size += len(names)
            if size >= BLOCK_TOKENS or len(docs) >= BLOCK_DOCS:
                yield from flush()
                docs, size, number = [], 0, number + 1
        if docs:
            yield from flush()

    return run


@dataclass
class Totals:
    """What the parts share: sums over all of them, and the counts of the words that are spread. `history` holds, for
    the seating after each sweep (the first: one table per pair), the tables per numbered context (last: of all others
    together) and those of the parent; `hot_shared` the parent's probabilities of the spread words."""

    parts: int
    hot: np.ndarray
    tokens: int = 0
    words: int = 0
    customers: np.ndarray = field(default_factory=lambda: np.zeros(NAMED + 1))
    hot_counts: np.ndarray = field(default_factory=lambda: np.zeros((0, CLASSES)))
    hot_rest: np.ndarray = field(default_factory=lambda: np.zeros(0))
    hot_chance: np.ndarray = field(default_factory=lambda: np.zeros((0, CLASSES)))
    discount: float = 0.5
    parent_discount: float = 0.5
    history: list[tuple[np.ndarray, float]] = field(default_factory=list)
    hot_shared: list[np.ndarray] = field(default_factory=list)

    @property
    def homes(self) -> int:
        return -(-self.parts // HOME_PARTS)

    def unseen(self, sweep: int) -> float:
        """The weight of the parent's own parent for each word, given the seating after a sweep."""
        return (STRENGTH + self.parent_discount * self.history[sweep][1]) / (self.words + 1)


@dataclass
class Shares:
    """Customers, and tables after each sweep, of the contexts of a part that have no number, from all parts."""

    customers: np.ndarray = field(default_factory=lambda: np.zeros(0))
    tables: list[np.ndarray] = field(default_factory=list)

    @classmethod
    def of(cls, rows: pa.Array | None) -> Shares:
        """From the answers of the homes; in the order of the homes their contexts are in that of the names."""
        found: dict[int, list[np.ndarray]] = {}
        if rows is not None:
            home, sweep = (rows.field(c).to_numpy() for c in ("home", "sweep"))
            for i in np.lexsort((home, sweep)):
                found.setdefault(int(sweep[i]), []).append(np.frombuffer(unpacked(rows.field("payload")[i].as_buffer()), "<u4"))
        if not found:
            return cls()
        first = [x.reshape(2, -1) for x in found.pop(0)]
        return cls(np.concatenate([x[0] for x in first]), [np.concatenate([x[1] for x in first])] + [np.concatenate(found[s]) for s in sorted(found)])

    def beside(self, totals: Totals, sweep: int) -> np.ndarray:
        """Tables of every context of the part after a sweep."""
        return np.concatenate([totals.history[sweep][0][:NAMED], self.tables[sweep] if self.tables else []])


class Seats:
    """The restaurants' (word, context) pairs that were seen twice or more in training, and how often. Pairs seen once
    always have one table; their numbers per word and per context stand for them. Spread words, at `hot_at`, have their
    probabilities from all parts."""

    def __init__(self, pairs: np.ndarray, count: np.ndarray, lone_words: np.ndarray, lone_contexts: np.ndarray, hot_at: np.ndarray, hot_row: np.ndarray):
        self.words, self.contexts = len(lone_words), len(lone_contexts)
        self.word_of, self.context_of = pairs // self.contexts, pairs % self.contexts
        self.count, self.lone_words, self.lone_contexts = count.astype(np.int64), lone_words, lone_contexts
        self.hot_at, self.hot_row = hot_at, hot_row

    def guests(self, tables: np.ndarray) -> np.ndarray:
        return np.bincount(self.word_of, tables, self.words).astype(np.int64) + self.lone_words

    def own(self, tables: np.ndarray) -> np.ndarray:
        """Guests of the words that are not spread."""
        guests = self.guests(tables)
        guests[self.hot_at] = 0
        return guests

    def per_context(self, tables: np.ndarray) -> np.ndarray:
        return np.bincount(self.context_of, tables, self.contexts) + self.lone_contexts

    def shared(self, tables: np.ndarray, parent: np.ndarray, totals: Totals, sweep: int) -> np.ndarray:
        """The parent's probability of each word, in the seating after a sweep."""
        out = self.own(tables) - totals.parent_discount * parent + totals.unseen(sweep)
        out /= STRENGTH + totals.history[sweep][0].sum()
        out[self.hot_at] = totals.hot_shared[sweep][self.hot_row]
        return out

    def chain(self, totals: Totals, shares: Shares, rng: np.random.Generator) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Tables per pair and tables of the parent per word: at first, and after each sweep whose odds are known, which
        are those of the seating before. Equal totals and numbers give the same seating again, wherever it runs."""
        tables = np.ones(len(self.count), dtype=np.int64)
        parent = (self.own(tables) > 0).astype(np.int64)
        yield tables, parent
        for sweep in range(len(totals.history)):
            shared = self.shared(tables, parent, totals, sweep)
            weight = STRENGTH + totals.discount * shares.beside(totals, sweep)
            tables = reseat(self.count, weight[self.context_of] * shared[self.word_of], totals.discount, rng)
            parent = reseat(self.own(tables), np.full(self.words, totals.unseen(sweep)), totals.parent_discount, rng)
            yield tables, parent


def predicted(count: np.ndarray, tables: np.ndarray, customers: np.ndarray, open_tables: np.ndarray, shared: np.ndarray, discount: float) -> np.ndarray:
    """Predictive probabilities of pairs in one seating: counts and tables of the pair, customers and tables of its
    context, the parent's probability of its word. Discounts and the mass that backs off are of one seating, so the
    probabilities of a context add up to one."""
    return (count - discount * tables + (STRENGTH + discount * open_tables) * shared) / (STRENGTH + customers)


class Part:
    """All occurrences of the words of one part, and the training counts of its (word, context) pairs. Spread words have
    a count of zero in the restaurants of the commonest contexts; these are seated once, from the counts over all parts."""

    def __init__(self, blobs: pa.StructArray, hot: np.ndarray):
        words, counts, classes, docs, named = [], [], [], [], []
        self.blocks = blobs.field("block").to_pylist()
        for payload in blobs.field("payload"):
            raw, at = unpacked(payload.as_buffer()), 8
            n_words, n = (int(x) for x in np.frombuffer(raw, "<u4", 2))
            for out, kind, size in ((words, "<u8", n_words), (counts, "<u4", n_words), (classes, "<u2", n), (docs, "<u4", n)):
                out.append(np.frombuffer(raw, kind, size, at))
                at += out[-1].nbytes
            named.append(np.frombuffer(raw, "<u8", np.count_nonzero(classes[-1] == NAMED), at))
        self.shares = Shares()
        self.block = np.repeat(np.arange(len(docs), dtype=np.int32), [len(d) for d in docs])
        self.words, inverse = np.unique(np.concatenate(words), return_inverse=True)
        self.named, rank = np.unique(np.concatenate(named), return_inverse=True)
        context = np.concatenate(classes)
        self.contexts = NAMED + len(self.named)
        key = np.repeat(inverse.astype(np.uint64) * np.uint64(self.contexts), np.concatenate(counts))
        key += context
        key[context == NAMED] += rank.astype(np.uint64)
        self.pairs, self.pair = _numbered(key)
        doc = np.concatenate(docs)
        self.doc, train = doc >> 1, (doc & 1) == 0
        self.counted = np.bincount(self.pair[train], minlength=len(self.pairs))
        self.word_of, self.context_of = (x.astype(np.int32) for x in np.divmod(self.pairs, self.contexts))
        self.spread = np.isin(self.words, hot)
        self.hot_row = np.searchsorted(hot, self.words)
        self.joined = self.spread[self.word_of] & (self.context_of < CLASSES)
        self.count = self.counted * ~self.joined
        lone, self.often = self.count == 1, self.count > 1
        self.seats = Seats(
            self.pairs[self.often], self.count[self.often],
            np.bincount(self.word_of[lone], minlength=len(self.words)), np.bincount(self.context_of[lone], minlength=self.contexts),
            np.flatnonzero(self.spread), self.hot_row[self.spread],
        )

    def chances(self, totals: Totals, shares: Shares, seatings: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Predictive probability of each pair, averaged over the seatings after the first sweeps."""
        customers = np.concatenate([totals.customers[:NAMED], shares.customers])[self.context_of]
        chance, all_tables = np.zeros(len(self.pairs)), (self.count > 0).astype(np.int64)
        for sweep, (tables, parent) in enumerate(islice(seatings, BURN_IN + SAMPLES + 1)):
            if sweep > BURN_IN:
                all_tables[self.often] = tables
                shared = self.seats.shared(tables, parent, totals, sweep)[self.word_of]
                chance += predicted(self.count, all_tables, customers, shares.beside(totals, sweep)[self.context_of], shared, totals.discount)
        return chance / SAMPLES

    def statistics(self) -> list[tuple[str, int, int, float]]:
        """Rows to be summed: words, how many counts are one and two, and the counts and tables of spread words."""
        seats, names = self.seats, self.words.view(np.int64)
        tables = np.ones(len(seats.count), dtype=np.int64)
        seen = seats.own(tables)
        out = [("words", 0, 0, float(np.count_nonzero(seen)))]
        out += [(f"pairs{i}", 0, 0, float(np.count_nonzero(self.count == i))) for i in (1, 2)]
        out += [(f"words{i}", 0, 0, float(np.count_nonzero(seen == i))) for i in (1, 2)]
        rest = np.bincount(self.word_of, self.count, len(self.words))
        out += [("rest", int(names[i]), 0, float(rest[i])) for i in seats.hot_at]
        out += _hot_guests(seats, tables)
        hot = np.flatnonzero(self.joined & (self.counted > 0))
        return out + [("hot", int(names[self.word_of[i]]), int(self.context_of[i]), float(self.counted[i])) for i in hot]


def _hot_guests(seats: Seats, tables: np.ndarray) -> list[tuple[str, int, int, float]]:
    """Tables of the spread words in a part's own restaurants, by row."""
    guests = seats.guests(tables)
    return [("guests", int(r), 0, float(guests[i])) for i, r in zip(seats.hot_at, seats.hot_row, strict=True)]


def _numbered(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and the place of each key among them; the keys are used up. One sort in place of the
    key with its position behind it, where both fit a number, takes half the memory of an indirect one."""
    bits = max(1, int(len(key) - 1).bit_length())
    if not len(key) or int(key.max()) >> (64 - bits):
        pairs, place = np.unique(key, return_inverse=True)
        return pairs.astype(np.int64), place.astype(np.int32)
    key <<= np.uint64(bits)
    key += np.arange(len(key), dtype=np.uint64)
    key.sort()
    position = (key & np.uint64((1 << bits) - 1)).astype(np.uint32)
    key >>= np.uint64(bits)
    new = np.ones(len(key), dtype=bool)
    np.not_equal(key[1:], key[:-1], out=new[1:])
    place = np.empty(len(key), dtype=np.int32)
    place[position] = np.cumsum(new, dtype=np.int32) - 1
    return key[new].astype(np.int64), place


def reseat(customers: np.ndarray, new_table: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish after its customers sat down one after another, where a new table weighs `new_table` and
    the open ones weigh their customers less the discount of each. Beyond eight customers a quarter of those seated
    comes at a time, with the odds at its start."""
    tables = (customers > 0).astype(np.int64)
    live, seated = np.flatnonzero(customers > 1), 1
    while len(live):
        step = 1 if seated < 8 else seated // 4
        come = np.minimum(step, customers[live] - seated)
        odds = new_table[live] / (new_table[live] + seated - discount * tables[live])
        tables[live] += rng.binomial(come, np.clip(odds, 0, 1))
        seated += step
        live = live[customers[live] > seated]
    return tables


class Sums:
    """Partial sums of a task's parts per block and document, so that few of them are sent."""

    def __init__(self):
        self.blocks: dict[int, list[np.ndarray]] = {}
        self.docs = 0

    def add(self, block: int, doc: np.ndarray, *values: np.ndarray) -> None:
        size = int(doc.max()) + 1
        new = [np.bincount(doc, minlength=size), *(np.bincount(doc, v, size) for v in values)]
        old = self.blocks.get(block)
        if old is None:
            self.blocks[block] = new
            self.docs += size
            return
        if len(old[0]) < size:
            self.docs += size - len(old[0])
            old = [np.pad(x, (0, size - len(x))) for x in old]
        for total, more in zip(old, new, strict=True):
            total[:size] += more
        self.blocks[block] = old

    def sent(self) -> Iterator[pa.RecordBatch]:
        for block, (n, *sums) in self.blocks.items():
            doc = np.flatnonzero(n)
            # documents as steps from one to the next, mostly 1
            columns = [np.diff(doc, prepend=0), *(x[doc] for x in sums)]
            payload = packed(b"".join(x.astype(kind).tobytes() for x, kind in zip(columns, _TYPES.values(), strict=True)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([len(doc)], pa.int64()), pa.array([payload])], names=["block", "rows", "sums"]
            )
        self.blocks, self.docs = {}, 0


def _over_parts(parts: DataFrame, totals: Totals, make, schema: str) -> DataFrame:
    """make(part number, Part, totals, sums) -> record batches, for each part; `sums` belongs to the task, and what it
    still holds behind the last part is sent on. The parts may have shares beside them."""
    shared = parts.sparkSession.sparkContext.broadcast(totals)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums()
        for batch in batches:
            for i in range(batch.num_rows):
                number = batch.column("part")[i].as_py()
                part = Part(batch.column("blobs")[i].values, shared.value.hot)
                if "shares" in batch.schema.names:
                    part.shares = Shares.of(batch.column("shares")[i].values)
                yield from make(number, part, shared.value, sums)
                pa.default_memory_pool().release_unused()
        yield from sums.sent()

    rows = parts.where("part >= 0")
    return rows.select(*(c for c in ("part", "blobs", "shares") if c in rows.columns)).mapInArrow(run, schema)


_SUMS = "kind string, a long, b long, value double, pairs binary"


def _rows(rows: list[tuple[str, int, int, float]], pairs: list[bytes | None] | None = None) -> pa.RecordBatch:
    kind, a, b, value = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(kind), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(value, pa.float64()),
            pa.array(pairs or [None] * len(rows), pa.binary()),
        ],
        names=["kind", "a", "b", "value", "pairs"],
    )


def _summed(rows: DataFrame) -> list:
    return rows.where("pairs IS NULL").groupBy("kind", "a", "b").agg(F.sum("value").alias("value")).collect()


_SLICE = 1 << 12


def _array_rows(kind: str, values: np.ndarray) -> pa.RecordBatch:
    """Sums per numbered context (last: of all others), in slices."""
    whole = np.append(values[:NAMED], values[NAMED:].sum()).astype("<i8")
    rows = [(kind, i, 0, 0.0) for i in range(0, len(whole), _SLICE)]
    return _rows(rows, [packed(whole[i : i + _SLICE].tobytes()) for _, i, _, _ in rows])


def _array_sum(rows: pa.Table) -> pa.Table:
    total = np.zeros(_SLICE, dtype="<i8")
    for x in rows.column("pairs"):
        total += np.frombuffer(unpacked(x.as_buffer()), "<i8")
    return rows.slice(0, 1).set_column(1, "pairs", pa.array([total.tobytes()], pa.binary()))


def _arrays(rows: DataFrame, kind: str) -> np.ndarray:
    """The sum of the arrays of a kind."""
    found = rows.where(F.col("kind") == kind).select("a", "pairs").groupBy("a").applyInArrow(_array_sum, "a long, pairs binary").collect()
    out = np.zeros(NAMED + 1)
    for r in found:
        out[r["a"] : r["a"] + _SLICE] = np.frombuffer(r["pairs"], "<i8")
    return out


def _to_homes(kind: str, number: int, named: np.ndarray, homes: int, *columns: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Columns of the contexts without a number, a row for each home. Names are hashes: ranges of them are even."""
    home = ((named >> np.uint64(32)) * np.uint64(homes)) >> np.uint64(32)
    found, first = np.unique(home, return_index=True)
    cuts = [*first.tolist(), len(named)]
    if len(found):
        bodies = [packed(b"".join(c[a:b].tobytes() for c in columns)) for a, b in zip(cuts, cuts[1:], strict=False)]
        yield _rows([(kind, int(h), number, float(b - a)) for h, a, b in zip(found, cuts, cuts[1:], strict=False)], bodies)


_SHARES = "kind string, home int, part int, sweep int, payload binary"


def _share_rows(rows: list[tuple[str, int, int, int, bytes]]) -> pa.Table:
    kind, home, part, sweep, payload = zip(*rows, strict=True)
    kinds = (pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
    return pa.table([pa.array(x, k) for x, k in zip((kind, home, part, sweep, payload), kinds, strict=True)], names=["kind", "home", "part", "sweep", "payload"])


def _meet(rows: pa.Table) -> pa.Table:
    """What the parts say of the contexts of one home -> to each part the customers and first tables of those it named;
    and where each stands among the home's contexts, for the sweeps to come."""
    home, parts = rows.column("a")[0].as_py(), rows.column("b").to_pylist()
    size = [int(n) for n in rows.column("value").to_pylist()]
    raw = [unpacked(x.as_buffer()) for x in rows.column("pairs")]
    names = np.concatenate([np.frombuffer(x, "<u8", n) for x, n in zip(raw, size, strict=True)])
    rest = [np.frombuffer(x, "<u4", 2 * n, 8 * n).reshape(2, n) for x, n in zip(raw, size, strict=True)]
    distinct, place = np.unique(names, return_inverse=True)
    sums = [np.bincount(place, x, len(distinct)).astype("<u4") for x in np.concatenate(rest, axis=1)]
    out, at = [], 0
    for part, n in zip(parts, size, strict=True):
        mine = place[at : at + n]
        out.append(("share", home, part, 0, packed(b"".join(x[mine].tobytes() for x in sums))))
        out.append(("place", home, part, 0, packed(np.diff(mine, prepend=0).astype("<u4").tobytes())))
        at += n
    return _share_rows(out)


def _answer(sweep: int):
    def run(rows: pa.Table) -> pa.Table:
        """The parts' tables after a sweep and their places -> to each part the sums over all parts."""
        home, of = rows.column("home")[0].as_py(), {}
        for kind, part, payload in zip(rows.column("kind").to_pylist(), rows.column("part").to_pylist(), rows.column("payload"), strict=True):
            of.setdefault(part, {})[kind] = np.frombuffer(unpacked(payload.as_buffer()), "<u4")
        place = {part: np.cumsum(x["place"], dtype=np.int64) for part, x in of.items()}
        total = np.zeros(1 + max(int(x[-1]) for x in place.values()), dtype="<u4")
        for part, x in of.items():
            total[place[part]] += x["tables"]
        return _share_rows([("share", home, part, sweep, packed(total[x].tobytes())) for part, x in place.items()])

    return run


def _beside(rows: DataFrame, shares: DataFrame) -> DataFrame:
    """Each part with what the homes answered it; the parts stay where they are."""
    given = shares.groupBy("part").agg(F.collect_list(F.struct("home", "sweep", "payload")).alias("shares"))
    return rows.join(given.hint("shuffle_hash"), "part", "left")


_COUNTED = (("pairs", "<u8"), ("count", "<u4"), ("lone_words", "<u4"), ("lone_contexts", "<u4"), ("hot_at", "<u4"), ("hot_row", "<u4"), ("named", "<u8"))


def _count(number: int, part: Part, totals: Totals, sums: Sums) -> Iterator[pa.RecordBatch]:
    yield _rows(part.statistics())
    seats = part.seats
    customers = np.bincount(part.context_of, part.counted, part.contexts)
    tables = seats.per_context(np.ones(len(seats.count), dtype=np.int64))
    yield _array_rows("customers", customers)
    yield _array_rows("tables", tables)
    yield from _to_homes("named", number, part.named, totals.homes, part.named, customers[NAMED:].astype("<u4"), tables[NAMED:].astype("<u4"))
    columns = (np.diff(part.pairs[part.often], prepend=0), seats.count, seats.lone_words, seats.lone_contexts, seats.hot_at, seats.hot_row, np.diff(part.named, prepend=np.uint64(0)))
    body = [np.array([len(x) for x in columns], dtype="<u4"), *(x.astype(kind) for x, (_, kind) in zip(columns, _COUNTED, strict=True))]
    yield _rows([("pairs", number, 0, 0.0)], [packed(b"".join(x.tobytes() for x in body))])


def _seats(payload: pa.Buffer) -> tuple[Seats, np.ndarray]:
    """A part's seats and its contexts without a number, as they were counted."""
    raw, at, out = unpacked(payload), 4 * len(_COUNTED), []
    for n, (_, kind) in zip(np.frombuffer(raw, "<u4", len(_COUNTED)), _COUNTED, strict=True):
        out.append(np.frombuffer(raw, kind, n, at))
        at += out[-1].nbytes
    pairs, count, *lone, hot_at, hot_row, named = out
    return Seats(np.cumsum(pairs.astype(np.int64)), count, *(x.astype(np.int64) for x in (*lone, hot_at, hot_row))), np.cumsum(named, dtype=np.uint64)


def _generator(seed: int, number: int) -> np.random.Generator:
    return np.random.Generator(np.random.PCG64([seed, number]))


def _swept(counted: DataFrame, totals: Totals, seed: int) -> DataFrame:
    """Tables per context and in the parent, of the seating after the next sweep."""
    shared = counted.sparkSession.sparkContext.broadcast(totals)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = shared.value
        per_context, parent_tables, hot = np.zeros(NAMED + 1, dtype=np.int64), 0.0, np.zeros(len(totals.hot))
        for batch in batches:
            for row in range(batch.num_rows):
                number = batch.column("part")[row].as_py()
                seats, named = _seats(batch.column("pairs")[row].as_buffer())
                *_, (tables, parent) = seats.chain(totals, Shares.of(batch.column("shares")[row].values), _generator(seed, number))
                mine = seats.per_context(tables).astype(np.int64)
                per_context[:NAMED] += mine[:NAMED]
                per_context[NAMED] += mine[NAMED:].sum()
                parent_tables += float(parent.sum())
                hot[seats.hot_row] += seats.guests(tables)[seats.hot_at]
                yield from _to_homes("named", number, named, totals.homes, mine[NAMED:].astype("<u4"))
        yield _array_rows("tables", per_context)
        yield _rows([("parent", 0, 0, parent_tables), *(("guests", i, 0, float(x)) for i, x in enumerate(hot))])

    return counted.select("part", "pairs", "shares").mapInArrow(run, _SUMS)


_PARTIAL = "block long, rows long, sums binary"
_TYPES = {"doc": "<u2", "score": "<f4", "base": "<f8", "known": "<u4"}  # a block has fewer than 2^16 documents


def _score(seed: int):
    def make(number: int, part: Part, totals: Totals, sums: Sums) -> Iterator[pa.RecordBatch]:
        chance = part.chances(totals, part.shares, part.seats.chain(totals, part.shares, _generator(seed, number)))
        count = np.bincount(part.word_of, part.count, len(part.words))
        if part.spread.any():
            at = np.flatnonzero(part.joined)
            chance[at] = totals.hot_chance[part.hot_row[part.word_of[at]], part.context_of[at]]
            rows = part.hot_row[part.spread]
            count[part.spread] = totals.hot_counts[rows].sum(axis=1) + totals.hot_rest[rows]
        score = np.log10(chance)
        base = np.log10((count + 1) / (totals.tokens + totals.words + 1))[part.word_of]
        known = (count > 0)[part.word_of]
        cuts = np.searchsorted(part.block, np.arange(len(part.blocks) + 1))
        for block, a, b in zip(part.blocks, cuts, cuts[1:], strict=False):
            pair = part.pair[a:b]
            sums.add(block, part.doc[a:b], score[pair], base[pair], known[pair])
        if sums.docs > HELD_DOCS:
            yield from sums.sent()

    return make


def _gather(rows: pa.Table) -> pa.Table:
    """The partial sums of one block and its list of documents -> a row per document."""
    rows = rows.combine_chunks()
    docs = next(x for x in rows.column("docs") if x.is_valid).values
    out = {"score": np.zeros(len(docs)), "base": np.zeros(len(docs)), "known": np.zeros(len(docs))}
    for n, sums in zip(rows.column("rows").to_pylist(), rows.column("sums"), strict=True):
        if n is not None:
            raw, at, doc = unpacked(sums.as_buffer()), 0, None
            for name, kind in _TYPES.items():
                values = np.frombuffer(raw, kind, n, at)
                at += values.nbytes
                if doc is None:
                    doc = np.cumsum(values, dtype=np.int64)
                else:
                    out[name][doc] += values
    return pa.table({
        "doc_id": docs.field("doc_id"), "held_out": docs.field("held"), "n_tokens": docs.field("n"),
        "n_known": pa.array(out["known"].astype(np.int64)), "base_score": pa.array(out["base"]), "score": pa.array(out["score"]),
    })


def learn(parts: DataFrame, totals: Totals, seed: int) -> DataFrame:
    """Count the parts and seat their customers; what they share is filled into `totals`. Returns the shares of the
    parts in the contexts without a number. Spread words after the commonest contexts, of which there are few, are
    seated here."""
    counted = stage(_over_parts(parts, totals, _count, _SUMS), "pitman-yor-counts", **PACKED)
    pairs = counted.where("kind = 'pairs'").select(F.col("a").cast("int").alias("part"), "pairs")
    pairs = stage_by(pairs, "part", "pitman-yor-pairs", **PACKED)
    met = stage(counted.where("kind = 'named'").select("a", "b", "value", "pairs").groupBy("a").applyInArrow(_meet, _SHARES), "pitman-yor-contexts", **PACKED)
    shares = met.where("kind = 'share'")

    found = _summed(counted)
    value = {r["kind"]: r["value"] for r in found}
    n_hot = len(totals.hot)
    totals.customers = _arrays(counted, "customers")
    totals.hot_counts, totals.hot_rest = np.zeros((n_hot, CLASSES)), np.zeros(n_hot)
    for r in found:
        if r["kind"] in ("hot", "rest"):
            row = np.searchsorted(totals.hot, np.int64(r["a"]).view(np.uint64))
            if r["kind"] == "hot":
                totals.hot_counts[row, r["b"]] = r["value"]
            else:
                totals.hot_rest[row] = r["value"]
    totals.tokens = int(totals.customers.sum())
    totals.words = int(value.get("words", 0)) + int((totals.hot_counts.sum(axis=1) + totals.hot_rest > 0).sum())
    totals.discount = _discount(value.get("pairs1", 0), value.get("pairs2", 0))
    totals.parent_discount = _discount(value.get("words1", 0), value.get("words2", 0))

    count, customers, rng = totals.hot_counts.astype(np.int64), totals.customers[:CLASSES], _generator(seed, totals.parts)
    tables, parent, parent_tables = (count > 0).astype(np.int64), np.zeros(n_hot, dtype=np.int64), value.get("words", 0.0)
    per_context = _arrays(counted, "tables")
    totals.hot_chance = np.zeros(count.shape)
    for sweep in range(BURN_IN + SAMPLES + 1):
        if sweep:
            swept = stage(_swept(_beside(pairs, shares), totals, seed), "pitman-yor-sweep", **PACKED)
            sent = swept.where("kind = 'named'").selectExpr("'tables' AS kind", "cast(a AS int) AS home", "cast(b AS int) AS part", f"{sweep} AS sweep", "pairs AS payload")
            answers = sent.unionByName(met.where("kind = 'place'")).groupBy("home").applyInArrow(_answer(sweep), _SHARES)
            shares = shares.unionByName(stage(answers, "pitman-yor-shares", **PACKED))
            found, per_context = _summed(swept), _arrays(swept, "tables")
            parent_tables = sum(r["value"] for r in found if r["kind"] == "parent")
            weight = (STRENGTH + totals.discount * totals.history[-1][0][:CLASSES]) * totals.hot_shared[-1][:, None]
            tables = reseat(count.ravel(), weight.ravel(), totals.discount, rng).reshape(count.shape)
        guests = tables.sum(axis=1)
        for r in found:
            if r["kind"] == "guests":
                guests[r["a"]] += int(r["value"])
        parent = reseat(guests, np.full(n_hot, totals.unseen(-1)), totals.parent_discount, rng) if sweep else (guests > 0).astype(np.int64)
        per_context[:CLASSES] += tables.sum(axis=0)
        totals.history.append((per_context, parent_tables + float(parent.sum())))
        room = STRENGTH + per_context.sum()
        totals.hot_shared.append((guests - totals.parent_discount * parent + totals.unseen(-1)) / room)
        if sweep > BURN_IN:
            shared = totals.hot_shared[-1][:, None]
            totals.hot_chance += predicted(count, tables, customers, per_context[:CLASSES], shared, totals.discount) / SAMPLES
    return shares


def scored(documents: DataFrame, held_out: Column, seed: int = 5) -> DataFrame:
    """Score every document by a model of those that are not held out.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (add-one unigrams) and score (log10
    probability by the model); perplexity is 10 ** (-score / n_tokens).
    """
    spark = documents.sparkSession
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(held_out, F.lit(True)).alias("held"),
    )
    often = rows.select("text").mapInArrow(_frequent, "name long, n long").groupBy("name").agg(F.sum("n").alias("n"))
    often = stage(often, "pitman-yor-frequent")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    everything = F.broadcast(often.where("name = 0").select(F.col("n").alias("total")))
    # at most 512 words have the share
    hot = [r["name"] for r in often.where("name <> 0").join(everything, F.expr(f"n * {2 * HOT_SHARE} >= total")).collect()]
    totals = Totals(parts=max(1, -(-size // PART_BYTES)), hot=np.sort(np.array(hot, dtype=np.int64).view(np.uint64)))
    # the choice of contexts with a number saves room and changes nothing else
    common = often.where("name <> 0").orderBy(F.desc("n"), "name").limit(NAMED - 1).select("name").collect()
    common = np.append(START, np.array([r["name"] for r in common], dtype=np.int64).view(np.uint64))

    packed = rows.mapInArrow(_blocks(totals.parts, totals.hot, spark.sparkContext.broadcast(common)), BLOCK)
    gathered = packed.groupBy("part").agg(F.collect_list(F.struct("block", "payload", "docs")).alias("blobs"))
    with shuffles_freed(spark):
        parts = stage_by(gathered, "part", "pitman-yor-parts", **PACKED)
        shares = learn(parts, totals, seed)
    partial = _over_parts(_beside(parts.where("part >= 0"), shares), totals, _score(seed), _PARTIAL)
    lists = parts.where("part < 0").select(F.explode("blobs").alias("b")).select("b.block", "b.docs")
    together = partial.unionByName(lists, allowMissingColumns=True)
    out = together.groupBy("block").applyInArrow(
        _gather, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    return out.withColumn("train_tokens", F.lit(totals.tokens).cast("long"))


def _discount(ones: float, twos: float) -> float:
    """The usual estimate of a discount from how many counts are one and two."""
    return float(np.clip(ones / (ones + 2 * twos), 0.05, 0.95)) if ones else 0.5
