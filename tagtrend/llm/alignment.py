"""Alignment of two tokenizers' ids over one text, by the byte offsets at which tokens of both end.

For each text the cumulative ends of either id list go into an end-to-index dictionary. The intersection of their key
sets, sorted, slices both lists into groups that stand for the same bytes; within a slice the tokens that end with it
are linked. Links are counted over the corpus, so that every link can be told from the best one of its second token.

The first tokenizer is a byte-level BPE that reads a space and the text, the second a piece model that puts the space
there itself. Neither joins what stands before a space that follows solid characters to what stands behind it (for the
piece model this is read off its pieces, for the first off its kind), so texts are cut there, and every distinct part
of a slice is encoded and aligned once. Other tokenizers get whole texts.

One token's bytes end with the other's where both end together. So only pairs of which one is a suffix of the other
can be linked: they are listed from the vocabularies, each token has at most as many partners as it has bytes, and the
corpus counts are one array over them, whose size no corpus changes. Tasks add up their own, Spark adds those.

Defined results: a text that is null or empty, or whose ids do not spell the space and the text, has no tokens and no
groups; rows without an id, repeated rows and rows that share an id are aligned like others; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagtrend.llm.store import stage
from tagtrend.llm.words import BYTE_VALUE, bytes_of, slices, span_hash

SLICE_BYTES = 2 << 20
CALL_BYTES = 1 << 16
_SPACE = "▁"
_MARK = _SPACE.encode()
# bytes that surely end a character which is no white space
_SOLID = np.zeros(256, dtype=bool)
_SOLID[0x21:0x7F] = True
_SOLID[0x80:] = True
_SOLID[[0x85, 0xA0, *range(0x80, 0x8B), 0xA8, 0xA9, 0xAF, 0x9F]] = False
# what byte-level vocabularies write for a byte: itself where it is visible, otherwise a letter from 256 on
_VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE = {chr(b): b for b in _VISIBLE} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(_VISIBLE))}

_NONE = np.zeros(0, dtype=np.int64)


def group_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where both lists are cut: the number of tokens of each up to every byte offset at which both have an end."""
    size = max(int(ends_a[-1]) if len(ends_a) else 0, int(ends_b[-1]) if len(ends_b) else 0) + 1
    index_a, index_b = np.zeros(size, dtype=np.int64), np.zeros(size, dtype=np.int64)
    index_a[ends_a] = np.arange(1, len(ends_a) + 1)
    index_b[ends_b] = np.arange(1, len(ends_b) + 1)
    common = np.flatnonzero((index_a > 0) & (index_b > 0))
    return index_a[common], index_b[common]


def linked(ends_a: np.ndarray, ends_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The pairs that end together, as positions in either list, and the group of each: in each slice the tokens that
    end with it, commonly the last of each; tokens without bytes end where their neighbour does."""
    left = np.maximum(np.searchsorted(ends_a, ends_a[cut_a - 1]), np.append(0, cut_a[:-1])[: len(cut_a)])
    right = np.maximum(np.searchsorted(ends_b, ends_b[cut_b - 1]), np.append(0, cut_b[:-1])[: len(cut_b)])
    wide = cut_b - right
    count = (cut_a - left) * wide
    group = np.repeat(np.arange(len(cut_a)), count)
    at = np.arange(len(group)) - np.repeat(np.cumsum(count) - count, count)
    return left[group] + at // wide[group], right[group] + at % wide[group], group


@dataclass
class Found:
    """Parts in a row: which they are, whether their ids spell them, and per part its rows in each list of numbers."""

    parts: np.ndarray
    good: np.ndarray
    counts: list[np.ndarray]  # per list: rows of each part
    rows: list[np.ndarray]  # ids of both, group ends and links (pairs of positions in the part), kinds of the links
    texts: list[bytes]


def _digits(size: int, mark: str) -> np.ndarray:
    """Each number below `size` in decimal with a mark behind it, filled up with zero bytes."""
    return np.array([f"{i}{mark}" for i in range(size)], dtype="S").view(np.uint8).reshape(size, -1) if size else np.zeros((0, 1), dtype=np.uint8)


class Aligner:
    """Both tokenizers, the bytes of their tokens, and the pairs that can be linked."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        names = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.bytes_a = [_unmapped(names.get(i, "")) for i in range(max(names, default=-1) + 1)]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.cuts = self._parts_stand_alone(pieces)
        self.kinds = self._linkable()
        self.flat_a, self.flat_b = _flat(self.bytes_a), _flat(self.bytes_b)
        # by list and by whether a token ends its group
        self.digits = [[_digits(len(self.bytes_a), ","), _digits(len(self.bytes_a), "|")], [_digits(len(self.bytes_b), ","), _digits(len(self.bytes_b), ";")]]

    def _parts_stand_alone(self, pieces: list[str]) -> bool:
        inner = any(_SPACE in p.lstrip(_SPACE) for p in pieces)
        prefixed = [self.bytes_b[i] for i in self.b.encode("a  b ")] == [self.bytes_b[i] for i in self.b.encode("a")] + [
            self.bytes_b[i] for i in self.b.encode(" b ")
        ]
        kind = self.a.pre_tokenizer and type(self.a.pre_tokenizer).__name__ == "ByteLevel" and self.a.pre_tokenizer.use_regex
        return bool(kind and self.a.normalizer is None and not inner and prefixed and self.b.encode("") == [])

    def _linkable(self) -> np.ndarray:
        """All pairs of tokens of which one's bytes are a suffix of the other's, as sorted numbers a * size + b."""
        of_b: dict[bytes, list[int]] = {}
        for i, x in enumerate(self.bytes_b):
            of_b.setdefault(x, []).append(i)
        of_a: dict[bytes, list[int]] = {}
        for i, x in enumerate(self.bytes_a):
            of_a.setdefault(x, []).append(i)
        n = len(self.bytes_b)
        pairs = [i * n + j for i, x in enumerate(self.bytes_a) for k in range(len(x) + 1) for j in of_b.get(x[k:], ())]
        pairs += [i * n + j for j, x in enumerate(self.bytes_b) for k in range(1, len(x) + 1) for i in of_a.get(x[k:], ())]
        return np.unique(np.array(pairs, dtype=np.int64))

    def found(self, parts: list[bytes]) -> list[Found]:
        """The groups and links of all parts, from calls of a bounded size."""
        out, call, size = [], [], 0
        for i in [*range(len(parts)), -1]:
            if call and (i < 0 or size + len(parts[i]) > CALL_BYTES):
                out.append(self.call(np.array(call), [parts[k] for k in call]))
                call, size = [], 0
            if i >= 0:
                part = parts[i]
                # alone: what may join the part behind it, or have ids that do not spell it
                if not self.cuts or not _SOLID[part[-1]] or _MARK in part or 0 in part:
                    out.append(self.call(np.array([i]), [part]))
                else:
                    call.append(i)
                    size += len(part)
        return out

    def call(self, which: np.ndarray, parts: list[bytes]) -> Found:
        """Parts in a row, each beginning with the space, encoded as one text."""
        raw = b"".join(parts)
        whole, data = raw.decode(), np.frombuffer(raw, dtype=np.uint8)
        ids_a = np.array(self.a.encode_batch_fast([whole], add_special_tokens=False)[0].ids, dtype=np.int64)
        ids_b = np.array(self.b.encode(whole[1:]), dtype=np.int64)
        ends = []
        for ids, (bytes_, begin, size) in ((ids_a, self.flat_a), (ids_b, self.flat_b)):
            total = np.cumsum(size[ids])
            spelled = len(total) > 0 and total[-1] == len(data)
            if spelled:
                at = np.arange(len(data)) + np.repeat(begin[ids] - (total - size[ids]), size[ids])
                spelled = np.array_equal(bytes_[at], data)
            if not spelled:
                none = np.zeros(len(parts), dtype=np.int64)
                return Found(which, none.astype(bool), [none] * 5, [_NONE, _NONE, np.zeros((0, 2)), np.zeros((0, 2)), _NONE], [b""] * len(parts))
            ends.append(total)
        part_ends = np.cumsum([len(p) for p in parts])
        cut_a, cut_b = group_ends(*ends)
        of_group = np.searchsorted(part_ends, ends[0][cut_a - 1])
        groups = np.bincount(of_group, minlength=len(parts))
        last = np.cumsum(groups) - 1
        up_to_a, up_to_b = cut_a[last], cut_b[last]
        left, right, group = linked(*ends, cut_a, cut_b)
        kinds = np.searchsorted(self.kinds, ids_a[left] * len(self.bytes_b) + ids_b[right])
        links = np.bincount(of_group[group], minlength=len(parts))
        zero_a, zero_b = up_to_a - np.diff(up_to_a, prepend=0), up_to_b - np.diff(up_to_b, prepend=0)
        own_cuts = np.stack([cut_a - zero_a[of_group], cut_b - zero_b[of_group]], axis=1)
        own_links = np.stack([left - zero_a[of_group[group]], right - zero_b[of_group[group]]], axis=1)
        counts = [np.diff(up_to_a, prepend=0), np.diff(up_to_b, prepend=0), groups, links, links]
        return Found(which, np.ones(len(parts), dtype=bool), counts, [ids_a, ids_b, own_cuts, own_links, kinds], self._written(ids_a, ids_b, cut_a, cut_b, last))

    def _written(self, ids_a: np.ndarray, ids_b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray, last: np.ndarray) -> list[bytes]:
        """The groups of each part as text: a group's ids of both lists one behind the other."""
        ends = [np.zeros(len(ids), dtype=np.int64) for ids in (ids_a, ids_b)]
        ends[0][cut_a - 1] = ends[1][cut_b - 1] = 1
        of_a, of_b = np.cumsum(ends[0]) - ends[0], np.cumsum(ends[1]) - ends[1]
        width = max(x.shape[1] for pair in self.digits for x in pair)
        out = np.zeros((len(ids_a) + len(ids_b), width), dtype=np.uint8)
        places = np.arange(len(ids_a)) + np.append(0, cut_b)[of_a], np.arange(len(ids_b)) + cut_a[of_b]
        for place, ids, end, tables in zip(places, (ids_a, ids_b), ends, self.digits, strict=True):
            for mark, table in enumerate(tables):
                mine = end == mark
                out[place[mine], : table.shape[1]] = table[ids[mine]]
        length = np.count_nonzero(out, axis=1)
        stop = np.cumsum(length)[cut_a[last] + cut_b[last] - 1].tolist()
        text = out[out != 0].tobytes()
        return [text[a:b] for a, b in zip([0, *stop], stop, strict=False)]


def _flat(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The tokens' bytes one after the other, where each begins, and how many it has."""
    size = np.array([len(t) for t in tokens], dtype=np.int64)
    return np.frombuffer(b"".join(tokens), dtype=np.uint8), np.cumsum(size) - size, size


def _unmapped(token: str) -> bytes:
    """The bytes of a byte-level vocabulary entry."""
    return bytes(map(_BYTE.get, token)) if all(c in _BYTE for c in token) else token.encode()


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One per worker; Spark deals out the work, so its calls use one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Aligner(path_a, path_b)


class Aligned:
    """The distinct parts of a slice of texts, which of them stand in each text in order, and which texts have tokens."""

    def __init__(self, coder: Aligner, texts: pa.Array):
        empty = pc.fill_null(pc.equal(pc.binary_length(texts), 0), True)
        data, offsets = bytes_of(pc.if_else(empty, "", pc.binary_join_element_wise(" ", texts.fill_null(""), "")))
        cut = np.zeros(len(data) + 1, dtype=bool)
        if coder.cuts and len(data):
            cut[1:-1] = (data[1:] == 32) & _SOLID[data[:-1]]
        cut[offsets[1:][np.diff(offsets) > 0] - 1] = False  # a lone space at the end stays with what stands before
        cut[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(cut[:-1])
        ends = np.append(starts[1:], len(data))[: len(starts)]
        values = BYTE_VALUE[data]
        names, check = span_hash(values, starts, ends, 0), span_hash(values, starts, ends, 1)
        _, first, of = np.unique(names, return_index=True, return_inverse=True)
        if not np.array_equal(check[first][of], check):
            first = of = np.arange(len(names))
        raw = data.tobytes()
        found = coder.found([raw[a:b] for a, b in zip(starts[first].tolist(), ends[first].tolist(), strict=True)])
        text = np.searchsorted(offsets, starts, side="right") - 1
        # what each distinct part has in the lists, which stand in the order of the calls
        order = np.concatenate([_NONE, *(f.parts for f in found)])
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        self.count = [np.concatenate([_NONE, *(f.counts[i] for f in found)]) for i in range(5)]
        self.rows = [np.concatenate([f.rows[i] for f in found]) if found else np.zeros((0, 2) if i in (2, 3) else 0) for i in range(5)]
        self.written = [t for f in found for t in f.texts]
        spelled = np.concatenate([np.zeros(0, dtype=bool), *(f.good for f in found)])[place]
        good = np.ones(len(offsets) - 1, dtype=bool)
        good[text[~spelled[of]]] = False
        keep = good[text]
        self.of = place[of[keep]]
        self.first = np.searchsorted(text[keep], np.arange(len(good) + 1))

    def counts(self, which: int) -> np.ndarray:
        """How many rows of a list each text has."""
        return np.diff(np.concatenate([[0], np.cumsum(self.count[which][self.of])])[self.first])

    def numbers(self, which: int) -> np.ndarray:
        """One of the lists of all texts, one after the other."""
        size = self.count[which]
        begin, counts = (np.cumsum(size) - size)[self.of], size[self.of]
        total = np.concatenate([[0], np.cumsum(counts)])
        return self.rows[which][np.arange(total[-1]) + np.repeat(begin - total[:-1], counts)].astype(np.int32)

    def shifted(self, which: int) -> np.ndarray:
        """Pairs of token positions, counted within the text instead of the part."""
        pairs, counts = self.numbers(which), self.count[which][self.of]
        for side in (0, 1):
            before = np.concatenate([[0], np.cumsum(self.count[side][self.of])])
            at = before[:-1] - np.repeat(before[self.first[:-1]], np.diff(self.first))
            pairs[:, side] += np.repeat(at, counts).astype(np.int32)
        return pairs

    def digests(self) -> list[str]:
        """SHA-256 of each text's groups; nothing for a text without tokens."""
        texts, of, first = self.written, self.of.tolist(), self.first.tolist()
        joined = (b"".join([texts[k] for k in of[a:b]])[:-1] for a, b in zip(first, first[1:], strict=False))
        return [hashlib.sha256(x).hexdigest() if x else "" for x in joined]


def _lists(flat: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(flat).astype(np.int32, copy=False)))


def _pair_lists(pairs: np.ndarray, counts: np.ndarray) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    both = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(pairs[:, i])) for i in (0, 1)], names=["a", "b"])
    return pa.ListArray.from_arrays(pa.array(offsets), both)


ALIGNED = "doc_id long, ids_a array<int>, ids_b array<int>, group_ends array<struct<a:int,b:int>>, links array<struct<a:int,b:int>>"
_DIGEST = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, kinds array<int>"


def _texts(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def aligned(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row both id lists, the ends of the groups in them (exclusive), and the linked pairs of positions."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = aligner(path_a, path_b)
        for batch in slices(batches, limit=SLICE_BYTES):
            found = Aligned(coder, batch.column("text"))
            columns = [batch.column("doc_id"), *(_lists(found.numbers(i), found.counts(i)) for i in (0, 1)), *(_pair_lists(found.shifted(i), found.counts(i)) for i in (2, 3))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids_a", "ids_b", "group_ends", "links"])

    return _texts(documents).mapInArrow(run, ALIGNED)


def _digested(path_a: str, path_b: str):
    """Per row the numbers and the digest of its groups, and the kind of every link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = aligner(path_a, path_b)
        for batch in slices(batches, limit=SLICE_BYTES):
            found = Aligned(coder, batch.column("text"))
            columns = [
                batch.column("doc_id"), *(pa.array(found.counts(i)) for i in range(4)), pa.array(found.digests(), pa.string()),
                _lists(found.numbers(4), found.counts(4)),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "kinds"])

    return run


def _counted(size: int):
    """kind and n: the links of a task of each kind."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, dtype=np.int64)
        for batch in batches:
            total += np.bincount(batch.column("kinds").flatten().to_numpy(), minlength=size)
        kind = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(kind.astype(np.int32)), pa.array(total[kind])], names=["kind", "n"])

    return run


def _judged(shared):
    """Per row how many links are the best of their second token, and the sum of the links' counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = shared.value
        for batch in batches:
            lists = batch.column("kinds")
            kinds = lists.flatten().to_numpy()
            cuts = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
            sums = [np.diff(np.concatenate([[0], np.cumsum(x[kinds])])[cuts]) for x in (best.astype(np.int64), counts)]
            columns = [*batch.columns[:5], *map(pa.array, sums), batch.column("groups_sha256")]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return run


def link_counts(digested: DataFrame, size: int) -> np.ndarray:
    """Links of each kind over all rows. The array has one number per pair of the vocabularies that can be linked."""
    sums = digested.select("kinds").mapInArrow(_counted(size), "kind int, n long").groupBy("kind").agg(F.sum("n").alias("n"))
    found, counts = sums.toArrow(), np.zeros(size, dtype=np.int64)
    counts[found.column("kind").to_numpy()] = found.column("n").to_numpy()
    return counts


def digests(documents: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Per row its tokens, groups and links in numbers, the links that are the best of their second token over the
    corpus, the sum of the counts of its links, and the digest of its groups."""
    coder = aligner(path_a, path_b)
    whole = stage(_texts(documents).mapInArrow(_digested(path_a, path_b), _DIGEST), "aligned")
    counts = link_counts(whole, len(coder.kinds))
    of_b = coder.kinds % len(coder.bytes_b)
    highest = np.zeros(len(coder.bytes_b), dtype=np.int64)
    np.maximum.at(highest, of_b, counts)
    shared = documents.sparkSession.sparkContext.broadcast((counts, counts == highest[of_b]))
    kind = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return whole.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "kinds").mapInArrow(_judged(shared), kind)
