"""Substring dedup by recompression: rounds that name runs and pairs of tokens alike wherever they occur.

A round first names each maximal run of one symbol, then each pair of neighbours of which the first falls in the left
and the second in the right half of the alphabet. A name is a 64-bit fingerprint of what it stands for, so the rounds
give the same symbol to the same run or pair in every task and document without a dictionary. Equal substrings get
equal symbols but for a few at either end, where the words outside could have mattered. For every window the rounds
track which symbols are certain, that is, fixed by the words of the window alone; the certain triple of symbols with
the smallest fingerprint is the window's anchor. Windows too uniform to keep three certain symbols use their words.

Defined results: null text has no words; repeated rows are copies only if their ids differ, a document never repeats
itself; texts shorter than a window keep everything; rows without an id keep everything; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from tagtrend.llm import repeats
from tagtrend.llm.repeats import repeated_spans, window_starts
from tagtrend.llm.words import Words, mix, runs

WIDTH = 50
ROUNDS = 4


def _round(symbols: np.ndarray, doc: np.ndarray, low: np.ndarray, high: np.ndarray, seed: int):
    """One round: new symbols and their documents, and the certain range [low, high) of each window in them."""
    breaks = np.flatnonzero(np.diff(doc)) + 1
    begin, length = runs(symbols, breaks)
    run_of = np.zeros(len(symbols) + 1, dtype=np.int64)
    run_of[begin[1:]] = 1
    run_of = np.cumsum(run_of)
    run_of[-1] = len(begin)
    named = symbols[begin]
    long = length > 1
    named[long] = mix(named[long] ^ mix(length[long].astype(np.uint64), 11), 2 * seed)
    doc = doc[begin]
    # the run at either end may go on outside the window
    low, high = run_of[np.minimum(low, len(symbols))] + 1, run_of[np.maximum(high - 1, 0)]

    right = np.append((mix(named, 1000 + seed) >> np.uint64(63)).astype(bool), True)
    pair = np.zeros(len(named) + 1, dtype=bool)
    pair[: len(named) - 1] = ~right[: len(named) - 1] & right[1 : len(named)] & (doc[1:] == doc[:-1])
    starts = np.ones(len(named) + 1, dtype=bool)
    starts[1:] = ~pair[:-1]
    new_of = np.cumsum(starts) - 1  # of the symbol that covers each position; past the end: their number
    low = np.minimum(low, len(named))
    low = np.minimum(low + (right[low] & (low < len(named))), len(named))
    high = np.maximum(high, 0)
    high = high - ((high > 0) & ~right[np.maximum(high - 1, 0)])
    first = np.flatnonzero(starts[:-1])
    paired = pair[first]
    out = named[first]
    out[paired] = mix(out[paired] + mix(named[first[paired] + 1], 7), 2 * seed + 1)
    return out, doc[first], new_of[low], new_of[np.maximum(high, 0)]


def _triples(symbols: np.ndarray, seed: int) -> np.ndarray:
    if len(symbols) < 3:
        return np.zeros(0, dtype=np.uint64)
    return mix(mix(mix(symbols[:-2], seed) ^ symbols[1:-1], 3) ^ symbols[2:], 5)


def _range_min(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Minimum of values[low:high] for many non-empty ranges, by minima over powers of two."""
    out = np.zeros(len(low), dtype=values.dtype)
    if not len(low):
        return out
    size = high - low
    power = np.frexp(size)[1] - 1
    table = values
    for p in range(int(power.max()) + 1):
        if p:
            half = 1 << (p - 1)
            table = np.minimum(table[:-half], table[half:])
        mine = np.flatnonzero(power == p)
        out[mine] = np.minimum(table[low[mine]], table[high[mine] - (1 << p)])
    return out


def anchors(words: Words, width: int = WIDTH, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Key, document, first window and number of windows of each anchor in a slice of texts."""
    at, of = window_starts(words, width)
    if not len(at):
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none, none
    symbols, doc, low, high = words.names, of, at, at + width
    for seed in range(rounds):
        symbols, doc, low, high = _round(symbols, doc, low, high, seed)
    key = np.zeros(len(at), dtype=np.uint64)
    enough = high - low >= 3
    key[enough] = _range_min(_triples(symbols, 101), low[enough], high[enough] - 2)
    rest = ~enough
    key[rest] = _range_min(_triples(words.names, 102), at[rest], at[rest] + width - 2)
    key = mix(key, 9)
    begin, n = runs(key, np.flatnonzero((np.diff(at) > 1) | (np.diff(of[at]) > 0)) + 1)
    return key[begin], of[at[begin]], at[begin], n


def substring_dedup(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """Words of each document covered by `width` words that also stand in a document with a smaller doc_id.

    Returns doc_id, n_words, n_removed, kept_sha256, the removed spans [first, last) in words, and the kept text.
    """
    if width < 3:
        raise ValueError("a window has three words or more")
    return repeated_spans(documents, lambda words: anchors(words, width), width, "recompression")


def without_repeats(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents with those words cut out; documents of which nothing is left go."""
    if width < 3:
        raise ValueError("a window has three words or more")
    return repeats.without_repeats(documents, lambda words: anchors(words, width), width, "recompression")
