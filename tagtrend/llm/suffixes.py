"""Substring dedup by a sparse suffix array: suffixes at minimiser positions, sorted, neighbours compared.

A suffix is kept at the position of the smallest `k`-word fingerprint among the first `reach` positions of a window,
so every window holds a kept suffix that begins in it and has at least `width - reach + 1` words left in it. Suffixes
are ordered by the name (a hash) of that many first words; neighbours with equal names propose the windows that they
stand for, which are then compared by content. No match is extended.

Defined results are those of `recompression`: null text has no words, short texts and rows without an id keep
everything, a document does not repeat itself, other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from tagtrend.llm.repeats import repeated_spans, window_starts
from tagtrend.llm.words import Words, runs, span_hash, window_hash

WIDTH = 50
GRAM = 8
REACH = 24


def _first_smallest(values: np.ndarray, reach: int) -> np.ndarray:
    """Position of the leftmost smallest of values[i : i + reach], for each i with a whole range."""
    best, size = np.arange(len(values)), 1
    while size < reach:
        step = min(size, reach - size)
        a, b = best[:-step], best[step:]
        best = np.where(values[b] < values[a], b, a)
        size += step
    return best


def anchors(words: Words, width: int = WIDTH, gram: int = GRAM, reach: int = REACH):
    """Key, document, first window and number of windows of each kept suffix in a slice of texts."""
    at, of = window_starts(words, width)
    none = np.zeros(0, dtype=np.int64)
    if not len(at):
        return none.astype(np.uint64), none, none, none
    grams = window_hash(words.names, gram, 2)
    position = _first_smallest(grams, reach)[at]
    begin, n = runs(position)
    suffix = position[begin]
    key = span_hash(words.names, suffix, suffix + (width - reach + 1), 0)
    return key, of[at[begin]], at[begin], n


def suffix_dedup(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """Words of each document covered by `width` words that also stand in a document with a smaller doc_id.

    Returns doc_id, n_words, n_removed, kept_sha256, the removed spans [first, last) in words, and the kept text.
    """
    gram, reach = min(GRAM, width // 2), min(REACH, width // 2)
    return repeated_spans(documents, lambda words: anchors(words, width, gram, reach), width, "suffixes")
