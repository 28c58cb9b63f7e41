"""Suffix and recompression dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from tagtrend.llm import recompression, suffixes
from tagtrend.llm.recompression import substring_dedup, without_repeats
from tagtrend.llm.suffixes import suffix_dedup
from tagtrend.llm.words import words_of

OPERATORS = [substring_dedup, suffix_dedup]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, width):
    words = [(d, WORD.findall(t or "")) for d, t in rows]
    first = {}
    for d, w in words:
        if d is not None:
            for i in range(len(w) - width + 1):
                k = tuple(w[i : i + width])
                first[k] = min(first.get(k, d), d)
    out = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - width + 1):
            if d is not None and first[tuple(w[i : i + width])] < d:
                gone.update(range(i, i + width))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((d, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def found(frame):
    return sorted((tuple(r) for r in frame.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()), key=repr)


def passages(seed, count, alphabet, length):
    rng = random.Random(seed)
    shared = [[rng.choice(alphabet) for _ in range(rng.randint(8, 40))] for _ in range(6)]
    rows = []
    for i in range(count):
        words = [rng.choice(alphabet) for _ in range(rng.randint(0, length))]
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(words))
            words[at:at] = rng.choice(shared)
        rows.append((i, " ".join(words)))
    return rows + [(count, rows[3][1]), (count + 1, rows[3][1] + " tail")]


@pytest.mark.parametrize("operator", OPERATORS)
@pytest.mark.parametrize("alphabet", ["ab", "abcdefghijklmnopqrstuvwxyz"])
def test_against_brute_force(spark, operator, alphabet, tiny_batches):
    rows = passages(len(alphabet), 60, list(alphabet), 60)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert found(operator(frame, 12)) == brute(rows, 12)


@pytest.mark.parametrize("operator", OPERATORS)
def test_awkward_rows(spark, operator, awkward, nothing, clashing):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    assert found(operator(awkward, 10)) == brute(rows, 10)
    assert operator(nothing).count() == 0
    assert found(operator(clashing, 10)) == brute([(r["doc_id"], r["text"]) for r in clashing.collect()], 10)


@pytest.mark.parametrize("operator", OPERATORS)
def test_a_passage_that_most_documents_share(spark, operator, tiny_batches):
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, f"a{i} b{i} {passage} c{i} d{i}") for i in range(80)]
    result = operator(spark.createDataFrame(rows, "doc_id long, text string"))
    assert {r["doc_id"]: r["n_removed"] for r in result.collect()} == {i: 60 if i else 0 for i in range(80)}
    spans = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in result.collect()}
    assert spans[0] == [] and spans[7] == [(2, 62)]


def test_kept_text_keeps_what_stands_around(spark, clashing, nothing):
    rows = [(1, "x a b c d e y", "k"), (2, "  p\ta b  c\nd e\n\nq ", "k"), (3, "a b c d e", "k"), (4, "", None), (5, None, None)]
    out = {r["doc_id"]: (r["text"], r["spans"]) for r in without_repeats(spark.createDataFrame(rows, "doc_id long, text string, spans string"), 5).collect()}
    assert out == {1: ("x a b c d e y", "k"), 2: ("  p\t\n\nq ", "k"), 4: ("", None), 5: ("", None)}
    assert without_repeats(clashing, 10).columns == clashing.columns
    assert without_repeats(nothing).count() == 0


@pytest.mark.parametrize("find", [recompression.anchors, suffixes.anchors])
@pytest.mark.parametrize("alphabet", [1, 2, 3, 50])
def test_equal_windows_have_equal_anchors(find, alphabet):
    """Whatever stands around a window, its anchor is the same, and every window has one."""
    rng, width = np.random.default_rng(alphabet), 50
    for _ in range(30):
        core = rng.integers(0, alphabet, rng.integers(50, 90)).tolist()
        texts = [" ".join(map(str, rng.integers(0, alphabet, rng.integers(0, 30)).tolist() + core + rng.integers(0, alphabet, rng.integers(0, 30)).tolist())) for _ in range(4)]
        words = words_of(pa.array(texts))
        key, doc, start, n = find(words)
        of = {}
        for k, s, m in zip(key.tolist(), start.tolist(), n.tolist(), strict=True):
            of.update(dict.fromkeys(range(s, s + m), k))
        seen = {}
        for i in range(len(texts)):
            part = words.text(i)
            for s in range(part.start, part.stop - width + 1):
                assert seen.setdefault(words.names[s : s + width].tobytes(), of[s]) == of[s]


def test_parameters(awkward):
    with pytest.raises(ValueError):
        substring_dedup(awkward, 2)
