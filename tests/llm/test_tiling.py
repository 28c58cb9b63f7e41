"""Greedy string tiling against a naive search for the longest tile."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
from tagtrend.llm import tiling
from tagtrend.llm.tiling import decontaminate, matches, tiles, tiles_by_length
from tagtrend.llm.words import words_of


def naive(item, doc, seed):
    a_free, b_free, out = [True] * len(item), [True] * len(doc), []
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and a_free[i + n] and b_free[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < seed:
            return out
        out.append((i, j, n))
        a_free[i : i + n] = [False] * n
        b_free[j : j + n] = [False] * n


def test_tiles_are_those_of_the_naive_search():
    rng = random.Random(1)
    for _ in range(150):
        item = [rng.choice("abc") for _ in range(rng.randint(3, 25))]
        doc = [rng.choice("abc") for _ in range(rng.randint(3, 40))]
        for _ in range(2):
            at, n = rng.randrange(len(item)), rng.randint(3, 12)
            doc[rng.randrange(len(doc)) :][:0] = item[at : at + n]
            doc += item[at : at + n]
        names = [words_of(pa.array([" ".join(x)])).names for x in (item, doc)]
        places = [(i, j) for i in range(len(item) - 2) for j in range(len(doc) - 2) if item[i : i + 3] == doc[j : j + 3]]
        at = np.array(places, dtype=np.int64).reshape(-1, 2)
        assert tiles(*names, at[:, 0], at[:, 1], 3) == naive(item, doc, 3) == tiles_by_length(*names, 3)


def test_repetitive_texts_take_little_memory():
    """Six hundred million pairs of places agree; texts and items are found as with few."""
    item = tiling.Items([1, 2], [" ".join(["ha"] * 2000), " ".join(f"w{i}" for i in range(40))], 5)
    texts = [" ".join(["ha"] * 300_000), "nothing of it", " ".join([*(f"w{i}" for i in range(40)), *["ha"] * 1300])]
    tracemalloc.start()
    found = {(d, i): (n, t) for d, i, n, t in tiling._search(item, words_of(pa.array(texts), lower=True), 5, 0.6)}
    assert tracemalloc.get_traced_memory()[1] < 300 << 20
    tracemalloc.stop()
    assert found == {(0, 0): (2000, [(0, 0, 2000)]), (2, 1): (40, [(0, 0, 40)]), (2, 0): (1300, [(0, 40, 1300)])}


def test_chunks_and_lengths_change_nothing(monkeypatch):
    rng = random.Random(4)
    texts = [" ".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) for _ in range(30)]
    item = tiling.Items(list(range(8)), [" ".join(rng.choice("ab") for _ in range(rng.randint(4, 20))) for _ in range(8)], 5)
    words = words_of(pa.array(texts), lower=True)
    whole = list(tiling._search(item, words, 5, 0.6))
    monkeypatch.setattr(tiling, "CHUNK_HITS", 3)
    monkeypatch.setattr(tiling, "PAIR_HITS", 0)
    assert whole and list(tiling._search(item, words, 5, 0.6)) == whole


ITEM = [f"t{i}" for i in range(30)]


def test_reordered_and_edited_passages(spark):
    moved = ITEM[20:] + ["x"] + ITEM[:10] + ["y", "z"] + ITEM[10:20]
    rows = [
        (1, " ".join(["a", "b", *ITEM, "c"]).upper()), (2, " ".join(moved)), (3, " ".join(ITEM[:12] + ["q"] * 50)),
        (4, "nothing to see here at all"), (5, " ".join([*ITEM[:9], "#", *ITEM[10:]])), (6, " ".join(ITEM[::-1])), (None, " ".join(ITEM)),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    bench = spark.createDataFrame(
        [(7, " ".join(ITEM)), (8, "too short"), (9, None), (10, "some other item that nobody has copied yet"), (11, " ".join(ITEM))], "item_id long, text string"
    )
    whole = matches(docs, bench)
    got = {(r["doc_id"], r["item_id"]): (r["n_covered"], len(r["tiles"])) for r in whole.collect()}
    one = {1: (30, 1), 2: (30, 3), 5: (29, 2), None: (30, 1)}
    assert got == {(d, i): x for d, x in one.items() for i in (7, 11)}
    blocks = matches(docs, bench, block_words=5)
    assert sorted(map(repr, blocks.collect())) == sorted(map(repr, whole.collect()))
    assert sorted(r["doc_id"] for r in decontaminate(docs, bench).collect()) == [3, 4, 6]


def test_awkward_rows(spark, awkward, nothing, clashing):
    bench = spark.createDataFrame([(1, "one two three four five six seven eight"), (2, "ha ha ha ha ha ha"), (None, "straße, 東京")], "item_id long, text string")
    got = sorted(((r["doc_id"], r["item_id"]) for r in matches(awkward, bench).collect()), key=repr)
    assert got == sorted([(1, 1), (2, 1), (None, 1), (6, 2), (7, 2)], key=repr)
    assert sorted(r["doc_id"] for r in decontaminate(awkward, bench).collect()) == [3, 4, 5, 8, 9, 10, 10]
    assert matches(nothing, bench).count() == 0 and matches(awkward, bench.where("item_id > 5")).count() == 0
    assert decontaminate(clashing, bench).columns == clashing.columns
