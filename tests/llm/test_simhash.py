"""Fingerprints, balls, components and near copies against brute force."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from tagtrend.llm import simhash
from tagtrend.llm.components import components
from tagtrend.llm.simhash import ball, hexadecimal, links, majority, near_duplicates, one_of_each, shingle_hashes, xxh64
from tagtrend.llm.words import LOWER, words_of

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def brute_print(text, shingle=3):
    words = WORD.findall((text or "").encode().translate(LOWER.tobytes()))
    if not words:
        return 0
    grams = [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, pairs):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_xxh64_of_any_length():
    rng = random.Random(1)
    parts = [bytes(rng.randrange(256) for _ in range(n)) for n in [*range(0, 100), 255, 256, 1000]]
    data = np.frombuffer(b"".join(parts), dtype=np.uint8)
    ends = np.cumsum([len(p) for p in parts])
    got = xxh64(data, ends - [len(p) for p in parts], ends)
    assert got.tolist() == [xxhash.xxh64_intdigest(p, 42) for p in parts]


def test_fingerprints_against_brute_force():
    rng = random.Random(2)
    texts = ["".join(rng.choices(["a", "B", "é", " ", "\n", "cc", " ", "Ä"], k=rng.randint(0, 60))) for _ in range(300)] + [None, "", " "]
    got = majority(*shingle_hashes(words_of(pa.array(texts), lower=True), 3))
    assert got.tolist() == [brute_print(t) for t in texts]


def test_links_find_every_pair_within_the_radius(spark):
    rng = random.Random(3)
    prints = [0, (1 << 64) - 1]
    for _ in range(40):
        base = rng.getrandbits(64)
        prints += [base ^ sum(1 << b for b in rng.sample(range(64), k)) for k in (0, 1, 2, 3, 4)]
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    frame = spark.createDataFrame(signed, "fingerprint long")
    for radius in (0, 2, 4):
        got = {tuple(r) for r in links(frame, radius).collect()}
        nodes = sorted({s for s, in signed})
        near = [(a, b) for a in nodes for b in nodes if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= radius]
        assert all(((a ^ b) & (2**64 - 1)).bit_count() <= radius for a, b in got)
        assert roots(nodes, got) == roots(nodes, near)
    assert len(ball(1)) == 65 and len(set(ball(2))) == 1 + 64 + 64 * 63 // 2
    with pytest.raises(ValueError):
        links(frame, 3)


def test_components(spark):
    rng = random.Random(4)
    pairs = [(i, i + 1) for i in range(1000, 1060)] + [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(5, 5), (None, 3), (7, None)]
    pairs += [(500, 500 + i) for i in range(1, 90)]
    frame = spark.createDataFrame(pairs, "a long, b long")
    whole = [(a, b) for a, b in pairs if a is not None and b is not None and a != b]
    want = {n: r for n, r in roots({x for p in whole for x in p}, whole).items() if n != r}
    assert {r["node"]: r["root"] for r in components(frame, "a", "b", "test").collect()} == want
    assert components(frame.where("a < 0"), "a", "b", "test").count() == 0


def test_near_duplicates(spark, awkward, nothing, clashing):
    for frame in (awkward, clashing):
        rows = [(r["doc_id"], r["text"]) for r in frame.collect()]
        prints = [brute_print(t) for _, t in rows]
        pairs = [(a, b) for a in set(prints) for b in set(prints) if (a ^ b).bit_count() <= 2]
        root = roots(set(prints), pairs)
        lowest = {}
        for (d, _), p in zip(rows, prints, strict=True):
            if d is not None:
                lowest[root[p]] = min(lowest.get(root[p], d), d)
        want = sorted(((d, f"{p:016x}", lowest[root[p]]) for (d, _), p in zip(rows, prints, strict=True)), key=repr)
        result = near_duplicates(frame).select("doc_id", hexadecimal("fingerprint").alias("f"), "component_id")
        assert sorted((tuple(r) for r in result.collect()), key=repr) == want
    assert near_duplicates(nothing).count() == 0


def kept_by_brute_force(rows):
    """The first row by (id, none last) of every component of fingerprints."""
    prints = [brute_print(t) for _, t in rows]
    distinct = sorted(set(prints))
    root = roots(distinct, [(a, b) for a in distinct for b in distinct if (a ^ b).bit_count() <= 2])
    best = {}
    for (d, _), p in zip(rows, prints, strict=True):
        best[root[p]] = min(best.get(root[p], (True, 0)), (d is None, d or 0))
    return sorted((not none, d) for none, d in best.values())


def test_one_of_each_keeps_the_first_of_every_component(spark, tiny_batches):
    rng = random.Random(5)
    vocabulary = [f"v{i}" for i in range(3000)]
    rows = []
    for _ in range(30):
        base = [rng.choice(vocabulary) for _ in range(200)]
        rows.append(" ".join(base))
        for edits in (0, 1, 2, 60):
            copy = list(base)
            for at in rng.sample(range(200), edits):
                copy[at] = rng.choice(vocabulary)
            rows.append(" ".join(copy))
    rows = list(enumerate(rows))
    rng.shuffle(rows)
    kept = one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((True, r["doc_id"]) for r in kept) == kept_by_brute_force(rows)
    assert len(kept) < 120


@pytest.mark.parametrize("limit", [simhash.MAX_BROADCAST, 0])
def test_one_of_each_of_awkward_rows(awkward, nothing, clashing, monkeypatch, limit):
    monkeypatch.setattr(simhash, "MAX_BROADCAST", limit)
    kept = one_of_each(awkward)
    assert kept.columns == awkward.columns
    # 2 and the row without an id are copies of 1; null, empty and blank texts are alike; so are 6 and 7; 10 is one document twice
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 6, 8, 9, 10, 10]
    assert one_of_each(awkward.where("doc_id IS NULL")).count() == 1
    assert one_of_each(nothing).count() == 0
    assert one_of_each(clashing).columns == clashing.columns


def test_rows_that_share_an_id_but_not_a_text_are_judged_apart(spark):
    rows = [(1, "a b c d e"), (2, "a b c d e"), (2, "quite another text stands here")]
    kept = one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["text"][0]) for r in kept) == [(1, "a"), (2, "q")]
