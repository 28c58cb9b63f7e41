"""Every context of the Pitman-Yor model has a restaurant of its own, whether it goes by a number or by its name."""

import math
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tagtrend.llm import pitman_yor
from tagtrend.llm.store import stage_by

ROW = "doc_id long, text string, held boolean"


def named(words):
    return [int(pitman_yor.token_names(pa.array([w]))[0][0]) for w in words]


def learned(spark, rows, hot, common):
    """What the parts share, and each part with what it was answered; only the words in `common` go by a number."""
    totals = pitman_yor.Totals(parts=9, hot=np.sort(np.array(named(hot), dtype=np.uint64)))
    numbers = np.array([pitman_yor.START, *named(common)], dtype=np.uint64)
    run = pitman_yor._blocks(totals.parts, totals.hot, spark.sparkContext.broadcast(numbers))
    packed = spark.createDataFrame(rows, ROW).repartition(1).mapInArrow(run, pitman_yor.BLOCK)
    gathered = stage_by(packed.groupBy("part").agg(F.collect_list(F.struct("block", "payload", "docs")).alias("blobs")), "part")
    shares = pitman_yor.learn(gathered, totals, 5)
    found = []
    table = pitman_yor._beside(gathered.where("part >= 0"), shares).toArrow()
    for i in range(table.num_rows):
        part = pitman_yor.Part(table.column("blobs")[i].values, totals.hot)
        part.shares = pitman_yor.Shares.of(table.column("shares")[i].values)
        part.context_names = [int(numbers[c] if c < pitman_yor.NAMED else part.named[c - pitman_yor.NAMED]) for c in part.context_of]
        found.append((table.column("part")[i].as_py(), part))
    return totals, numbers, found


@pytest.mark.parametrize("n_hot", [0, 2])
def test_chances_add_up_to_one_after_every_word(spark, n_hot):
    rng = np.random.default_rng(3)
    words = [f"w{i}" for i in range(12)]  # the last is unknown
    rows = [(i, " ".join(rng.choice(words[:11], 6)), False) for i in range(300)]
    rows += [(1000 + i, f"{a} {b}", True) for i, (a, b) in enumerate(product(words, words))] + [(5000, "", True)]
    totals, _, parts = learned(spark, rows, words[1:6:4][:n_hot], words[:2])
    chance = defaultdict(dict)
    for number, part in parts:
        part.doc = np.arange(len(part.doc))
        sums = pitman_yor.Sums()
        list(pitman_yor._score(5)(number, part, totals, sums))
        (_, score, _, _), = sums.blocks.values()
        for p, one in zip(part.pair, score, strict=True):
            chance[part.context_names[p]][int(part.words[part.word_of[p]])] = 10**one
    assert len(chance) == 13 and all(len(x) == 13 for c, x in chance.items())
    assert all(abs(sum(x.values()) - 1) < 1e-9 for x in chance.values())


def test_totals_of_a_context_are_those_of_its_word(spark):
    """Customers and first tables against counting; later seatings have no fewer tables and no more than customers."""
    rng = np.random.default_rng(4)
    texts = [" ".join(f"v{x}" for x in rng.integers(0, 60, 30) ** 2) for _ in range(400)]
    texts += [f"once{i} v{i % 5}" for i in range(1500)]
    totals, numbers, parts = learned(spark, [(i, t, i % 9 == 0) for i, t in enumerate(texts)], ["v0"], ["v1", "v4", "v9"])
    customers, followers = Counter(), defaultdict(set)
    for i, t in enumerate(texts):
        tokens, before, _ = (x.tolist() for x in pitman_yor.token_names(pa.array([t])))
        for a, b in zip(before, tokens, strict=True):
            customers[a] += i % 9 != 0
            followers[a] |= {b} if i % 9 else set()
    seen = {}
    for _, part in parts:
        shares = part.shares
        assert len(shares.customers) == len(part.named) and len(shares.tables) == 1 + pitman_yor.BURN_IN + pitman_yor.SAMPLES
        for i, name in enumerate(part.named.tolist()):
            one = (int(shares.customers[i]), *(int(t[i]) for t in shares.tables))
            assert seen.setdefault(name, one) == one
    for i, name in enumerate(numbers.tolist()):
        seen[name] = (int(totals.customers[i]), *(int(t[i]) for t, _ in totals.history))
    assert len(seen) > 1500 and seen.keys() == customers.keys()
    for name, (n, first, *later) in seen.items():
        assert n == customers[name] and first == len(followers[name])
        assert all(first <= t <= n for t in later)
    assert sum(t[1] for t in seen.values()) == totals.history[0][0].sum()
    assert all(sum(t[1 + s] for t in seen.values()) == x.sum() for s, (x, _) in enumerate(totals.history))


def test_many_contexts_are_told_apart(spark):
    """6,001 contexts, each with one follower: a fixed number of classes would mix several."""
    rows = [(i, f"a{i % 3000} b{i % 3000}", False) for i in range(12_000)]
    found = pitman_yor.scored(spark.createDataFrame(rows, ROW), F.col("held")).agg(F.avg("score"), F.count("*")).first()
    assert found[1] == 12_000 and found[0] + math.log10(3000) > math.log10(0.25)
