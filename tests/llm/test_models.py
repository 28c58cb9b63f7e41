"""Quality classifier, learned rules and Pitman-Yor scores: held-out accuracy and brute force."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tagtrend.llm import decision_list, pitman_yor, quality_model
from tagtrend.llm.queries import op6_quality_model, op8_decision_list, op10_pitman_yor

FOLDER = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
QUALITY = "doc_id long, quality int"


def crc(doc_id, modulus):
    return zlib.crc32(str(doc_id).encode()) % modulus


def test_classifier_on_held_out_labels(spark):
    found = {r["doc_id"]: r for r in op6_quality_model(spark, FOLDER).collect()}
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    assert len(found) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    held = [r for r in labels if crc(r["doc_id"], 3) == 1]
    assert all(found[r["doc_id"]]["held_out"] == (crc(r["doc_id"], 3) == 1) for r in labels)
    right = [found[r["doc_id"]]["predicted"] == r["quality"] for r in held]
    assert len(held) > 80 and np.mean(right) > 0.95
    chance = np.clip([found[r["doc_id"]]["score"] for r in held], 1e-6, 1 - 1e-6)
    assert np.mean([-math.log(p if r["quality"] else 1 - p) for p, r in zip(chance, held, strict=True)]) < 0.15


def test_held_out_labels_are_not_learned_from(spark):
    documents = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").select("doc_id", F.col("quality").cast("int").alias("quality"))
    rule = F.crc32(F.col("doc_id").cast("string")) % 3 != 1
    turned = labels.withColumn("quality", F.when(rule, F.col("quality")).otherwise(1 - F.col("quality")))
    one, two = (quality_model.fit(documents, x, rule) for x in (labels, turned))
    assert all(np.array_equal(a, b) for a, b in zip(one.layers, two.layers, strict=True)) and one.temperature == two.temperature


def test_classifier_of_awkward_rows(spark, awkward, nothing, clashing):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 0), (4, None), (None, 1), (6, 0), (6, 1), (8, 1), (99, 0)], QUALITY)
    model = quality_model.fit(awkward, labels, F.lit(True))
    for frame in (awkward, clashing):
        found = quality_model.scored(frame, model)
        assert set(found.columns) == {*frame.columns, "score"}
        assert all(0 <= r["score"] <= 1 for r in found.collect()) and found.count() == frame.count()
    assert quality_model.scored(nothing, model).count() == 0
    for some, constant in ((labels.where("quality = 1 AND doc_id <> 6"), 1.0), (labels.where("doc_id > 1000"), 0.5)):
        plain = quality_model.fit(awkward, some, F.lit(True))
        assert {r["score"] for r in quality_model.scored(awkward, plain).collect()} == {constant}


def test_pooling_does_not_depend_on_the_slice():
    texts = ["a b c", None, "", "THE!! END!!", "ha ha ha"]
    table = quality_model.normalised(quality_model.neighbour_sums(iter([pa.array(texts)])))
    whole = quality_model.pooled(pa.array(texts, pa.string()), table)
    for i, t in enumerate(texts):
        assert np.array_equal(quality_model.pooled(pa.array([t], pa.string()), table)[0], whole[i])


def test_word_vectors_sum_over_all_documents(spark, awkward, nothing, tiny_batches):
    """Against one neighbour after another, over many partitions; texts without a label count as well."""
    texts = [r["text"] or "" for r in awkward.collect()]
    whole = np.zeros((quality_model.ROWS, quality_model.DIMENSIONS))
    for text in texts:
        names, _, _ = quality_model.tokens(pa.array([text]))
        rows = (names % np.uint64(quality_model.ROWS)).astype(int).tolist()
        for i, a in enumerate(rows):
            for j in range(max(0, i - quality_model.REACH), min(len(rows), i + quality_model.REACH + 1)):
                if i != j:
                    whole[a] += quality_model.INDEX_TABLE[rows[j]]
    found = quality_model.word_vectors(awkward.repartition(5).select(F.coalesce("text", F.lit("")).alias("text")))
    assert np.array_equal(found, quality_model.normalised(whole)) and found.any()
    assert not quality_model.word_vectors(nothing).any()


def brute_counts(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if often[g] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_statistics_against_brute_force(spark, awkward, clashing, nothing, tmp_path):
    extra = [(i, t) for i, t in enumerate(["a b c a b c", "a b a b a b a", "x\nx\n \nx\ny", "a\r\nb\x0bc\x0cd", "#é|\U0001f600 & <b>", "a b c d e a b c", "\x1cq\x85 w"])]
    frames = [awkward, clashing, spark.createDataFrame(extra, "doc_id long, text string")]
    columns = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    for frame in frames:
        got = sorted((tuple(r) for r in decision_list.statistics(frame).select("doc_id", *columns).collect()), key=repr)
        assert got == sorted(((r["doc_id"], *brute_counts(r["text"])) for r in frame.collect()), key=repr)
    assert decision_list.statistics(nothing).count() == 0


def test_rules_are_learned_and_read(spark):
    rows = [(i, i % 2, 100, 600 + i % 7, 80 if i % 2 == 0 else i % 3) for i in range(400)]
    counts = {c: F.lit(1).cast("long") for c in decision_list.COUNTS}
    stats = spark.createDataFrame(rows, "doc_id long, quality int, n_words long, word_chars long, n_symbols long")
    full = stats.withColumns({c: v for c, v in counts.items() if c not in stats.columns})
    rules = decision_list.learn(full, stats.select("doc_id", "quality"))
    assert len(rules) == 1 and str(rules[0]).startswith("symbols_per_word >= ")
    verdict = full.withColumn("rule", decision_list.rejected(rules))
    assert {(r["quality"], r["rule"]) for r in verdict.collect()} == {(0, 1), (1, None)}
    assert decision_list.learn(full, stats.select("doc_id", F.lit(1).alias("quality"))) == []
    assert decision_list.learn(full, stats.where("doc_id < 0").select("doc_id", "quality")) == []


def test_op8_keeps_the_good_and_runs_no_python(spark, awkward, nothing, tmp_path):
    frame = op8_decision_list(spark, FOLDER)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    found = {r["doc_id"]: r for r in frame.collect()}
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet").collect()
    whole = [r for r in labels if not found[r["doc_id"]]["base_failed"]]
    assert np.mean([found[r["doc_id"]]["kept"] == bool(r["quality"]) for r in whole]) > 0.95
    for i, frame in enumerate((awkward, nothing)):
        frame.write.parquet(f"{tmp_path}/{i}/documents.parquet")
        spark.createDataFrame([(1, 1), (None, 0), (6, None)], QUALITY).write.parquet(f"{tmp_path}/{i}/labels.parquet")
        rows = op8_decision_list(spark, f"{tmp_path}/{i}").collect()
        assert len(rows) == frame.count()
        for r in rows:
            assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
            assert not (r["kept"] and r["base_failed"])


def base_scores(rows, modulus=7, held=2):
    low = str.maketrans({c: chr(c + 32) for c in range(65, 91)})
    tokens = [(d, [*WORD.findall((t or "").translate(low)), "\n"]) for d, t in rows]
    out = [d is None or crc(d, modulus) == held for d, _ in tokens]
    seen = Counter(x for (_, t), h in zip(tokens, out, strict=True) if not h for x in t)
    n, v = sum(seen.values()), len(seen)
    return sorted(
        ((d, h, len(t), sum(seen[x] > 0 for x in t), n, round(sum(math.log10((seen[x] + 1) / (n + v + 1)) for x in t), 6)) for (d, t), h in zip(tokens, out, strict=True)),
        key=repr,
    )


@pytest.mark.parametrize("part_bytes", [1 << 25, 20_000])
def test_base_scores_and_perplexity(spark, monkeypatch, part_bytes):
    """One part or many, with and without words that are spread over them."""
    monkeypatch.setattr(pitman_yor, "PART_BYTES", part_bytes)
    monkeypatch.setattr(pitman_yor, "BLOCK_TOKENS", 20_000)
    folder = "/root/testdata/sf0.001"
    documents = spark.read.parquet(f"{folder}/documents.parquet").collect()
    found = op10_pitman_yor(spark, folder).collect()
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found), key=repr)
    assert got == base_scores([(r["doc_id"], r["text"]) for r in documents])
    for held in (True, False):
        part = [r for r in found if r["held_out"] == held]
        assert sum(r["score"] for r in part) > sum(r["base_score"] for r in part)


@pytest.mark.parametrize("n_hot", [0, 3])
def test_scores_are_a_distribution(spark, n_hot):
    """The chances that `_score` gives to all words and the unknown one add up to one in every context: three parts
    learned over Spark, each occurrence a document of its own, every pair once held out."""
    rng = np.random.Generator(np.random.PCG64(1))
    words, classes, n = pitman_yor.mix(np.arange(41, dtype=np.uint64)), np.arange(5, dtype=np.uint16), 3000
    names = np.append(words[rng.integers(0, 40, n) ** 2 // 40], np.repeat(words, 5))  # the last word is unknown
    where = np.append(rng.integers(0, 5, n).astype(np.uint16), np.tile(classes, 41))
    held = np.arange(len(names)) >= n
    hot = np.sort(words[:n_hot])
    part_of = (names % np.uint64(3)).astype(np.int64)
    part_of[np.isin(names, hot)] = np.arange(len(names))[np.isin(names, hot)] % 3
    rows, place = [], {}
    for number in range(3):
        mine = np.flatnonzero(part_of == number)
        mine = mine[np.argsort(names[mine], kind="stable")]
        word, times = np.unique(names[mine], return_counts=True)
        docs = (np.arange(len(mine)) * 2 + held[mine]).astype("<u4")
        body = [np.array([len(word), len(mine)], "<u4"), word, times.astype("<u4"), where[mine], docs]
        rows.append((number, [(number, pitman_yor.packed(b"".join(x.tobytes() for x in body)))]))
        place[number] = mine
    parts = spark.createDataFrame(rows, "part int, blobs array<struct<block:long,payload:binary>>").repartition(3)
    totals = pitman_yor.Totals(parts=3, hot=hot)
    pitman_yor.learn(parts, totals, 5)
    assert totals.tokens == n and totals.words == len(set(names[:n].tolist()))
    chance = {}
    for number, mine in place.items():
        part = pitman_yor.Part(pa.array(rows[number][1], pa.struct([("block", pa.int64()), ("payload", pa.binary())])), hot)
        sums = pitman_yor.Sums()
        list(pitman_yor._score(5)(number, part, totals, sums))
        for i, score in zip(mine, sums.blocks[number][1], strict=True):
            chance[int(names[i]), int(where[i])] = 10**score
    unknown = [w for w in words.tolist() if w not in set(names[:n].tolist())]
    for k in range(5):
        known = sum(chance[w, k] for w in words.tolist() if w not in unknown)
        assert abs(known + chance[unknown[0], k] - 1) < 1e-9
    tables = [t.sum() for t, _ in totals.history]
    assert tables[0] <= min(tables[1:]) and max(tables) <= n


def test_reseating_follows_the_process():
    rng = np.random.Generator(np.random.PCG64(2))
    customers = np.full(4000, 6)
    got = pitman_yor.reseat(customers, np.full(4000, 0.7), 0.4, rng).mean()
    chance = {1: 1.0}
    for seated in range(1, 6):
        after = Counter()
        for t, p in chance.items():
            new = 0.7 / (0.7 + seated - 0.4 * t)
            after[t + 1] += p * new
            after[t] += p * (1 - new)
        chance = after
    assert abs(got - sum(t * p for t, p in chance.items())) < 0.05
    assert pitman_yor.reseat(np.array([0, 1]), np.ones(2), 0.5, rng).tolist() == [0, 1]


def test_pitman_yor_of_awkward_rows(spark, awkward, nothing, clashing):
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    for frame in (awkward, clashing):
        found = pitman_yor.scored(frame, held).collect()
        got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found), key=repr)
        assert got == base_scores([(r["doc_id"], r["text"]) for r in frame.collect()])
        assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)
    assert pitman_yor.scored(nothing, held).count() == 0
    everything = pitman_yor.scored(awkward, F.lit(True)).collect()
    assert {r["n_known"] for r in everything} == {0} and all(math.isfinite(r["score"]) for r in everything)
