"""The stages one after the other on planted rows."""

import random

import corpus_pipeline
import pytest

pytest.importorskip("public_tokenizers")
FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def planted(spark, tmp_path_factory):
    """The smallest given documents with planted copies, passages, leaks and junk."""
    folder = str(tmp_path_factory.mktemp("planted"))
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    rng = random.Random(1)
    vocabulary = sorted({w for r in docs.limit(80).collect() for w in r["text"].split() if w.isalpha()})
    fresh = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    item = spark.read.parquet(f"{FOLDER}/benchmark.parquet").first()["text"]
    passage, base = fresh(70), fresh(300)
    near = list(base)
    near[299] = "altered"  # one shingle of 298
    rows = {
        5000: base, 5001: base, 5002: near, 5003: fresh(150) + passage + fresh(20), 5004: fresh(30) + passage + fresh(150),
        5005: fresh(60) + item.split() + fresh(60), 5006: [w + "***" for w in fresh(200)], 5007: fresh(250),
    }
    extra = spark.createDataFrame([(i, " ".join(w), "en", "planted", 1) for i, w in rows.items()], docs.schema)
    docs.unionByName(extra).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return folder


def test_stages(spark, planted):
    docs = spark.read.parquet(f"{planted}/documents.parquet")
    kept, texts = [], {}
    for name, stage in corpus_pipeline.STAGES:
        out = corpus_pipeline.stage(stage(spark, docs, planted), f"test-{name}")
        if name != "tokens":
            assert out.columns == docs.columns
        docs = out
        kept.append({r["doc_id"] for r in docs.select("doc_id").collect() if r["doc_id"] >= 5000})
        if name == "substrings":
            texts = {r["doc_id"]: r["text"] for r in docs.where("doc_id >= 5000").collect()}
    assert kept[0] == {5000, 5001, 5002, 5003, 5004, 5005, 5007}  # the junk goes
    assert kept[1] == {5000, 5003, 5004, 5005, 5007}  # copies go
    assert kept[2] == kept[1] and len(texts[5004].split()) == 180 and len(texts[5003].split()) == 240
    assert kept[3] == kept[4] == {5000, 5003, 5004, 5007}  # the leak goes
    assert docs.where("n_bytes = 0 OR n_tokens <> size(ids)").count() == 0


def test_run_equals_the_stages(spark, planted):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "substrings", "decontamination", "tokens"]
    out = corpus_pipeline.run(spark, planted)
    assert out.columns == ["doc_id", "ids", "n_tokens", "n_bytes"] and out.count() > 500


def test_stages_take_awkward_rows(spark, awkward, nothing, planted):
    for docs in (awkward, nothing):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, planted)
            assert out.count() <= docs.count()
            if name != "tokens":
                assert out.columns == docs.columns
