"""Rows of compressed arrays are written as they are, and spans are told apart by their bytes."""

import random
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tagtrend.llm import pfor, pitman_yor, words

P = pytest.importorskip("public_tokenizers")
WORDS = P.path("word_bpe_49k.json")


def codecs(table):
    """The codecs of all columns in the files of a table."""
    files = [pq.ParquetFile(unquote(urlparse(f).path)).metadata for f in table.inputFiles()]
    groups = [(m.row_group(g), m.num_columns) for m in files for g in range(m.num_row_groups)]
    return {group.column(c).compression for group, n in groups for c in range(n)}


def test_segments_are_not_compressed_again(spark):
    rows = spark.createDataFrame([(i, f"some words and {i}") for i in range(50)], "doc_id long, text string")
    assert codecs(pfor.write_segments(rows, WORDS, segment_ids=32)) == {"UNCOMPRESSED"}


def test_parts_and_sweeps_are_not_compressed_again(spark, monkeypatch):
    written = []

    def kept(write):
        def run(*args, **options):
            written.append(write(*args, **options))
            return written[-1]

        return run

    monkeypatch.setattr(pitman_yor, "stage", kept(pitman_yor.stage))
    monkeypatch.setattr(pitman_yor, "stage_by", kept(pitman_yor.stage_by))
    rows = spark.createDataFrame([(i, f"one two three {i % 7} two") for i in range(60)], "doc_id long, text string")
    assert pitman_yor.scored(rows, F.expr("doc_id % 5 = 0")).count() == 60
    packed = [t for t in written if set(t.columns) & {"blobs", "payload", "pairs"}]
    assert len(packed) >= 5
    assert [codecs(t) for t in packed if codecs(t)] == [{"UNCOMPRESSED"}] * sum(bool(codecs(t)) for t in packed)


def test_words_of_letters_need_no_offsets(monkeypatch):
    coder = pfor.WordIds(WORDS)
    texts = pa.array(["élan über Straße naïve", "mañana Ørsted łódź", None])
    alone = [coder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts.to_pylist()]
    monkeypatch.setattr(pfor.WordIds, "_encoded", None)
    ids, counts = coder.encode(texts)
    assert ids.tolist() == sum(alone, [])
    assert counts.tolist() == [len(x) for x in alone]


def test_letters_that_the_tokenizer_takes_apart():
    """Letters that its normalizer turns into a letter and a mark, beside others."""
    coder = pfor.WordIds(WORDS)
    some = ["İstanbul été", "क़क क़", "ŉ Å ﬁn ǅ", "é é Ǻx", "한글 한", "ª º ʰ"]
    ids, counts = coder.encode(pa.array(some))
    alone = [coder.tokenizer.encode(t, add_special_tokens=False).ids for t in some]
    assert ids.tolist() == sum(alone, [])
    assert counts.tolist() == [len(x) for x in alone]


def test_distinct_spans_are_those_of_their_bytes(monkeypatch):
    rng = random.Random(7)
    pool = [bytes(rng.choices(b"ab\x00", k=n)) for n in range(41) for _ in range(4)] + [b"a", b"a\x00", b"a\x00\x00", b"", b"\x00" * 16, b"\x00" * 17]
    spans = [rng.choice(pool) for _ in range(3000)]
    ends = np.cumsum([len(s) for s in spans])
    starts = ends - [len(s) for s in spans]
    seen = []
    hashed = words.span_hash
    monkeypatch.setattr(words, "span_hash", lambda values, *a: seen.append(len(values)) or hashed(values, *a))
    first, of = words.distinct(np.frombuffer(b"".join(spans), dtype=np.uint8), starts, ends)
    order = list(dict.fromkeys(spans))
    assert [spans[i] for i in first] == order
    assert [order[i] for i in of] == spans
    assert set(seen) == {sum(len(s) for s in spans if len(s) > 16)}  # only long spans are hashed byte by byte
    none = np.zeros(0, dtype=np.int64)
    assert [len(x) for x in words.distinct(np.zeros(0, dtype=np.uint8), none, none)] == [0, 0]
