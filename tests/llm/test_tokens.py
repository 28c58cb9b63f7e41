"""Token ids: patched blocks and prefix tables, against the libraries and exact round trips."""

import base64
import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tagtrend.llm import pfor, prefix_bpe
from tagtrend.llm.queries import op7_patched_ids, op9_prefix_bpe
from tagtrend.llm.words import Recent

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
tokenizers = pytest.importorskip("tokenizers")
RANKS = P.path("byte_bpe_multi_50k.tiktoken")
WORDS = P.path("word_bpe_49k.json")
ODD = [
    " ", "  ", "\n", "\n\n", "a", "the", "é", "ß", "#", "***", "'s", "'", "1", "23", "\t", "\xa0", "　", "中文", "\r", "ing", "THE", "😀", "\x1c", "é",
    "that,", "don't!", "—", "!…", "Σ", "ΑΣ.", "<|endoftext|>", "<|ENDOFTEXT|>", "İ", "ﬁ", "a-b", "\x00", "\x85", "​",
]


def texts(seed, count):
    rng = random.Random(seed)
    return ["".join(rng.choices(ODD, k=rng.randint(0, 14))) for _ in range(count)]


@pytest.fixture(scope="module")
def byte_level():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def check(coder, some, whole):
    """A slice of texts, with a null and empty ones, against encoding each alone."""
    some = [*some, "", None, "last\n"]
    ids, counts = coder.encode(pa.array(some))
    cuts = np.concatenate([[0], np.cumsum(counts)])
    assert [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:], strict=False)] == [whole(t or "") for t in some]


def test_prefix_tables_encode_as_the_library(byte_level):
    check(prefix_bpe.encoder(RANKS, P.PATTERN), texts(1, 3000), byte_level.encode_ordinary)


def test_appends_and_edits_equal_encoding_anew():
    vocabulary = prefix_bpe.encoder(RANKS, P.PATTERN).vocabulary
    rng = random.Random(2)
    for _ in range(400):
        data = bytes(rng.choices(b"abcdefghiklmnorstuvz\xc3\xa9 the", k=rng.randint(1, 80)))
        table = prefix_bpe.PrefixTable(vocabulary, data[:7])
        before = list(table.last)
        table.append(data[7:])
        assert table.last[: len(before)] == before
        assert table.tokens() == [vocabulary.ranks[p] for p in vocabulary.merged(data)]
        a = rng.randint(0, len(data))
        b = rng.randint(a, min(len(data), a + 4))
        new = bytes(rng.choices(b"abcxyz", k=rng.randint(0, 4)))
        table.splice(a, b, new)
        edited = data[:a] + new + data[b:]
        assert table.data == edited and table.tokens() == [vocabulary.ranks[p] for p in vocabulary.merged(edited)]
    long = prefix_bpe.PrefixTable(vocabulary, b"the quick brown fox " * 200)
    assert long.splice(10, 11, b"Q") < 200


def test_tables_that_grow_together_are_those_grown_alone():
    v = prefix_bpe.encoder(RANKS, P.PATTERN).vocabulary
    rng = random.Random(3)
    pieces = [bytes(rng.choices(b"aabcdeeghilnorsttu\xc3\xa9 .", k=rng.randint(1, 40))) for _ in range(2000)] + [b"the", b" nothing", b"aaaaaaaa"]
    first = np.cumsum([0, *map(len, pieces)])
    last = prefix_bpe.last_tokens(v, np.frombuffer(b"".join(pieces), dtype=np.uint8), first)
    ids, counts = prefix_bpe.tokens_of(v, np.frombuffer(b"".join(pieces), dtype=np.uint8), first)
    cuts = np.cumsum([0, *counts])
    for i, piece in enumerate(pieces):
        alone = prefix_bpe.PrefixTable(v, piece)
        assert last[first[i] : first[i + 1]].tolist() == alone.last and ids[cuts[i] : cuts[i + 1]].tolist() == alone.tokens()


def test_kept_pieces_change_nothing(byte_level, monkeypatch):
    monkeypatch.setattr(prefix_bpe, "TOGETHER", 6)
    monkeypatch.setattr(prefix_bpe, "KEPT_PIECES", 2)
    monkeypatch.setattr(prefix_bpe, "KEPT_SEAMS", 5)
    coder = prefix_bpe.Encoder(prefix_bpe.encoder(RANKS, P.PATTERN).vocabulary)
    for i in range(8):
        check(coder, texts(3 + i, 40), byte_level.encode_ordinary)


def test_op9_of_awkward_rows(spark, awkward, nothing, clashing, byte_level, tmp_path, tiny_batches):
    for i, frame in enumerate((awkward, clashing, nothing)):
        frame.write.parquet(f"{tmp_path}/{i}/documents.parquet")
        want = []
        for r in frame.collect():
            data = (r["text"] or "").encode()
            ids = byte_level.encode_ordinary(r["text"] or "")
            want.append((r["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(data).hexdigest()))
        got = op9_prefix_bpe(spark, f"{tmp_path}/{i}").select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_decode_of_a_null_list(spark):
    frame = spark.createDataFrame([(1, None), (2, []), (3, [0, 1])], "doc_id long, ids array<int>")
    out = {r["doc_id"]: bytes(r["bytes"]) for r in prefix_bpe.decode(frame, RANKS, P.PATTERN).collect()}
    token = prefix_bpe.encoder(RANKS, P.PATTERN).vocabulary.token
    assert out == {1: b"", 2: b"", 3: token[0] + token[1]}


def test_segments_round_trip():
    rng = np.random.default_rng(1)
    for n in (0, 1, 511, 512, 513, 3000):
        for high in (1, 2, 50_000, 2**32 - 1):
            ids = rng.integers(0, high, n, dtype=np.uint64).astype(np.uint32)
            ids[::61] = 2**32 - 1
            data = pfor.pack(ids)
            assert (pfor.unpack(data) == ids).all()
            assert (pfor.unpack(data, n // 3, n // 3 + 600) == ids[n // 3 : n // 3 + 600]).all()
    small = np.full(5120, 40_000, dtype=np.uint32) + np.arange(5120, dtype=np.uint32) % 16
    small[::100] = 0
    assert len(pfor.pack(small)) < len(small) * 4  # sixteen values around a base, a few exceptions


def test_words_are_encoded_as_the_library_does(monkeypatch):
    coder = pfor.WordIds(WORDS)
    whole = lambda text: coder.tokenizer.encode(text, add_special_tokens=False).ids
    check(coder, texts(4, 3000), whole)
    monkeypatch.setattr(pfor, "KEPT_PARTS", 2)
    monkeypatch.setattr(pfor, "CALL_PARTS", 3)
    coder = pfor.WordIds(WORDS)
    for i in range(8):
        check(coder, texts(40 + i, 60), whole)


def test_op7_of_awkward_rows(spark, awkward, nothing, clashing, tmp_path, monkeypatch):
    tokenizer = tokenizers.Tokenizer.from_file(WORDS)
    for i, frame in enumerate((awkward, clashing, nothing)):
        frame.write.parquet(f"{tmp_path}/{i}/documents.parquet")
        rows = sorted(frame.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
        want, start = [], 0
        for r in rows:
            ids = [*tokenizer.encode(r["text"] or "", add_special_tokens=False).ids, 1]
            want.append((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
            start += len(ids)
        got = op7_patched_ids(spark, f"{tmp_path}/{i}").collect()
        assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_many_segments(spark):
    rows = [(i, f"word{i} and more " * (i % 5)) for i in range(300)]
    frame = spark.createDataFrame(rows[::-1], "doc_id long, text string").repartition(3)
    segments = pfor.write_segments(frame, WORDS, segment_ids=100)
    assert segments.count() > 20
    found = sorted((r["doc_id"], r["start"], len(r["ids"])) for r in pfor.read_documents(segments).collect())
    starts = np.cumsum([0, *(n for _, _, n in found)])
    assert [s for _, s, _ in found] == starts[:-1].tolist() and [d for d, _, _ in found] == list(range(300))


def test_kept_pieces_of_both_generations_come_in_one_go(monkeypatch):
    """No call for each key that is missing from the younger generation."""
    kept = Recent(3)
    kept.keep_all([(b"a", b"1"), (b"b", b"2"), (b"c", b"3")])
    kept.keep_all([(b"d", b"4")])
    monkeypatch.setattr(Recent, "find", lambda *_: pytest.fail("one by one"))
    assert kept.find_all([b"c", b"x", b"d", b"a", b"c"]) == [b"3", None, b"4", b"1", b"3"]
    assert kept.get(b"a") == b"1" and kept.get(b"c") == b"3" and kept.get(b"x") is None
