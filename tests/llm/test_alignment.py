"""Alignment of two tokenizers against whole texts encoded one by one."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

public = pytest.importorskip("public_tokenizers")
from tagtrend.llm.alignment import Aligner, aligned, digests, group_ends, linked  # noqa: E402

A, B = public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tokenizers():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def visible():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


BYTES = visible()


def brute(text, a, b):
    """Groups and links of a text as [(ids of A, ids of B)] and [(id, id)]."""
    if not text:
        return [], [], 0, 0
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    data_a = [bytes(BYTES[c] for c in a.id_to_token(i)) for i in ids_a]
    data_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in ids_b)]
    whole = (" " + text).encode()
    if b"".join(data_a) != whole or b"".join(data_b) != whole:
        return [], [], 0, 0
    groups, links, i, j, at_a, at_b, one, two = [], [], 0, 0, 0, 0, [], []
    while i < len(ids_a) or j < len(ids_b):
        if at_a <= at_b and i < len(ids_a):
            one.append(ids_a[i])
            at_a += len(data_a[i])
            i += 1
        else:
            two.append(ids_b[j])
            at_b += len(data_b[j])
            j += 1
        if at_a == at_b:
            groups.append((one, two))
            links.append((one[-1], two[-1]))
            one, two = [], []
    return groups, links, len(ids_a), len(ids_b)


def expected(rows, a, b):
    found = [(d, *brute(t, a, b)) for d, t in rows]
    counts = Counter(x for _, _, links, _, _ in found for x in links)
    best = {}
    for (_, y), n in counts.items():
        best[y] = max(best.get(y, 0), n)
    out = []
    for d, groups, links, n_a, n_b in found:
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        digest = hashlib.sha256(text.encode()).hexdigest() if text else ""
        out.append((d, n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), digest))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def got(frame):
    return sorted((tuple(r) for r in frame.select(*COLUMNS).collect()), key=repr)


def test_given_documents(spark, tokenizers, tiny_batches):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert got(digests(docs, A, B)) == expected(rows, *tokenizers)


def test_awkward_rows(awkward, nothing, clashing, tokenizers):
    for docs in (awkward, clashing):
        assert got(digests(docs, A, B)) == expected([(r["doc_id"], r["text"]) for r in docs.collect()], *tokenizers)
    assert digests(nothing, A, B).count() == 0 and aligned(nothing, A, B).count() == 0


def test_spaces_scripts_and_marks(spark, tokenizers):
    """White space of every kind at every place, text that is split inside characters, strings of special tokens."""
    rng = random.Random(3)
    atoms = ["a", "Wort", "don't", "'s", " ", "  ", "\n", "\t", "\r\n", " ", "　", " ", "\x85", "\x1c", "\x00", "é", "東京", "😀", "한국어",
             "▁", "<|endoftext|>", "<s>", "</s>", "<0x41>", "<unk>", "123", "...", "#$", "ÀÀ", "\x7f", "‍", "é"]
    texts = ["".join(rng.choices(atoms, k=rng.randint(1, 25))) for _ in range(600)] + [" ", "  ", "\n", "▁", " a", "a ", "aaaa" * 500]
    texts = [t for t in texts if rng.random() < 0.9 or "▁" not in t]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = expected(list(enumerate(texts)), *tokenizers)
    assert got(digests(frame, A, B)) == want
    assert sum(1 for x in want if x[1] == 0) and sum(1 for x in want if x[3]) > 300


def test_whole_texts_where_parts_may_not_stand_alone(spark, tokenizers, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40)
    want = expected([(r["doc_id"], r["text"]) for r in docs.collect()], *tokenizers)
    coder = Aligner(A, B)
    assert coder.cuts
    coder.cuts = False
    import pyarrow as pa
    from tagtrend.llm.alignment import Aligned

    rows = docs.orderBy("doc_id").collect()
    found = Aligned(coder, pa.array([r["text"] for r in rows]))
    digest = {w[0]: w[7] for w in want}
    assert found.digests() == [digest[r["doc_id"]] for r in rows]


def test_groups_and_links_of_the_operator(awkward, tokenizers):
    for row in aligned(awkward, A, B).collect():
        groups, links, n_a, n_b = brute(awkward.where(f"doc_id <=> {row['doc_id'] if row['doc_id'] is not None else 'null'}").first()["text"], *tokenizers)
        assert (len(row["ids_a"]), len(row["ids_b"])) == (n_a, n_b)
        assert [(row["ids_a"][x["a"]], row["ids_b"][x["b"]]) for x in row["links"]] == links
        cuts = [(0, 0), *((x["a"], x["b"]) for x in row["group_ends"])]
        assert [(row["ids_a"][p:q], row["ids_b"][r:s]) for (p, r), (q, s) in zip(cuts, cuts[1:], strict=False)] == groups


def test_tokens_without_bytes_end_with_their_neighbour():
    ends_a, ends_b = np.array([2, 2, 5]), np.array([1, 2, 4, 5, 5])
    cuts = group_ends(ends_a, ends_b)
    assert [x.tolist() for x in cuts] == [[2, 3], [2, 5]]
    assert [x.tolist() for x in linked(ends_a, ends_b, *cuts)] == [[0, 1, 2, 2], [1, 1, 3, 4], [0, 0, 1, 1]]


def test_every_link_has_a_kind():
    coder = Aligner(A, B)
    assert len(coder.kinds) <= sum(map(len, coder.bytes_a)) + sum(map(len, coder.bytes_b)) + len(coder.bytes_a) + len(coder.bytes_b)
