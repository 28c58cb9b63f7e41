"""Words that were seen before are found in arrays, and numbers are packed by whole bytes."""

import random

import numpy as np
import pyarrow as pa
import pytest
from tagtrend.llm import pfor
from tagtrend.llm.words import Known, Recent, sixteen

P = pytest.importorskip("public_tokenizers")
WORDS = P.path("word_bpe_49k.json")


def alone(coder, texts):
    return [coder.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def encoded(coder, texts):
    ids, counts = coder.encode(pa.array(texts, pa.string()))
    cuts = np.cumsum([0, *counts])
    return [ids[a:b].tolist() for a, b in zip(cuts, cuts[1:], strict=False)]


def test_short_words_are_not_looked_up_one_by_one(monkeypatch):
    asked = []
    find_all = Recent.find_all
    monkeypatch.setattr(Recent, "find_all", lambda self, keys: asked.extend(keys) or find_all(self, keys))
    coder = pfor.WordIds(WORDS)
    some = ["the words, of a text", "Über élan é, x1 -- 'tis", "a word longerthansixteenbytes and the", None, ""]
    want = alone(coder, some)
    assert encoded(coder, some) == want
    assert asked == [b"longerthansixteenbytes"]
    monkeypatch.setattr(pfor.WordIds, "tokens", lambda self, parts: [pytest.fail("known already") for _ in parts])
    monkeypatch.setattr(pfor.WordIds, "_letters", lambda *_: pytest.fail("known already"))
    assert encoded(coder, some) == want


def test_letters_are_encoded_as_the_library_does(monkeypatch):
    """ASCII and Latin-1 letters beside everything that is close to them."""
    rng = random.Random(11)
    pool = "abcdehinorstXYZ" + "".join(map(chr, range(0xA0, 0x181))) + "  .,'1\n"
    texts = ["".join(rng.choices(pool, k=rng.randint(0, 40))) for _ in range(3000)]
    texts += ["".join(rng.choices("abcehnorstéüßÀÉÑ .", k=rng.randint(0, 60))) for _ in range(3000)]
    for kept in (pfor.KEPT_WORDS, 50):
        monkeypatch.setattr(pfor, "KEPT_WORDS", kept)
        coder = pfor.WordIds(WORDS)
        for i in range(0, len(texts), 500):
            assert encoded(coder, texts[i : i + 500]) == alone(coder, texts[i : i + 500])


def test_marks_that_join_small_letters_only():
    """The tokenizer joins letters and marks before it lowers the case."""
    coder = pfor.WordIds(WORDS)
    rng = random.Random(13)
    marks = "\u0331\u030c\u0308\u030a\u0301\u0327\u0333\u0344\u0591"
    some = ["H\u0331", "h\u0331", "J\u030c, a", "T\u0308", "T\u0591\u0308x.", "W\u030a", "Y\u030a", "T\u0344", "E\u0301", "\u00ca\u0301x"]
    some += ["".join(rng.choices("AEHJTWYaehjtwy\u00c9\u00fc ." + marks, k=rng.randint(1, 20))) for _ in range(2000)]
    assert encoded(coder, some) == alone(coder, some)


@pytest.mark.parametrize("crowded", [False, True])
def test_entries_are_those_of_the_bytes(monkeypatch, crowded):
    """Also where all hashes name one place, and when the table grows or starts anew."""
    if crowded:
        monkeypatch.setattr(Known, "_place", lambda self, low, high, size: np.full(len(low), len(self.slots) - 3))
    rng = random.Random(3)
    pool = [b"a", b"a\x00", b"a\x00\x00", b"\x00" * 8, b"\x00" * 16, *(bytes(rng.choices(b"ab\x00", k=n)) for n in range(1, 17) for _ in range(400 // (1 + 9 * crowded)))]
    known, seen, cleared = Known(600 if crowded else 5000), {}, 0
    for _ in range(40):
        words = rng.choices(pool, k=500)
        ends = np.cumsum([len(w) for w in words])
        size = np.array([len(w) for w in words])
        low, high = sixteen(np.frombuffer(b"".join(words), dtype=np.uint8), ends - size, size)
        entry = known.find(low, high, size)
        assert [w in seen for w in words] == (entry > 0).tolist()
        new = list({w: i for i, w in enumerate(words) if w not in seen}.values())
        ids = [np.frombuffer(words[i], np.uint8).astype("<u4") for i in new]
        numbers = known.add(low[new], high[new], size[new], np.concatenate([*ids, np.zeros(0, "<u4")]), np.array([len(x) for x in ids], dtype=np.int64))
        seen |= {words[i]: n for i, n in zip(new, numbers.tolist(), strict=True)}
        again = known.find(low, high, size)
        assert again.tolist() == [seen[w] for w in words]
        got, counts = known.ids_of(again)
        assert got.astype(np.uint8).tobytes() == b"".join(words) and (counts == size).all()
        if known.entries == 1:
            seen, cleared = {}, cleared + 1
    assert crowded or cleared or known.entries <= 5000


def test_packed_bits_stand_as_before():
    """Number after number from the lowest bit on, at every width and any block."""
    rng = np.random.default_rng(5)
    for block in (1, 7, 8, 12, 512):
        for width in range(1, 33):
            rows = rng.integers(0, 1 << width, (3, block), dtype=np.uint64).astype(np.uint32)
            rows[0] = (1 << width) - 1
            bits = ((rows[:, :, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)).astype(np.uint8)
            body = np.packbits(bits.reshape(3, -1), axis=1, bitorder="little")
            assert (pfor._packed(rows, width) == body).all()
            assert (pfor._unpacked(body, block, width) == rows).all()
        ids = rng.integers(0, 1 << 32, 1000, dtype=np.uint64).astype(np.uint32)
        assert (pfor.unpack(pfor.pack(ids, block)) == ids).all()
