import random
import re

import numpy as np
import pyarrow as pa
from tagtrend.llm.words import LOWER, runs, slices, span_hash, window_hash, words_of

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def test_words_are_those_of_the_pattern():
    rng = random.Random(3)
    texts = ["".join(rng.choices(["a", "B", "é", " ", "\n", "\t", "\x0b", " ", "\x1c", "😀"], k=rng.randint(0, 30))) for _ in range(400)]
    texts[5] = None
    for lower in (False, True):
        found = words_of(pa.array(texts), lower)
        for i, text in enumerate(texts):
            data = (text or "").encode()
            want = WORD.findall(data.translate(LOWER.tobytes()) if lower else data)
            part = found.text(i)
            got = [found.data[a:b].tobytes() for a, b in zip(found.starts[part], found.ends[part], strict=True)]
            assert got == want
    assert len(words_of(pa.array([], pa.string())).names) == 0


def test_names_depend_on_the_word_alone():
    found = words_of(pa.array(["x yy zzz", "zzz", "yy x", "ab ba"]))
    x, yy, zzz = found.names[:3]
    assert found.names[3] == zzz and list(found.names[4:6]) == [yy, x]
    assert len(set(found.names.tolist())) == 5


def test_windows_hash_alike_wherever_they_stand():
    values = np.random.default_rng(1).integers(0, 3, 4000).astype(np.uint64)
    seen = {}
    for start, h in enumerate(window_hash(values, 7).tolist()):
        assert seen.setdefault(tuple(values[start : start + 7].tolist()), h) == h
    assert len(set(seen.values())) == len(seen)
    assert len(window_hash(values[:3], 7)) == 0
    spans = span_hash(values, np.array([0, 5]), np.array([0, 5]))
    assert spans[0] == spans[1]


def test_slices_and_runs():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * 10, None, "b" * 25, "c", ""]})
    parts = list(slices(iter([batch, batch.slice(0, 0)]), limit=12))
    assert [t for p in parts for t in p.column("text").to_pylist()] == batch.column("text").to_pylist()
    assert len(parts) > 1
    assert [x.tolist() for x in runs(np.array([4, 4, 4, 2]), np.array([1]))] == [[0, 1, 3], [1, 2, 1]]
