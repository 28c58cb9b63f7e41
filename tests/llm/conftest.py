"""Small tables with the awkward rows that every operator has to take."""

import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(25_000))
AWKWARD = [
    (1, "one two three four five six seven eight nine ten eleven twelve", "en", "a", 60),
    (2, "one two three four five six seven eight nine ten eleven twelve", "en", None, None),
    (3, None, None, None, None),
    (4, "", "en", "a", 0),
    (5, " \n\t ", "en", "a", 4),
    (6, "ha " * 300, "en", "a", 900),
    (7, "ha " * 200, "en", "a", 600),
    (8, LONG, "xx", "b", len(LONG)),
    (None, "one two three four five six seven eight nine ten eleven twelve", "en", "a", 60),
    (9, "Straße, 東京 😀 ends here\x00 'tis <|endoftext|>", "de", "c", 1),
    (10, "alone", "en", "a", 5),
    (10, "alone", "en", "a", 5),
]


@pytest.fixture
def awkward(spark):
    return spark.createDataFrame(AWKWARD, DOCUMENT)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], DOCUMENT)


@pytest.fixture
def clashing(spark):
    """Columns named like those that the operators make inside or return."""
    names = ["key", "copy", "spans", "fingerprint", "node", "root", "part", "score", "held", "bucket", "shard", "place", "slot", "ids", "n", "_row", "_gone", "kept"]
    columns = ", ".join(f"{n} string" for n in names)
    rows = [(i, t, *["x"] * len(names)) for i, t, *_ in AWKWARD[:7]]
    return spark.createDataFrame(rows, f"doc_id long, text string, {columns}")


@pytest.fixture
def tiny_batches(spark):
    """Arrow batches of a few rows, so that groups cross their borders."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(key)
    spark.conf.set(key, "3")
    yield
    spark.conf.set(key, old)
