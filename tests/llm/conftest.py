import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, size long, _key string, shard int"


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls everywhere, empty and long texts, ties, repeated rows, and extra columns with clashing names."""
    prose = " ".join(f"word{i * 7919 % 1000}" for i in range(400))
    changed = prose.replace("word7919", "x").replace("word5", "y", 1)
    texts = [
        (1, prose, "a"), (2, changed, "a"), (3, prose, None), (3, prose, None), (None, prose, "b"), (None, None, None), (4, None, "b"), (5, "", "b"),
        (6, " \t\n", "c"), (7, "one", "c"), (8, "ONE", "c"), (9, "one two", "c"), (10, "z " * 60_000, "a"), (11, "café " + prose[:900], "a"), (11, "other text", "a"),
    ]
    rows = [(i, t, "en", s, None if t is None else len(t), 5, "k", 9) for i, t, s in texts]
    return spark.createDataFrame(rows, COLUMNS)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], COLUMNS)
