import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node long, id string, cut_text string"


@pytest.fixture(scope="session")
def words():
    """Makes texts of invented words; the same seed gives the same text."""
    def make(seed: int, n: int) -> list[str]:
        rng = random.Random(seed)
        return ["".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 8))) for _ in range(n)]

    return make


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (id, text) or (id, text, lang, source), with extra columns whose names clash with inner ones."""
    def build(rows):
        full = [(i, t, *(rest or ("en", "s")), None if t is None else len(t), 7, "x", "y") for i, t, *rest in rows]
        return spark.createDataFrame(full, SCHEMA)

    return build


@pytest.fixture(scope="session")
def odd_rows(words):
    """Null and repeated ids, null, empty and blank texts, one very long text, repeated rows."""
    long = " ".join(words(99, 30_000))
    return [(None, "a text without an id stays"), (None, None), (1, None), (2, ""), (3, " \n\t "), (4, long), (5, long), (6, "same row here"),
            (6, "same row here"), (2**60, "big id"), (8, "x" * 50_000)]
