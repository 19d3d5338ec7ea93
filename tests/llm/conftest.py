from __future__ import annotations

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside; they must not disturb.
CLASHES = "row string, kept string, words string, size string, key string, shard int, fp long, spans string, new string, digest string, doc long, id long"


@pytest.fixture
def docs(spark):
    """A table of documents from texts or from (doc_id, text, lang, source)."""

    def make(*rows):
        full = [(i, r, "en", "a") if r is None or isinstance(r, str) else r for i, r in enumerate(rows)]
        return spark.createDataFrame([(*r, None if r[1] is None else len(r[1])) for r in full], SCHEMA)

    return make


@pytest.fixture
def odd(spark):
    """Nulls in every column, empty and very long texts, repeated rows, clashing columns."""
    long = " ".join(f"w{i % 977} longer{i % 31}" for i in range(20_000))
    texts = [
        (1, "plain words here and there, mail bob.7@mail1.example.com now", "en", "a"), (2, None, None, None), (3, "", "en", "b"),
        (4, " \t\n ", "fr", None), (5, long, None, "a"), (6, long + " x", "en", "a"), (6, long + " x", "en", "a"),
        (None, "no id at all, only words", "de", "c"), (None, None, None, None), (7, "x" * 30_000, "en", "b"),
        (8, "été 日本語 😀 naïve", "fr", "b"), (8, "another text under the same id", "fr", "b"),
    ]
    rows = [(*t, None if t[1] is None else len(t[1]), "r", "k", "w", "s", "k", 1, 2, "sp", "n", "d", 3, 4) for t in texts]
    return spark.createDataFrame(rows, f"{SCHEMA}, {CLASHES}")


@pytest.fixture
def none(spark):
    return spark.createDataFrame([], SCHEMA)
