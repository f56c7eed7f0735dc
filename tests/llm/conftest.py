from __future__ import annotations

import pytest

#: Nulls, empty and white-space texts, ties, repeated rows, a long text and columns with names that operators use inside.
LONG = " ".join(f"word{i % 997}" for i in range(30_000))
TEXTS = [
    (1, "The cat sat on the mat. It was a fine day.\nAnd so on it went.", "en", "a"), (2, "The cat sat on the mat. It was a fine day.\nAnd so on it went.", "en", "a"), (2, "The cat sat on the mat. It was a fine day.\nAnd so on it went.", "en", "a"),
    (3, None, "en", "b"), (4, "", None, "b"), (5, "   \n\t ", "fr", None), (6, "le chat est sur la table et il dort", "fr", None), (7, LONG, "en", "c"), (8, "1 2 3 ... !!", "en", "c"),
    (None, "no id here", "en", "c"), (9, "le chat est sur la table et il mange", "fr", "a"), (10, "der Hund und die Katze sind nicht hier", "de", "d"), (11, "x", "de", "d"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, bucket int, fp bigint, size bigint, hash string, score double"


@pytest.fixture(scope="session")
def docs(spark):
    rows = [(i, t, g, s, None if t is None else len(t), 7, 7, 7, "h", 0.5) for i, t, g, s in TEXTS]
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
