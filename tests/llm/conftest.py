from __future__ import annotations

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, gone int, times int, key int"


def _words(seed, n):
    return " ".join(f"w{(seed * 7919 + i * i * 31 + i * 17) % 9973:x}" for i in range(n))


@pytest.fixture(scope="session")
def words():
    return _words


@pytest.fixture(scope="session")
def edge_docs(spark):
    """Nulls in every column, empty and very long texts, copies, near copies, repeated rows, clashing extra columns."""
    long_text = _words(3, 60_000)
    base = _words(5, 120)
    near = base.replace(base.split()[60], "other")
    rows = [
        (1, None, None, None), (2, "", "en", "a"), (3, " \n\t", "en", "a"), (4, long_text, "en", "b"),
        (5, base, "en", "b"), (6, near, None, "b"), (7, base.upper(), "de", None), (8, base, "de", "a"),
        (8, base, "de", "a"), (9, "x", "en", "a"), (10, "1 2 3 !!", None, "b"), (None, "no id at all", "en", "a"),
        (11, "Äö ß " + _words(8, 40), "de", "c"), (12, "same words here", "en", "c"), (13, "same words here", "en", "c"),
    ]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), 1, 2, 3) for r in rows], DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
