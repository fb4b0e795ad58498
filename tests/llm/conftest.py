from __future__ import annotations

import pytest

from pressroom.session import configure

#: Texts that every operator has to take: nothing, blanks, one word, non-ASCII, repeated lines, one very long word, a very long text.
ODD_TEXTS = [
    None,
    "",
    " \n\t ",
    "word",
    "ÄÖÜ ſecret = K 漢字 \U0001f600 ok",
    "same line\nsame line\n\nsame line",
    "x" * 300_000,
    "long " * 40_000 + "end",
    "one two three four five six seven eight nine ten eleven",
]


@pytest.fixture()
def session(spark):
    return configure(spark)


@pytest.fixture()
def odd(session):
    """Odd texts, repeated rows, equal and null ids, and extra columns with names the operators use themselves."""
    rows = [(i, t, "en", "s1", 7, "mine", 1.5) for i, t in enumerate(ODD_TEXTS)]
    rows += [rows[-1], (3, "other text with the same id", None, None, None, None, None), (None, "no id", "en", "s2", 1, "x", 0.0), (None, None, None, None, None, None, None)]
    return session.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, node string, score double")


@pytest.fixture()
def nothing(odd):
    return odd.limit(0)


@pytest.fixture()
def no_labels(session):
    return session.createDataFrame([], "doc_id long, quality int, toxic int")


@pytest.fixture()
def odd_labels(session):
    return session.createDataFrame([(1, 0, 1), (1, 1, 0), (2, None, None), (3, 1, 0), (None, 1, 1), (99, 0, 0), (8, 1, 0), (5, 0, 1)], "doc_id long, quality int, toxic int")
