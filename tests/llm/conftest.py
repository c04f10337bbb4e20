from __future__ import annotations

import pytest

from tallyloom.llm import common

LONG = "Lorem ipsum dolor, sit amet. " * 4000
# Clashing names on purpose: results use some of them, and one differs only in case.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, spans int, digest int, TEXT string, fp int"


def row(doc_id, text, lang="en"):
    return (doc_id, text, lang, "s", None if text is None else len(text), 1, 2, "other", 3)


ROWS = [
    row(1, "The cat sat on the mat and looked at me"),
    row(2, "the CAT sat on the mat and looked at me"),
    row(2, "the CAT sat on the mat and looked at me"),
    row(3, None),
    row(4, ""),
    row(5, "   \n\t "),
    row(6, "1234 !!"),
    row(7, "Un chat noir, ça va été là-bas", "fr"),
    row(8, LONG),
    row(9, LONG),
    row(None, "no id at all, only text"),
    row(None, "no id at all, only text"),
    row(10, "x", None),
    row(11, "Mail a.b@c.org or +1 (555) 123-4567, card 4111 1111 1111 1111, ip 10.0.0.1"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and further columns of clashing names."""
    common.ship(spark)
    return spark.createDataFrame(ROWS, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark, odd):
    return odd.limit(0)
