"""Documents that operators must take without stumbling."""

from __future__ import annotations

from collections import namedtuple

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars int, score string, predicted string, row string, "
    "n string, digest string, level string, held_out string, keys string"
)
LONG = "lorem ipsum dolor sit amet " * 8000  # some 200,000 characters
PROSE = "The quick brown fox jumps over the lazy dog while seven wizards quietly mix potions under a pale moon tonight"

Doc = namedtuple("Doc", "doc_id text lang source")

# Nulls in every column, empty and blank texts, very long texts, repeated ids, repeated rows, ties.
ODD = [
    Doc(1, PROSE, "en", "a"),
    Doc(2, None, None, None),
    Doc(3, "", "en", "a"),
    Doc(4, " \n\t ", "de", None),
    Doc(5, PROSE.replace(" ", "  "), "en", "b"),
    Doc(5, PROSE.replace(" ", "  "), "en", "b"),
    Doc(5, "another text of the same id", "en", "b"),
    Doc(None, PROSE, "en", "a"),
    Doc(None, None, None, "a"),
    Doc(None, "a text that stands alone without an id", None, None),
    Doc(6, LONG, "en", "a"),
    Doc(7, LONG, "en", "a"),
    Doc(8, "x" * 120_000, "en", "a"),
    Doc(9, "Ünïcödé 漢字かな 🎉🎉 ÀÉÎ İstanbul ΣΑΣ", "fr", "c"),
    Doc(10, "one", "en", "a"),
    Doc(11, PROSE.upper(), "en", "a"),
    Doc(12, "12 34 !? <|endoftext|> ok", "en", "a"),
]


def table_of(spark, rows):
    """Documents with columns that clash with names the operators use."""
    extra = ("clash",) * 8
    return spark.createDataFrame([(*r, None if r.text is None else len(r.text), *extra) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    return table_of(spark, ODD).cache()


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
