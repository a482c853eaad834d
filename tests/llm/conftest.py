"""Rows that every operator must stand: NULLs, no words, long texts, ties, repeats, clashing names."""

from __future__ import annotations

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
CLASHING = ("k", "th", "h1", "words", "copy", "fingerprint", "start", "n_words", "n_lines", "g")

PROSE = " ".join(f"w{i % 97}x{i % 89}" for i in range(400))
LONG = " ".join(f"v{i * i % 7919}" for i in range(30_000)) + "\n" + "end of a long text\n" * 500

EDGE = [
    (None, None, None, None),
    (None, "no id but some words in a line", "en", "a"),
    (1, None, "en", "a"),
    (2, "", "en", None),
    (3, " \t\n \x0b\r\n", None, "a"),
    (4, "one", "en", "a"),
    (5, LONG, "en", "a"),
    (6, PROSE, "en", "b"),
    (6, PROSE, "en", "b"),
    (7, PROSE, "en", "b"),
    (8, PROSE + " and a little more", "en", "b"),
    (9, "A line of TEXT\n  a line of text\t\nÄ LINE of text\nshort", "de", "b"),
    (10, "a line of text\nä line of text\nshort\n", "de", "b"),
    (11, "mail é@x.de or a@b.co\n" + "x" * 5000, "fr", "a"),
]


@pytest.fixture(scope="session")
def docs(spark):
    def make(rows=EDGE, clashing=True):
        made = [(*r, len(r[1] or "")) for r in rows]
        frame = spark.createDataFrame(made, SCHEMA)
        if clashing:
            from pyspark.sql import functions as F

            frame = frame.withColumns({c: F.lit(f"other {c}") for c in CLASHING})
        return frame

    return make


@pytest.fixture(scope="session")
def sample(spark):
    """A few real documents."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def tokenizer():
    from salesmart.llm.queries import tokenizer_files

    return tokenizer_files()


def sorted_rows(frame, *columns):
    return sorted((tuple(r) for r in frame.select(*columns).collect()), key=repr)
