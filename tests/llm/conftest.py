from __future__ import annotations

import pytest

LONG = "lorem ipsum dolor sit amet " * 8000
PLAIN = "the quick brown fox jumps over the lazy dog and runs far away from all the other animals of the old wood"

# Names that the operators use themselves.
CLASH = "`row` string, score double, hits int, n_words int, keep string, digest string, id int, `key` string, n_copies int"
SCHEMA = f"doc_id bigint, text string, lang string, source string, n_chars bigint, {CLASH}"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (id, text) or (id, text, lang, source); further columns clash with the operators' own."""

    def build(rows):
        full = []
        for row in rows:
            doc_id, text, lang, source = (*row, "en", "web")[:4] if len(row) == 2 else row
            full.append((doc_id, text, lang, source, len(text or ""), "r", 0.5, 1, 2, "k", "d", 3, "x", 4))
        return spark.createDataFrame(full, SCHEMA)

    return build


@pytest.fixture(scope="session")
def messy():
    """Missing ids, texts and columns, empty and very long texts, repeated rows, ids used twice."""
    return [
        (1, PLAIN), (1, PLAIN), (2, PLAIN + " too"), (3, None), (3, "another text under a used id"), (4, ""), (5, "   \n\t \n"),
        (None, "a text without an id " * 3), (None, None), (6, LONG), (7, "x" * 50_000), (8, "É ñ 漢字 😀 \u0000 end"),
        (9, PLAIN, None, None), (10, "one\n" * 30), (-5, PLAIN.upper()), (1 << 62, "short"),
    ]
