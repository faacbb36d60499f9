from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from martloom.llm import common

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DARK = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
texts = st.lists(st.one_of(st.none(), st.text(alphabet="aAbZ09 .\n\tñÉ漢😀\x00-", max_size=40)), max_size=8)


def spelled(words):
    out = [[] for _ in range(words.rows)]
    for a, b, r in zip(words.start, words.end, words.row, strict=True):
        out[r].append(words.data[a:b].tobytes().decode())
    return out


@settings(max_examples=150, deadline=None)
@given(texts)
def test_words_are_those_of_the_patterns(rows):
    column = pa.array(rows, pa.string())
    assert spelled(common.scan_words(column)) == [ALNUM.findall((t or "").translate(LOWER)) for t in rows]
    assert spelled(common.scan_words(column, common.DARK, lower=False)) == [DARK.findall(t or "") for t in rows]


@settings(max_examples=100, deadline=None)
@given(texts, st.integers(1, 4))
def test_equal_runs_have_equal_hashes_and_others_do_not(rows, k):
    words = common.scan_words(pa.array([*rows, *rows], pa.string()))
    value, at = common.runs_of_words(words.hashes(), words.row, k)
    plain = spelled(words)
    names = [tuple(plain[words.row[i]][i - words.first[words.row[i]] :][:k]) for i in at]
    assert len(set(names)) == len(set(value.tolist())) == len(set(zip(names, value.tolist(), strict=True)))
    assert len(at) == sum(max(0, len(p) - k + 1) for p in plain)


def test_blocks_cover_all_rows_in_order_and_slices_read_right():
    column = pa.array(["a b", None, "", "c " * 500, "dé", "e"], pa.string())
    batch = pa.RecordBatch.from_arrays([column, pa.array(range(6))], ["text", "n"])
    blocks = list(common.text_blocks(batch, "text", 20))
    assert [n for b in blocks for n in b.column("n").to_pylist()] == list(range(6))
    assert [w for b in blocks for w in spelled(common.scan_words(b.column("text")))][3:] == [["c"] * 500, ["dé"], ["e"]]
    assert list(common.text_blocks(batch.slice(0, 0), "text")) == []


def test_hashes_do_not_depend_on_the_block():
    one = common.scan_words(pa.array(["x", "some words here"])).hashes()
    two = common.scan_words(pa.array(["some words here"])).hashes()
    assert np.array_equal(one[1:], two)
