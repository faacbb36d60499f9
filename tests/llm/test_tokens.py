from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from martloom.llm import pretokens, token_counts, token_output
from martloom.llm.queries import tokenizer_path

PATH = tokenizer_path()
with open(PATH, encoding="utf-8") as _file:
    PIECES = pretokens.Pieces(_file.read())
LIBRARY = Tokenizer.from_file(PATH)

ODD = [
    "", " ", "İstanbul ǅ ſ K Å é Ñ", "é café", "don't DON'T we'Ll I'M he'd 'S '' 'sa !!'re", "<|endoftext|> a <|startoftext|>b <|END <|endoftext",
    "漢字 кириллица ΑΣ Σ ΟΔΟΣ", "½¾²³ 12345 ١٢", "a​b c’s “quoted” — x…", "\x1c\x1d\x85\xa0 x y", "ŉ ǰ ΐ ß ẞ ﬁ", "__a_b__ ##", "x" * 5000, "😀😀 a", "\u0000",
]


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def test_ids_and_counts_of_odd_texts_equal_the_library():
    column = pa.array([*ODD, None])
    ids, sizes = token_output.block_ids(column, PIECES, 1)
    assert ids.tolist() == [i for t in [*ODD, None] for i in [*library_ids(t), 1]]
    assert sizes.tolist() == [len(library_ids(t)) + 1 for t in [*ODD, None]]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x24F), st.characters(min_codepoint=0x2000, max_codepoint=0x2030), st.sampled_from("'stremdl漢é🙂Я ")), max_size=25), max_size=4))
def test_any_text_equals_the_library(texts):
    column = pa.array(texts, pa.string())
    assert token_output.block_ids(column, PIECES, 1)[0].tolist() == [i for t in texts for i in [*library_ids(t), 1]]


def test_a_full_cache_starts_anew(monkeypatch):
    monkeypatch.setattr(pretokens, "CACHE", 3)
    with open(PATH, encoding="utf-8") as file:
        small = pretokens.Pieces(file.read())
    column = pa.array(["one two three four five six one two"] * 3)
    for _ in range(3):
        assert token_output.block_ids(column, small, 1)[1].tolist() == [len(library_ids(column[0].as_py())) + 1] * 3
        assert len(small) == 6
    assert token_output.block_ids(pa.array(["seven"]), small, 1)[1].tolist() == [len(library_ids("seven")) + 1]
    assert len(small) == 1


@pytest.mark.parametrize("frequent", [0, 5, 1 << 17])
def test_counts_equal_the_library_wherever_a_pretoken_is_joined(make_docs, messy, monkeypatch, frequent):
    monkeypatch.setattr(token_counts, "_HELD", 7)
    rng = random.Random(2)
    rows = [*messy, *[(1000 + i, t) for i, t in enumerate(ODD)], *[(1000 + i, t) for i, t in enumerate(ODD)]]
    rows += [(2000 + i, " ".join(rng.choices(["the", "of", "unlikely", "zyxwvutsrq", "é漢", "12"], k=rng.randint(0, 50)))) for i in range(60)]
    got = token_counts.count_tokens(make_docs(rows), PATH, limit=20, frequent=frequent).collect()
    expected = [(d, len((t or "").encode()), len(library_ids(t)), len(library_ids(t)) > 20) for d, t, *_ in rows]
    assert sorted([(r["row"]["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got], key=repr) == sorted(expected, key=repr)


def test_a_pretoken_is_in_the_table_once_with_its_occurrences(spark, make_docs):
    with open(PATH, encoding="utf-8") as file:
        tokenizer = spark.sparkContext.broadcast(file.read())
    docs = make_docs([(i, "Hello hello world" if i % 2 else "unbelievable") for i in range(20)]).repartition(5)
    rows = token_counts.pretoken_table(docs, tokenizer).collect()
    assert {r["pretoken"]: r["n"] for r in rows} == {"hello": 20, "world": 10, "unbelievable": 10}
    assert {r["pretoken"]: r["pieces"] for r in rows} == {t: len(library_ids(t)) for t in ("hello", "world", "unbelievable")}


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32 - 1), st.integers(0, 700), st.integers(1, 60000), st.integers(1, 90))
def test_coder_round_trip(seed, n, kinds, block):
    ids = np.random.default_rng(seed).integers(0, kinds, n).astype(np.uint32)
    if n > 10:
        ids[n // 2 :] = ids[: n - n // 2]
    coded = token_output.encode_blocks(ids, 4, block)
    assert np.array_equal(token_output.decode_blocks(coded, n, 4, block), ids)


def test_coder_learns_and_does_not_expand():
    rng = np.random.default_rng(1)
    again = np.tile(rng.integers(0, 49408, 50), 400).astype(np.uint32)
    assert sum(map(len, token_output.encode_blocks(again, 4))) < len(again) * 0.3
    noise = rng.integers(0, 65536, 20000).astype(np.uint32)
    assert sum(map(len, token_output.encode_blocks(noise, 4))) < len(noise) * 2.2


def test_segment_round_trip_and_checksums():
    ids = np.arange(5000, dtype=np.uint32) % 977
    segment = token_output.Segment([3, None, -7], np.array([0, 4999, 1]), ids)
    data = token_output.pack(segment, 4)
    back = token_output.unpack(data)
    assert back.doc_ids == [3, None, -7] and back.sizes.tolist() == [0, 4999, 1] and np.array_equal(back.ids, ids)
    for at in (10, 40, len(data) - 200):
        broken = bytearray(data)
        broken[at] ^= 0x40
        with pytest.raises(ValueError, match="checksum|segment"):
            token_output.unpack(bytes(broken))


def test_files_hold_all_ids_in_order(spark, make_docs, messy, monkeypatch):
    rng = random.Random(9)
    rows = [*messy, *[(i, " ".join(rng.choices(["red", "green", "blue sky"], k=rng.randint(0, 300)))) for i in range(1000, 1060)], (70, "<|endoftext|> x")]
    monkeypatch.setattr(token_output, "SEGMENT", 3000)
    got = [tuple(r) for r in token_output.encode_and_read(make_docs(rows), PATH).orderBy("start").collect()]
    assert [g[0] for g in got] == sorted((r[0] for r in rows), key=lambda d: (d is not None, d or 0))
    assert [g[1] for g in got] == [sum(g[2] for g in got[:i]) for i in range(len(got))]
    expected = sorted((str(d), len(ids := [*library_ids(t), 1]), zlib.crc32(np.array(ids, "<u4").tobytes())) for d, t, *_ in rows)
    assert sorted((str(d), n, crc) for d, _, n, crc in got) == expected
    assert token_output.encode_and_read(make_docs(rows).limit(0), PATH).count() == 0


def test_counts_per_document(make_docs, messy):
    rows = token_counts.count_tokens(make_docs(messy), PATH, limit=50).select("row.doc_id", "row.text", "n_bytes", "n_tokens", "over_limit").collect()
    assert len(rows) == len(messy)
    for r in rows:
        n = len(library_ids(r["text"]))
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len((r["text"] or "").encode()), n, n > 50)


def test_an_id_is_coded_in_one_step_from_the_table_of_its_segment(monkeypatch):
    steps = []
    plain = token_output._Encoder.code
    monkeypatch.setattr(token_output._Encoder, "code", lambda self, state, *rest: steps.append(len(state[1])) or plain(self, state, *rest))
    rng = np.random.default_rng(3)
    ids = (rng.zipf(1.3, 1 << 20) % 49408).astype(np.uint32)
    coded = token_output.encode_blocks(ids, 4)
    # One choice an id, and at most one more step.
    assert sum(steps) <= 2 * len(ids)
    n = np.bincount(ids)[ids.max() :: -1]
    share = n[n > 0] / len(ids)
    assert 8 * sum(map(len, coded)) < len(ids) * (1.1 * -(share * np.log2(share)).sum() + 1)
    assert np.array_equal(token_output.decode_blocks(coded, len(ids), 4), ids)
    # A block needs the table and no other block.
    assert np.array_equal(token_output.decode_blocks([coded[0], coded[7]], 2048, 4), ids[6 * 2048 : 7 * 2048])


@pytest.mark.parametrize("digits", [1, 2, 5, 8])
def test_coder_round_trip_for_vocabularies_of_any_size(digits):
    ids = np.random.default_rng(digits).integers(0, min(16**digits, 1 << 32), 5000, np.uint64).astype(np.uint32)
    assert np.array_equal(token_output.decode_blocks(token_output.encode_blocks(ids, digits, 100), 5000, digits, 100), ids)


def test_pieces_stay_with_the_worker():
    with open(PATH, encoding="utf-8") as file:
        text = file.read()
    assert pretokens.held_pieces(text) is pretokens.held_pieces("".join(list(text)))
