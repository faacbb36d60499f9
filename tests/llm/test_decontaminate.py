from __future__ import annotations

import hashlib
import random
import re

import pytest

from martloom.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(text):
    return WORD.findall((text or "").translate(LOWER))


def brute_force(docs, items):
    windows = {}
    for item, text in items:
        words = words_of(text)
        k = min(13, len(words))
        for i in range(len(words) - k + 1 if words else 0):
            windows.setdefault(tuple(words[i : i + k]), set()).add(item)
    lengths = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        words, hit, ids = words_of(text), set(), set()
        for k in lengths:
            for i in range(len(words) - k + 1):
                found = windows.get(tuple(words[i : i + k]))
                if found:
                    hit |= set(range(i, i + k))
                    ids |= {str(x) for x in found if x is not None}
        digest = hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(ids), digest, len(hit) > 0 and 20 * len(hit) >= len(words)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def case(messy):
    rng = random.Random(3)
    vocabulary = ["ab", "cd", "Ef", "g1", "ñu", "漢"]
    items = [(i, " ".join(rng.choices(vocabulary, k=rng.choice([1, 2, 5, 13, 14, 30])))) for i in range(12)]
    items += [(0, items[0][1]), (None, "lonely item " * 9), (90, None), (91, ""), (92, "..."), (93, items[5][1])]
    docs = [(r[0], r[1]) for r in messy]
    for i in range(60):
        text = " ".join(rng.choices(vocabulary, k=rng.randint(0, 700)))
        _, passage = rng.choice(items[:12])
        docs.append((100 + i, f"{text}. {passage.upper()}, {text}" if i % 2 else text))
    docs.append((999, "lonely, item! " * 20))
    return docs, items


@pytest.fixture
def broadcasts(spark, monkeypatch):
    """How many broadcasts of search tables were alive whenever one was made."""
    alive, seen = [], []
    make, destroy = type(spark.sparkContext).broadcast, decontaminate.Broadcast.destroy

    def made(self, value):
        found = make(self, value)
        if isinstance(value, list) and all(isinstance(v, decontaminate.WuManber) for v in value):
            alive.append(found)
            seen.append(len(alive))
        return found

    def destroyed(self, *a):
        alive[:] = [b for b in alive if b is not self]
        return destroy(self, *a)

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", made)
    monkeypatch.setattr(decontaminate.Broadcast, "destroy", destroyed)
    return seen


@pytest.mark.parametrize("part_bytes, parts", [(8 << 20, 1), (400, 10)])
def test_equals_brute_force_with_one_and_many_parts(spark, make_docs, case, broadcasts, part_bytes, parts):
    docs, items = case
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.find_overlaps(make_docs(docs), benchmark, part_bytes=part_bytes)
    got = sorted([tuple(r) for r in decontaminate.digest_columns(found).collect()], key=repr)
    assert got == brute_force(docs, items)
    assert set(broadcasts) == {1} and (len(broadcasts) >= parts if parts > 1 else len(broadcasts) == 1)


def test_hits_are_the_same_for_any_number_of_parts(spark, make_docs, case):
    docs, items = case
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    listed = []
    for part_bytes in (8 << 20, 4000):
        rows = decontaminate.find_overlaps(make_docs(docs), benchmark, part_bytes=part_bytes).select("row.doc_id", "row.text", "hits").collect()
        listed.append(sorted([(r[0], r[1], sorted(map(repr, r["hits"]))) for r in rows], key=repr))
    assert listed[0] == listed[1]


def test_dropping_keeps_columns_and_clean_rows(spark, make_docs, case):
    docs, items = case
    given = make_docs(docs)
    kept = decontaminate.drop_contaminated(given, spark.createDataFrame(items, "item_id bigint, text string"))
    assert kept.dtypes == given.dtypes
    clean = [r for r in brute_force(docs, items) if not r[5]]
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(str(r[0]) for r in clean)


def test_empty_tables(spark, make_docs):
    nothing = spark.createDataFrame([], "item_id bigint, text string")
    docs = make_docs([(1, "some words")])
    assert decontaminate.digest_columns(decontaminate.find_overlaps(docs, nothing)).collect()[0]["n_hit"] == 0
    assert decontaminate.find_overlaps(docs.limit(0), nothing).count() == 0
