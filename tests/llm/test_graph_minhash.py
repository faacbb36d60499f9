from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from martloom.llm import graph, minhash

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, x, y):
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)


def test_components_equal_union_find(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)]
    edges += [(1000 + i, 1001 + i) for i in range(40)] + [(5000, 6000 + i) for i in range(50)] + [(7, 7), *edges[:5]]
    union = Union()
    for a, b in edges:
        union.join(a, b)
    got = dict(map(tuple, graph.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()))
    assert got == {x: union.find(x) for e in edges if e[0] != e[1] for x in e}
    assert graph.components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_trees_find_their_roots(spark):
    links = [(0, 1), (1, 2), (2, 3), (3, 4), (10, 11), (10, 12), (12, 13), (0, 20)]
    got = dict(map(tuple, graph.trees(spark.createDataFrame(links, "u bigint, v bigint")).collect()))
    assert got == {**dict.fromkeys([0, 1, 2, 3, 4, 20], 0), **dict.fromkeys([10, 11, 12, 13], 10)}
    assert graph.trees(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def multiset(text):
    words = WORD.findall(text.translate(LOWER))
    return Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else Counter([tuple(words)] if words else [])


def similarity(a, b):
    shared = sum((a & b).values())
    return shared / (sum(a.values()) + sum(b.values()) - shared) if a and b else 0.0


def test_signatures_agree_as_often_as_the_weighted_similarity():
    rng = np.random.default_rng(2)
    m = 2000
    for _ in range(3):
        value = rng.integers(0, 1 << 63, 40).astype(np.uint64)
        a, b = rng.integers(0, 9, 40), rng.integers(0, 9, 40)
        exact = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        both = [(value[w > 0], w[w > 0]) for w in (a, b)]
        order = np.concatenate([np.full(len(v), i) for i, (v, _) in enumerate(both)])
        out = minhash.signatures(np.concatenate([v for v, _ in both]), np.concatenate([w for _, w in both]), order, 2, m)
        assert abs((out[0] == out[1]).mean() - exact) < 4 * np.sqrt(exact * (1 - exact) / m) + 1e-3


def test_signature_does_not_depend_on_the_block():
    texts = ["one two three four five six seven", "a", "", "a a a a a a a a a b", "x " * 3000]
    alone = []
    for t in texts:
        value, weight, row, *_ = minhash.multisets(pa.array([t]))
        alone.append(minhash.signatures(value, weight, row, 1)[0])
    value, weight, row, *_ = minhash.multisets(pa.array(texts))
    assert np.array_equal(minhash.signatures(value, weight, row, len(texts)), np.array(alone))


def test_multisets_equal_plain_counting():
    texts = ["A b. c d e f a b c d e", "a b", "", "x x x x x x x", "é 漢 1 2 3"]
    value, weight, row, *_ = minhash.multisets(pa.array(texts))
    for i, t in enumerate(texts):
        assert sorted(weight[row == i].tolist()) == sorted(multiset(t).values())


@pytest.fixture(scope="module")
def near(messy):
    """A group whose texts drift away from the first one, texts that share most words without being near, and copies."""
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(4000)]
    base = rng.choices(vocabulary, k=200)
    rows, chain = list(messy), list(base)
    for i in range(40):
        chain[(i * 5) % 200] = f"new{i}"
        rows.append((200 + i, " ".join(chain)))
    for i in range(30):
        own = list(base)
        for j in rng.sample(range(200), 3):
            own[j] = f"own{i}x{j}"
        rows.append((300 + i, " ".join(own)))
    passage = rng.choices(vocabulary, k=60)
    for i in range(60):
        rows.append((400 + i, " ".join(passage + rng.choices(vocabulary, k=rng.randint(15, 40)))))
    rows += [(600, "same words here now ok"), (601, "Same  words, here: now ok!"), (602, "???"), (603, "???"), (604, "!!!")]
    return rows


def test_classes_equal_brute_force(make_docs, near):
    got = minhash.near_duplicates(make_docs(near)).collect()
    assert len(got) == len(near)
    union, sets = Union(), {}
    for doc_id, text, *_ in near:
        if text is not None:
            key = " ".join(WORD.findall(text.translate(LOWER))) or "raw " + text
            sets[key] = multiset(text)
            union.find(key)
    keys = list(sets)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if similarity(sets[a], sets[b]) >= 0.8:
                union.join(a, b)
    least = {}
    for doc_id, text, *_ in near:
        if text is not None:
            part = union.find(" ".join(WORD.findall(text.translate(LOWER))) or "raw " + text)
            ids = [x for x in (least.get(part), doc_id) if x is not None]
            least[part] = min(ids) if ids else None
    expected = sorted(
        ((d, least[union.find(" ".join(WORD.findall(t.translate(LOWER))) or "raw " + t)]) if t is not None else (d, d) for d, t, *_ in near), key=repr
    )
    assert sorted(((r["id"], r["class_id"]) for r in got), key=repr) == expected


def test_one_of_each_class_stays(make_docs, near):
    docs = make_docs(near)
    classes = minhash.near_duplicates(docs).collect()
    kept = minhash.keep_one(docs)
    assert kept.dtypes == docs.dtypes
    rows = kept.collect()
    assert len(rows) == len({(r["class_id"], r["digest"] is None) for r in classes})
    # The one that stays is the least of its class; a class without any id has one row, too.
    least = {}
    for r in classes:
        key = (r["class_id"], r["digest"] is None)
        least[key] = min((i for i in (least.get(key), r["id"]) if i is not None), default=None)
    assert sorted([r["doc_id"] for r in rows], key=repr) == sorted(least.values(), key=repr)
    assert minhash.keep_one(docs.limit(0)).count() == 0


def test_pairs_beyond_the_hubs_are_found(spark):
    """Two components in one bucket whose only link does not touch the bucket's hub."""
    words = [f"t{i}" for i in range(120)]
    texts = [" ".join(words)]
    for i in range(1, 25):
        words[(i * 4) % 120] = f"z{i}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    union, sets = Union(), [multiset(t) for t in texts]
    for i in range(len(texts)):
        union.find(i)
        for j in range(i):
            if similarity(sets[i], sets[j]) >= 0.8:
                union.join(i, j)
    got = {r["id"]: r["class_id"] for r in minhash.near_duplicates(docs).collect()}
    assert got == {i: union.find(i) for i in range(len(texts))}


def classes_by_brute_force(texts):
    union, sets = Union(), [multiset(t) for t in texts]
    holders = {}
    for i, runs in enumerate(sets):
        union.find(i)
        shared = Counter()
        for run, n in runs.items():
            for j, m in holders.get(run, ()):
                shared[j] += min(n, m)
            holders.setdefault(run, []).append((i, n))
        for j, overlap in shared.items():
            if overlap >= 0.8 * (sum(runs.values()) + sum(sets[j].values()) - overlap):
                union.join(i, j)
    return {i: union.find(i) for i in range(len(texts))}


@pytest.fixture(scope="module")
def crowd():
    """1,000 texts around one, half of whose pairs are similar and half are not, and 200 that share most buckets but are apart."""
    rng = random.Random(8)
    base = [f"b{i}" for i in range(150)]
    texts = []
    for i in range(1200):
        words = list(base)
        for j in rng.sample(range(150), rng.randint(1, 4) if i < 1000 else 9):
            words[j] = f"x{i}x{j}"
        texts.append(" ".join(words))
    rng.shuffle(texts)
    return texts


def test_a_large_bucket_of_texts_around_the_similarity(spark, crowd, monkeypatch):
    seen = []
    plain = minhash._links

    def counted(pairs, runs, least):
        seen.append(pairs.count())
        return plain(pairs, runs, least)

    monkeypatch.setattr(minhash, "_links", counted)
    docs = spark.createDataFrame(list(enumerate(crowd)), "doc_id bigint, text string").repartition(8)
    expected = classes_by_brute_force(crowd)
    assert len(set(expected.values())) > 20
    assert {r["id"]: r["class_id"] for r in minhash.near_duplicates(docs).collect()} == expected
    # A pass looks at one order of at most 32 buckets a text; verified pairs do not grow with the square of the bucket.
    assert max(seen) <= 32 * len(crowd)


def test_the_exact_step_alone_loses_nothing(spark, monkeypatch):
    monkeypatch.setattr(minhash, "LARGE", 10**9)
    rng = random.Random(21)
    base = [f"b{i}" for i in range(80)]
    texts = []
    for i in range(150):
        words = list(base) + ["same same same"] * rng.randint(0, 3)
        for j in rng.sample(range(80), rng.randint(1, 4)):
            words[j] = f"x{i}x{j}"
        texts.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    assert {r["id"]: r["class_id"] for r in minhash.near_duplicates(docs).collect()} == classes_by_brute_force(texts)


def plans_of(module, monkeypatch):
    """The physical plans of all tables that the module stores."""
    plans = []
    for name in ("stored", "stored_with"):
        plain = getattr(module, name)

        def noted(df, *rest, plain=plain):
            plans.append(df._jdf.queryExecution().sparkPlan().toString())
            return plain(df, *rest)

        monkeypatch.setattr(module, name, noted)
    return plans


def test_components_of_few_edges_take_one_shuffle_a_turn(spark, monkeypatch):
    edges = [(0, i) for i in range(1, 30)] + [(100 + i, 101 + i) for i in range(20)] + [(60, 65), (61, 65), (61, 66), (62, 66), (62, 67)]
    union = Union()
    for a, b in edges:
        union.join(a, b)
    plans = plans_of(graph, monkeypatch)
    got = dict(map(tuple, graph.components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()))
    assert got == {x: union.find(x) for e in edges for x in e}
    turns = sum("HashAggregate" in p for p in plans)
    assert turns <= 4 and len(plans) <= 1 + turns * 9
