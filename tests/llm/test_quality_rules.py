from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from martloom.llm import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(text):
    text = text or ""
    words = WORD.findall(text)
    runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(runs)
    inside = {j for i, r in enumerate(runs) if count[r] > 1 for j in range(i, i + 5)}
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeated, len(inside)


def normal_text(rng, n):
    return " ".join(rng.choices(["the", "and", "of", "house", "tree", "river", "walked", "slowly", "blue", "over"], k=n)) + "."


@pytest.fixture(scope="module")
def rows(messy):
    rng = random.Random(8)
    # In a language of their own, since one very long odd text outweighs the few others here.
    out = [(r[0], r[1], None if i % 2 else "xx", "web") for i, r in enumerate(messy)]
    out += [(100 + i, "\n".join(normal_text(rng, 12) for _ in range(rng.randint(4, 12)))) for i in range(150)]
    out += [(500, "\n".join(normal_text(rng, 10).upper() + "!!! ###" for _ in range(20))), (501, "a b c d e f\n" * 20)]
    out += [(502, " | ".join(rng.choices(["x1", "$$", "%%", "77", "@@"], k=300))), (503, "#*$ " * 40 + normal_text(rng, 5))]
    return out


def test_counts_and_verdicts(make_docs, rows):
    got = quality_rules.judge(make_docs(rows)).select(
        "row.doc_id", "row.text", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    ).collect()
    assert len(got) == len(rows)
    for r in got:
        expected = brute_force(r["text"])
        assert tuple(r[2:7]) == expected, r["doc_id"]
        failed = expected[0] < 10 or 100 * expected[4] > 20 * expected[0]
        assert r["base_failed"] == failed
        assert not (failed and r["kept"])
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert all(kept[100 + i] for i in range(150) if not next(r for r in got if r["doc_id"] == 100 + i)["base_failed"])
    assert not kept[500] and not kept[501] and not kept[502]


def test_distance_is_a_distance():
    rng = np.random.default_rng(1)
    p, q = rng.dirichlet(np.ones(9)), rng.dirichlet(np.ones(9))
    assert quality_rules.jensen_shannon(p[None] * 1e6, p)[0] < 1e-3
    assert np.isclose(quality_rules.jensen_shannon(p[None], q)[0], quality_rules.jensen_shannon(q[None], p)[0])
    apart = quality_rules.jensen_shannon(np.array([[5.0, 0.0], [0.0, 0.0]]), np.array([0.0, 1.0]))
    assert np.allclose(apart, [1.0, 0.0])


def test_empty_table(make_docs):
    assert quality_rules.judge(make_docs([(1, "x")]).limit(0)).count() == 0


def test_every_language_has_its_own_reference(make_docs):
    rng = random.Random(9)
    # The last of 262 languages are smaller, with words and letters of their own.
    rows = [(i, "\n".join(normal_text(rng, 14) for _ in range(110)), f"l{i}", "web") for i in range(257)]
    for k in range(257, 262):
        words = [f"ж{k}щ{j}" for j in range(40)]
        rows += [(1000 + k * 4 + i, "\n".join(" ".join(rng.choices(words, k=12)) for _ in range(25)), f"l{k}", "web") for i in range(4)]
    # A language without enough words is not judged by distance.
    rows += [(9000, " ".join(f"юя{j}" for j in range(200)), "tiny", "web")]
    got = quality_rules.judge(make_docs(rows)).select("row.doc_id", "row.lang", "class_distance", "base_failed", "kept").collect()
    assert len(got) == len(rows)
    assert all(r["kept"] for r in got if not r["base_failed"])
    assert sum(not r["base_failed"] for r in got if r["doc_id"] >= 1000) == 21
    assert all((r["class_distance"] is None) == (r["lang"] == "tiny") for r in got)
