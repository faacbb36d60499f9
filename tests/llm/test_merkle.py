from __future__ import annotations

import hashlib
import zlib

import pytest

from martloom.llm import merkle
from martloom.llm.merkle import F


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def part(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf_of(doc_id, text, lang, source, n_chars):
    return sha("".join(part(v) for v in (doc_id, source, lang, n_chars, text)))


def brute(rows):
    """(id, leaf, subroot, root, digest of the proof, root from the changed row) by a plain tree."""
    leaves = [leaf_of(*row) for row in rows]
    siblings = [[] for _ in rows]

    def climb(nodes):
        while len(nodes) > 1:
            above = []
            for k in range(0, len(nodes), 2):
                run = nodes[k : k + 2]
                for member in run[0][1]:
                    siblings[member].append(("right", run[1][0]) if len(run) == 2 else ("alone", ""))
                for member in run[1][1] if len(run) == 2 else ():
                    siblings[member].append(("left", run[0][0]))
                above.append((sha("".join(n[0] for n in run)), [m for n in run for m in n[1]]))
            nodes = above
        return nodes[0]

    groups = {}
    for i, row in enumerate(rows):
        groups.setdefault(row[2], []).append(i)
    tops = []
    for lang in sorted(groups, key=lambda g: (g is not None, (g or "").encode())):
        order = sorted(groups[lang], key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, leaves[i]))
        tops.append(climb([(leaves[i], [i]) for i in order]))
    subroot = {m: top[0] for top in tops for m in top[1]}
    root = climb(tops)[0]
    out = []
    for i, (doc_id, text, lang, source, n_chars) in enumerate(rows):
        at = leaves[i]
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 0:
            at = leaf_of(doc_id, text, lang, source, None if n_chars is None else n_chars + 1)
        for side, other in siblings[i]:
            at = sha(at + other) if side == "right" else sha(other + at)
        out.append((doc_id, leaves[i], subroot[i], root, sha("".join(s for _, s in siblings[i])), at, at == root))
    return sorted(out, key=repr)


@pytest.fixture
def make(spark):
    def build(rows):
        return spark.createDataFrame(
            [(*row, 1, "x", b"y") for row in rows],
            "doc_id bigint, text string, lang string, source string, n_chars bigint, tree int, digest string, segment binary",
        )

    return build


def manifest(docs):
    changed = F.when(F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False)), F.col("n_chars") + 1)
    return merkle.manifest(docs, changed={"n_chars": F.coalesce(changed, F.col("n_chars"))})


MESSY = [
    (1, "a", "en", "web", 1), (1, "a", "en", "web", 1), (1, "b", "en", None, None), (None, "no id", "en", "web", 5), (2, None, "en", "web", None),
    (3, "", "", "web", 0), (4, "long " * 50_000, None, "x", 250_000), (5, "é 漢字 😀", None, "x", 7), (-6, "t", "zz", "x", 1), (7, "t", "é", "", 1),
]


@pytest.mark.parametrize("block", [1, 3, 10])
def test_proofs_equal_a_plain_tree(make, monkeypatch, block):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", block)
    rows = [*MESSY, *[(100 + 3 * i, f"text {i}", "de", "web", i) for i in range(37)]]
    got = merkle.digest_columns(manifest(make(rows))).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


@pytest.mark.parametrize("rows", [MESSY[:1], MESSY[:2], MESSY[5:7], [(i, "t", f"l{i}", "s", 1) for i in range(5)]])
def test_small_trees(make, rows):
    got = merkle.digest_columns(manifest(make(rows))).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_empty_table(make):
    got = merkle.digest_columns(manifest(make(MESSY).limit(0)))
    assert got.count() == 0
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def test_joins_without_broadcast_give_the_same(make, monkeypatch):
    rows = [(i, f"text {i}", "de" if i % 3 else "fr", "web", i) for i in range(70)]
    monkeypatch.setattr(merkle, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 2)
    got = merkle.digest_columns(manifest(make(rows))).collect()
    assert sorted(map(tuple, got), key=repr) == brute(rows)


def test_changed_rows_and_strangers_are_not_verified(make):
    rows = [(i, f"text {i}", "de", "web", i) for i in range(9)]
    proofs = merkle.manifest(make(rows))
    shown = [*rows[:7], (7, "another text", "de", "web", 7), (99, "a stranger", "de", "web", 1)]
    got = {r["id"]: r["verified"] for r in merkle.verify(proofs, make(shown)).collect()}
    assert got == {**{i: True for i in range(7)}, 7: False, 99: False}


def test_a_segment_grows_with_the_depth_only(make):
    proofs = merkle.manifest(make([(i, "t", "de", "web", i) for i in range(65)]))
    assert {len(r["segment"]) for r in proofs.select("segment").collect()} == {7}
