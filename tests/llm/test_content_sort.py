from __future__ import annotations

import hashlib
import random
import re

from martloom.llm import content_sort


def normal(text):
    return re.sub("[\x20\x09-\x0d]+", " ", text or "")


def brute(rows):
    """(id, keep_id, group_size, digest) of every row, and how many rows of each text are kept."""
    groups = {}
    for doc_id, text, *_ in rows:
        groups.setdefault(normal(text), []).append(doc_id)
    out = []
    for doc_id, text, *_ in rows:
        ids = groups[normal(text)]
        out.append((doc_id, min((i for i in ids if i is not None), default=None), len(ids), hashlib.sha256(normal(text).encode()).hexdigest()))
    return sorted(out, key=repr)


def check(docs, rows, pieces):
    got = content_sort.exact_duplicates(docs, pieces=pieces).collect()
    assert sorted([(r["id"], r["keep_id"], r["group_size"], r["digest"]) for r in got], key=repr) == brute(rows)
    kept = [r for r in got if r["kept"]]
    assert len(kept) == len({r["digest"] for r in got}) == len({r["digest"] for r in kept})
    assert all(r["id"] == r["keep_id"] for r in kept)


def test_groups_equal_brute_force(make_docs, messy):
    rng = random.Random(3)
    begin = "the same long beginning of very many texts, as a header is, " * 3
    rows = [*messy, (7, None), (11, " "), (12, " "), (13, "\t"), (14, "\x1f"), (15, "a\x0bb"), (16, "a \n b"), (17, "a b ")]
    rows += [(1000 + i, begin + str(rng.randint(0, 40)) + " " * rng.randint(0, 3)) for i in range(300)]
    rows += [(2000 + i, "hot  text" if i % 2 else "hot text") for i in range(500)]
    rng.shuffle(rows)
    for pieces in (1, 7):
        check(make_docs(rows), rows, pieces)


def test_empty_table_and_missing_ids(make_docs):
    rows = [(None, "x"), (None, "x"), (None, "y")]
    check(make_docs(rows), rows, 4)
    empty = make_docs(rows).limit(0)
    assert content_sort.exact_duplicates(empty).count() == 0
    assert content_sort.digest_columns(content_sort.exact_duplicates(empty)).columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def test_dropping_copies_keeps_columns_and_least_ids(make_docs, messy):
    docs = make_docs(messy)
    kept = content_sort.drop_copies(docs)
    assert kept.dtypes == docs.dtypes
    least = {normal(text): None for _, text, *_ in messy}
    for doc_id, text, *_ in messy:
        best = least[normal(text)]
        least[normal(text)] = doc_id if best is None or (doc_id is not None and doc_id < best) else best
    assert sorted([(r["doc_id"], normal(r["text"])) for r in kept.collect()], key=repr) == sorted([(i, t) for t, i in least.items()], key=repr)


def test_the_plan_has_no_python_and_one_exchange_of_texts(make_docs, messy, capsys):
    content_sort.sorted_runs(make_docs(messy), pieces=4).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("rangepartitioning") == 1 and "hashpartitioning" not in plan


def test_a_hot_group_is_dealt_over_partitions(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "if(id % 3 = 0, repeat('copy ', 50), concat('text ', id)) AS text")
    runs = content_sort.sorted_runs(docs, pieces=32).select("piece", "head", content_sort.F.spark_partition_id().alias("part"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = [r["count"] for r in runs.groupBy("part").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) >= 4 and max(sizes) < 20_000 / 3
    assert runs.where("head").count() <= 2 * 20_000 / 3 + 32 + 1
