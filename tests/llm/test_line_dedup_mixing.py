from __future__ import annotations

import hashlib
import math
import random
from collections import Counter, defaultdict

import pytest

from martloom.llm import line_dedup, mixing

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def dedup(rows):
    holders = defaultdict(set)
    low = -(1 << 63)

    def key(line):
        return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)

    for d, t, *_ in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                holders[key(line)].add(low if d is None else d)
    out = []
    for d, t, *_ in rows:
        lines = (t or "").split("\n")
        lost = [len(holders.get(key(x), ())) >= 3 and (low if d is None else d) != max(holders[key(x)]) for x in lines]
        kept = "\n".join(x for x, gone in zip(lines, lost, strict=True) if not gone)
        out.append((d, len(lines), sum(lost), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_lines_equal_brute_force(make_docs, messy):
    rng = random.Random(5)
    pool = [f"A shared line of text, number {i} é" for i in range(15)] + ["short line", "", "   ", "12345678901234567890", "1234567890123456789"]
    rows = list(messy) + [(100 + i, "\n".join(f"{' ' * rng.randint(0, 2)}{rng.choice(pool)}\t" for _ in range(rng.randint(0, 40)))) for i in range(60)]
    rows += [(rng.randint(100, 120), "\n".join(p.upper() for p in pool)) for _ in range(4)] + [(None, "\n".join(pool))]
    docs = make_docs(rows)
    bitmaps = line_dedup.keep_bitmaps(docs)
    got = line_dedup.digest_columns(line_dedup.apply_bitmaps(docs, bitmaps)).collect()
    assert sorted([tuple(r) for r in got], key=repr) == dedup(rows)
    for r in bitmaps.collect():
        assert sum(k["lines"] for k in r["keep"]) == r["n_lines"] - r["n_dropped"]
    empty = docs.limit(0)
    assert line_dedup.apply_bitmaps(empty, line_dedup.keep_bitmaps(empty)).count() == 0


@pytest.mark.parametrize("mean", [0.05, 0.7, 1.0, 3.5, 40.0, 200.0])
def test_counts_follow_the_poisson_distribution(spark, mean):
    n = 4000
    docs = spark.range(n).selectExpr("id AS doc_id", "'a' AS source")
    rates = spark.createDataFrame([("a", mean)], "source string, rate double")
    got = mixing.replicate(docs, rates).groupBy("row.doc_id").count().collect()
    counts = Counter(r["count"] for r in got)
    counts[0] = n - len(got)
    average = sum(k * c for k, c in counts.items()) / n
    assert abs(average - mean) < 5 * math.sqrt(mean / n)
    assert abs(sum((k - average) ** 2 * c for k, c in counts.items()) / n - mean) < 8 * mean * math.sqrt(2 / n) + 5 * math.sqrt(mean / n)
    assert abs(counts[0] / n - math.exp(-mean)) < 5 * math.sqrt(math.exp(-mean) / n) + 1e-9


def test_steps_reach_the_resolution_of_the_draw(spark):
    for mean in (0.001, 1.0, 64.0):
        steps = spark.range(1).select(mixing.poisson_steps(mixing.F.lit(mean)).alias("s")).first()["s"]
        assert 1 - steps[-1] < 1e-12 and steps == sorted(steps)


def test_sources_get_their_weights_and_rows_are_repeatable(make_docs, messy):
    rows = [(i, f"t{i}", "en", "big" if i % 10 else "small") for i in range(6000)] + [(7000 + i, "n", "en", None) for i in range(300)]
    docs = make_docs([*rows, *messy])
    rates = mixing.weight_rates(docs, {"big": 1.0, "small": 2.0, None: 1.0}, total=8000)
    mixed = mixing.replicate(docs, rates)
    count = {r["source"]: r["count"] for r in mixed.groupBy("row.source").count().collect()}
    assert set(count) == {"big", "small", None}
    assert abs(count["small"] - 4000) < 400 and abs(count["big"] - 2000) < 250 and abs(count[None] - 2000) < 250
    again = mixing.replicate(docs.repartition(7), rates)
    names = ["row.doc_id", "row.text", "copy_no", "shuffle_key"]
    assert sorted(map(repr, mixed.select(*names).collect())) == sorted(map(repr, again.select(*names).collect()))
    assert mixed.select("row.*").dtypes == docs.dtypes
    even = mixing.temperature_rates(docs, power=0.0).collect()
    assert len({r["source"] for r in even}) == 4
    assert mixing.replicate(docs.limit(0), rates).count() == 0


def test_few_sources_move_no_documents(spark, make_docs):
    docs = make_docs([(i, f"{i} " * 400, "en", f"s{i % 3}") for i in range(400)])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "60KB")
    try:
        mixed = mixing.replicate(docs, mixing.temperature_rates(docs))
        plan = mixed._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
