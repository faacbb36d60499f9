from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

import corpus_pipeline
from martloom.llm import toxicity
from martloom.llm.common import stored, table
from martloom.llm.oracle import ORACLE
from martloom.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def labelled(rng, n):
    vocabulary = ["house", "river", "green", "walk", "often", "table", "grand", "other"]
    rows, labels = [], []
    for i in range(n):
        words = rng.choices(vocabulary, k=rng.randint(5, 80))
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["blockhead", "nitwit!", "Dunce"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_features_are_the_distinct_grams_inside_words():
    slots, row = toxicity.features(["Abcd, abcd", "", "abcd", "漢字漢字"])
    assert set(slots[row == 0].tolist()) == set(slots[row == 2].tolist())
    assert len(slots[row == 2]) == len({" abc", "abcd", "bcd ", " abcd "}) and len(slots[row == 1]) == 0 and (row == 3).any()


def test_learns_from_training_folds_only_and_holds_out(spark, make_docs, messy):
    rows, labels = labelled(random.Random(1), 600)
    # Labels of the held-out fold are turned round: a fit that used them would be worse.
    turned = [(d, q, 1 - t if zlib.crc32(str(d).encode()) % 5 == 0 else t) for d, q, t in labels]
    turned += [(None, 1, 1), (5, None, None), *turned[:3]]
    frame = spark.createDataFrame(turned, "doc_id bigint, quality int, toxic int")
    docs = make_docs([*rows, *[(d if d is None else d + 10_000, *r) for d, *r in messy]])
    got = toxicity.digest_columns(toxicity.score(docs, frame)).collect()
    assert len(got) == len(rows) + len(messy)
    truth = {d: t for d, _, t in labels}
    held = [r for r in got if r["doc_id"] in truth and r["held_out"]]
    assert {r["doc_id"] for r in held} == {d for d in truth if zlib.crc32(str(d).encode()) % 5 == 0}
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)


def test_the_sample_has_one_text_of_an_id_however_many_rows_share_it(spark):
    docs = spark.range(5000).selectExpr("id % 50 AS doc_id", "concat('text ', id) AS text").repartition(7)
    labels = spark.range(50).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS toxic")
    sample, _ = toxicity.training_sample(docs, labels, per_class=10)
    rows = sample.collect()
    assert len(rows) == 20 == len({r["doc_id"] for r in rows})
    again, _ = toxicity.training_sample(docs.repartition(3), labels, per_class=10)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again.collect()))


def test_without_labels_all_scores_are_equal(spark, make_docs, messy):
    nothing = spark.createDataFrame([], "doc_id bigint, toxic int")
    got = toxicity.score(make_docs(messy), nothing).collect()
    assert len({r["score"] for r in got}) == 1 and len(got) == len(messy)
    assert toxicity.score(make_docs(messy).limit(0), nothing).count() == 0


def test_stages_keep_the_columns_and_only_remove_what_they_should(spark):
    docs = table(spark, SMALL, "documents")
    columns, before = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    scores = {r["doc_id"]: r["predicted"] for r in QUERIES["op7_toxicity"](spark, SMALL).collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SMALL), f"test-{name}")
        assert docs.columns == columns, name
        after = [r["doc_id"] for r in docs.collect()]
        assert {r["doc_id"]: r["text"] for r in docs.collect()}.items() <= before.items()
        if name == "toxicity":
            assert set(after) == {d for d, p in scores.items() if not p}
        if name != "mixing":
            assert len(after) == len(set(after))
    index = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).orderBy("start").collect()
    assert sorted(r["doc_id"] for r in index) == sorted(r["doc_id"] for r in docs.collect())
    assert [r["doc_id"] for r in index] == sorted(r["doc_id"] for r in index)


def test_run_gives_the_rows_of_its_stages(spark):
    docs = table(spark, SMALL, "documents")
    for name, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, SMALL), f"again-{name}")
    assert sorted(map(tuple, corpus_pipeline.run(spark, SMALL).collect())) == sorted(map(tuple, docs.collect()))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_equal_their_sql(spark, name):
    import duckdb

    from checks.compare import _rows

    con = duckdb.connect()
    for t in ("documents", "benchmark", "labels", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    result = con.execute(ORACLE[name])
    columns = [d[0] for d in result.description]
    got = QUERIES[name](spark, SMALL)
    assert sorted(got.columns) == sorted(columns)
    assert _rows(got.columns, got.collect()) == _rows(columns, result.fetchall())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_every_query_covers_the_whole_table(spark, name):
    got = QUERIES[name](spark, SMALL)
    if name == "op11_shallot_clusters":
        ids = [r["vec_id"] for r in table(spark, SMALL, "embeddings").select("vec_id").collect()]
        assert sorted(r["vec_id"] for r in got.select("vec_id").collect()) == sorted(ids)
        return
    ids = {r["doc_id"] for r in table(spark, SMALL, "documents").select("doc_id").collect()}
    found = [r["doc_id"] for r in got.select("doc_id").collect()]
    assert set(found) <= ids if name == "op3_mix_sources" else sorted(found) == sorted(ids)
