"""Bounds on what a task or the driver holds."""

import random

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from yardline.llm import bpe, common, language, quality_classifier, simhash, vector_join
from yardline.llm.common import lookup, settle
from yardline.llm.components import components


def test_chunks_remembered_are_bounded_in_bytes():
    words = bpe.Vocabulary(public_tokenizers.path("word_bpe_49k.json"))
    words.whole.most = 1 << 20
    rng = random.Random(1)
    for _ in range(200):
        words.encode("".join(chr(0x4E00 + rng.randrange(2000)) for _ in range(2000)))
    assert not any(len(c) > bpe.LONGEST for c in (*words.whole, *words.whole.older))
    for _ in range(40):
        words.encode(" ".join("".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(500)))
        assert words.whole.held < (1 << 20) + 500 * 1000
    assert words.whole.older


def test_sample_of_null_and_repeated_ids(spark):
    rows = [(None, f"text number {i}", "en") for i in range(3000)] + [(7, "the same", "en")] * 3000 + [(i, "ein Text", "de") for i in range(50)]
    got = language.sampled(spark.createDataFrame(rows, "id long, text string, lang string"), 30).collect()
    assert sum(r.lang == "de" for r in got) == 1
    assert 8 <= sum(r.lang == "en" for r in got) <= 70


def test_labels_without_a_page_do_not_shrink_the_sample(spark, monkeypatch):
    used = []
    monkeypatch.setattr(quality_classifier, "co_train", lambda views, y, *rest: used.append(len(y)))
    pages = spark.createDataFrame([(i, f"text {i}", "s", "en", 7) for i in range(60)], "id long, text string, source string, lang string, size long")
    labels = spark.range(40_000).selectExpr("id + 10 AS id", "id % 2 AS label")
    quality_classifier.fit(pages, labels, labelled=100)
    assert used == [50]


def broadcasts(df):
    """Broadcasts in the plan that ran."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().count("BroadcastExchange")


def test_cells_asked_for_are_not_broadcast(spark):
    """Spark counts a fingerprint once, whatever the number of cells it asks for."""
    nodes, drop = settle(spark.range(2000).select(F.xxhash64("id").alias("fp")))
    assert broadcasts(simhash.links(nodes)) == 0
    drop()


def test_salted_rows_are_not_broadcast(spark, monkeypatch):
    big = spark.range(3000).selectExpr("id % 50 AS key", "id AS v")
    small, drop = settle(spark.range(40).selectExpr("if(id = 39, null, id) AS key", "id * 2 AS w"))
    before = sorted(tuple(r) for r in lookup(big, small, ["key"]).collect())
    monkeypatch.setattr(common, "SMALL_ROWS", 30)
    for how in ("left", "inner", "left_semi"):
        assert broadcasts(lookup(big, small, ["key"], how)) == 0
    assert broadcasts(lookup(big, small.limit(40), ["key"], "inner", 31)) == 0
    assert sorted(tuple(r) for r in lookup(big, small, ["key"]).collect()) == before
    drop()


def test_vectors_are_not_broadcast(spark):
    rows = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(50)], "vec_id long, embedding array<float>")
    assert broadcasts(vector_join.near_duplicates(rows)) == 0


def test_links_of_the_pipeline_are_not_broadcast(spark, monkeypatch):
    found = []
    monkeypatch.setattr(simhash, "components", lambda links: found.append(broadcasts(links)) or components(links))
    docs = spark.createDataFrame([(i, f"some text of number {i} {i * i}", "en", "s", 9) for i in range(300)], "doc_id long, text string, lang string, source string, n_chars long")
    assert 0 < corpus_pipeline.near_dedup(spark, docs, "").count() <= 300
    assert found == [0]
