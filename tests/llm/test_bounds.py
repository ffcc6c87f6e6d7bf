"""Samples for fitting: their bounds, at least one row of every group, and very many groups."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from textgauge.llm import embeddings, language, secrets, toxicity
from textgauge.llm.tables import below, draw, sampled


def test_rates_far_below_a_millionth_still_hold(spark):
    rows = spark.range(200_000)
    for rate, low, high in ((1.0, 200_000, 200_000), (0.1, 19_000, 21_000), (1e-4, 5, 45), (1e-9, 0, 0), (0.0, 0, 0)):
        assert low <= rows.filter(below(draw(42, "id"), F.lit(rate))).count() <= high


def test_every_group_has_a_row_and_bounds_hold(spark):
    rows = spark.range(20_000).selectExpr("id", "if(id < 19000, 'a', concat('g', id % 50)) as g", "'x' as _group")
    rows = rows.select("id", "g")
    got = sampled(rows, "g", F.lit(100), 500, 1e9, draw(1, "id"), "test-rates")
    counts = {r.g: r["count"] for r in got.groupBy("g").count().collect()}
    assert len(counts) == 51 and 1 <= counts["a"] <= 20 and all(1 <= n <= 20 for n in counts.values())
    tight = sampled(rows, "g", F.lit(100), 500, 51, draw(1, "id"), "test-rates")
    assert 51 <= tight.count() <= 80
    assert sampled(rows.limit(0), "g", F.lit(1), 1, 1, draw(1, "id"), "test-rates").count() == 0


def test_a_language_of_few_long_texts_is_learnt(spark):
    rows = [(i, "the cat and the dog are in the house", "en") for i in range(200)]
    rows += [(1000 + i, "der Hund und die Katze sind im Haus " * 3000, "de") for i in range(3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for seed in range(4):
        trees = language.train(docs, max_bytes=2000, seed=seed)
        assert trees.langs == ["de", "en"]
        assert language.Scorer(trees).predict("die Katze und der Hund")[0] == "de"


def test_ten_thousand_languages(spark):
    rows = spark.range(12_000).selectExpr("id as doc_id", "concat('word', id % 10000, ' common text') as text", "concat('l', id % 10000) as lang")
    trees = language.train(rows)
    assert len(trees.langs) == 10_000 and trees.cost.size <= language.MOST_COSTS
    found = language.identify(rows.limit(40), trees).collect()
    assert len(found) == 40 and all(r.lang_pred.startswith("l") and 0 < r.score <= 1 for r in found)


def test_combining_marks_belong_to_words():
    assert language.words_of("हिन्दी में लिखा") == ["हिन्दी", "में", "लिखा"]
    assert language.words_of("été 12 über_x") == ["été", "über", "x"]
    for text in ("plain words, 3 of them", "Ünïcode – “quotes” ½ x²", "日本語 テスト"):
        assert language.words_of(text) == language.WORD.findall(text)


def test_a_marked_script_is_recognised(spark):
    hindi = "यह एक छोटा सा वाक्य है और इसमें कुछ शब्द हैं"
    rows = [(i, f"this is a short sentence with some words {i}", "en") for i in range(40)] + [(100 + i, f"{hindi} {i}", "hi") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trees = language.train(docs)
    assert {r.doc_id for r in language.recognised(docs, trees).collect()} == {r[0] for r in rows}
    assert {r.lang_pred for r in language.identify(docs.filter("lang = 'hi'"), trees).collect()} == {"hi"}


def test_labelled_secrets_are_fitted_whole(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(secrets, "Detector", lambda random, ordinary: seen.append((random, ordinary)))
    value = "Ab3" * 200
    docs = spark.createDataFrame([(1, f"token = {value} and {'ordinary' * 60}/x")], "doc_id long, text string")
    secrets.train(docs)
    assert value in seen[0][0] and "ordinary" * 60 + "/x" in seen[0][1]


def test_texts_are_scored_in_slices_of_bounded_bytes():
    texts = ["a" * 10] * 300 + ["b" * 3_000_000, None, "", "c" * 600_000, "d" * 600_000]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], names=["doc_id", "text"])
    parts = list(toxicity._bounded(batch))
    assert [k for p in parts for k in p.column(0).to_pylist()] == list(range(len(texts)))
    for p in parts:
        assert p.num_rows <= 128 and (p.num_rows == 1 or sum(len(t or "") for t in p.column(1).to_pylist()) <= 1 << 20)
    assert list(toxicity._bounded(batch.slice(0, 0))) == []


def test_both_classes_reach_the_network(spark):
    docs = spark.createDataFrame([(i, "mild words " * 3000 if i < 3 else "fine text") for i in range(300)], "doc_id long, text string").withColumn("lang", F.lit("en"))
    labels = spark.range(300).selectExpr("id as doc_id", "int(id < 3) as toxic")
    model = toxicity.train(docs, labels, max_documents=40, max_bytes=4000)
    assert len(model.network.hashes) or model.network.c != 0


@pytest.mark.parametrize("lengths", [60])
def test_many_vector_lengths(spark, lengths):
    rows = [(i, [float((i * j) % 7 + 1) for j in range(1 + i % lengths)]) for i in range(4 * lengths)]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = embeddings.near_duplicates(vectors).collect()
    assert len(found) == len(rows)
