"""Sentence borders and phrases: planted cases and plain formulas."""

import math
import random

import pytest

from textgauge.operators import sentences
from textgauge.operators.bootstrap import bootstrap_intervals, metric_replicates, ranking_replicates
from textgauge.operators.vocabulary import phrases


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(8)
    words = [f"{a}{b}" for a in ("lo", "mi", "ra", "tu", "se") for b in ("pan", "kel", "dor", "vis", "non", "gar")]
    starters = ["However", "Then", "This"]

    def sentence():
        body = [rng.choice(words) for _ in range(rng.randrange(4, 9))]
        if rng.random() < 0.5:
            body.insert(2, rng.choice(["Dr. Kelsor", "approx. seven", "e.g. none", "Mr. Tulane"]))
        return f"{rng.choice(starters)} {' '.join(body)}{rng.choice(['.', '.', '!', '?'])}"

    texts, counts = [], []
    for _ in range(400):
        n = rng.randrange(1, 6)
        texts.append(" ".join(sentence() for _ in range(n)))
        counts.append(n)
    rows = [(i, t) for i, t in enumerate(texts)] + [(400, None), (401, "  "), (402, "no mark at all"), (403, "One (two.) Three")]
    return spark.createDataFrame(rows, "k int, text string").repartition(3).cache(), counts


def test_abbreviations_starters_and_counts(corpus):
    df, counts = corpus
    borders = sentences.fit_borders(df, "text")
    assert {r.word for r in borders.abbreviations.collect()} == {"dr", "approx", "e.g", "mr"}
    assert {"however", "then", "this"} <= {r.word for r in borders.starters.collect()}
    assert ("dr", "kelsor") in {(r.word, r.following) for r in borders.collocations.collect()}
    got = {r.k: r.n_sentences for r in sentences.trained_sentence_counts(df, "text", "k", borders).collect()}
    assert [got[i] for i in range(400)] == counts
    assert (got[400], got[401], got[402], got[403]) == (0, 0, 1, 2)


def test_scores_follow_the_published_formula(corpus):
    df, _ = corpus
    found = {r.word: r for r in sentences.abbreviations(sentences.word_pairs(df, "text")).collect()}
    pairs = [(r.word, r.mark) for r in sentences.word_pairs(df, "text").collect() if r.word]
    share = sum(m == "." for _, m in pairs) / len(pairs)
    for word, letters, inner in (("dr", 2, 0), ("e.g", 2, 1)):
        a = sum(p == (word, ".") for p in pairs)
        b = sum(p[0] == word for p in pairs) - a
        ratio = 2 * (a * math.log(0.99) + b * math.log(0.01) - a * math.log(share) - b * math.log(1 - share))
        assert found[word].score == pytest.approx(ratio * math.exp(-letters) * (inner + 1) * letters ** (-b))


def test_an_empty_corpus_has_no_borders(spark):
    none = spark.createDataFrame([], "k int, text string")
    borders = sentences.fit_borders(none, "text")
    assert not borders.abbreviations.collect() and not borders.starters.collect() and not borders.collocations.collect()
    assert sentences.trained_sentence_counts(none, "text", "k", borders).collect() == []


def test_phrases_take_their_words_occurrences(spark):
    rng = random.Random(2)
    texts = []
    for _ in range(300):
        words = [f"w{rng.randrange(30)}" for _ in range(10)]
        words.insert(rng.randrange(10), "new york")
        texts.append((" ".join(words), 1))
    df = spark.createDataFrame([*texts, ("york is new", 1), (None, 0)], "text string, y int")
    got = {(r.y, r.word): r for r in phrases(df, "text", "y").collect()}
    pair = got[1, "new york"]
    assert pair.n == 300 and got[1, "new"].n == 1 and got[1, "york"].n == 1 and got[1, "is"].score is None
    k, a, b, n = 300, 301, 301, 300 * 12 + 3

    def part(x, m, p):
        return x * math.log(max(p, 1e-10)) + (m - x) * math.log(max(1 - p, 1e-10))

    want = 2 * (part(k, a, k / a) + part(b - k, n - a, (b - k) / (n - a)) - part(k, a, b / n) - part(b - k, n - a, b / n))
    assert pair.score == pytest.approx(want)
    assert got[0, "none"].n == 1


# ---- intervals ----


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(6)
    rows = []
    for _ in range(2000):
        y = int(rng.random() < 0.35)
        p = round(min(1.0, max(0.0, rng.gauss(0.6 if y else 0.4, 0.2))), 3)
        rows.append((y, int(p > 0.5), p))
    return spark.createDataFrame(rows, "label int, prediction int, probability double"), rows


def test_intervals_agree_with_the_analytic_ones(scored):
    df, rows = scored
    got = {r.metric: r for r in bootstrap_intervals(df, 1000, 400).collect()}
    assert set(got) == {"accuracy", "precision", "recall", "f1", "roc_auc", "brier_score"}
    n = len(rows)
    right = sum(y == p for y, p, _ in rows) / n
    width = 2 * 1.96 * math.sqrt(right * (1 - right) / n)
    for metric in ("accuracy", "recall"):
        assert got[metric].lower_bound < right < got[metric].upper_bound
        assert abs(got[metric].upper_bound - got[metric].lower_bound - width) < 0.15 * width
    ones, zeros = [p for y, _, p in rows if y], [p for y, _, p in rows if not y]
    wins = [[(a > b) + (a == b) / 2 for b in zeros] for a in ones]
    by_one = [sum(w) / len(zeros) for w in wins]
    by_zero = [sum(w[j] for w in wins) / len(ones) for j in range(len(zeros))]
    auc = sum(by_one) / len(ones)

    def variance(x):
        return sum((v - auc) ** 2 for v in x) / (len(x) - 1)

    width = 2 * 1.96 * math.sqrt(variance(by_one) / len(ones) + variance(by_zero) / len(zeros))
    assert got["roc_auc"].lower_bound < auc < got["roc_auc"].upper_bound
    assert abs(got["roc_auc"].upper_bound - got["roc_auc"].lower_bound - width) < 0.2 * width
    errors = [(p - y) ** 2 for y, _, p in rows]
    mean = sum(errors) / n
    width = 2 * 1.96 * math.sqrt(sum((e - mean) ** 2 for e in errors) / n / n)
    assert got["brier_score"].lower_bound < mean < got["brier_score"].upper_bound
    assert abs(got["brier_score"].upper_bound - got["brier_score"].lower_bound - width) < 0.2 * width


def test_replicates_do_not_depend_on_the_partitioning(scored):
    df, _ = scored
    for draw in (lambda d: metric_replicates(d, 20), lambda d: ranking_replicates(d, 20), lambda d: ranking_replicates(d, 20, per_range=50)):
        a, b = ({r.replicate: [round(x, 9) for x in r[1:]] for r in draw(d).collect()} for d in (df, df.repartition(7)))
        assert a == b and len(a) == 20
    one = {r.replicate: r.roc_auc for r in ranking_replicates(df, 10).collect()}
    many = {r.replicate: r.roc_auc for r in ranking_replicates(df, 10, per_range=40).collect()}
    assert one == pytest.approx(many)


def test_intervals_of_one_class_and_of_nothing(spark):
    df = spark.createDataFrame([(1, 1, 0.9)] * 5, "label int, prediction int, probability double")
    got = {r.metric: r.lower_bound for r in bootstrap_intervals(df, 10, 10).collect()}
    assert got["accuracy"] == 1.0 and got["roc_auc"] is None and abs(got["brier_score"] - 0.01) < 1e-9
    assert all(r.lower_bound is None for r in bootstrap_intervals(df.limit(0), 10, 10).collect())


# ---- subwords ----


def test_subword_counts_are_those_of_whole_texts(spark, sf):
    import public_tokenizers
    import sentencepiece

    from textgauge.functions import text as X
    from textgauge.operators import subwords

    model = public_tokenizers.path("piece_bpe_32k.model")
    processor = sentencepiece.SentencePieceProcessor(model_file=model)
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-1, None), (-2, " \n "), (-3, "the " * 5000), (-4, "one")], "doc_id bigint, text string")
    docs = docs.union(odd)
    got = {r.doc_id: r.n_subwords for r in subwords.subword_counts(docs, "text", "doc_id", model).collect()}
    want = {r.doc_id: len(processor.encode(r.t)) if r.t else 0 for r in docs.select("doc_id", X.clean_light("text").alias("t")).collect()}
    assert got == want
    kept = {r.doc_id for r in subwords.filter_subwords(docs, "text", "doc_id", model, 100).collect()}
    assert kept == {k for k, n in want.items() if n <= 100}
