"""The fit along penalties and the closed-form classifier against plain versions and Spark ML."""

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from textgauge.config import TrainConfig
from textgauge.operators import bayes
from textgauge.operators.metrics import classification_metrics
from textgauge.operators.model import as_model, best_of, scored_columns, train
from textgauge.operators.penalties import confusion, fit_penalties, weighted_scores
from textgauge.operators.sampling import split_rows

LADDER = (1.0, 0.3, 0.1, 0.03, 0.01, 0.003, 0.001)


def vectors(spark, n=600, size=40, seed=4, dense=False):
    rng = np.random.default_rng(seed)
    truth = rng.normal(size=size) * (rng.random(size) < 0.4)
    rows = []
    for i in range(n):
        x = np.where(rng.random(size) < 0.3, rng.gamma(2, 1, size), 0.0)
        x[size - 1] = 2.5  # never varies
        y = float(rng.random() < 1 / (1 + math.exp(-(x @ truth) * 0.7)))
        rows.append((y, Vectors.dense(x) if dense else Vectors.sparse(size, [(int(j), float(x[j])) for j in np.flatnonzero(x)])))
    return spark.createDataFrame(rows, ["label", "features"]).repartition(5)


@pytest.mark.parametrize("dense", [False, True])
def test_all_penalties_reach_the_optimum_of_spark_ml(spark, dense):
    rows = vectors(spark, dense=dense).cache()
    fits = fit_penalties(rows, "label", LADDER, 40, steps=100, tolerance=1e-9)
    for fit in fits:
        model = LogisticRegression(maxIter=200, regParam=fit.penalty, tol=1e-10).fit(rows)
        assert np.allclose(fit.weights, model.coefficients.toArray(), atol=2e-3)
        assert abs(fit.intercept - model.intercept) < 5e-3
        assert abs(fit.objective[-1] - model.summary.objectiveHistory[-1]) < 1e-5
        assert all(a >= b - 1e-12 for a, b in zip(fit.objective, fit.objective[1:]))
        assert fit.weights[39] == 0


def test_a_pass_serves_all_penalties(spark, monkeypatch):
    from textgauge.operators import penalties

    passes, summed = [], penalties._summed
    monkeypatch.setattr(penalties, "_summed", lambda *a: passes.append(1) or summed(*a))
    fits = fit_penalties(vectors(spark), "label", LADDER, 40)
    longest = max(len(f.objective) for f in fits)
    assert longest <= 51 and len(passes) <= longest + 15 < sum(len(f.objective) for f in fits)


def test_sums_by_spark_are_those_of_the_driver(spark, monkeypatch):
    from textgauge.operators import penalties

    rows = vectors(spark, 300).cache()
    here = fit_penalties(rows, "label", (0.1,), 40)
    monkeypatch.setattr(penalties, "AT_DRIVER", 0)
    monkeypatch.setattr(penalties, "TASK_ROWS", 60)
    monkeypatch.setattr(penalties, "CHUNK", 16)
    there = fit_penalties(rows, "label", (0.1,), 40)
    assert np.allclose(here[0].weights, there[0].weights, atol=1e-6) and abs(here[0].intercept - there[0].intercept) < 1e-6


def test_one_class_or_no_rows(spark):
    rows = vectors(spark, 50)
    for part, sign in ((rows.where("label = 1"), 1), (rows.where("label = 0"), -1), (rows.limit(0), 0)):
        (fit,) = fit_penalties(part, "label", (0.1,), 40)
        assert not fit.weights.any() and np.sign(fit.intercept) == sign


def test_the_model_and_the_counts_say_the_same(spark):
    rows = vectors(spark, seed=9).cache()
    fits = fit_penalties(rows, "label", (0.1, 0.001), 40)
    for fit, table in zip(fits, confusion(rows, "label", fits), strict=True):
        scored = scored_columns(as_model(spark, fit, "label").transform(rows), "label").cache()
        cells = {(r.label, r.prediction): r["count"] for r in scored.groupBy("label", "prediction").count().collect()}
        assert cells == {(i, j): table[i, j] for i in (0, 1) for j in (0, 1) if table[i, j]}
        want = classification_metrics(scored).first()
        got = weighted_scores(table)
        assert np.allclose([got[c] for c in ("accuracy", "precision", "recall", "f1")], [want.accuracy, want.precision_weighted, want.recall_weighted, want.f1])
        margin = [1 / (1 + math.exp(-(r.features.toArray() @ fit.weights + fit.intercept))) for r in rows.limit(5).collect()]
        chance = [r.probability for r in scored_columns(as_model(spark, fit, "label").transform(rows.limit(5)), "label").collect()]
        assert np.allclose(margin, chance)


def noisy(spark, seed, n=900):
    rng = random.Random(seed)
    words = [[f"h{i}" for i in range(60)], [f"a{i}" for i in range(60)]]
    rows = []
    for i in range(n):
        label = int(rng.random() < 0.4)
        rows.append((i, " ".join(rng.choice(words[label if rng.random() < 0.56 else 1 - label]) for _ in range(12)), label))
    return spark.createDataFrame(rows, "k bigint, text string, generated int")


def one_by_one(rows, config):
    """The ladder with a Spark ML fit per penalty."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import IDF, HashingTF

    from textgauge.operators.model import with_tokens

    ready = with_tokens(rows, "text").select("split", F.col("generated").cast("double").alias("generated"), "tokens")
    front = Pipeline(stages=[HashingTF(inputCol="tokens", outputCol="c", numFeatures=config.features), IDF(inputCol="c", outputCol="features", minDocFreq=config.min_texts)])
    features = front.fit(ready.where("split = 'train'")).transform(ready).cache()
    history = []
    for reg in config.reg_ladder:
        model = LogisticRegression(labelCol="generated", maxIter=config.max_iter, regParam=reg).fit(features.where("split = 'train'"))
        row = classification_metrics(scored_columns(model.transform(features.where("split = 'validation'")), "generated")).first()
        history.append({"reg_param": reg, "f1": row["f1"]})
        if best_of(history, config)[1] is not None:
            break
    return history, history[best_of(history, config)[0]]["reg_param"]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_the_ladder_chooses_the_same_penalty(spark, seed):
    config = TrainConfig(features=1 << 10, max_iter=50)
    rows = split_rows(noisy(spark, seed), "generated", "k").cache()
    history, chosen = one_by_one(rows.where("split <> 'test'"), config)
    fitted = train(rows, "text", "generated", config)
    assert [h["reg_param"] for h in fitted.history] == [h["reg_param"] for h in history]
    assert np.allclose([h["f1"] for h in fitted.history], [h["f1"] for h in history], atol=0.02)
    best = max(h["f1"] for h in history)
    assert fitted.reg_param == chosen or abs({h["reg_param"]: h["f1"] for h in history}[fitted.reg_param] - best) < 0.01


def test_search_ends_after_steps_without_a_gain():
    config = TrainConfig(patience=2, min_gain=0.01)
    assert best_of([{"f1": x} for x in (0.5, 0.6, 0.605, 0.606, 0.9)], config) == (3, 3)
    assert best_of([{"f1": x} for x in (0.5, None, 0.7)], config) == (2, None)


def test_three_classes_are_fitted_too(spark):
    rows = spark.createDataFrame([(i, f"w{i % 3} common", i % 3) for i in range(150)], "k bigint, text string, generated int")
    rows = split_rows(rows, "generated", "k")
    fitted = train(rows, "text", "generated", TrainConfig(features=1 << 8, max_iter=10, reg_ladder=(0.1, 0.01)))
    assert fitted.model.stages[-1].numClasses == 3 and fitted.history[0]["f1"] == 1.0


# ---- naive Bayes ----


def plain_bayes(train_rows, texts, alpha):
    counts, seen = {0: Counter(), 1: Counter()}, Counter()
    for text, label in train_rows:
        if text is not None and label in (0, 1):
            counts[label].update(text.lower().split())
            seen[label] += 1
    kinds = len(set(counts[0]) | set(counts[1]))
    out = []
    for text in texts:
        joint = [
            math.log(seen[c] / sum(seen.values())) + sum(math.log((counts[c][t] + alpha) / (sum(counts[c].values()) + alpha * kinds)) for t in (text or "").lower().split() if t in counts[0] or t in counts[1])
            for c in (0, 1)
        ]
        out.append(1 / (1 + math.exp(joint[0] - joint[1])))
    return out


def test_bayes_equals_plain_counting(spark, tmp_path):
    rng = random.Random(3)
    texts = [" ".join(rng.choices(["the"] * 40 + [f"w{i}" for i in range(50)], k=rng.randrange(0, 30))) for _ in range(300)]
    rows = [(i, t, rng.choice([0, 0, 1])) for i, t in enumerate(texts)] + [(300, None, 1), (301, "w1 w2", 7), (302, "w1", None)]
    df = spark.createDataFrame(rows, "k int, text string, y int").repartition(4)
    model = bayes.fit_bayes(df, "text", "y", str(tmp_path / "counts"), alpha=0.5)
    new = spark.createDataFrame([(1, "the w1 w3"), (2, "never seen"), (3, ""), (4, None), (5, "the " * 500)], "k int, text string")
    got = {r.k: r for r in bayes.score_bayes(new, model, "text", "k").collect()}
    want = plain_bayes([r[1:] for r in rows], ["the w1 w3", "never seen", "", None, "the " * 500], 0.5)
    for k in (1, 2, 3, 5):
        assert got[k].probabilities[1] == pytest.approx(want[k - 1], abs=1e-9)
        assert got[k].prediction == int(want[k - 1] > 0.5)
    assert got[4].prediction is None and got[4].probabilities is None


def test_frequent_tokens_are_looked_up_and_rare_ones_joined(spark, tmp_path):
    df = spark.createDataFrame([(i, f"the the rare{i}", i % 2) for i in range(2000)], "k int, text string, y int")
    model = bayes.fit_bayes(df, "text", "y", str(tmp_path / "counts"))
    scored = bayes.score_bayes(df, model, "text", "k", ["y"]).cache()
    assert scored.count() == 2000
    want = {k: plain_bayes([(f"the the rare{i}", i % 2) for i in range(2000)], [f"the the rare{k}"], 1.0)[0] for k in (0, 1, 77)}
    got = {r.k: r.probabilities[1] for r in scored.where(F.col("k").isin(0, 1, 77)).collect()}
    assert all(got[k] == pytest.approx(want[k]) for k in want)
    row = bayes.validation_metrics(scored, "y").first()
    assert (row.n, row.accuracy, row.f1) == (2000, 1.0, 1.0) and 0 < row.loss < math.log(2)


def test_bayes_without_training_rows(spark, tmp_path):
    none = spark.createDataFrame([], "k int, text string, y int")
    model = bayes.fit_bayes(none, "text", "y", str(tmp_path / "counts"))
    with pytest.raises(ValueError):
        bayes.score_bayes(none, model, "text", "k")
    with pytest.raises(ValueError):
        bayes.fit_bayes(none, "text", "y", str(tmp_path / "more"), alpha=0)


def test_many_passes_together_are_summed_by_spark(spark, monkeypatch):
    from textgauge.operators import penalties

    sent, taken = [], penalties.np.frombuffer
    monkeypatch.setattr(penalties.np, "frombuffer", lambda data, kind: sent.append(len(data)) or taken(data, kind))
    rows = vectors(spark, 300).repartition(5).cache()
    monkeypatch.setattr(penalties, "TASK_ROWS", 60)
    # A single pass of all tasks is below the limit, 50 of them are not.
    monkeypatch.setattr(penalties, "AT_DRIVER", 50 * 40 * 8)
    fits = fit_penalties(rows, "label", (0.1,), 40)
    width, passes = 42 * 8, len(fits[0].objective)
    moments = 5 * 82 * 8
    assert sum(sent) <= moments + (passes + 20) * width
