"""Metrics, curves, calibration and gates against brute force on hand-written and generated scores."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from textgauge.config import GateConfig
from textgauge.functions.stats import chi2_tail
from textgauge.operators import bootstrap, calibration, gates, metrics, ranking

SCHEMA = "label int, prediction int, probability double"


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def from_cells(spark, tn, fp, fn, tp):
    rows = [(0, 0, 0.1)] * tn + [(0, 1, 0.9)] * fp + [(1, 0, 0.1)] * fn + [(1, 1, 0.9)] * tp
    return table(spark, rows)


def generated(n=700, seed=5):
    rng = np.random.default_rng(seed)
    label = (rng.random(n) < 0.3).astype(int)
    p = np.clip(rng.normal(0.35 + 0.3 * label, 0.25), 0, 1)
    p = np.where(np.arange(n) % 3 == 0, np.round(p, 1), p)  # a third of the scores tie
    return label, (p > 0.5).astype(int), p


def zipped(label, prediction, p):
    return [(int(a), int(b), float(c)) for a, b, c in zip(label, prediction, p)]


def test_metrics(spark):
    label, pred, p = generated()
    df = table(spark, zipped(label, pred, p))
    row = metrics.classification_metrics(df).first()
    f1s, precisions, recalls, supports = [], [], [], []
    for c in (0, 1):
        hit = ((label == c) & (pred == c)).sum()
        precisions.append(hit / (pred == c).sum())
        recalls.append(hit / (label == c).sum())
        f1s.append(2 * precisions[-1] * recalls[-1] / (precisions[-1] + recalls[-1]))
        supports.append((label == c).sum())
    assert np.isclose(row.accuracy, (label == pred).mean())
    assert np.isclose(row.f1_macro, np.mean(f1s)) and np.isclose(row.f1, np.average(f1s, weights=supports))
    assert np.isclose(row.precision_weighted, np.average(precisions, weights=supports))
    assert np.isclose(row.recall_macro, np.mean(recalls))
    assert np.isclose(metrics.brier_score(df).first()[0], np.mean((p - label) ** 2))


def test_absent_classes(spark):
    df = table(spark, [(0, 1, 0.9)] * 3)
    rows = {r.label: r for r in metrics.per_class_metrics(df).collect()}
    assert (rows[0].precision, rows[0].recall, rows[0].f1, rows[0].support) == (0, 0, 0, 3)
    assert rows[1].support == 0 and rows[1].name == "ai"
    assert {(r.label, r.prediction): r.n for r in metrics.confusion_matrix(df).collect()} == {
        (0, 0): 0, (0, 1): 3, (1, 0): 0, (1, 1): 0,
    }
    assert ranking.ranking_metrics(df).first() == (None, None)
    summary = metrics.evaluation_summary(df, ranking.ranking_metrics(df), calibration.expected_calibration_error(df))
    values = {r.metric: r.value for r in summary.collect()}
    assert values["roc_auc"] == values["average_precision"] == 0.0


def brute_auc(label, p):
    pos, neg = p[label == 1], p[label == 0]
    return np.mean((pos[:, None] > neg) + 0.5 * (pos[:, None] == neg))


def brute_ap(label, p):
    cuts, last, total = sorted(set(p), reverse=True), 0.0, 0.0
    for c in cuts:
        recall = label[p >= c].sum() / label.sum()
        total += (recall - last) * label[p >= c].mean()
        last = recall
    return total


@pytest.mark.parametrize("kind", ["mixed", "ties", "saturated", "perfect", "edges"])
def test_ranking(spark, kind):
    label, pred, p = generated()
    if kind == "ties":
        p = np.full_like(p, 0.5)
    elif kind == "saturated":  # all but a few scores within 1e-9 of the ends
        p = np.where(label == 1, 1 - p * 1e-9, p * 1e-9)
        p[:20] = 0.5
    elif kind == "perfect":
        p = label.astype(float)
    elif kind == "edges":
        label, pred, p = np.array([0, 1, 1, 0, 1]), np.array([0] * 5), np.array([0.0, 0.0, 1.0, 1.0, 0.5])
    df = table(spark, zipped(label, pred, p))
    row = ranking.ranking_metrics(df).first()
    assert np.isclose(row.roc_auc, brute_auc(label, p)) and np.isclose(row.average_precision, brute_ap(label, p))
    roc = ranking.roc_curve(df).toPandas().sort_values(["fpr", "tpr"])
    assert len(roc) == len(set(p)) + 1
    assert np.isclose(np.trapezoid(roc.tpr, roc.fpr), row.roc_auc)
    pr = ranking.pr_curve(df).toPandas()
    assert len(pr) == len(set(p)) + 1 and np.allclose(pr.baseline, label.mean())


def test_calibration(spark):
    label, pred, p = generated()
    p[:5] = [0.0, 1.0, 0.1, 0.30000000000000004, 0.7]
    df = table(spark, zipped(label, pred, p))
    edges = np.linspace(0, 1, 11)
    ece = sum(
        abs(p[m].mean() - label[m].mean()) * m.mean()
        for m in ((p > a) & (p <= b) for a, b in zip(edges, edges[1:])) if m.any()
    )
    assert np.isclose(calibration.expected_calibration_error(df).first()[0], ece)
    slots = np.searchsorted(edges[1:-1], p) + 1
    curve = {r.bin: r for r in calibration.calibration_curve(df).collect()}
    assert set(curve) == set(slots)
    for b in curve:
        assert curve[b].n == (slots == b).sum() and np.isclose(curve[b].observed, label[slots == b].mean())


def test_chi_square_tail(spark):
    cases = [(3.841458820694124, 1, 0.05), (5.991464547107979, 2, 0.05), (7.814727903251179, 3, 0.05), (0.0, 1, 1.0),
             (23.209251158954356, 10, 0.01), (10.0, 1, math.erfc(math.sqrt(5))), (30.0, 1, math.erfc(math.sqrt(15))),
             (1e6, 1, 0.0), (4.0, 2, math.exp(-2)), (60.0, 20, 7.121751e-06)]
    df = spark.createDataFrame([c[:2] for c in cases], "x double, k int")
    got = [r.p for r in df.select(chi2_tail(F.col("x"), F.col("k")).alias("p")).collect()]
    assert np.allclose(got, [c[2] for c in cases], atol=1e-11)


def rows_of(df, gate, config=GateConfig()):
    return {r["item"]: r for r in gates.gate(df, gate, config).collect()}


def test_mcnemar_needs_eleven_errors(spark):
    ten = rows_of(from_cells(spark, 50, 6, 4, 50), "error_balance")
    assert ten["mcnemar"].actual is None and ten["mcnemar"].warning
    eleven = rows_of(from_cells(spark, 50, 10, 1, 50), "error_balance")
    assert np.isclose(eleven["mcnemar"].actual, 64 / 11)
    assert np.isclose(eleven["mcnemar_p"].actual, math.erfc(math.sqrt(64 / 22))) and not eleven["mcnemar_p"].warning
    even = rows_of(from_cells(spark, 50, 10, 10, 50), "error_balance")
    assert even["mcnemar_p"].warning
    assert rows_of(table(spark, [(0, 0, 0.1)] * 20), "error_balance") == {}


def test_symmetry(spark):
    assert rows_of(from_cells(spark, 5, 0, 3, 5), "error_symmetry") == {}
    rows = rows_of(from_cells(spark, 5, 8, 2, 5), "error_symmetry")
    assert rows["error_ratio"].actual == 4.0 and rows["error_ratio"].warning
    assert rows["reasonably_symmetric"].actual == 0.0


def test_skew_is_skipped_for_one_predicted_class(spark):
    one = rows_of(table(spark, [(0, 0, 0.1)] * 5 + [(1, 0, 0.2)] * 5), "prediction_skew")["largest_share"]
    assert one.passed is None and one.actual == 1.0
    two = rows_of(from_cells(spark, 90, 1, 0, 9), "prediction_skew")["largest_share"]
    assert two.passed is False and two.actual == 0.9


def test_chi_square(spark):
    rows = rows_of(from_cells(spark, 40, 20, 5, 35), "distribution")
    stat = (45 - 60) ** 2 / 60 + (55 - 40) ** 2 / 40
    assert np.isclose(rows["chi_square"].actual, stat) and rows["chi_square_p"].warning
    unpaired = rows_of(table(spark, [(0, 0, 0.1)] * 5 + [(1, 0, 0.2)] * 5), "distribution")
    assert unpaired["chi_square"].actual is None and unpaired["chi_square"].warning


def test_class_gate(spark):
    rows = rows_of(from_cells(spark, 100, 0, 5, 5), "classes")
    assert rows["f1_ai"].passed is None and rows["f1_ai"].warning  # ten rows are too few to judge
    assert rows["f1_human"].passed and rows["imbalance_ratio"].warning
    assert rows_of(from_cells(spark, 20, 20, 1, 10), "classes")["f1_ai"].passed is False


def test_report(spark):
    good = from_cells(spark, 100, 4, 4, 100)
    row = gates.model_gate_report(good).first()
    assert row.inputs_valid and row.n_issues == 0 and row.passed == (row.n_issues == 0)
    assert row.n_warnings == 1 and row.recommendation == "Ready for release once the warnings are reviewed."
    bad = gates.model_gate_report(from_cells(spark, 50, 50, 50, 50)).first()
    assert not bad.passed and f"{bad.n_issues} issues" in bad.recommendation
    for broken in ([(0, 0, 1.2)], [(0, 0, None)], [(0, 7, 0.5)], [(3, 0, 0.5)], [(None, 0, 0.5)]):
        report = gates.model_gate_report(good.unionByName(table(spark, broken))).first()
        assert not report.inputs_valid and not report.passed
    empty = gates.model_gate_report(good.limit(0)).first()
    assert not empty.passed


def test_one_class_drops_the_auc_limit(spark):
    row = rows_of(table(spark, [(0, 0, 0.1)] * 30), "thresholds")["roc_auc"]
    assert row.passed is None and row.warning


def test_bootstrap(spark):
    label, pred, p = generated(2000)
    df = table(spark, zipped(label, pred, p))
    row = bootstrap.bootstrap_accuracy_ci(df).first()
    accuracy = (label == pred).mean()
    spread = 1.96 * math.sqrt(accuracy * (1 - accuracy) / 2000)
    assert abs(row.lower_bound - (accuracy - spread)) < 0.005 and abs(row.upper_bound - (accuracy + spread)) < 0.005
    again = bootstrap.bootstrap_accuracy_ci(df.repartition(1)).first()
    assert (row.lower_bound, row.upper_bound) == (again.lower_bound, again.upper_bound)
    assert bootstrap.bootstrap_accuracy_ci(df.limit(0), 10).first().lower_bound is None


def test_grades(spark):
    df = from_cells(spark, 88, 12, 12, 88)
    row = metrics.performance_summary(df, ranking.roc_auc(df).scalar()).first()
    assert row.overall_performance == "Good" and row.key_metrics == "Accuracy: 0.880, F1: 0.880, AUC: 0.880"
    assert row.calibration == "Reasonably calibrated"
