"""Release gates over a scored test set.

``gate_facts`` reduces the scored table to one row: classes, calibration and input rules from one pass, AUC from
another.  Each gate then turns that row into result rows
``(gate, item, actual, bound, passed, warning)``; ``passed`` is null for what is only reported.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgauge.config import AI, HUMAN, GateConfig
from textgauge.functions.labels import class_name
from textgauge.functions.stats import bin_index, chi2_tail
from textgauge.operators.bootstrap import bootstrap_accuracy_ci
from textgauge.operators.ranking import ranking_metrics

DEFAULT = GateConfig()


def gate_facts(scored: DataFrame, config: GateConfig = DEFAULT) -> DataFrame:
    """Everything the gates need, in one row.

    One grouping by calibration bin holds the counts of every allowed class, the calibration sums and the violations of
    the input rules; only the AUC is a pass of its own.  Only rows with allowed labels and predictions count.
    ``inputs_valid`` says whether there were others: then nothing passes.
    """
    allowed = list(config.allowed_labels)
    label, prediction, p = F.col("label"), F.col("prediction"), F.col("probability")
    inside = label.isin(*allowed) & prediction.isin(*allowed)
    good = F.coalesce(inside, F.lit(False))
    error = F.pow(p - label, 2)
    sums = [F.count_if(good).alias("n"), F.sum(F.when(good, error)).alias("sq")]
    sums += [F.avg(F.when(good, label.cast("double"))).alias("observed"), F.avg(F.when(good, p)).alias("predicted")]
    for i, c in enumerate(allowed):
        sums += [F.count_if(good & (label == c)).alias(f"s{i}"), F.count_if(good & (prediction == c)).alias(f"p{i}")]
        sums.append(F.count_if(good & (label == c) & (prediction == c)).alias(f"h{i}"))
    sums += [c.alias(n) for n, c in _violations(config).items()]
    bins = scored.groupBy(bin_index(p, config.bins, False).alias("bin")).agg(*sums)
    gap = F.when(F.col("bin").isNotNull(), F.abs(F.col("predicted") - F.col("observed")) * F.col("n")).otherwise(0.0)
    counts = [f"{kind}{i}" for i in range(len(allowed)) for kind in "sph"]
    checks = [*_violations(config)]
    row = bins.agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ["n", *counts, *checks]],
        F.sum("sq").alias("_sq"),
        F.sum(F.when(F.col("n") > 0, gap)).alias("_gap"),
    )
    total = F.nullif(F.col("n"), F.lit(0)).cast("double")

    def ratio(x: Column, y: Column) -> Column:
        return F.when(y > 0, x.cast("double") / y).otherwise(F.lit(0.0))

    each, weighted = [], {"precision": [], "recall": [], "f1": []}
    for i, c in enumerate(allowed):
        support, predicted, hits = (F.col(f"{kind}{i}") for kind in "sph")
        f1 = ratio(hits * 2, support + predicted)
        for name, value in (("precision", ratio(hits, predicted)), ("recall", ratio(hits, support)), ("f1", f1)):
            weighted[name].append(value * support)
        named = {"label": F.lit(c), "name": class_name(F.lit(c)), "f1": f1, "support": support, "predicted": predicted, "hits": hits}
        each.append(F.struct(*[v.alias(n) for n, v in named.items()]))

    def mean(name: str) -> Column:
        return sum(weighted[name][1:], weighted[name][0]) / total

    seen = F.filter(F.array(*each), lambda c: c["support"] + c["predicted"] > 0)
    row = row.select(
        F.nullif(F.col("n"), F.lit(0)).alias("n"),
        (sum((F.col(f"h{i}") for i in range(1, len(allowed))), F.col("h0")) / total).alias("accuracy"),
        *[mean(name).alias(name) for name in weighted],
        F.array_sort(seen).alias("classes"),
        F.struct((F.col("_sq") / total).alias("brier"), (F.col("_gap") / total).alias("ece")).alias("calibration"),
        _valid().alias("inputs_valid"),
    )
    row = row.withColumn("roc_auc", ranking_metrics(scored.where(inside)).select("roc_auc").scalar())
    # Of two classes, human and machine, the errors to either side.
    both = (F.size("classes") == 2) & F.forall("classes", lambda c: c["label"].isin(HUMAN, AI))
    machine = F.element_at("classes", 2)
    return row.withColumn("false_positives", F.when(both, machine["predicted"] - machine["hits"])).withColumn(
        "false_negatives", F.when(both, machine["support"] - machine["hits"])
    )


def _row(gate: str, item, actual, bound, passed=None, warning=None) -> Column:
    def number(x) -> Column:
        return (x if isinstance(x, Column) else F.lit(x)).cast("double")

    return F.struct(
        F.lit(gate).alias("gate"),
        (item if isinstance(item, Column) else F.lit(item)).alias("item"),
        number(actual).alias("actual"),
        number(bound).alias("bound"),
        (F.lit(None) if passed is None else passed).cast("boolean").alias("passed"),
        F.coalesce(F.lit(False) if warning is None else warning, F.lit(False)).alias("warning"),
    )


def _none() -> Column:
    return F.filter(F.array(_row("", "", None, None)), lambda r: F.lit(False))


def _only(condition: Column, rows: Column) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), rows).otherwise(_none())


def _at_least(value: Column, bound: float) -> Column:
    return F.coalesce((value >= bound) & ~F.isnan(value), F.lit(False))


def threshold_rows(config: GateConfig) -> Column:
    limits = {
        "accuracy": config.min_accuracy,
        "f1": config.min_f1,
        "precision": config.min_precision,
        "recall": config.min_recall,
    }
    rows = [_row("thresholds", m, F.col(m), b, _at_least(F.col(m), b)) for m, b in limits.items()]
    auc = F.col("roc_auc")
    # Without both classes there is no AUC: the limit is dropped with a warning.
    judged = F.when(auc.isNotNull(), _at_least(auc, config.min_auc))
    rows.append(_row("thresholds", "roc_auc", auc, config.min_auc, judged, auc.isNull()))
    return F.array(*rows)


def calibration_rows(config: GateConfig) -> Column:
    brier, ece = F.col("calibration.brier"), F.col("calibration.ece")
    return F.array(
        _row("calibration", "brier_score", brier, config.max_brier, F.coalesce(brier <= config.max_brier, F.lit(False))),
        _row("calibration", "expected_calibration_error", ece, config.max_ece, F.coalesce(ece <= config.max_ece, F.lit(False))),
    )


def class_rows(config: GateConfig) -> Column:
    def judge(c: Column) -> Column:
        enough = c["support"] > config.min_support
        passed = F.when(enough, c["f1"] >= config.min_class_f1)
        return _row("classes", F.concat(F.lit("f1_"), c["name"]), c["f1"], config.min_class_f1, passed, ~enough)

    present = F.filter("classes", lambda c: c["support"] > 0)
    supports = F.transform(present, lambda c: c["support"].cast("double"))
    ratio = F.array_max(supports) / F.array_min(supports)
    imbalance = F.array(_row("classes", "imbalance_ratio", ratio, config.max_imbalance, None, ratio > config.max_imbalance))
    return F.concat(F.transform("classes", judge), _only(F.size(present) > 1, imbalance))


def skew_rows(config: GateConfig) -> Column:
    predicted = F.filter("classes", lambda c: c["predicted"] > 0)
    share = F.array_max(F.transform(predicted, lambda c: c["predicted"].cast("double"))) / F.col("n")
    # With a single predicted class the check is skipped: reported, not judged.
    judged = F.when(F.size(predicted) > 1, share <= config.max_prediction_share)
    return F.array(_row("prediction_skew", "largest_share", share, config.max_prediction_share, judged))


def _chi_square() -> tuple[Column, Column]:
    """Statistic and degrees of freedom of predicted against true counts; null if they do not pair up."""
    predicted = F.transform(F.filter("classes", lambda c: c["predicted"] > 0), lambda c: c["predicted"].cast("double"))
    true = F.transform(F.filter("classes", lambda c: c["support"] > 0), lambda c: c["support"].cast("double"))
    parts = F.zip_with(predicted, true, lambda o, e: (o - e) * (o - e) / e)
    stat = F.aggregate(parts, F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(predicted) == F.size(true), stat), F.size(true) - 1


def chi_square_rows(config: GateConfig) -> Column:
    stat, dof = _chi_square()
    p = F.when(dof > 0, chi2_tail(stat, dof))
    return F.array(
        _row("distribution", "chi_square", stat, None, None, stat.isNull()),
        _row("distribution", "chi_square_p", p, 0.01, None, p <= 0.01),
    )


def mcnemar_rows(config: GateConfig) -> Column:
    fp, fn = F.col("false_positives").cast("double"), F.col("false_negatives").cast("double")
    errors = fp + fn
    enough = errors > 10
    stat = F.when(enough, F.pow(F.abs(fp - fn) - 1, 2) / errors)
    p = chi2_tail(stat, F.lit(1))
    rows = F.array(
        _row("error_balance", "mcnemar", stat, None, None, ~enough),
        _row("error_balance", "mcnemar_p", p, 0.05, None, p >= 0.05),
    )
    return _only(errors.isNotNull(), rows)


def symmetry_rows(config: GateConfig) -> Column:
    fp, fn = F.col("false_positives").cast("double"), F.col("false_negatives").cast("double")
    ratio = F.when((fp > 0) & (fn > 0), F.greatest(fp, fn) / F.least(fp, fn))
    rows = F.array(
        _row("error_symmetry", "false_positives", fp, None),
        _row("error_symmetry", "false_negatives", fn, None),
        _row("error_symmetry", "error_ratio", ratio, 3.0, None, ratio > 3.0),
        _row("error_symmetry", "reasonably_symmetric", (ratio <= 2.0).cast("int"), 2.0),
    )
    return _only(ratio.isNotNull(), rows)


GATES = {
    "thresholds": threshold_rows,
    "calibration": calibration_rows,
    "classes": class_rows,
    "prediction_skew": skew_rows,
    "distribution": chi_square_rows,
    "error_balance": mcnemar_rows,
    "error_symmetry": symmetry_rows,
}


def gate(scored: DataFrame, name: str, config: GateConfig = DEFAULT) -> DataFrame:
    """Result rows of one gate; a judged row passes only if the input is valid."""
    return _judged(gate_facts(scored, config), GATES[name](config)).drop("inputs_valid")


def _judged(facts: DataFrame, rows: Column) -> DataFrame:
    out = facts.select(F.coalesce("inputs_valid", F.lit(False)).alias("inputs_valid"), F.inline(rows))
    # What is only reported stays null.
    return out.withColumn("passed", F.when(F.col("passed").isNotNull(), F.col("passed") & F.col("inputs_valid")))


def _violations(config: GateConfig) -> dict[str, Column]:
    """Counts of rows and of rows that break the input rules."""
    p, allowed = F.col("probability"), list(config.allowed_labels)
    return {
        "n_rows": F.count(F.lit(1)),
        "null_values": F.count_if(F.col("label").isNull() | F.col("prediction").isNull() | p.isNull()),
        "bad_probabilities": F.count_if((p < 0) | (p > 1) | F.isnan(p)),
        "bad_labels": F.count_if(~F.col("label").isin(*allowed)),
        "bad_predictions": F.count_if(~F.col("prediction").isin(*allowed)),
    }


def _valid() -> Column:
    broken = F.col("null_values") + F.col("bad_probabilities") + F.col("bad_labels") + F.col("bad_predictions")
    return (F.col("n_rows") > 0) & (broken == 0)


def gate_inputs(scored: DataFrame, config: GateConfig = DEFAULT) -> DataFrame:
    """Violations of the input rules; nulls stand for arrays of unequal length."""
    return scored.agg(*[c.alias(n) for n, c in _violations(config).items()]).withColumn("passed", _valid())


def _all_rows(scored: DataFrame, config: GateConfig) -> DataFrame:
    every = reduce(lambda a, b: F.concat(a, b), (make(config) for make in GATES.values()))
    return _judged(gate_facts(scored, config), every)


def gate_rows(scored: DataFrame, config: GateConfig = DEFAULT) -> DataFrame:
    """Result rows of all gates, from one row of facts."""
    return _all_rows(scored, config).drop("inputs_valid")


def model_gate_report(scored: DataFrame, config: GateConfig = DEFAULT) -> DataFrame:
    """One row: verdict, number of issues and warnings, recommendation.

    Input that breaks the rules of ``gate_inputs`` never passes.
    """
    verdict = _all_rows(scored, config).agg(
        F.count_if(~F.col("passed")).alias("n_issues"), F.count_if("warning").alias("n_warnings"), F.bool_and("inputs_valid").alias("inputs_valid")
    )
    passed = F.col("inputs_valid") & (F.col("n_issues") == 0)
    advice = (
        F.when(~F.col("inputs_valid"), "Scored input is invalid.")
        .when(passed & (F.col("n_warnings") == 0), "Ready for release.")
        .when(passed, "Ready for release once the warnings are reviewed.")
        .when(F.col("n_issues") == 1, "Not ready: one issue to resolve.")
        .otherwise(F.concat(F.lit("Not ready: "), F.col("n_issues").cast("string"), F.lit(" issues to resolve.")))
    )
    return verdict.select(
        passed.alias("passed"), "inputs_valid", "n_issues", "n_warnings", advice.alias("recommendation")
    )


def with_bootstrap(scored: DataFrame, config: GateConfig = DEFAULT) -> DataFrame:
    """Gate rows and, next to them, the bootstrap interval of accuracy, which never fails."""
    interval = bootstrap_accuracy_ci(scored, config.replicates, seed=config.seed)
    rows = interval.select(
        F.inline(
            F.array(
                _row("accuracy_interval", "lower_bound", F.col("lower_bound"), None),
                _row("accuracy_interval", "upper_bound", F.col("upper_bound"), None),
            )
        )
    )
    return gate_rows(scored, config).unionByName(rows)
