"""Queries over scored tables: metrics, curves, calibration, gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from textgauge.catalog.registry import SCORED, query, rounded, scored, table
from textgauge.operators import bootstrap, calibration, gates, metrics, ranking
from textgauge.plans.training import evaluate

CELLS = f"(select label, prediction, count(*) as n from {SCORED} group by label, prediction)"


def per_class_sql(cells: str) -> str:
    """Precision, recall, F1 and support per class from a table of cell counts."""
    return f"""(select c as label, case c when 0 then 'human' when 1 then 'ai' else 'class_' || c end as name,
      case when pred > 0 then hit / cast(pred as double) else 0e0 end as precision,
      case when sup > 0 then hit / cast(sup as double) else 0e0 end as recall,
      case when sup + pred > 0 then 2 * hit / cast(sup + pred as double) else 0e0 end as f1,
      sup as support, pred as predicted, hit as hits
    from (select c, cast(coalesce(sum(n) filter (where label = c), 0) as bigint) as sup,
        cast(coalesce(sum(n) filter (where prediction = c), 0) as bigint) as pred,
        cast(coalesce(sum(n) filter (where label = c and prediction = c), 0) as bigint) as hit
      from {cells} x, (select label as c from {cells} union select prediction from {cells}) k group by c))"""


PER_CLASS = per_class_sql(CELLS)


def metrics_sql(per_class: str) -> str:
    return f"""(select cast(sum(support) as bigint) as n, sum(hits) / cast(sum(support) as double) as accuracy,
      avg(precision) as precision_macro, avg(recall) as recall_macro, avg(f1) as f1_macro,
      sum(precision * support) / sum(support) as precision_weighted, sum(recall * support) / sum(support) as recall_weighted,
      sum(f1 * support) / sum(support) as f1_weighted, sum(f1 * support) / sum(support) as f1 from {per_class})"""


METRICS = metrics_sql(PER_CLASS)
_ROUND = ", ".join(
    f"round({c}, 6) as {c}"
    for c in ("accuracy", "precision_macro", "recall_macro", "f1_macro", "precision_weighted", "recall_weighted", "f1_weighted", "f1")
)

# A multi-class table: the embedding's own label, and a prediction that is right where its first number is positive.
MULTI = """(select label, cast(case when embedding[1] > 0 then label else (label + 1) % 10 end as integer) as prediction from embeddings)"""


def multi(spark, sf):
    rows = table(spark, sf, "embeddings")
    right = F.element_at("embedding", 1) > 0
    return rows.select("label", F.when(right, F.col("label")).otherwise((F.col("label") + 1) % 10).alias("prediction"))


@query(
    "confusion_matrix",
    f"""select cast(a as integer) as label, cast(b as integer) as prediction, (select count(*) from {SCORED} where label = a and prediction = b) as n
    from (values (0, 0), (0, 1), (1, 0), (1, 1)) g(a, b)""",
)
def _(spark, sf):
    return metrics.confusion_matrix(scored(spark, sf))


@query("classification_metrics", f"select n, {_ROUND} from {METRICS}")
def _(spark, sf):
    return rounded(metrics.classification_metrics(scored(spark, sf)))


_MULTI_CELLS = f"(select label, prediction, count(*) as n from {MULTI} group by label, prediction)"


@query("classification_metrics_multiclass", f"select n, {_ROUND} from {metrics_sql(per_class_sql(_MULTI_CELLS))}")
def _(spark, sf):
    return rounded(metrics.classification_metrics(multi(spark, sf)))


_CLASS_COLUMNS = "name, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1, support"


@query("per_class_metrics", f"select cast(label as integer) as label, {_CLASS_COLUMNS} from {PER_CLASS}")
def _(spark, sf):
    return rounded(metrics.per_class_metrics(scored(spark, sf)))


@query(
    "per_class_metrics_multiclass",
    f"select cast(label as integer) as label, {_CLASS_COLUMNS} from {per_class_sql(_MULTI_CELLS)}",
)
def _(spark, sf):
    return rounded(metrics.per_class_metrics(multi(spark, sf)))


@query(
    "classification_report",
    f"""select {_CLASS_COLUMNS} from {PER_CLASS}
    union all select 'accuracy', null, null, round(accuracy, 6), n from {METRICS}
    union all select 'macro avg', round(precision_macro, 6), round(recall_macro, 6), round(f1_macro, 6), n from {METRICS}
    union all select 'weighted avg', round(precision_weighted, 6), round(recall_weighted, 6), round(f1_weighted, 6), n from {METRICS}""",
)
def _(spark, sf):
    return rounded(metrics.classification_report(scored(spark, sf)))


# All pairs of a positive and a negative row, ties counted half.
AUC = f"""(select sum(case when p.probability > q.probability then 1.0e0 when p.probability = q.probability then 0.5e0 else 0e0 end) / count(*)
  from {SCORED} p join {SCORED} q on p.label = 1 and q.label = 0)"""
AP = f"""(select sum(hits / cast((select count(*) from {SCORED} where label = 1) as double) * prec) from (
    select t.probability, t.hits, (select avg(cast(label as double)) from {SCORED} s where s.probability >= t.probability) as prec
    from (select probability, sum(label) as hits from {SCORED} group by probability) t))"""


@query("roc_auc", f"select round({AUC}, 6) as roc_auc")
def _(spark, sf):
    return rounded(ranking.roc_auc(scored(spark, sf)))


@query("average_precision", f"select round({AP}, 6) as average_precision")
def _(spark, sf):
    return rounded(ranking.average_precision(scored(spark, sf)))


_STEPS = f"""(select probability as threshold, sum(sum(label)) over w as tp, sum(sum(1 - label)) over w as fp,
    sum(sum(label)) over () as p, sum(sum(1 - label)) over () as n from {SCORED} group by probability
  window w as (order by probability desc))"""


@query(
    "roc_curve",
    f"""select round(threshold, 6) as threshold, round(cast(fp as double) / n, 6) as fpr, round(cast(tp as double) / p, 6) as tpr from {_STEPS}
    union all select null, 0e0, 0e0""",
)
def _(spark, sf):
    return rounded(ranking.roc_curve(scored(spark, sf)))


@query(
    "pr_curve",
    f"""select round(threshold, 6) as threshold, round(cast(tp as double) / (tp + fp), 6) as precision,
        round(cast(tp as double) / p, 6) as recall, round(cast(p as double) / (p + n), 6) as baseline from {_STEPS}
    union all select null, 1e0, 0e0, round(avg(label), 6) from {SCORED}""",
)
def _(spark, sf):
    return rounded(ranking.pr_curve(scored(spark, sf)))


@query(
    "class_distributions",
    f"""select 'true' as side, cast(label as integer) as label, count(*) as n from {SCORED} group by label
    union all select 'predicted', cast(prediction as integer), count(*) from {SCORED} group by prediction""",
)
def _(spark, sf):
    return metrics.class_distributions(scored(spark, sf))


BRIER = f"(select avg(pow(probability - label, 2)) from {SCORED})"
_EDGES = "(values (1, 0.0e0, 0.1e0), (2, 0.1e0, 0.2e0), (3, 0.2e0, 0.30000000000000004e0), (4, 0.30000000000000004e0, 0.4e0), (5, 0.4e0, 0.5e0), (6, 0.5e0, 0.6000000000000001e0), (7, 0.6000000000000001e0, 0.7000000000000001e0), (8, 0.7000000000000001e0, 0.8e0), (9, 0.8e0, 0.9e0), (10, 0.9e0, 1.0e0)) e(bin, lo, hi)"
ECE = f"""(select sum(gap * share) from (select abs(avg(probability) - avg(label)) as gap,
    count(*) / cast((select count(*) from {SCORED}) as double) as share
  from {SCORED} s join {_EDGES} on s.probability > e.lo and s.probability <= e.hi group by e.bin))"""


@query("brier_score", f"select round({BRIER}, 6) as brier_score")
def _(spark, sf):
    return rounded(metrics.brier_score(scored(spark, sf)))


@query("expected_calibration_error", f"select round({ECE}, 6) as expected_calibration_error")
def _(spark, sf):
    return rounded(calibration.expected_calibration_error(scored(spark, sf)))


@query(
    "calibration_curve",
    f"""select cast(e.bin as integer) as bin, count(*) as n, round(avg(label), 6) as observed, round(avg(probability), 6) as predicted
    from {SCORED} s join {_EDGES} on (s.probability > e.lo or e.bin = 1) and s.probability <= e.hi group by e.bin""",
)
def _(spark, sf):
    return rounded(calibration.calibration_curve(scored(spark, sf)))


@query(
    "performance_summary",
    f"""select case when accuracy >= 0.9 and f1 >= 0.9 then 'Excellent' when accuracy >= 0.85 and f1 >= 0.85 then 'Good'
        when accuracy >= 0.75 and f1 >= 0.75 then 'Fair' else 'Poor' end as overall_performance,
        printf('Accuracy: %.3f, F1: %.3f, AUC: %.3f', accuracy, f1, {AUC}) as key_metrics,
        case when {BRIER} <= 0.1 then 'Well calibrated' when {BRIER} <= 0.2 then 'Reasonably calibrated' else 'Poorly calibrated' end as calibration
    from {METRICS}""",
)
def _(spark, sf):
    rows = scored(spark, sf)
    return metrics.performance_summary(rows, auc=ranking.roc_auc(rows).scalar())


_NAMES = ("accuracy", "precision_macro", "recall_macro", "f1_macro", "precision_weighted", "recall_weighted", "f1_weighted", "f1")


@query(
    "evaluation_summary",
    " union all ".join(f"select '{m}' as metric, round({m}, 6) as value from {METRICS}" for m in _NAMES)
    + f""" union all select 'brier_score', round({BRIER}, 6) union all select 'expected_calibration_error', round({ECE}, 6)
    union all select 'roc_auc', round({AUC}, 6) union all select 'average_precision', round({AP}, 6)""",
)
def _(spark, sf):
    return rounded(evaluate(scored(spark, sf)))


@query(
    "bootstrap_accuracy_ci",
    f"select round(avg(case when label = prediction then 1.0e0 else 0.0e0 end), 6) as accuracy, true as inside, true as as_wide from {SCORED}",
)
def _(spark, sf):
    # The bounds are drawn: compared is whether they hold the accuracy, 0.7 to 1.4 times as wide as the normal interval.
    rows = scored(spark, sf)
    exact = rows.agg(F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("a"), F.count(F.lit(1)).alias("n"))
    drawn = bootstrap.bootstrap_accuracy_ci(rows).select(F.struct("lower_bound", "upper_bound").alias("b")).scalar()
    wide = 2 * 1.959964 * F.sqrt(F.col("a") * (1 - F.col("a")) / F.col("n"))
    width = F.col("b.upper_bound") - F.col("b.lower_bound")
    return exact.withColumn("b", drawn).select(
        F.round("a", 6).alias("accuracy"),
        F.col("a").between(F.col("b.lower_bound"), F.col("b.upper_bound")).alias("inside"),
        (width / wide).between(0.7, 1.4).alias("as_wide"),
    )


# ---- gates ----

_GATE = "select '{gate}' as gate, '{item}' as item, round({actual}, 6) as actual, cast({bound} as double) as bound, cast({passed} as boolean) as passed, {warning} as warning"


def _line(gate, item, actual, bound="null", passed="null", warning="false", source="") -> str:
    row = _GATE.format(gate=gate, item=item, actual=f"cast({actual} as double)", bound=bound, passed=passed, warning=warning)
    return f"{row} {source}"


def _cell(a: int, b: int) -> str:
    return f"(select count(*) from {SCORED} where label = {a} and prediction = {b})"


_M = f"from {METRICS}"
THRESHOLDS = [
    _line("thresholds", "accuracy", "accuracy", 0.85, "accuracy >= 0.85", source=_M),
    _line("thresholds", "f1", "f1_weighted", 0.85, "f1_weighted >= 0.85", source=_M),
    _line("thresholds", "precision", "precision_weighted", 0.8, "precision_weighted >= 0.8", source=_M),
    _line("thresholds", "recall", "recall_weighted", 0.8, "recall_weighted >= 0.8", source=_M),
    _line("thresholds", "roc_auc", AUC, 0.85, f"{AUC} >= 0.85"),
]
CALIBRATION = [
    _line("calibration", "brier_score", BRIER, 0.25, f"{BRIER} <= 0.25"),
    _line("calibration", "expected_calibration_error", ECE, 0.1, f"{ECE} <= 0.1"),
]
_SUPPORTS = f"(select max(n) / cast(min(n) as double) from (select count(*) as n from {SCORED} group by label))"
CLASSES = [
    f"""select 'classes' as gate, 'f1_' || name as item, round(f1, 6) as actual, cast(0.75 as double) as bound,
        case when support > 10 then f1 >= 0.75 end as passed, support <= 10 as warning from {PER_CLASS}""",
    _line("classes", "imbalance_ratio", _SUPPORTS, 3.0, "null", f"{_SUPPORTS} > 3.0"),
]
_SKEW = f"(select max(n) / cast(sum(n) as double) from (select count(*) as n from {SCORED} group by prediction))"
SKEW = [_line("prediction_skew", "largest_share", _SKEW, 0.8, f"{_SKEW} <= 0.8")]
_CHI = f"(select sum(pow(predicted - support, 2) / support) from {PER_CLASS})"


def _tail(x: str) -> str:
    """P(X >= x) with one degree of freedom: the series of erf(z), z = sqrt(x/2), summed in logarithms."""
    terms = f"""(select sum(exp(k * ln(2.0e0) + (2 * k + 1) * ln(sqrt({x} / 2)) - {x} / 2
        - ((k + 1) * ln(2.0e0) + lgamma(k + 1.5e0) - 0.5 * ln(pi())))) * 2 / sqrt(pi()) from range(0, 400) r(k))"""
    return f"(case when {x} > 80 then 0e0 else greatest(0e0, 1 - {terms}) end)"


DISTRIBUTION = [
    _line("distribution", "chi_square", _CHI),
    f"""select 'distribution', 'chi_square_p', round({_tail('x')}, 6), 0.01e0, cast(null as boolean), {_tail('x')} <= 0.01
    from (select {_CHI} as x)""",
]
_MCNEMAR = f"(pow(abs({_cell(0, 1)} - {_cell(1, 0)}) - 1, 2) / cast({_cell(0, 1)} + {_cell(1, 0)} as double))"
BALANCE = [
    _line("error_balance", "mcnemar", _MCNEMAR),
    f"""select 'error_balance', 'mcnemar_p', round({_tail('x')}, 6), 0.05e0, cast(null as boolean), {_tail('x')} >= 0.05
    from (select {_MCNEMAR} as x)""",
]
_RATIO = f"(greatest({_cell(0, 1)}, {_cell(1, 0)}) / cast(least({_cell(0, 1)}, {_cell(1, 0)}) as double))"
SYMMETRY = [
    _line("error_symmetry", "false_positives", _cell(0, 1)),
    _line("error_symmetry", "false_negatives", _cell(1, 0)),
    _line("error_symmetry", "error_ratio", _RATIO, 3.0, "null", f"{_RATIO} > 3.0"),
    _line("error_symmetry", "reasonably_symmetric", f"cast({_RATIO} <= 2.0 as integer)", 2.0),
]
_ALL = THRESHOLDS + CALIBRATION + CLASSES + SKEW + DISTRIBUTION + BALANCE + SYMMETRY


@query(
    "gate_inputs",
    f"""select count(*) as n_rows, count(*) filter (where label is null or prediction is null or probability is null) as null_values,
        count(*) filter (where probability < 0 or probability > 1) as bad_probabilities,
        count(*) filter (where label not in (0, 1)) as bad_labels, count(*) filter (where prediction not in (0, 1)) as bad_predictions,
        count(*) > 0 and count(*) filter (where label is null or prediction is null or probability is null or probability < 0
          or probability > 1 or label not in (0, 1) or prediction not in (0, 1)) = 0 as passed from {SCORED}""",
)
def _(spark, sf):
    return gates.gate_inputs(scored(spark, sf))


def _register(name: str, gate: str, lines: list[str]) -> None:
    @query(name, " union all ".join(lines))
    def _(spark, sf):
        return rounded(gates.gate(scored(spark, sf), gate))


_register("gate_thresholds", "thresholds", THRESHOLDS)
_register("gate_calibration", "calibration", CALIBRATION)
_register("gate_classes", "classes", CLASSES)
_register("gate_skew", "prediction_skew", SKEW)
_register("chi_square", "distribution", [DISTRIBUTION[0], DISTRIBUTION[1]])
_register("mcnemar", "error_balance", BALANCE)
_register("error_symmetry", "error_symmetry", SYMMETRY)


@query("gate_rows", " union all ".join(_ALL))
def _(spark, sf):
    return rounded(gates.gate_rows(scored(spark, sf)))


@query(
    "model_gate_report",
    f"""with r as ({' union all '.join(_ALL)}),
    s as (select count(*) filter (where not passed) as n_issues, count(*) filter (where warning) as n_warnings from r)
    select n_issues = 0 as passed, true as inputs_valid, n_issues, n_warnings,
        case when n_issues = 0 and n_warnings = 0 then 'Ready for release.' when n_issues = 0 then 'Ready for release once the warnings are reviewed.'
        when n_issues = 1 then 'Not ready: one issue to resolve.' else 'Not ready: ' || n_issues || ' issues to resolve.' end as recommendation from s""",
)
def _(spark, sf):
    return gates.model_gate_report(scored(spark, sf))


_INTERVAL = [_line("accuracy_interval", f"{side}_bound", "null") for side in ("lower", "upper")]


@query("gate_rows_with_interval", " union all ".join([*_ALL, *_INTERVAL]))
def _(spark, sf):
    # The interval's bounds are drawn, so they are left out of what is compared.
    rows = gates.with_bootstrap(scored(spark, sf))
    fixed = F.when(F.col("gate") != "accuracy_interval", F.col("actual"))
    return rounded(rows.withColumn("actual", fixed))


@query(
    "gate_invalid_inputs",
    """select gate, item, false as passed from (values ('thresholds', 'accuracy'), ('thresholds', 'f1'), ('thresholds', 'precision'),
        ('thresholds', 'recall'), ('calibration', 'brier_score'), ('calibration', 'expected_calibration_error')) t(gate, item)""",
)
def _(spark, sf):
    """Perfect predictions but for rows with a null or foreign label: nothing may pass."""
    rows = scored(spark, sf)
    label = F.when(F.col("doc_id") % 5 == 0, 7).when(F.col("doc_id") % 7 == 0, None).otherwise(F.col("label"))
    rows = rows.select("doc_id", label.alias("label"), F.col("label").alias("prediction"), F.col("label").cast("double").alias("probability"))
    judged = gates.gate_rows(rows).where("gate in ('thresholds', 'calibration') and item <> 'roc_auc'")
    return judged.select("gate", "item", "passed")


_WITHIN = """with s as ({scored}), n as (select count(*) as n, count(*) filter (label = 1) as n1, count(*) filter (label = 0) as n0 from s),
  cells as (select c, count(*) filter (label = c) as support, count(*) filter (prediction = c) as predicted,
    count(*) filter (label = c and prediction = c) as hits from s, (select unnest([0, 1]) as c) group by c),
  each as (select *, case when predicted > 0 then hits / predicted::double else 0 end as pr, case when support > 0 then hits / support::double else 0 end as re,
    case when support + predicted > 0 then 2 * hits / (support + predicted)::double else 0 end as f from cells),
  wins as (select sum((a.probability > b.probability)::int + (a.probability = b.probability)::int / 2.0e0) as w from s a join s b on a.label = 1 and b.label = 0)
  select metric, round(value, 6) as value, true as inside, true as narrow from (
    select 'accuracy' as metric, sum(hits) / sum(support)::double as value from each union all
    select 'precision', sum(pr * support) / sum(support) from each union all select 'recall', sum(re * support) / sum(support) from each union all
    select 'f1', sum(f * support) / sum(support) from each union all select 'roc_auc', w / (n1 * n0) from wins, n union all
    select 'brier_score', avg((probability - label) * (probability - label)) from s)"""


@query("bootstrap_metric_intervals", _WITHIN.format(scored=SCORED.strip()[1:-1]))
def _(spark, sf):
    """The drawn bounds differ from engine to engine; compared are the metrics, and that the bounds enclose them closely."""
    rows = scored(spark, sf)
    values = metrics.classification_metrics(rows).select("accuracy", F.col("precision_weighted").alias("precision"), F.col("recall_weighted").alias("recall"), "f1")
    values = values.withColumn("roc_auc", ranking.roc_auc(rows).scalar()).withColumn("brier_score", metrics.brier_score(rows).scalar())
    names = values.columns
    values = values.select(F.inline(F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).alias("value")) for c in names])))
    bounds = bootstrap.bootstrap_intervals(rows, 500, 200)
    inside = F.col("value").between(F.col("lower_bound"), F.col("upper_bound"))
    # Six standard errors of a share, at their widest.
    width = F.lit(6.0) * F.sqrt(F.lit(0.25) / rows.agg(F.least(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0))).scalar())
    return values.join(bounds, "metric").select("metric", F.round("value", 6).alias("value"), inside.alias("inside"), (F.col("upper_bound") - F.col("lower_bound") < width).alias("narrow"))
