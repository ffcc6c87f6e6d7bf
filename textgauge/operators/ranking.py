"""Score-ranking metrics: ROC AUC, average precision and both curves.

Rows are first combined per distinct score, then a range-wise running total gives the number of
positives and negatives at or above each score.  No task ever sees all scores.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgauge.operators.prefix import STEP, running_totals


def score_steps(scored: DataFrame, label: str = "label", probability: str = "probability", step: int = STEP) -> DataFrame:
    """Per distinct score, from high to low: positives ``tp``, negatives ``fp``, ``*_upto`` and ``*_total``.

    Scores are cut into ``step * step`` ranges; any number gives the same result.
    """
    rows = scored.where(F.col(label).isNotNull() & F.col(probability).isNotNull())
    steps = rows.groupBy(F.col(probability).alias("threshold")).agg(
        F.count_if(F.col(label) == 1).alias("tp"), F.count_if(F.col(label) == 0).alias("fp")
    )
    return running_totals(steps.withColumn("_o", -F.col("threshold")), "_o", ["tp", "fp"], step=step).drop("_o")


def ranking_metrics(scored: DataFrame, step: int = STEP) -> DataFrame:
    """One row: ``roc_auc`` and ``average_precision``; null when a class is absent."""
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    up_tp, up_fp = F.col("tp_upto").cast("double"), F.col("fp_upto").cast("double")
    positives, negatives = F.max("tp_total").cast("double"), F.max("fp_total").cast("double")
    both = (positives > 0) & (negatives > 0)
    area = F.sum(fp * (up_tp - tp) + 0.5 * tp * fp)
    gain = F.sum(tp * (up_tp / (up_tp + up_fp)))
    return score_steps(scored, step=step).agg(
        F.when(both, area / (positives * negatives)).alias("roc_auc"),
        F.when(both, gain / positives).alias("average_precision"),
    )


def roc_auc(scored: DataFrame, step: int = STEP) -> DataFrame:
    return ranking_metrics(scored, step).select("roc_auc")


def average_precision(scored: DataFrame, step: int = STEP) -> DataFrame:
    return ranking_metrics(scored, step).select("average_precision")


def roc_curve(scored: DataFrame, step: int = STEP) -> DataFrame:
    """False and true positive rate at every distinct score, and the origin (null threshold)."""
    points = score_steps(scored, step=step).select(
        "threshold",
        (F.col("fp_upto").cast("double") / F.nullif(F.col("fp_total"), F.lit(0))).alias("fpr"),
        (F.col("tp_upto").cast("double") / F.nullif(F.col("tp_total"), F.lit(0))).alias("tpr"),
    )
    origin = scored.agg(F.count(F.lit(1)).alias("_")).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def pr_curve(scored: DataFrame, step: int = STEP) -> DataFrame:
    """Precision and recall at every distinct score, the end point, and the positive rate as baseline."""
    up_tp, up_fp = F.col("tp_upto").cast("double"), F.col("fp_upto").cast("double")
    points = score_steps(scored, step=step).select(
        "threshold",
        (up_tp / (up_tp + up_fp)).alias("precision"),
        (up_tp / F.nullif(F.col("tp_total"), F.lit(0))).alias("recall"),
        (F.col("tp_total").cast("double") / (F.col("tp_total") + F.col("fp_total"))).alias("baseline"),
    )
    end = scored.agg(F.avg(F.col("label").cast("double")).alias("baseline")).select(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"), "baseline"
    )
    return points.unionByName(end)
