"""Classification metrics, all from one small table of (label, prediction) counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgauge.config import CLASSES
from textgauge.functions.labels import class_name


def cells(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Rows per (label, prediction): the only pass over the data."""
    return scored.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(scored: DataFrame, classes: Sequence[int] = CLASSES) -> DataFrame:
    """The full grid of the listed classes, absent cells as 0."""
    counts = cells(scored)
    grid = F.array(
        *[F.struct(F.lit(a).alias("label"), F.lit(b).alias("prediction"), F.lit(0).cast("bigint").alias("n"))
          for a in classes for b in classes]
    )
    zeros = counts.agg(F.count(F.lit(1)).alias("_")).select(F.inline(grid))
    return counts.unionByName(zeros).groupBy("label", "prediction").agg(F.sum("n").alias("n"))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b > 0, a.cast("double") / b).otherwise(F.lit(0.0))


def per_class(scored: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support for every label seen as truth or prediction."""
    hit = F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(F.lit(0))
    none = F.lit(0).cast("bigint")
    sides = F.array(
        F.struct(F.col("label").alias("label"), F.col("n").alias("support"), none.alias("predicted"), hit.alias("hits")),
        F.struct(F.col("prediction").alias("label"), none.alias("support"), F.col("n").alias("predicted"), none.alias("hits")),
    )
    sums = cells(scored).select(F.inline(sides)).groupBy("label").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("hits").alias("hits")
    )
    return sums.select(
        "label",
        class_name(F.col("label")).alias("name"),
        _ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        _ratio(F.col("hits"), F.col("support")).alias("recall"),
        _ratio(F.col("hits") * 2, F.col("support") + F.col("predicted")).alias("f1"),
        "support",
        "predicted",
        "hits",
    )


def per_class_metrics(scored: DataFrame) -> DataFrame:
    return per_class(scored).drop("predicted", "hits")


def classification_metrics(scored: DataFrame) -> DataFrame:
    """One row: accuracy, macro and support-weighted precision, recall and F1; ``f1`` is the weighted one."""
    total = F.sum("support")

    def weighted(name: str) -> Column:
        return F.sum(F.col(name) * F.col("support")) / total

    return per_class(scored).agg(
        total.alias("n"),
        (F.sum("hits").cast("double") / total).alias("accuracy"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
        F.avg("f1").alias("f1_macro"),
        weighted("precision").alias("precision_weighted"),
        weighted("recall").alias("recall_weighted"),
        weighted("f1").alias("f1_weighted"),
        weighted("f1").alias("f1"),
    )


def classification_report(scored: DataFrame) -> DataFrame:
    """Per-class rows, then accuracy, macro average and weighted average."""
    classes = per_class_metrics(scored).select("name", "precision", "recall", "f1", "support")
    null = F.lit(None).cast("double")

    def line(name: str, precision: Column, recall: Column, f1: Column) -> Column:
        return F.struct(
            F.lit(name).alias("name"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            F.col("n").alias("support"),
        )

    averages = F.array(
        line("accuracy", null, null, F.col("accuracy")),
        line("macro avg", F.col("precision_macro"), F.col("recall_macro"), F.col("f1_macro")),
        line("weighted avg", F.col("precision_weighted"), F.col("recall_weighted"), F.col("f1_weighted")),
    )
    return classes.unionByName(classification_metrics(scored).select(F.inline(averages)))


def class_distributions(scored: DataFrame) -> DataFrame:
    """Rows per class, once by truth and once by prediction."""
    counts = per_class(scored)
    sides = F.array(
        F.struct(F.lit("true").alias("side"), F.col("label"), F.col("support").alias("n")),
        F.struct(F.lit("predicted").alias("side"), F.col("label"), F.col("predicted").alias("n")),
    )
    return counts.select(F.inline(sides)).where(F.col("n") > 0)


def brier_score(scored: DataFrame, label: str = "label", probability: str = "probability") -> DataFrame:
    """Mean squared distance of probability and label."""
    return scored.agg(F.avg(F.pow(F.col(probability) - F.col(label), 2)).alias("brier_score"))


def performance_summary(scored: DataFrame, auc: Column | None = None) -> DataFrame:
    """Verbal grades of one scored table."""
    brier = brier_score(scored).scalar()
    row = classification_metrics(scored).select("accuracy", "f1").withColumn("brier_score", brier)
    if auc is not None:
        row = row.withColumn("_auc", auc)

    def both(level: float) -> Column:
        return (F.col("accuracy") >= level) & (F.col("f1") >= level)

    grade = F.when(both(0.9), "Excellent").when(both(0.85), "Good").when(both(0.75), "Fair").otherwise("Poor")
    calibration = (
        F.when(F.col("brier_score") <= 0.1, "Well calibrated")
        .when(F.col("brier_score") <= 0.2, "Reasonably calibrated")
        .otherwise("Poorly calibrated")
    )
    line = F.format_string("Accuracy: %.3f, F1: %.3f", "accuracy", "f1")
    if auc is not None:
        line = F.concat(line, F.format_string(", AUC: %.3f", "_auc"))
    return row.select(
        grade.alias("overall_performance"), line.alias("key_metrics"), calibration.alias("calibration")
    )


def evaluation_summary(scored: DataFrame, ranking: DataFrame, ece: DataFrame) -> DataFrame:
    """(metric, value): all single-number metrics; ranking metrics are 0.0 where a class is absent."""
    row = classification_metrics(scored).withColumn("brier_score", brier_score(scored).scalar())
    both = ranking.select(F.struct("roc_auc", "average_precision").alias("_r")).scalar()
    row = row.withColumn("_r", both).withColumn("expected_calibration_error", ece.scalar())
    row = row.withColumn("roc_auc", F.coalesce("_r.roc_auc", F.lit(0.0))).withColumn(
        "average_precision", F.coalesce("_r.average_precision", F.lit(0.0))
    )
    wanted = [c for c in row.columns if c not in ("_r", "n")]
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value")) for c in wanted])
    return row.select(F.inline(pairs))
