"""The default classifier: hashed token weights and logistic regression on Spark ML."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.linalg import SparseMatrix, Vectors
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgauge.config import TrainConfig
from textgauge.functions import text as X
from textgauge.operators.metrics import classification_metrics
from textgauge.operators.penalties import Weights, confusion, fit_penalties, weighted_scores
from textgauge.operators.scoring import positive_probability
from textgauge.session import scratch_path


@dataclass
class Fitted:
    model: PipelineModel
    reg_param: float
    history: list[dict]


def with_tokens(df: DataFrame, text: str, max_tokens: int | None = None) -> DataFrame:
    """Add the token array, lightly cleaned like texts to be scored; cut to ``max_tokens`` if given."""
    return df.withColumn("tokens", X.tokens(X.clean_light(text), max_tokens))


def scored_columns(transformed: DataFrame, label: str) -> DataFrame:
    """``label, prediction, probability`` of a transformed table, as the evaluation operators read them."""
    return transformed.select(
        F.col(label).cast("int").alias("label"),
        F.col("prediction").cast("int").alias("prediction"),
        positive_probability("probability").alias("probability"),
    )


def as_model(spark: SparkSession, fit: Weights, label: str) -> LogisticRegressionModel:
    """The weights as a Spark ML model, by way of its stored form."""
    size = len(fit.weights)
    rows = [(float(i), Vectors.sparse(size, [i % size], [1.0])) for i in (0, 1)]
    path = scratch_path(spark, "model")
    LogisticRegression(labelCol=label, maxIter=1, regParam=fit.penalty).fit(spark.createDataFrame(rows, [label, "features"])).write().save(path)
    kind = spark.read.parquet(f"{path}/data").schema
    used = fit.weights.nonzero()[0]
    # One row of weights, stored by rows.
    matrix = SparseMatrix(1, size, [0, len(used)], used, fit.weights[used], isTransposed=True)
    row = (2, size, Vectors.dense([fit.intercept]), matrix, False)
    spark.createDataFrame([row], kind).coalesce(1).write.mode("overwrite").parquet(f"{path}/data")
    return LogisticRegressionModel.load(path)


def best_of(history: list[dict], config: TrainConfig) -> tuple[int, int | None]:
    """The place of the best F1 along the ladder, and that of the step that ended the search (none: still open).

    The search ends after ``patience`` steps without a gain of at least ``min_gain`` over the last such gain; a better
    model before that is kept however small its gain.
    """
    best, mark, waited = 0, None, 0
    for i, row in enumerate(history):
        f1 = row["f1"] or 0.0
        if f1 > (history[best]["f1"] or 0.0):
            best = i
        if mark is None or f1 >= mark + config.min_gain:
            mark, waited = f1, 0
        else:
            waited += 1
            if waited >= config.patience:
                return best, i
    return best, None


def train(df: DataFrame, text: str, label: str, config: TrainConfig = TrainConfig()) -> Fitted:
    """Fit on ``split = train`` along a ladder of penalties; keep the best F1 on ``split = validation``.

    The penalties of two classes, 0 and 1, are fitted together: every pass over the features serves all of them, and one
    more pass judges them.  More classes are fitted one penalty after another.  ``history`` has the validation metrics of
    every step of the ladder until it ends (see ``best_of``).  The test rows are never read.
    """
    rows = df.where(F.col("split").isin("train", "validation"))
    return train_on_tokens(with_tokens(rows, text, config.max_tokens), label, config)


def train_on_tokens(df: DataFrame, label: str, config: TrainConfig = TrainConfig()) -> Fitted:
    """``train`` on rows that have their ``tokens`` already."""
    rows = df.where(F.col("split").isin("train", "validation"))
    rows = rows.select("split", F.col(label).cast("double").alias(label), "tokens")
    hashing = HashingTF(inputCol="tokens", outputCol="_counts", numFeatures=config.features)
    weighting = IDF(inputCol="_counts", outputCol="features", minDocFreq=config.min_texts)
    front = Pipeline(stages=[hashing, weighting]).fit(rows.where("split = 'train'"))
    features = front.transform(rows).select("split", label, "features").persist(StorageLevel.MEMORY_AND_DISK)
    learn, judge = features.where("split = 'train'"), features.where("split = 'validation'")
    try:
        if features.agg(F.bool_and(F.col(label).isin(0.0, 1.0))).first()[0] is False:
            best, history, last = _one_by_one(learn, judge, label, config)
        else:
            fits = fit_penalties(learn, label, config.reg_ladder, config.features, config.max_iter)
            tables = confusion(judge, label, fits)
            history = [{"reg_param": f.penalty, **weighted_scores(t)} for f, t in zip(fits, tables, strict=True)]
            best, ended = best_of(history, config)
            history = history[: ended + 1] if ended is not None else history
            last = as_model(df.sparkSession, fits[best], label)
    finally:
        features.unpersist()
    return Fitted(PipelineModel(stages=[*front.stages, last]), history[best]["reg_param"], history)


def _one_by_one(learn: DataFrame, judge: DataFrame, label: str, config: TrainConfig) -> tuple[int, list[dict], object]:
    history, models = [], []
    for reg in config.reg_ladder:
        models.append(LogisticRegression(labelCol=label, maxIter=config.max_iter, regParam=reg).fit(learn))
        row = classification_metrics(scored_columns(models[-1].transform(judge), label)).first()
        history.append({"reg_param": reg, "accuracy": row["accuracy"], "precision": row["precision_weighted"], "recall": row["recall_weighted"], "f1": row["f1"]})
        best, ended = best_of(history, config)
        if ended is not None:
            break
    return best, history, models[best]
