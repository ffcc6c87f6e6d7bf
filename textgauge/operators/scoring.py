"""Batch scoring with any predictor, and what is read off the scores.

A predictor is a function without arguments that loads a model and returns a callable from a list of
texts to an array of class probabilities, one row per text.  It is loaded once per Python worker task.
Only the text column travels to Python; the other columns stay in the JVM.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Transformer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textgauge.config import ScoreConfig
from textgauge.functions import text as X

Predictor = Callable[[], Callable[[list[str]], np.ndarray]]

RESULT = T.StructType(
    [
        T.StructField("probabilities", T.ArrayType(T.DoubleType())),
        T.StructField("seconds", T.DoubleType()),
        T.StructField("error", T.StringType()),
    ]
)


def predict_column(text: Column, predictor: Predictor, batch_size: int) -> Column:
    """Struct of probabilities, seconds and error for a text column."""

    # Nested, so that workers need not have this package installed.
    def attempt(model, texts: list[str]) -> list[tuple]:
        start = time.perf_counter()
        try:
            probabilities = np.asarray(model(texts), dtype=float)
            if probabilities.ndim != 2 or len(probabilities) != len(texts):
                raise ValueError("the predictor must return one row of probabilities per text")
            each = (time.perf_counter() - start) / len(texts)
            return [(row.tolist(), each, None) for row in probabilities]
        except Exception as problem:
            if len(texts) == 1:
                return [(None, None, str(problem) or type(problem).__name__)]
            # One bad row fails a batch: score its rows one by one so that the good ones survive.
            return [attempt(model, [one])[0] for one in texts]

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = predictor()
        for batch in batches:
            rows: list[tuple] = [(None, None, "text is null")] * len(batch)
            known = np.flatnonzero(batch.notna().to_numpy())
            for start in range(0, len(known), batch_size):
                places = known[start : start + batch_size]
                for place, row in zip(places, attempt(model, [batch.iloc[i] for i in places])):
                    rows[place] = row
            yield pd.DataFrame(rows, columns=["probabilities", "seconds", "error"])

    # The measured time differs from run to run, so the result must not be computed twice.
    return F.pandas_udf(run, RESULT).asNondeterministic()(text)


def score_texts(df: DataFrame, predictor: Predictor, config: ScoreConfig = ScoreConfig()) -> DataFrame:
    """The input rows with prediction, label, confidence, time, lengths, error columns and ``prob_<class>``."""
    original = F.col(config.text)
    processed = X.clean_light(original) if config.light_clean else original
    processed = F.when(original.isNotNull(), processed)
    scored = df.withColumn("_processed", processed).withColumn(
        "_s", predict_column(F.col("_processed"), predictor, config.batch_size)
    )
    return _result_columns(
        scored, df.columns, F.col("_s.probabilities"), F.col("_s.seconds"), F.col("_s.error"), config
    )


def score_with_model(df: DataFrame, model, config: ScoreConfig = ScoreConfig()) -> DataFrame:
    """The same columns from a fitted Spark ML model; scoring stays in the JVM, so no time per text."""
    processed = F.when(F.col(config.text).isNotNull(), X.clean_light(config.text))
    scored = df.withColumn("_processed", processed).withColumn(
        "tokens", X.tokens(F.coalesce("_processed", F.lit("")), config.max_tokens)
    )
    scored = model.transform(scored)
    error = F.when(F.col(config.text).isNull(), "text is null")
    probabilities = F.when(error.isNull(), vector_to_array("probability"))
    return _result_columns(scored, df.columns, probabilities, F.lit(None).cast("double"), error, config)


def score(df: DataFrame, scorer, config: ScoreConfig = ScoreConfig()) -> DataFrame:
    """Score with a plug-in predictor or with a fitted Spark ML model."""
    return score_with_model(df, scorer, config) if isinstance(scorer, Transformer) else score_texts(df, scorer, config)


def prediction_log(scored: DataFrame, at: Column | None = None) -> DataFrame:
    """What is kept of each scored text: ``ts, text_length, prediction, confidence, inference_time, failed``."""
    return scored.select(
        (F.current_timestamp() if at is None else at).alias("ts"),
        F.col("processed_text_length").alias("text_length"),
        "prediction",
        "confidence",
        "inference_time",
        F.col("processing_error").alias("failed"),
    )


def _result_columns(
    scored: DataFrame, keep: list[str], probabilities: Column, seconds: Column, error: Column, config: ScoreConfig
) -> DataFrame:
    text = F.col(config.text)
    rows = scored.select(
        *keep, "_processed", probabilities.alias("_p"), seconds.alias("inference_time"), error.alias("_error")
    )
    confidence = F.array_max("_p")
    prediction = (F.array_position("_p", confidence) - 1).cast("int")
    names = F.lit(None).cast("string")
    for i, name in enumerate(config.class_names):
        names = F.when(F.col("prediction") == i, F.lit(name)).otherwise(names)
    failed = F.col("_error").isNotNull()
    rows = rows.withColumn("prediction", F.when(~failed, prediction)).withColumn("confidence", confidence)
    return rows.select(
        *keep,
        "prediction",
        names.alias("prediction_label"),
        "confidence",
        "inference_time",
        X.char_count(text).alias("original_text_length"),
        X.char_count("_processed").alias("processed_text_length"),
        failed.alias("processing_error"),
        F.col("_error").alias("error_message"),
        F.when(failed, X.excerpt(text)).alias("error_text"),
        *[F.get("_p", i).alias(f"prob_{name}") for i, name in enumerate(config.class_names)],
    )


def positive_probability(probabilities: Column | str) -> Column:
    """Probability of the positive class from a vector column."""
    return F.get(vector_to_array(probabilities), 1)


def scoring_summary(scored: DataFrame) -> DataFrame:
    """Totals, errors, and mean confidence and time of the successes."""
    good = ~F.col("processing_error")
    return scored.agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(good).alias("n_successful"),
        F.count_if("processing_error").alias("n_errors"),
        F.avg(F.when(good, F.col("confidence"))).alias("mean_confidence"),
        F.avg(F.when(good, F.col("inference_time"))).alias("mean_time"),
    )


def confidence_bands(confidence: Column | str) -> tuple[Column, Column]:
    """Coarse and fine verbal grade of a confidence."""
    c = F.col(confidence) if isinstance(confidence, str) else confidence
    coarse = F.when(c > 0.9, "High").when(c > 0.7, "Medium").otherwise("Low")
    fine = (
        F.when(c > 0.9, "Very High").when(c > 0.8, "High").when(c > 0.7, "Medium").when(c > 0.6, "Low").otherwise("Very Low")
    )
    return coarse, fine


def input_status(text: Column | str, min_words: int = 3) -> Column:
    """Whether a text is worth scoring: empty, too short or ok."""
    return (
        F.when(X.is_blank(text), "empty").when(X.word_count(text) < min_words, "too short").otherwise("ok")
    )
