"""Train, score the held-out rows, evaluate, gate."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import asdict

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgauge.config import CLASSES, GateConfig, ScoreConfig, TrainConfig
from textgauge.functions.digests import names
from textgauge.operators.calibration import expected_calibration_error
from textgauge.operators.gates import model_gate_report
from textgauge.operators.metrics import evaluation_summary
from textgauge.operators.model import Fitted, train, train_on_tokens, with_tokens
from textgauge.operators.ranking import ranking_metrics
from textgauge.operators.sampling import split_rows
from textgauge.operators.scoring import score_with_model
from textgauge.sources.stage_cache import Stage, complete, run_stage
from textgauge.sources.writers import write_split


def train_and_score(
    corpus: DataFrame,
    text: str,
    label: str,
    key,
    config: TrainConfig = TrainConfig(),
    classes: Sequence[int] = CLASSES,
    folder: str | None = None,
) -> tuple[Fitted, DataFrame]:
    """The fitted model, and all corpus rows with their split, class and scores.

    With a ``folder`` that tasks share, the split rows are stored there and read by fit and scoring; without it the
    split is computed for each of them.
    """
    ready = corpus.where(F.col(text).isNotNull() & F.col(label).isNotNull())
    ready = split_rows(ready, label, key, config.split, classes)
    if folder is not None:
        ready = corpus.sparkSession.read.parquet(write_split(ready, f"{folder.rstrip('/')}/split"))
    fitted = train(ready, text, label, config)
    scores = ScoreConfig(text=text, max_tokens=config.max_tokens)
    return fitted, score_with_model(ready, fitted.model, scores)


def scored_table(rows: DataFrame, label: str) -> DataFrame:
    """``label, prediction, probability`` as the evaluation operators and gates read it."""
    return rows.where(~F.col("processing_error")).select(
        F.col(label).cast("int").alias("label"), "prediction", F.col("prob_ai").alias("probability")
    )


def evaluate(scored: DataFrame) -> DataFrame:
    """(metric, value) of a scored table."""
    return evaluation_summary(scored, ranking_metrics(scored), expected_calibration_error(scored))


def training_stages(
    source: Mapping, base: str, text: str, label: str, key, config: TrainConfig = TrainConfig(), classes: Sequence[int] = CLASSES
) -> dict[str, Stage]:
    """The stages of a training job over the corpus that ``source`` describes: each is fingerprinted with all before it."""
    columns = {"text": text, "label": label, "key": names(key), "classes": list(classes)}
    split = Stage(base, "split", {**columns, **asdict(config.split)}, (source,))
    tokens = Stage(base, "tokens", {"max_tokens": config.max_tokens}, (split,))
    fit = {k: v for k, v in asdict(config).items() if k not in ("split", "max_tokens")}
    model = Stage(base, "model", fit, (tokens,))
    scores = Stage(base, "scores", {}, (split, model))
    return {s.name: s for s in (split, tokens, model, scores)}


def staged_training(
    corpus: DataFrame,
    source: Mapping,
    base: str,
    text: str,
    label: str,
    key,
    config: TrainConfig = TrainConfig(),
    classes: Sequence[int] = CLASSES,
) -> tuple[PipelineModel, DataFrame]:
    """The model and the scored rows, each stage read from ``base`` while nothing before it changed.

    ``source`` describes the state of the corpus, for instance ``inventory.listing`` of its files.  A change of a fit
    setting reuses split and tokens; a change of the corpus or of the split shares nothing.
    """
    spark = corpus.sparkSession
    stages = training_stages(source, base, text, label, key, config, classes)

    def split() -> DataFrame:
        ready = corpus.where(F.col(text).isNotNull() & F.col(label).isNotNull())
        return split_rows(ready, label, key, config.split, classes)

    rows = run_stage(spark, stages["split"], split)

    def tokens() -> DataFrame:
        return with_tokens(rows, text, config.max_tokens).select(*names(key), "split", label, "tokens")

    tokenized = run_stage(spark, stages["tokens"], tokens)

    def fit(path: str) -> None:
        train_on_tokens(tokenized, label, config).model.write().overwrite().save(path)

    model = PipelineModel.load(complete(spark, stages["model"], fit))
    scores = ScoreConfig(text=text, max_tokens=config.max_tokens)
    return model, run_stage(spark, stages["scores"], lambda: score_with_model(rows, model, scores).drop(text))


def training_job(
    corpus: DataFrame,
    base: str,
    text: str,
    label: str,
    key,
    config: TrainConfig = TrainConfig(),
    gates: GateConfig = GateConfig(),
    classes: Sequence[int] = CLASSES,
    source: Mapping | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Train, store model and scores under ``base``; metrics and gate verdict of the test rows.

    The scores are written once, one folder per split, and only the test folder is read for evaluation.  With a
    ``source`` that describes the corpus all stages are kept by fingerprint, see ``staged_training``; without it they
    are made anew.
    """
    if source is not None:
        _, stored = staged_training(corpus, source, base, text, label, key, config, classes)
    else:
        fitted, rows = train_and_score(corpus, text, label, key, config, classes, base)
        fitted.model.write().overwrite().save(f"{base}/model")
        stored = corpus.sparkSession.read.parquet(write_split(rows.drop(text), f"{base}/scores"))
    test = scored_table(stored.where(F.col("split") == "test"), label)
    return evaluate(test), model_gate_report(test, gates)


def load_model(base: str) -> PipelineModel:
    return PipelineModel.load(f"{base}/model")
