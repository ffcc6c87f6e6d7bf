"""Score a stored table: read, score, write.  Partitions take the place of chunks."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from textgauge.config import ScoreConfig
from textgauge.operators.scoring import Predictor, score
from textgauge.sources.readers import read_table, require_columns
from textgauge.sources.writers import write_table


def predictions_path(path: str) -> str:
    """``name_predictions.suffix`` next to the input; dots in folders are no suffixes."""
    folder, slash, name = path.rstrip("/").rpartition("/")
    stem, dot, suffix = name.rpartition(".")
    return folder + slash + (f"{stem}_predictions.{suffix}" if dot and stem else f"{name}_predictions")


def score_file(
    spark: SparkSession,
    source: str,
    scorer: Predictor | PipelineModel,
    target: str | None = None,
    config: ScoreConfig = ScoreConfig(),
    schema: T.StructType | str | None = None,
    format: str | None = None,
) -> str:
    """Score a CSV or Parquet table, with a plug-in predictor or a fitted model, and write its rows with their scores.

    ``format`` names the input format where the path has no suffix; the target is then written in it as well.
    """
    rows = require_columns(read_table(spark, source, schema, format), config.text)
    return write_table(score(rows, scorer, config), target or predictions_path(source), format)
