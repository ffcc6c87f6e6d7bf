"""Continuous scoring and running statistics with Structured Streaming."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from textgauge.config import ScoreConfig
from textgauge.operators.scoring import Predictor, input_status, score


def read_stream(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str = "*.parquet", files_per_batch: int = 1000
) -> DataFrame:
    """New Parquet files of a folder as they appear."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def read_table_stream(spark: SparkSession, folder: str, name: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """New files of one Parquet table of a folder, be the table a single file or a folder of part files.

    A stream can't begin at a single file, so the table is named by a pattern that matches nothing else.
    """
    path = f"{folder.rstrip('/')}/{{{name}}}"
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def score_stream(texts: DataFrame, scorer: Predictor | PipelineModel, config: ScoreConfig = ScoreConfig()) -> DataFrame:
    """Scored rows with the input status, by a plug-in predictor or a fitted model; alike on a stream and on a table."""
    return score(texts.withColumn("input_status", input_status(config.text)), scorer, config)


def write_stream(rows: DataFrame, path: str, checkpoint: str, mode: str = "append", once: bool = False) -> StreamingQuery:
    """Exactly-once Parquet sink; with ``once`` the query ends when the present input is done."""
    writer = rows.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start(path)


def scoring_stats(
    log: DataFrame, failed, time: str = "ts", seconds: str = "value", window: str = "1 hour", late: str = "10 minutes"
) -> DataFrame:
    """Totals, errors and mean time of the successes per window; works alike on a stream and on a table.

    On a stream the watermark bounds the state: a window is emitted once no row within ``late`` can
    reach it, and later rows are dropped.
    """
    kind = log.schema[time].dataType
    rows = log
    if log.isStreaming:
        # A watermark needs an instant; a time without zone is read in the session's zone.
        rows = log.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return (
        rows.groupBy(F.window(time, window).alias("w"))
        .agg(
            F.count(F.lit(1)).alias("n_total"),
            F.count_if(failed).alias("n_errors"),
            F.avg(F.when(~failed, F.col(seconds))).alias("mean_time"),
        )
        .select(
            F.col("w.start").cast(kind).alias("window_start"),
            F.col("w.end").cast(kind).alias("window_end"),
            "n_total",
            "n_errors",
            "mean_time",
        )
    )
