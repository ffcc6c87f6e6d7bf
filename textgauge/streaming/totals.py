"""Totals of a scoring log since its start, kept as state of a stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def running_totals(log: DataFrame, failed: Column, by: Sequence[str] = (), seconds: str = "value") -> DataFrame:
    """Per key (or overall): predictions, errors, successes, their summed and mean time; alike on a stream and on a table.

    The state has one row per key and no watermark: totals run from the start and nothing arrives too late.  Every batch
    is combined by key before it meets the state, so a key with most of the rows costs one update per task.
    """
    good = F.coalesce(~failed, F.lit(False))
    totals = log.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_total"),
        F.count_if(~good).alias("n_errors"),
        F.count_if(good).alias("n_successful"),
        F.coalesce(F.sum(F.when(good, F.col(seconds))), F.lit(0.0)).alias("total_time"),
    )
    return totals.withColumn("mean_time", F.when(F.col("n_successful") > 0, F.col("total_time") / F.col("n_successful")))


def write_totals(totals: DataFrame, path: str, checkpoint: str, once: bool = False) -> StreamingQuery:
    """Write the totals of the keys that a batch touched to a folder of that batch.

    A batch that runs again after a failure starts from the state before it and overwrites its own folder, so nothing is
    counted or listed twice.
    """

    def save(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    writer = totals.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(save)
    return (writer.trigger(availableNow=True) if once else writer).start()


def totals_history(spark: SparkSession, path: str) -> DataFrame:
    """The totals after every batch, with ``batch``: a row per key that the batch touched."""
    return spark.read.option("basePath", path).parquet(f"{path}/batch=*").withColumn("batch", F.col("batch").cast("long"))


def current_totals(history: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The newest totals of every key."""
    values = [c for c in history.columns if c not in (*by, "batch")]
    newest = history.groupBy(*by).agg(F.max_by(F.struct(*values), "batch").alias("_v"))
    return newest.select(*by, *[F.col(f"_v.{c}").alias(c) for c in values]).where("n_total is not null")
