"""Calibration of probabilities: binned error and reliability curve."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgauge.functions.stats import bin_index


def _bins(scored: DataFrame, bins: int, zero_in_first: bool) -> DataFrame:
    slot = bin_index(F.col("probability"), bins, zero_in_first)
    return scored.groupBy(slot.alias("bin")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col("label").cast("double")).alias("observed"),
        F.avg("probability").alias("predicted"),
    )


def expected_calibration_error(scored: DataFrame, bins: int = 10) -> DataFrame:
    """Mean distance of predicted and observed rate over the bins, weighted by rows; 0 lies in no bin."""
    gap = F.when(F.col("bin").isNotNull(), F.abs(F.col("predicted") - F.col("observed")) * F.col("n")).otherwise(0.0)
    return _bins(scored, bins, False).agg((F.sum(gap) / F.sum("n")).alias("expected_calibration_error"))


def calibration_curve(scored: DataFrame, bins: int = 10) -> DataFrame:
    """Observed and predicted rate of every non-empty bin; 0 lies in the first bin."""
    return _bins(scored, bins, True).where(F.col("bin").isNotNull())
