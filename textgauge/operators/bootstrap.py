"""Bootstrap intervals of accuracy and of other metrics.

Resampling n rows with replacement draws each time a right or a wrong row, so one binomial draw with the
observed share of right rows is the same experiment.  The cost grows with the number of replicates, not
with rows times replicates.  Metrics of the confusion matrix need one multinomial draw over its cells, and metrics of
the scores Poisson weights per distinct score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgauge.config import SEED
from textgauge.session import scratch_path


def accuracy_replicates(scored: DataFrame, replicates: int = 1000, seed: int = SEED) -> DataFrame:
    """(replicate, accuracy): one draw per replicate, the same for a given seed under any partitioning."""
    known = F.col("label").isNotNull() & F.col("prediction").isNotNull()
    counts = scored.agg(
        F.struct(F.count_if(known).alias("n"), F.count_if(F.col("label") == F.col("prediction")).alias("right")).alias("_c")
    )
    plan = scored.sparkSession.range(replicates).withColumn("_c", counts.scalar())
    plan = plan.select(F.col("id").alias("replicate"), "_c.n", "_c.right")

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            accuracy = [
                np.random.default_rng([seed, r]).binomial(n, right / n) / n if n else None
                for r, n, right in zip(batch["replicate"], batch["n"], batch["right"])
            ]
            yield pd.DataFrame({"replicate": batch["replicate"], "accuracy": pd.Series(accuracy, dtype=float)})

    return plan.mapInPandas(draw, "replicate bigint, accuracy double")


def bootstrap_accuracy_ci(
    scored: DataFrame, replicates: int = 1000, level: float = 0.95, seed: int = SEED
) -> DataFrame:
    """Percentile interval over the replicates."""
    tail = (1.0 - level) / 2
    return accuracy_replicates(scored, replicates, seed).agg(
        F.percentile("accuracy", F.lit(tail)).alias("lower_bound"),
        F.percentile("accuracy", F.lit(1.0 - tail)).alias("upper_bound"),
        F.lit(level).alias("confidence_level"),
    )


CELL_METRICS = ("accuracy", "precision", "recall", "f1")


def metric_replicates(scored: DataFrame, replicates: int = 1000, seed: int = SEED) -> DataFrame:
    """(replicate, accuracy, precision, recall, f1), the last three weighted by support.

    Resampling rows with replacement draws (label, prediction) pairs with the observed shares, so one multinomial draw
    over the cells of the confusion matrix is the same experiment; the cost follows the classes, not the rows.
    """
    known = scored.where(F.col("label").isNotNull() & F.col("prediction").isNotNull())
    counts = known.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))
    # As many entries as there are pairs of classes, in one order whatever the partitioning.
    row = counts.agg(F.array_sort(F.collect_list(F.struct("label", "prediction", "n"))).alias("_c"))
    plan = scored.sparkSession.range(replicates).withColumn("_c", row.scalar())
    plan = plan.select(F.col("id").alias("replicate"), "_c.label", "_c.prediction", "_c.n")

    def draw(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for r, label, prediction, n in zip(batch["replicate"], batch["label"], batch["prediction"], batch["n"]):
                n = np.asarray(n, np.int64)
                if not n.sum():
                    out.append((r, None, None, None, None))
                    continue
                classes = np.unique(np.concatenate([label, prediction]))
                own = np.random.default_rng([seed, r]).multinomial(n.sum(), n / n.sum())
                table = np.zeros((len(classes), len(classes)))
                np.add.at(table, (np.searchsorted(classes, label), np.searchsorted(classes, prediction)), own)
                hits, support, predicted = np.diag(table), table.sum(1), table.sum(0)

                def mean(part, whole):
                    return float(np.divide(part, whole, out=np.zeros(len(part)), where=whole > 0) @ support / support.sum())

                out.append((r, float(hits.sum() / support.sum()), mean(hits, predicted), mean(hits, support), mean(2 * hits, support + predicted)))
            yield pd.DataFrame(out, columns=["replicate", *CELL_METRICS]).astype(dict.fromkeys(CELL_METRICS, float))

    return plan.mapInPandas(draw, "replicate bigint, accuracy double, precision double, recall double, f1 double")


def ranking_replicates(scored: DataFrame, replicates: int = 200, seed: int = SEED, per_range: int = 50_000) -> DataFrame:
    """(replicate, roc_auc, brier_score): every distinct score of a class gets a Poisson weight per replicate.

    The weights follow from the seed, the score and the class, so they are the same under any partitioning and are drawn
    again rather than stored.  Scores are cut into sorted ranges of about ``per_range`` distinct ones; one pass adds up the weights of each range, and a second
    one counts, with the sums of the ranges below, the pairs of a positive above a negative.  The driver holds ranges times
    replicates numbers.  A replicate without positives or without negatives has no area.
    """
    spark = scored.sparkSession
    rows = scored.where(F.col("label").isin(0, 1) & F.col("probability").isNotNull() & ~F.isnan("probability"))
    rows = rows.select(F.col("label").cast("int").alias("label"), (F.col("probability").cast("double") + F.lit(0.0)).alias("p"))
    groups = rows.groupBy("p").agg(F.count_if(F.col("label") == 1).alias("n1"), F.count_if(F.col("label") == 0).alias("n0"))
    path = scratch_path(spark, "scores")
    ranges = max(8, -(-groups.count() // per_range))
    groups.repartitionByRange(ranges, "p").withColumn("part", F.spark_partition_id()).write.parquet(path)
    groups = spark.read.parquet(path)

    def weights(own: pd.DataFrame, side: int) -> np.ndarray:
        """A row per score, a column per replicate."""
        out = np.zeros((len(own), replicates))
        bits = own["p"].to_numpy().view(np.uint64)
        for i, (p, n) in enumerate(zip(bits.tolist(), own[f"n{side}"])):
            if n:
                out[i] = np.random.Generator(np.random.Philox(key=[p, seed * 2 + side])).poisson(n, replicates)
        return out

    def sums(own: pd.DataFrame) -> pd.DataFrame:
        ones, zeros, p = weights(own, 1), weights(own, 0), own["p"].to_numpy()[:, None]
        error = (ones * (1 - p) ** 2 + zeros * p**2).sum(0)
        packed = [x.astype("<f8").tobytes() for x in (ones.sum(0), zeros.sum(0), error)]
        return pd.DataFrame([(int(own["part"].iloc[0]), *packed)], columns=["part", "ones", "zeros", "error"])

    found = groups.groupBy("part").applyInPandas(sums, "part int, ones binary, zeros binary, error binary").orderBy("part").collect()
    below, zeros, ones, error = {}, np.zeros(replicates), np.zeros(replicates), np.zeros(replicates)
    for r in found:
        below[r["part"]] = zeros.copy()
        zeros, ones, error = (a + np.frombuffer(r[c], "<f8") for a, c in ((zeros, "zeros"), (ones, "ones"), (error, "error")))
    shared = spark.sparkContext.broadcast(below)

    def pairs(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values("p", ignore_index=True)
        up, down = weights(own, 1), weights(own, 0)
        under = shared.value[int(own["part"].iloc[0])] + np.cumsum(down, 0) - down / 2
        return pd.DataFrame({"replicate": np.arange(replicates), "pairs": (up * under).sum(0)})

    wins = groups.groupBy("part").applyInPandas(pairs, "replicate bigint, pairs double")
    wins = wins.groupBy("replicate").agg(F.sum("pairs").alias("pairs"))
    totals = [(i, float(ones[i]), float(zeros[i]), float(error[i])) for i in range(replicates)]
    totals = spark.createDataFrame(totals, "replicate bigint, ones double, zeros double, error double")
    all_pairs, weight = F.col("ones") * F.col("zeros"), F.col("ones") + F.col("zeros")
    return totals.join(wins, "replicate", "left").select(
        "replicate",
        F.when(all_pairs > 0, F.col("pairs") / all_pairs).alias("roc_auc"),
        F.when(weight > 0, F.col("error") / weight).alias("brier_score"),
    )


def intervals(replicates: DataFrame, level: float = 0.95) -> DataFrame:
    """(metric, lower_bound, upper_bound, confidence_level): percentile intervals of all columns but ``replicate``."""
    tail = (1.0 - level) / 2
    metrics = [c for c in replicates.columns if c != "replicate"]
    bounds = [F.percentile(c, F.array(F.lit(tail), F.lit(1.0 - tail))).alias(c) for c in metrics]
    rows = [F.struct(F.lit(c).alias("metric"), F.get(c, 0).alias("lower_bound"), F.get(c, 1).alias("upper_bound"), F.lit(level).alias("confidence_level")) for c in metrics]
    return replicates.agg(*bounds).select(F.inline(F.array(*rows)))


def bootstrap_intervals(scored: DataFrame, replicates: int = 1000, ranking: int = 200, level: float = 0.95, seed: int = SEED) -> DataFrame:
    """Percentile intervals of accuracy, weighted precision, recall and F1, the area under the curve and the Brier score."""
    cells = intervals(metric_replicates(scored, replicates, seed), level)
    return cells.unionByName(intervals(ranking_replicates(scored, ranking, seed), level))
