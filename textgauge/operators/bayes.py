"""Multinomial naive Bayes in closed form: a fit is one grouped aggregate of token counts, and SQL can repeat every number.

The model is a table with a row per training token and its count in each class.  Scoring joins a text's tokens with that
table.  A token that makes up more than a thousandth of all occurrences is hot; there are at most a thousand of them, so
they are looked up in a broadcast table, and only the others go through a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgauge.config import CLASSES
from textgauge.functions import text as X
from textgauge.functions.digests import names
from textgauge.operators.metrics import classification_metrics

HOT_SHARE = 1000


@dataclass(frozen=True)
class Bayes:
    """``counts``: ``token, n`` (occurrences by class, in the order of ``classes``); rows and occurrences by class; tokens."""

    counts: DataFrame
    classes: tuple[int, ...]
    rows: tuple[int, ...]
    occurrences: tuple[int, ...]
    kinds: int
    alpha: float

    def prior(self) -> Column:
        """Logarithms of the shares of the classes; null for one without training rows."""
        n = sum(self.rows)
        return F.array(*[F.log(F.lit(r / n)) if r else F.lit(None).cast("double") for r in self.rows])

    def weights(self) -> DataFrame:
        """``token, w``: logarithms of the smoothed shares of a token in each class."""
        each = [
            F.log((F.col("n")[i] + F.lit(self.alpha)) / F.lit(total + self.alpha * self.kinds)) for i, total in enumerate(self.occurrences)
        ]
        return self.counts.select("token", F.array(*each).alias("w"))


def token_rows(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per token of a lightly cleaned, lower-cased text, with the kept columns."""
    return df.select(*keep, F.explode(X.tokens(X.clean_light(text))).alias("token"))


def fit_bayes(df: DataFrame, text: str, label: str, path: str, classes: Sequence[int] = CLASSES, alpha: float = 1.0) -> Bayes:
    """Count the tokens of each class and store them under ``path``, a folder that tasks share.

    Rows with a null text or a label that isn't listed do not count.
    """
    if alpha <= 0:
        raise ValueError("alpha must be positive")
    rows = df.where(F.col(text).isNotNull() & F.col(label).isin(*classes)).select(text, F.col(label).alias("_label"))
    by_class = F.array(*[F.count_if(F.col("_label") == c) for c in classes])
    counts = token_rows(rows, text, "_label").groupBy("token").agg(by_class.alias("n"))
    counts.write.parquet(path)
    counts = df.sparkSession.read.parquet(path)
    total = counts.agg(F.count(F.lit(1)), *[F.coalesce(F.sum(F.col("n")[i]), F.lit(0)) for i in range(len(classes))]).first()
    seen = rows.agg(*[F.count_if(F.col("_label") == c) for c in classes]).first()
    return Bayes(counts, tuple(classes), tuple(seen), tuple(total[1:]), total[0], alpha)


def score_bayes(df: DataFrame, model: Bayes, text: str, key, keep: Sequence[str] = ()) -> DataFrame:
    """The key and kept columns with ``prediction, probabilities`` (by class); ties go to the class listed first.

    Tokens that training never saw say nothing.  A null text has null scores; rows of equal key would be taken for one text.
    """
    if not sum(model.rows):
        raise ValueError("no training rows")
    cols, k = names(key), len(model.classes)
    weights, every = model.weights(), sum(model.occurrences)
    frequent = F.aggregate("n", F.lit(0).cast("bigint"), lambda a, b: a + b) * HOT_SHARE > every
    hot = weights.join(model.counts.where(frequent).select("token"), "token", "left_semi")
    tokens = token_rows(df.where(F.col(text).isNotNull()), text, *cols)
    tokens = tokens.join(F.broadcast(hot), "token", "left")
    known = tokens.where("w is not null").select(*cols, "w")
    rare = tokens.where("w is null").select(*cols, "token").join(weights, "token").select(*cols, "w")
    sums = known.unionByName(rare).groupBy(*cols).agg(*[F.sum(F.col("w")[i]).alias(f"_s{i}") for i in range(k)])
    sums = sums.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(cols)], *[f"_s{i}" for i in range(k)])
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(cols)]
    rows = df.select(*cols, *keep, F.col(text).isNotNull().alias("_known")).join(sums, same, "left")
    prior = model.prior()
    joint = F.array(*[prior[i] + F.coalesce(f"_s{i}", F.lit(0.0)) for i in range(k)])
    rows = rows.withColumn("_j", joint).withColumn("_top", F.array_max("_j"))
    odds = [F.coalesce(F.exp(F.col("_j")[i] - F.col("_top")), F.lit(0.0)) for i in range(k)]
    total = sum(odds[1:], odds[0])
    place = F.array_position("_j", F.col("_top")).cast("int")
    prediction = F.element_at(F.array(*[F.lit(c) for c in model.classes]), place)
    return rows.select(
        *cols,
        *keep,
        F.when(F.col("_known"), prediction).cast("int").alias("prediction"),
        F.when(F.col("_known"), F.array(*[o / total for o in odds])).alias("probabilities"),
    )


def validation_metrics(scored: DataFrame, label: str, classes: Sequence[int] = CLASSES) -> DataFrame:
    """One row: ``n, accuracy, precision, recall, f1`` (weighted by support) and ``loss``, the mean log loss."""
    rows = scored.where(F.col("prediction").isNotNull() & F.col(label).isin(*classes))
    place = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label)).cast("int")
    chance = F.element_at("probabilities", place)
    loss = rows.agg(F.avg(-F.log(F.greatest(chance, F.lit(1e-300))))).scalar()
    row = classification_metrics(rows.select(F.col(label).cast("int").alias("label"), "prediction"))
    return row.select("n", "accuracy", F.col("precision_weighted").alias("precision"), F.col("recall_weighted").alias("recall"), "f1", loss.alias("loss"))
