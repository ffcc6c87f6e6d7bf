"""Vocabulary per class: size, overlap, frequent words.

Words are exploded and combined map-side; the corpus is never joined into one string.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textgauge.config import AI, HUMAN
from textgauge.functions import text as X
from textgauge.functions.runs import run_counts
from textgauge.session import stored


def class_words(df: DataFrame, text: str, label: str, size: int = 1) -> DataFrame:
    """One row per occurrence of ``size`` neighbouring words, joined by blanks: (label, word), lower-cased."""
    words = X.words(F.lower(F.coalesce(F.col(text), F.lit("None"))))
    if size > 1:
        kept = F.filter(words, lambda w: w != "")
        starts = F.sequence(F.lit(1), F.size("_w") - size + 1)
        runs = F.transform(starts, lambda i: F.array_join(F.slice("_w", i, size), " "))
        rows = X.compute_once(df.where(F.col(label).isNotNull()).select(label, text), _w=kept)
        return rows.where(F.size("_w") >= size).select(label, F.explode(runs).alias("word"))
    rows = df.where(F.col(label).isNotNull()).select(label, F.explode(words).alias("word"))
    return rows.where(F.col("word") != "")


def word_counts(df: DataFrame, text: str, label: str, size: int = 1) -> DataFrame:
    """``class_words`` counted: (label, word, n), combined within tasks before rows are made of it."""
    runs = run_counts(df.where(F.col(label).isNotNull()), F.lower(F.coalesce(F.col(text), F.lit("None"))), label, size=size)
    word = F.concat_ws(" ", *[f"w{i}" for i in range(size)]) if size > 1 else F.col("w0")
    return runs.select(label, word.alias("word"), "n").groupBy(label, "word").agg(F.sum("n").alias("n"))


def vocabulary_size(df: DataFrame, text: str, label: str) -> DataFrame:
    """Distinct words per class."""
    distinct = class_words(df, text, label).groupBy(label, "word").agg(F.count(F.lit(1)).alias("_n"))
    return distinct.groupBy(label).agg(
        F.count(F.lit(1)).alias("n_words"), F.sum("_n").alias("n_occurrences")
    )


def vocabulary_overlap(df: DataFrame, text: str, label: str, human: int = HUMAN, ai: int = AI) -> DataFrame:
    """Shared and exclusive words of two classes, from one grouping by word."""
    seen = class_words(df, text, label).groupBy("word").agg(
        F.bool_or(F.col(label) == human).alias("_h"), F.bool_or(F.col(label) == ai).alias("_a")
    )
    both = F.count_if(F.col("_h") & F.col("_a"))
    union = F.count_if(F.col("_h") | F.col("_a"))
    return seen.agg(
        F.count_if("_h").alias("human_words"),
        F.count_if("_a").alias("ai_words"),
        both.alias("shared"),
        F.count_if(F.col("_h") & ~F.col("_a")).alias("human_only"),
        F.count_if(F.col("_a") & ~F.col("_h")).alias("ai_only"),
        F.when(union > 0, both * 100.0 / union).alias("overlap_percent"),
    )


def top_words(
    df: DataFrame, text: str, label: str, k: int = 100, stop_words: Sequence[str] = (), parts: int = 64, size: int = 1
) -> DataFrame:
    """The ``k`` most frequent words, or runs of ``size`` words, per class; ties by word.

    Words are ranked within ``parts`` hash parts of a class first, so no task sorts a class's whole vocabulary; at
    most ``k`` words of each part meet in the last ranking, whatever ``k`` is.
    """
    counts = word_counts(df, text, label, size)
    if stop_words:
        counts = counts.where(~F.col("word").isin(*stop_words))
    counts = counts.withColumn("_part", F.pmod(F.xxhash64("word"), F.lit(parts)))
    inside = Window.partitionBy(label, "_part").orderBy(F.desc("n"), "word")
    counts = counts.withColumn("_in", F.row_number().over(inside)).where(F.col("_in") <= k)
    order = Window.partitionBy(label).orderBy(F.desc("n"), "word")
    ranked = counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(label, "rank", "word", "n")


def phrases(df: DataFrame, text: str, label: str, least: float = 30.0) -> DataFrame:
    """Per class: pairs of neighbouring words that come together more often than chance, and what is left of their words.

    ``word, n, score``: a pair whose log-likelihood ratio exceeds ``least`` counts as one phrase, and its occurrences are
    taken from the counts of its two words, whose own ``score`` is null; words without remaining occurrences are dropped.
    Frequent words are combined map-side; pairs meet the counts of their words by joins on the word.
    """
    lower = F.lower(F.coalesce(F.col(text), F.lit("None")))
    runs = run_counts(df.where(F.col(label).isNotNull()), lower, label, size=2, ends=True)
    # Texts are read once: a word occurs as often as it begins a pair or ends a text.
    runs = runs.groupBy(label, F.col("w0").alias("_a"), F.col("w1").alias("_b")).agg(F.sum("n").alias("_pair"))
    runs = stored(runs, "pairs")
    words = stored(runs.groupBy(label, F.col("_a").alias("word")).agg(F.sum("_pair").alias("n")), "words")
    total = words.groupBy(label).agg(F.sum("n").alias("_total"))
    pairs = runs.where("_b is not null").withColumn("word", F.concat_ws(" ", "_a", "_b"))
    pairs = pairs.join(words.select(label, F.col("word").alias("_a"), F.col("n").alias("_na")), [label, "_a"])
    pairs = pairs.join(words.select(label, F.col("word").alias("_b"), F.col("n").alias("_nb")), [label, "_b"]).join(total, label)

    def likelihood(k, n, p):
        tiny = F.lit(1e-10)
        return k * F.log(F.greatest(p, tiny)) + (n - k) * F.log(F.greatest(1 - p, tiny))

    k, a, b, n = (F.col(c) for c in ("_pair", "_na", "_nb", "_total"))
    rest = F.when(n > a, (b - k) / (n - a)).otherwise(0.0)
    score = 2 * (likelihood(k, a, k / a) + likelihood(b - k, n - a, rest) - likelihood(k, a, b / n) - likelihood(b - k, n - a, b / n))
    # More often than chance, not less.
    found = pairs.withColumn("score", score).where((F.col("score") > least) & (k / a > b / n))
    found = stored(found.select(label, "word", "_a", "_b", "_pair", "score"), "phrases")
    taken = found.select(label, F.inline(F.array(*[F.struct(F.col(c).alias("word"), k.alias("_k")) for c in ("_a", "_b")])))
    taken = taken.groupBy(label, "word").agg(F.sum("_k").alias("_taken"))
    left = words.join(taken, [label, "word"], "left").withColumn("n", F.col("n") - F.coalesce("_taken", F.lit(0)))
    left = left.where("n > 0").select(label, "word", "n", F.lit(None).cast("double").alias("score"))
    return left.unionByName(found.select(label, "word", F.col("_pair").alias("n"), "score"))
