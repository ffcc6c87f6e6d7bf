"""Sentence borders learnt from the corpus itself, without labels.

After the published method of Kiss and Strunk: a word that is nearly always followed by a period, judged by a
log-likelihood ratio and weighed by its length and inner periods, is an abbreviation; a word that follows sentence ends far
more often than chance is a sentence starter; two words around a period that come together far more often than chance are
a collocation.  All three are aggregates over word counts, and splitting is a look-up in their result.

A word is a run without white space, without closing quotes and brackets at its end, and lower-cased for counting.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textgauge.functions import text as X
from textgauge.functions.digests import names
from textgauge.functions.runs import run_counts
from textgauge.session import stored

# The limits of the method.
ABBREVIATION = 0.3
STARTER = 30.0
COLLOCATION = 7.88
CLOSING = "\"'”’»)]}"
_TINY = 1e-10


@dataclass(frozen=True)
class Borders:
    """``abbreviations`` (word, score), ``starters`` (word, score), ``collocations`` (word, following, score).

    The pairs of words behind the last two are counted and stored when one of these is first asked for.
    """

    texts: DataFrame
    text: str
    abbreviations: DataFrame

    @cached_property
    def _pairs(self) -> tuple[DataFrame, DataFrame]:
        return _judged(stored(pair_counts(self.texts, self.text), "word-pairs"), self.abbreviations)

    @property
    def starters(self) -> DataFrame:
        return self._pairs[0]

    @property
    def collocations(self) -> DataFrame:
        return self._pairs[1]


def _read(raw: Column, after: Column) -> dict[str, Column]:
    """``word, mark, following`` and ``upper`` of a word and the one behind it, see ``word_pairs``."""

    def bare(c: Column) -> Column:
        return F.when(F.substring(c, -1, 1).isin(*CLOSING), F.rtrim(c, F.lit(CLOSING))).otherwise(c)

    def plain(c: Column) -> Column:
        return F.lower(F.when(F.endswith(c, F.lit(".")), F.substring(c, F.lit(1), F.length(c) - 1)).otherwise(c))

    end = F.substring(bare(raw), -1, 1)
    first = F.substring(F.ltrim(bare(after), F.lit("\"'“‘«([{")), 1, 1)
    upper = F.when(after.isNotNull(), F.upper(first) == first) & (F.lower(first) != first)
    return {
        "mark": F.when(end == ".", ".").when(end.isin("!", "?"), "!").otherwise(""),
        "word": plain(bare(raw)),
        "following": plain(bare(after)),
        "upper": F.coalesce(upper, F.lit(False)),
    }


def word_pairs(df: DataFrame, text: str, *keep: str) -> DataFrame:
    """One row per word: ``place, word`` (lower-cased, without a final period), ``mark`` (``.``, ``!``, or empty), ``following``
    (the next word, lower-cased, without a final period; null at the end) and ``upper`` (whether that begins with a capital)."""
    words = F.filter(F.split(X.clean_light(text), " "), lambda w: w != "")
    rows = X.compute_once(df.select(*keep, text), _w=words).select(*keep, "_w", F.posexplode("_w").alias("place", "_raw"))
    found = _read(F.col("_raw"), F.get("_w", F.col("place") + 1))
    return rows.select(*keep, "place", *[c.alias(n) for n, c in found.items()])


def word_marks(df: DataFrame, text: str) -> DataFrame:
    """``word, mark`` of ``word_pairs`` counted: with ``n``."""
    found = _read(F.col("w0"), F.lit(None).cast("string"))
    return run_counts(df, F.col(text)).groupBy(*[found[c].alias(c) for c in ("word", "mark")]).agg(F.sum("n").alias("n"))


def pair_counts(df: DataFrame, text: str) -> DataFrame:
    """``word_pairs`` counted: ``word, mark, following, n``, of words that aren't empty."""
    runs = run_counts(df, F.col(text), size=2, ends=True)
    found = _read(F.col("w0"), F.col("w1"))
    rows = runs.select(*[found[c].alias(c) for c in ("word", "mark", "following")], "n").where("word <> ''")
    return rows.groupBy("word", "mark", "following").agg(F.sum("n").alias("n"))


def _dunning(pair: Column, first: Column, second: Column, total: Column) -> Column:
    """Log-likelihood ratio of ``second`` coming after ``first`` against coming after anything."""

    def likelihood(k: Column, n: Column, p: Column) -> Column:
        return k * F.log(F.greatest(p, F.lit(_TINY))) + (n - k) * F.log(F.greatest(1 - p, F.lit(_TINY)))

    p = second / total
    inside = pair / first
    outside = F.when(total > first, (second - pair) / (total - first)).otherwise(0.0)
    rest, others = second - pair, total - first
    return 2 * (likelihood(pair, first, inside) + likelihood(rest, others, outside) - likelihood(pair, first, p) - likelihood(rest, others, p))


def abbreviations(pairs: DataFrame) -> DataFrame:
    """``word, with_period, without, score`` of all words that are abbreviations; ``pairs`` as rows or with their number ``n``."""
    n = F.col("n") if "n" in pairs.columns else F.lit(1)
    period = F.sum(F.when(F.col("mark") == ".", n).otherwise(0))
    counts = pairs.where(F.col("word") != "").groupBy("word").agg(period.alias("with_period"), (F.sum(n) - period).alias("without"))
    total = counts.agg(F.struct(F.sum("with_period").alias("p"), F.sum(F.col("with_period") + F.col("without")).alias("n")).alias("_t")).scalar()
    counts = counts.where((F.col("with_period") > 0) & F.col("word").rlike(r"\p{L}")).withColumn("_t", total)
    share = F.col("_t.p") / F.col("_t.n")
    chance = F.col("with_period") * F.log(F.greatest(share, F.lit(_TINY))) + F.col("without") * F.log(F.greatest(1 - share, F.lit(_TINY)))
    almost = F.col("with_period") * F.log(F.lit(0.99)) + F.col("without") * F.log(F.lit(0.01))
    inner = F.length("word") - F.length(F.replace("word", F.lit("."), F.lit("")))
    letters = F.length("word") - inner
    # Length counts against a word, and so does every occurrence without the period.
    score = 2 * (almost - chance) * F.exp(-letters) * (inner + 1) * F.pow(letters.cast("double"), -F.col("without"))
    return counts.withColumn("score", score).where(F.col("score") >= ABBREVIATION).select("word", "with_period", "without", "score")


def fit_borders(df: DataFrame, text: str) -> Borders:
    """Abbreviations, sentence starters and collocations of a corpus."""
    return Borders(df, text, stored(abbreviations(stored(word_marks(df, text), "word-marks")), "abbreviations"))


def _judged(pairs: DataFrame, short: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Starters and collocations, from counted pairs and the abbreviations."""
    known = short.select("word", F.lit(True).alias("_short"))
    counted = pairs.join(known, "word", "left").withColumn("_short", F.coalesce("_short", F.lit(False)))
    ends = (F.col("mark") == "!") | ((F.col("mark") == ".") & ~F.col("_short"))
    # Words by how often they occur at all and after a sentence end.
    totals = counted.groupBy("word").agg(F.sum("n").alias("n_all"))
    after = counted.where("following is not null").groupBy(F.col("following").alias("word")).agg(F.coalesce(F.sum(F.when(ends, F.col("n"))), F.lit(0)).alias("n_start"))
    overall = counted.agg(F.struct(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(ends, F.col("n"))), F.lit(0)).alias("e")).alias("_t")).scalar()
    starts = totals.join(after, "word").where("n_start > 0").withColumn("_t", overall)
    score = _dunning(F.col("n_start"), F.col("_t.e"), F.col("n_all"), F.col("_t.n"))
    often = F.col("n_start") / F.col("_t.e") > F.col("n_all") / F.col("_t.n")
    starters = starts.where(F.col("word").rlike(r"\A\p{L}+\z")).withColumn("score", score).where(often & (F.col("score") >= STARTER)).select("word", "n_start", "score")
    # Pairs around a period whose first word is an abbreviation or a number.
    around = counted.where((F.col("mark") == ".") & F.col("following").isNotNull() & (F.col("_short") | F.col("word").rlike(r"\A[0-9]+\z")))
    around = around.groupBy("word", "following").agg(F.sum("n").alias("n_pair"))
    first = counted.where("mark = '.'").groupBy("word").agg(F.sum("n").alias("n_first"))
    second = totals.select(F.col("word").alias("following"), F.col("n_all").alias("n_second"))
    around = around.join(first, "word").join(second, "following").withColumn("_t", overall)
    score = _dunning(F.col("n_pair"), F.col("n_first"), F.col("n_second"), F.col("_t.n"))
    often = F.col("n_pair") / F.col("n_first") > F.col("n_second") / F.col("_t.n")
    collocations = around.where("n_pair > 1").withColumn("score", score).where(often & (F.col("score") >= COLLOCATION))
    return starters, collocations.select("word", "following", "n_pair", "score")


def _ended(df: DataFrame, text: str, cols: list[str]) -> DataFrame:
    """``cols``, ``_n`` (sentences of a text that its end, ``!`` and ``?`` close, in one of its rows), ``_raw`` and ``_after``: each
    word that ends with a period, and the one behind it.  A text without such words has one row without them; one without words none.
    """
    schema = T.StructType([*(df.schema[c] for c in cols), T.StructField("_n", T.LongType()), *(T.StructField(c, T.StringType()) for c in ("_raw", "_after"))])
    closing, marks = CLOSING, frozenset(CLOSING + ".!?")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                rows, closed, raw, after = [], [], [], []
                for i, text in enumerate(batch.column(len(cols))):
                    words = (text.as_py() or "").split()
                    if not words:
                        continue
                    ends = [(j, words[j].rstrip(closing)[-1:]) for j, w in enumerate(words[:-1]) if w[-1] in marks]
                    dots = [j for j, mark in ends if mark == "."] or [None]
                    rows += [i] * len(dots)
                    closed += [1 + sum(mark == "!" or mark == "?" for _, mark in ends), *[0] * (len(dots) - 1)]
                    raw += [None if j is None else words[j] for j in dots]
                    after += [None if j is None else words[j + 1] for j in dots]
                own = [batch.column(k).take(pa.array(rows, pa.int64())) for k in range(len(cols))]
                yield pa.RecordBatch.from_arrays([*own, pa.array(closed, pa.int64()), pa.array(raw, pa.string()), pa.array(after, pa.string())], names=schema.names)

    return df.select(*cols, text).mapInArrow(run, schema)


def trained_sentence_counts(df: DataFrame, text: str, key, borders: Borders) -> DataFrame:
    """Key and ``n_sentences`` of every row; texts are not shuffled, at most their words that end with a period.

    ``!`` and ``?`` end a sentence.  A period does, unless its word is an abbreviation; then only a capitalised sentence
    starter behind it begins a new one.  A collocation across the period is never cut.  The end of a text ends its last
    sentence; a null or blank text has none.
    """
    cols = names(key)
    found = _read(F.col("_raw"), F.col("_after"))
    dots = _ended(df, text, cols).select(*cols, "_n", *[found[c].alias(f"_{c}") for c in ("word", "following", "upper")])
    lists = (
        borders.abbreviations.select(F.col("word").alias("_word"), F.lit(True).alias("_short")),
        borders.starters.select(F.col("word").alias("_following"), F.lit(True).alias("_starter")),
        borders.collocations.select(F.col("word").alias("_word"), F.col("following").alias("_following"), F.lit(True).alias("_bound")),
    )
    # Lists are stored, hence of known size: small ones are sent to the words, which then aren't shuffled.
    for known, on in zip(lists, (["_word"], ["_following"], ["_word", "_following"]), strict=True):
        dots = dots.join(stored(known, "sentence-list"), on, "left")
    cut = F.col("_bound").isNull() & (F.col("_short").isNull() | (F.col("_upper") & F.col("_starter").isNotNull()))
    counts = dots.groupBy(*cols).agg((F.sum("_n") + F.count_if(F.col("_word").isNotNull() & cut)).alias("n_sentences"))
    counts = counts.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(cols)], "n_sentences")
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(cols)]
    return df.select(*cols).join(counts, same, "left").select(*cols, F.coalesce("n_sentences", F.lit(0)).cast("bigint").alias("n_sentences"))
