"""Corpus profiles: nulls, counts, shares, lengths, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textgauge.functions import text as X
from textgauge.functions.digests import names
from textgauge.operators.dedup import duplicate_rows
from textgauge.operators.prefix import frequencies, quantile_columns, running_totals, summarize

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls per column, in one pass."""
    total = F.count(F.lit(1))
    per_column = F.array(
        *[F.struct(F.lit(c).alias("column"), F.count_if(F.col(c).isNull()).alias("n_null")) for c in df.columns]
    )
    rows = df.agg(total.alias("_n"), per_column.alias("_c")).select("_n", F.inline("_c"))
    return rows.select(
        "column", "n_null", F.when(F.col("_n") > 0, F.col("n_null").cast("double") / F.col("_n")).alias("null_share")
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per value; nulls are left out."""
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def class_share(df: DataFrame, column: str) -> DataFrame:
    """Rows per value and their percentage of all rows, nulls in the total."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").cast("double")).scalar()
    return counts.where(F.col(column).isNotNull()).select(column, "n", (F.col("n") * 100.0 / total).alias("percent"))


def balance_ratio(df: DataFrame, label: str, min_balance: float = 0.5) -> DataFrame:
    """Smallest class over largest; 1.0 with fewer than two classes."""
    counts = value_counts(df, label)
    classes = F.count(F.lit(1))
    ratio = F.when(classes < 2, F.lit(1.0)).otherwise(F.min("n").cast("double") / F.max("n"))
    return counts.agg(
        classes.alias("classes"),
        F.min("n").alias("smallest"),
        F.max("n").alias("largest"),
        ratio.alias("ratio"),
        (ratio >= min_balance).alias("is_balanced"),
    )


def text_length_stats(df: DataFrame, text: str, by: Sequence[str] = (), approximate: bool = False) -> DataFrame:
    """Character length: count, min, max, mean, median, sample standard deviation.

    ``approximate`` takes the median from a sketch: a single aggregate, without interpolation.
    """
    lengths = X.compute_once(df.select(*by, text), length=X.char_count(text))
    if not approximate:
        return summarize(lengths, "length", {"median": 0.5}, by)
    for b in by:
        lengths = lengths.where(F.col(b).isNotNull())
    length = F.col("length")
    return lengths.groupBy(*by).agg(
        F.count(length).alias("n"),
        F.min(length).alias("min"),
        F.max(length).alias("max"),
        F.avg(length).alias("mean"),
        F.stddev(length).alias("std"),
        F.percentile_approx(length, 0.5, 10000).cast("double").alias("median"),
    )


def _measures(df: DataFrame, text: str, label: str) -> DataFrame:
    """Two narrow rows per text: its characters and its words."""
    both = F.array(
        F.struct(F.lit("chars").alias("measure"), X.char_count(text).alias("value")),
        F.struct(F.lit("words").alias("measure"), X.word_count(text).alias("value")),
    )
    return df.where(F.col(label).isNotNull()).select(label, F.inline(both))


def length_by_class(df: DataFrame, text: str, label: str) -> DataFrame:
    """Mean, median and standard deviation of characters and words per class."""
    stats = summarize(_measures(df, text, label), "value", {"median": 0.5}, [label, "measure"])
    return stats.select(label, "measure", "n", "mean", "median", "std")


def linguistic_by_class(df: DataFrame, text: str, label: str) -> DataFrame:
    """Means of sentence and punctuation counts per class."""
    rows = df.where(F.col(label).isNotNull()).select(label, text)
    rows = X.compute_once(rows, _sentences=X.sentence_count(text), _words=X.word_count(text))
    per = F.when(F.col("_sentences") > 0, F.col("_words").cast("double") / F.col("_sentences")).otherwise(0.0)
    return rows.groupBy(label).agg(
        F.avg("_sentences").alias("sentences"),
        F.avg(per).alias("words_per_sentence"),
        F.avg(X.count_of(text, ",")).alias("commas"),
        F.avg(X.count_of(text, ".")).alias("periods"),
    )


def length_histogram(df: DataFrame, value: str, label: str, bins: int = 50) -> DataFrame:
    """Equal bins over the joint range, counted per class; the last bin is closed above."""
    freq = frequencies(df, value, [label])
    # The row count rides along so that this grouping is the same as the one below and runs once.
    low, high, rows = F.min(value).cast("double"), F.max(value).cast("double"), F.sum("n")
    bounds = freq.agg(F.struct(low.alias("low"), high.alias("high"), rows.alias("rows")).alias("_b")).scalar()
    placed = freq.withColumn("_b", bounds)
    low, width = F.col("_b.low"), (F.col("_b.high") - F.col("_b.low")) / F.lit(float(bins))
    slot = F.when(width > 0, F.least(F.floor((F.col(value) - low) / width), F.lit(bins - 1))).otherwise(F.lit(0))
    counted = placed.select(label, slot.cast("int").alias("bin"), "n", low.alias("_l"), width.alias("_w"))
    out = counted.groupBy(label, "bin").agg(F.sum("n").alias("n"), F.max("_l").alias("_l"), F.max("_w").alias("_w"))
    return out.select(
        label,
        "bin",
        (F.col("_l") + F.col("bin") * F.col("_w")).alias("lower"),
        (F.col("_l") + (F.col("bin") + 1) * F.col("_w")).alias("upper"),
        "n",
    )


def box_summary(df: DataFrame, value: str, label: str, classes: Sequence | None = None) -> DataFrame:
    """Quartiles, whiskers at 1.5 interquartile ranges and rows outside them, per class; of the listed ones if given."""
    rows = df if classes is None else df.where(F.col(label).isin(*classes))
    freq = frequencies(rows, value, [label])
    quartiles = running_totals(freq, value, ["n"], [label]).groupBy(label).agg(*quantile_columns(value, QUARTILES))
    boxed = freq.join(quartiles.select(label, F.struct("q1", "median", "q3").alias("_q")), label)
    spread = (F.col("_q.q3") - F.col("_q.q1")) * 1.5
    inside = F.col(value).between(F.col("_q.q1") - spread, F.col("_q.q3") + spread)
    return boxed.groupBy(label).agg(
        F.max("_q.q1").alias("q1"),
        F.max("_q.median").alias("median"),
        F.max("_q.q3").alias("q3"),
        F.min(F.when(inside, F.col(value))).cast("double").alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).cast("double").alias("whisker_high"),
        F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("n_outliers"),
    )


# Bytes of fixed-width types, for the size estimate of a profile.
WIDTHS = {
    T.BooleanType: 1, T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.FloatType: 4, T.DateType: 4,
    T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8, T.TimestampNTZType: 8,
}


def _bytes(field: T.StructField) -> Column:
    column = F.col(field.name)
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.sum(F.octet_length(column)), F.lit(0))
    width = WIDTHS.get(type(field.dataType))
    if width is not None:
        return F.count(F.lit(1)) * width
    return F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(column)))), F.lit(0))


def dataset_profile(df: DataFrame, text: str | None = None, label: str | None = None) -> DataFrame:
    """Shape, types, nulls, bytes, duplicate rows, text lengths and label counts as a long table."""

    def row(section: str, item: str, value: Column, detail: Column | None = None) -> Column:
        return F.struct(
            F.lit(section).alias("section"),
            F.lit(item).alias("item"),
            value.cast("double").alias("value"),
            (F.lit(None) if detail is None else detail).cast("string").alias("detail"),
        )

    n = F.count(F.lit(1))
    rows = [row("shape", "rows", n), row("shape", "columns", F.lit(len(df.columns)))]
    rows += [row("dtype", f.name, F.lit(None), F.lit(f.dataType.simpleString())) for f in df.schema.fields]
    rows += [row("nulls", c, F.count_if(F.col(c).isNull())) for c in df.columns]
    rows += [row("bytes", f.name, _bytes(f)) for f in df.schema.fields]
    if text:
        length = X.char_count(text)
        rows += [
            row("text_length", "mean", F.avg(length)),
            row("text_length", "min", F.min(length)),
            row("text_length", "max", F.max(length)),
        ]
    out = df.agg(F.array(*rows).alias("_r")).select(F.inline("_r"))
    repeats = duplicate_rows(df).select(
        F.inline(F.array(row("duplicates", "rows", F.col("n_duplicates"))))
    )
    out = out.unionByName(repeats)
    if label:
        counts = value_counts(df, label).select(
            F.lit("labels").alias("section"),
            F.col(label).cast("string").alias("item"),
            F.col("n").cast("double").alias("value"),
            F.lit(None).cast("string").alias("detail"),
        )
        out = out.unionByName(counts)
    return out


def short_texts(df: DataFrame, text: str, report_below: int = 10, drop_below: int = 50) -> DataFrame:
    """How many raw texts are very short, and how many a length filter would keep."""
    length = F.length(F.col(text))
    return df.agg(
        F.count_if(length < report_below).alias("n_very_short"),
        F.count_if(length < drop_below).alias("n_dropped"),
        F.count_if(length >= drop_below).alias("n_kept"),
    )


def preview(df: DataFrame, text: str, key, rows: int = 3, size: int = 100) -> DataFrame:
    """First rows by key, long texts cut with an ellipsis (a distributed top-k, not a full sort)."""
    return df.orderBy(*names(key)).limit(rows).withColumn(text, X.excerpt(text, size))
