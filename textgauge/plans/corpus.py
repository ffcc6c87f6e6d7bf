"""The corpus job: raw (key, text, source) rows to a labelled, deduplicated, filtered, balanced corpus.

Deciding which rows stay needs no text in a shuffle.  A first, narrow pass carries key, class, digest and
cleaned length; it finds the kept copy of each text and the balancing thresholds.  The second pass reads
the texts, drops what fails the length limit or lies beyond its class threshold while still map-side, and
then meets the outcome of the first pass by key:

- ``build_corpus`` is one lazy plan and semi-joins the kept keys;
- ``corpus_job`` stores the narrow tables in between and anti-joins the *surplus* keys, the later copies of
  each text.  They are few as a rule, and as a stored table their size is known when the join is planned:
  Spark broadcasts them if they lie below its threshold, and then no text is shuffled at all; beyond it the
  join shuffles as usual.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textgauge.config import CLASSES, CorpusConfig, QualityConfig
from textgauge.functions import labels as L
from textgauge.functions import text as X
from textgauge.functions.digests import key_struct, names, numeric_key, text_digest
from textgauge.operators.prefix import summarize
from textgauge.operators.quality import validation_report
from textgauge.operators.sampling import BALANCE, _common_size, _narrow, sample_rows, thresholds, within
from textgauge.sources.inventory import listing
from textgauge.sources.readers import locate_corpus, read_corpus, require_columns
from textgauge.sources.stage_cache import cached_stage


def label_rows(
    df: DataFrame,
    config: CorpusConfig = CorpusConfig(),
    human: Sequence[str] = L.HUMAN_SOURCES,
    ai: Sequence[str] = L.AI_SOURCES,
) -> DataFrame:
    """Add the class from the source column; an unknown source counts as human."""
    return df.withColumn(config.label, L.from_source(config.source, human, ai))


def unknown_sources(df: DataFrame, source: str, human: Sequence[str], ai: Sequence[str]) -> DataFrame:
    """Sources without any known token, and how many rows they have."""
    code = L.from_source(source, human, ai, unknown=L.UNKNOWN)
    return df.where(code == L.UNKNOWN).groupBy(source).agg(F.count(F.lit(1)).alias("n"))


def _clean(config: CorpusConfig) -> Column:
    return X.clean(config.text, drop_special=config.drop_special, lowercase=config.lowercase)


def _first_copies(df: DataFrame, key, config: CorpusConfig, classes: Sequence[int]) -> DataFrame:
    """Narrow rows, of equal texts the one with the smallest key:
    ``key..., _label, _copies, _has_text, _labelled, _fits``.

    ``_fits`` tells whether the row has a text and a label and keeps the length limits; the label is that of
    the kept row, null if it is outside ``classes``.
    """
    cols = names(key)
    length = F.when(F.col(config.text).isNotNull(), X.char_count(_clean(config)))
    in_limits = F.coalesce(F.col("_length").between(config.min_length, config.max_length), F.lit(False))
    if not config.drop_duplicates:
        rows = df.select(*cols, F.col(config.label).alias("_label"), length.alias("_length"))
        labelled = F.col("_label").isNotNull()
        return rows.select(*cols, *_flags(F.col("_label"), F.lit(1).cast("bigint"), labelled, in_limits))
    narrow = df.select(
        text_digest(config.text).alias("_digest"), *cols, F.col(config.label).alias("_label"), length.alias("_length")
    )
    number, copies_of = numeric_key(df, key), F.count(F.lit(1)).alias("_copies")
    if number is None:
        first = F.min(F.struct(key_struct(cols).alias("k"), F.col("_label").alias("label"))).alias("_f")
        copies = narrow.groupBy("_digest").agg(copies_of, first, F.max("_length").alias("_length"))
        label, labelled = F.col("_f.label"), F.col("_f.label").isNotNull()
        kept = [F.col(f"_f.k.{c}").alias(c) for c in cols]
    else:
        # Fixed-width minima per class keep this a hash aggregate: the class whose smallest key is the
        # smallest of all is the class of the kept copy.
        k = F.col(number)
        minima = [F.min(F.when(F.col("_label") == c, k)).alias(f"_k{i}") for i, c in enumerate(classes)]
        copies = narrow.groupBy("_digest").agg(
            copies_of,
            F.min(k).alias(number),
            F.min(F.when(F.col("_label").isNotNull(), k)).alias("_known"),
            F.max("_length").alias("_length"),
            *minima,
        )
        label, labelled = F.lit(None).cast(df.schema[config.label].dataType), F.col("_known") == k
        for i, c in enumerate(classes):
            label = F.when(F.col(f"_k{i}") == k, F.lit(c)).otherwise(label)
        kept = [k]
    return copies.select(*kept, *_flags(label, F.col("_copies"), F.coalesce(labelled, F.lit(False)), in_limits))


def _flags(label: Column, copies: Column, labelled: Column, in_limits: Column) -> list[Column]:
    return [
        label.alias("_label"),
        copies.alias("_copies"),
        F.col("_length").isNotNull().alias("_has_text"),
        (F.col("_length").isNotNull() & labelled).alias("_labelled"),
        (in_limits & labelled).alias("_fits"),
    ]


def _class_limits(firsts: DataFrame, cols: list[str], config: CorpusConfig, classes: Sequence[int]) -> Column:
    """Balancing thresholds from the first copies that fit."""
    narrow = _narrow(firsts.where("_fits"), cols, config.seed, "_label", classes, BALANCE)
    common = _common_size(narrow, None)
    return thresholds(narrow, [lambda size: F.coalesce(common, size)])


def _candidates(df: DataFrame, cols: list[str], config: CorpusConfig, classes: Sequence[int], limits: Column | None) -> DataFrame:
    """Finished rows that pass everything a row can be judged by on its own, the cheap tests first."""
    out = [*cols, config.text, config.label] + ([config.source] if config.source in df.columns else [])
    texts = df.where(F.col(config.text).isNotNull() & F.col(config.label).isNotNull())
    if not config.lowercase:  # else cleaning may lengthen a text: one letter can become two
        texts = texts.where(F.length(config.text) >= config.min_length)
    if limits is not None:
        texts = texts.where(
            F.col(config.label).isin(*classes) & within(limits, F.col(config.label), 0, cols, config.seed, BALANCE)
        )
    texts = X.compute_once(texts.select(*out), _clean=_clean(config))
    texts = texts.where(F.length("_clean").between(config.min_length, config.max_length))
    return texts.select(*[F.col("_clean").alias(c) if c == config.text else F.col(c) for c in out])


def build_corpus(
    df: DataFrame, key, config: CorpusConfig = CorpusConfig(), classes: Sequence[int] = CLASSES
) -> DataFrame:
    """``key..., text, label[, source]`` of the finished corpus; ``df`` already has its label column.

    Rows of other than the listed classes stay only if balancing is off.
    """
    cols = names(key)
    firsts = _first_copies(df, key, config, classes)
    limits = _class_limits(firsts, cols, config, classes) if config.balance else None
    texts = _candidates(df, cols, config, classes, limits)
    if not config.drop_duplicates:
        return texts
    kept = firsts.where("_fits")
    if not config.balance:
        return texts.join(kept.select(*cols), cols, "left_semi").select(*texts.columns)
    # Joining on the class too keeps it in the plan: the grouping behind ``firsts`` is then the very one the
    # thresholds use, and its shuffle is made once.
    same = kept.select(*cols, F.col("_label").alias(config.label))
    return texts.join(same, [*cols, config.label], "left_semi").select(*texts.columns)


def build_corpus_in_stages(
    df: DataFrame,
    key,
    config: CorpusConfig,
    store: Callable[[str, Callable[[], DataFrame]], DataFrame],
    classes: Sequence[int] = CLASSES,
) -> DataFrame:
    """The same rows as ``build_corpus``; ``store(name, build)`` writes a table once and reads it back."""
    cols = names(key)
    firsts = store("firsts", lambda: _first_copies(df, key, config, classes).select(*cols, "_label", "_fits"))
    limits = _class_limits(firsts, cols, config, classes) if config.balance else None
    texts = _candidates(df, cols, config, classes, limits)
    if not config.drop_duplicates:
        return texts
    surplus = store("surplus", lambda: df.select(*cols).join(firsts.select(*cols), cols, "left_anti"))
    return texts.join(surplus, cols, "left_anti").select(*texts.columns)


def corpus_funnel(
    df: DataFrame, key, config: CorpusConfig = CorpusConfig(), classes: Sequence[int] = CLASSES
) -> DataFrame:
    """Rows left after each step, from the narrow grouping of ``build_corpus``: (position, step, n)."""
    per_class = (
        _first_copies(df, key, config, classes)
        .groupBy(F.when(F.col("_fits"), F.col("_label")).alias("label"))
        .agg(
            F.sum("_copies").alias("rows"),
            F.count(F.lit(1)).alias("texts"),
            F.count_if("_has_text").alias("with_text"),
            F.count_if("_labelled").alias("with_label"),
            F.count_if("_fits").alias("fitting"),
        )
    )
    inside = F.col("label").isNotNull()
    n_inside = F.coalesce(F.sum("fitting"), F.lit(0))
    balanced = F.coalesce(F.min(F.when(inside, F.col("texts"))) * F.count_if(inside), F.lit(0))
    steps = {
        "input": F.coalesce(F.sum("rows"), F.lit(0)),
        "deduplicated": F.coalesce(F.sum("texts"), F.lit(0)),
        "with_text": F.coalesce(F.sum("with_text"), F.lit(0)),
        "with_label": F.coalesce(F.sum("with_label"), F.lit(0)),
        "length_filtered": n_inside,
        "balanced": balanced if config.balance else n_inside,
    }
    rows = F.array(
        *[F.struct(F.lit(i).alias("position"), F.lit(s).alias("step"), n.cast("bigint").alias("n"))
          for i, (s, n) in enumerate(steps.items())]
    )
    return per_class.agg(rows.alias("_r")).select(F.inline("_r"))


def corpus_metadata(corpus: DataFrame, config: CorpusConfig = CorpusConfig()) -> DataFrame:
    """(section, item, value): shape, class counts, text lengths and the parameters of a corpus."""

    def row(section: str, item: Column, value: Column) -> Column:
        return F.struct(F.lit(section).alias("section"), item.alias("item"), value.cast("double").alias("value"))

    length = X.char_count(config.text)
    # One grouping by class gives the class counts and, summed up, the whole.
    classes = corpus.groupBy(F.col(config.label).alias("label")).agg(
        F.count(F.lit(1)).alias("n"),
        F.count(config.text).alias("texts"),
        F.min(length).alias("low"),
        F.max(length).alias("high"),
        F.sum(length).alias("total"),
    )
    fixed = [
        row("shape", F.lit("rows"), F.coalesce(F.sum("n"), F.lit(0))),
        row("shape", F.lit("columns"), F.lit(len(corpus.columns))),
        row("length", F.lit("min"), F.min("low")),
        row("length", F.lit("max"), F.max("high")),
        row("length", F.lit("mean"), F.sum("total").cast("double") / F.nullif(F.sum("texts"), F.lit(0))),
    ]
    numbers = {k: v for k, v in config.params().items() if isinstance(v, (bool, int))}
    fixed += [row("parameter", F.lit(k), F.lit(int(v))) for k, v in numbers.items()]
    whole = classes.agg(F.array(*fixed).alias("_r")).select(F.inline("_r"))
    each = row("class", F.col("label").cast("string"), F.col("n"))
    # One test over every aggregate: nothing is pruned or pushed below the grouping, so both branches share it.
    every = sum((F.coalesce(c, F.lit(0)) for c in ("texts", "low", "high", "total")), F.lit(0))
    used = F.when(F.col("label").isNull(), -1).otherwise(every) >= 0
    return whole.unionByName(classes.where(used).select(F.inline(F.array(each))))


def length_stats(corpus: DataFrame, config: CorpusConfig = CorpusConfig()) -> DataFrame:
    return summarize(corpus.select(X.char_count(config.text).alias("length")), "length")


def require_passed(report: DataFrame) -> None:
    """Raise if a validation report holds a failed check (it has six rows)."""
    failed = sorted(r["check"] for r in report.where(~F.col("passed")).select("check").collect() if r["check"] != "summary")
    if failed:
        raise ValueError(f"corpus fails: {', '.join(failed)}")


def corpus_job(
    spark: SparkSession,
    source: str,
    base: str,
    key,
    config: CorpusConfig = CorpusConfig(),
    quality: QualityConfig = QualityConfig(),
    filename: str | None = None,
    sample: int | None = None,
    human: Sequence[str] = L.HUMAN_SOURCES,
    ai: Sequence[str] = L.AI_SOURCES,
) -> DataFrame:
    """Read, label, build and check a corpus under ``base``; the finished table, or an error if it fails the gate.

    Each stage is stored under the fingerprint of everything that shapes it, the input's files included,
    and read instead of built while that stays the same.
    """
    files = listing(spark, locate_corpus(spark, source, filename))
    params = {"source": source, "file": filename, **files, "key": names(key), "sample": sample}
    params.update(human=list(human), ai=list(ai), **config.params())

    def store(name: str, build: Callable[[], DataFrame]) -> DataFrame:
        return cached_stage(spark, base, name, params, build)

    raw = require_columns(read_corpus(spark, source, filename), *names(key), config.text, config.source)
    raw = raw.select(*names(key), config.text, config.source)
    raw = label_rows(sample_rows(raw, sample, key, config.seed) if sample else raw, config, human, ai)
    corpus = store("corpus", lambda: build_corpus_in_stages(raw, key, config, store))
    limits = {**params, "quality": str(quality)}
    require_passed(cached_stage(spark, base, "report", limits, lambda: validation_report(corpus, quality)))
    return corpus
