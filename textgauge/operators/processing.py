"""Row-wise steps of text preparation that stand on their own."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgauge.config import CorpusConfig
from textgauge.functions import text as X


def process_texts(df: DataFrame, config: CorpusConfig = CorpusConfig()) -> DataFrame:
    """Add ``processed_text``, ``text_length`` and ``word_count``; the text is cleaned once."""
    cleaned = X.clean(config.text, drop_special=config.drop_special, lowercase=config.lowercase)
    done = X.compute_once(df, processed_text=cleaned)
    # Dropping special characters can leave two blanks in a row.
    count = X.word_count if config.drop_special else X.word_count_of_clean
    return done.withColumn("text_length", X.char_count("processed_text")).withColumn(
        "word_count", count("processed_text")
    )


def filter_length(processed: DataFrame, config: CorpusConfig = CorpusConfig()) -> DataFrame:
    """Keep texts whose cleaned length lies within the limits, both included."""
    return processed.where(F.col("text_length").between(config.min_length, config.max_length))


def filter_tokens(df: DataFrame, text: str, limit: int = 500) -> DataFrame:
    """Add the untruncated ``n_tokens`` and keep texts of at most ``limit``."""
    return X.compute_once(df, n_tokens=X.token_count(text)).where(F.col("n_tokens") <= limit)


def drop_missing(df: DataFrame, *columns: str) -> DataFrame:
    """Drop rows with a null in any of the columns."""
    return df.na.drop(subset=list(columns))


def finalize(processed: DataFrame, key: list[str], config: CorpusConfig = CorpusConfig()) -> DataFrame:
    """``key..., text, label[, source]`` with the processed text in place of the raw one."""
    source = [config.source] if config.source in processed.columns else []
    return processed.select(*key, F.col("processed_text").alias(config.text), config.label, *source)
