"""Subword counts of texts with a given tokenizer file, which is never trained here.

A tokenizer whose pieces don't cross white space gives a text the pieces of its words.  So every distinct word is encoded
once, in the tasks that hold the distinct words, and texts add up the counts of theirs.  Words that make up more than a
thousandth of all occurrences, at most a thousand, are looked up in a broadcast table; only the others are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgauge.functions import text as X
from textgauge.functions.digests import names
from textgauge.session import scratch_path

HOT_SHARE = 1000


def _encoded(model: str):
    """Pieces of every word, with a SentencePiece model or a tokenizer file."""

    def load():
        if model.endswith(".model"):
            import sentencepiece

            processor = sentencepiece.SentencePieceProcessor(model_file=model)
            return lambda words: [len(ids) for ids in processor.encode(words, num_threads=1)]
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(model)
        return lambda words: [len(e.ids) for e in tokenizer.encode_batch(words, add_special_tokens=False)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = None
        for batch in batches:
            count = count or load()
            words = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(count(words), pa.int64()), batch.column(1)], names=["word", "pieces", "n"])

    return run


def word_pieces(df: DataFrame, text: str, model: str) -> DataFrame:
    """``word, pieces, n``: every distinct word of the lightly cleaned texts, its subwords and its occurrences."""
    words = df.select(F.explode(F.split(X.clean_light(text), " ")).alias("word")).where("word <> ''")
    counts = words.groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counts.mapInArrow(_encoded(model), "word string, pieces bigint, n bigint")


def subword_counts(df: DataFrame, text: str, key, model: str) -> DataFrame:
    """Key and ``n_subwords`` of every text, not cut at any length; a null or blank text has none.

    ``model`` is a path that every task can read.  Keys must be unique.
    """
    cols, spark = names(key), df.sparkSession
    path = scratch_path(spark, "word-pieces")
    word_pieces(df, text, model).write.parquet(path)
    pieces = spark.read.parquet(path)
    total = pieces.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("t")).scalar()
    hot = pieces.where(F.col("n") * HOT_SHARE > total).select("word", F.col("pieces").alias("_hot"))
    rows = df.select(*cols, F.explode(F.split(X.clean_light(text), " ")).alias("word")).where("word <> ''")
    rows = rows.join(F.broadcast(hot), "word", "left")
    known = rows.where("_hot is not null").select(*cols, F.col("_hot").alias("pieces"))
    rare = rows.where("_hot is null").select(*cols, "word").join(pieces.select("word", "pieces"), "word").select(*cols, "pieces")
    sums = known.unionByName(rare).groupBy(*cols).agg(F.sum("pieces").alias("_n"))
    sums = sums.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(cols)], "_n")
    same = [F.col(c).eqNullSafe(F.col(f"_k{i}")) for i, c in enumerate(cols)]
    return df.select(*cols).join(sums, same, "left").select(*cols, F.coalesce("_n", F.lit(0)).cast("bigint").alias("n_subwords"))


def filter_subwords(df: DataFrame, text: str, key, model: str, limit: int = 500) -> DataFrame:
    """Add the untruncated ``n_subwords`` and keep texts of at most ``limit``."""
    counts = subword_counts(df, text, key, model)
    return df.join(counts, names(key)).where(F.col("n_subwords") <= limit)
