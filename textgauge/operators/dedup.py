"""Exact text deduplication and duplicate counts.

Digests stand for texts in every shuffle, and groups are combined map-side before it, so a text that
makes up a third of the table arrives as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textgauge.functions.digests import key_struct, names, row_digest, text_digest

FIXED_WIDTH = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType, T.TimestampType, T.TimestampNTZType)


def first_keys(df: DataFrame, text: str, key) -> DataFrame:
    """Smallest key of every distinct text (null counts as one text)."""
    cols = names(key)
    digest = text_digest(text).alias("_d")
    if len(cols) == 1:
        firsts = df.select(digest, *cols).groupBy("_d").agg(F.min(cols[0]).alias(cols[0]))
        return firsts.select(*cols)
    firsts = df.select(digest, key_struct(key).alias("_k")).groupBy("_d").agg(F.min("_k").alias("_k"))
    return firsts.select(*[F.col(f"_k.{c}").alias(c) for c in cols])


def drop_duplicate_texts(df: DataFrame, text: str, key, folder: str | None = None) -> DataFrame:
    """Keep, of equal texts, the row with the smallest key.

    With a ``folder`` that tasks share, the keys of the later copies are stored there first and anti-joined.  Their
    size is then known when the join is planned: below Spark's broadcast threshold no text is shuffled.  Without it
    the result is one lazy plan, which shuffles the rows by key.
    """
    cols = names(key)
    if folder is None:
        return df.join(first_keys(df, text, key), cols, "left_semi")
    spark = df.sparkSession
    firsts, surplus = f"{folder.rstrip('/')}/firsts", f"{folder.rstrip('/')}/surplus"
    first_keys(df, text, key).write.parquet(firsts)
    df.select(*cols).join(spark.read.parquet(firsts), cols, "left_anti").write.parquet(surplus)
    return df.join(spark.read.parquet(surplus), cols, "left_anti")


def _surplus(groups: DataFrame) -> DataFrame:
    rows = F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint")
    distinct = F.count(F.lit(1)).cast("bigint")
    return groups.agg(
        rows.alias("n_rows"),
        distinct.alias("n_distinct"),
        (rows - distinct).alias("n_duplicates"),
        F.when(rows > 0, (rows - distinct).cast("double") / rows).alias("duplicate_share"),
    )


def _groups(df: DataFrame, identity: Sequence[Column]) -> DataFrame:
    named = [c.alias(f"_d{i}") for i, c in enumerate(identity)]
    return df.select(*named).groupBy(*[f"_d{i}" for i in range(len(named))]).agg(F.count(F.lit(1)).alias("_n"))


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows that repeat an earlier row in all (or the given) columns.

    Columns of fixed width are grouped as they are, Spark taking the two zeros for one and all NaNs for one; a digest
    stands for all others together.
    """
    columns = list(columns or df.columns)
    wide = [c for c in columns if not isinstance(df.schema[c].dataType, FIXED_WIDTH)]
    identity = [F.col(c) for c in columns if c not in wide]
    return _surplus(_groups(df, [*identity, row_digest(df, wide)] if wide else identity))


def duplicate_texts(df: DataFrame, text: str) -> DataFrame:
    """Rows that repeat an earlier text."""
    return _surplus(_groups(df, [text_digest(text)]))
