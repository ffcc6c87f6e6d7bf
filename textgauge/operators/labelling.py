"""Label operators that need to look at the whole column."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textgauge.config import LABEL_CODES
from textgauge.functions.digests import key_struct
from textgauge.functions.labels import from_text_label


def normalize_labels(df: DataFrame, label: str, key) -> DataFrame:
    """Integer labels: numeric columns and numeric texts are cast, other texts are mapped by indicators.

    One narrow aggregate finds whether all labels are numbers and which label comes first by key; it is
    one row, whatever the number of distinct labels.
    """
    if not isinstance(df.schema[label].dataType, T.StringType):
        return df.withColumn(label, F.col(label).cast("int"))
    known = df.where(F.col(label).isNotNull())
    facts = known.agg(
        F.struct(
            F.min_by(label, key_struct(key)).alias("first"),
            F.bool_and(F.col(label).try_cast("int").isNotNull()).alias("numeric"),
        ).alias("_f")
    ).scalar()
    mapped = F.when(F.col("_f.numeric"), F.col(label).try_cast("int")).otherwise(
        from_text_label(F.col(label), F.col("_f.first"))
    )
    return df.withColumn("_f", facts).withColumn(label, mapped.cast("int")).drop("_f")


def label_violations(df: DataFrame, label: str, codes: Mapping[str, int] = LABEL_CODES) -> DataFrame:
    """Label values that a strict mapping would reject, with their row counts."""
    bad = F.col(label).isNull() | ~F.col(label).isin(*codes)
    return df.where(bad).groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))
