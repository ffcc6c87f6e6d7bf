"""Digests: text identity, row identity and the repeatable random order."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def names(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def key_struct(key: str | Sequence[str]) -> Column:
    return F.struct(*[F.col(k) for k in names(key)])


def numeric_key(df: DataFrame, key: str | Sequence[str]) -> str | None:
    """The key's only column if it is a number; its minimum can then be kept in a hash aggregate."""
    cols = names(key)
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    return cols[0] if len(cols) == 1 and isinstance(df.schema[cols[0]].dataType, whole) else None


def text_digest(text: Column | str) -> Column:
    """32 bytes that stand for the text in a shuffle."""
    return F.unhex(F.sha2(F.col(text) if isinstance(text, str) else text, 256))


def _rendered(name: str, kind: T.DataType) -> Column:
    """A value as text that differs wherever the value does: times to the microsecond, one zero, one NaN."""
    value = F.col(name)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value).cast("string")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(value == 0, F.lit("0")).otherwise(value.cast("string"))
    if isinstance(kind, T.BinaryType):
        return F.hex(value)
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        exact = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}
        return F.to_json(F.struct(value.alias("v")), exact)
    return value.cast("string")


def row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """32 bytes that stand for a whole row; nulls equal nulls.

    Every value stands behind its length, so neighbours can't run into each other; a null has a mark of its own.
    """
    parts = []
    for c in columns:
        shown = _rendered(c, df.schema[c].dataType)
        parts += [F.coalesce(F.octet_length(shown).cast("string"), F.lit("-")), F.lit(":"), F.coalesce(shown, F.lit(""))]
    return F.unhex(F.sha2(F.concat(F.lit(""), *parts), 256))


def order_digest(key: str | Sequence[str], seed: int, purpose: str = "") -> Column:
    """Random order that any engine and any partitioning reproduces: md5 of purpose, seed and key.

    Operators of different purposes draw independently: what one keeps is no biased input of the next.
    """
    start = [F.lit(purpose)] if purpose else []
    return F.md5(F.concat_ws("|", *start, F.lit(str(seed)), *[F.col(k).cast("string") for k in names(key)]))


def order_bucket(digest: Column, digits: int = 4) -> Column:
    """Leading hex digits of the order digest as a number; equal shares of the keys fall in each."""
    return F.conv(F.substring(digest, 1, digits), 16, 10).cast("int")


def fingerprint(params: Mapping) -> str:
    """md5 over all parameters of a stage."""
    return hashlib.md5(json.dumps(params, sort_keys=True, default=str).encode()).hexdigest()
