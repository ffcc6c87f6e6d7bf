"""Label expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from textgauge.config import AI, CLASS_NAMES, HUMAN, LABEL_CODES, UNKNOWN

# What marks a source or a label as human or machine text.
HUMAN_SOURCES = ("human", "wiki", "reddit", "book", "wikipedia")
AI_SOURCES = ("gpt", "chatgpt", "ai", "generated", "claude", "palm")
HUMAN_SOURCES_SHORT = ("human", "wiki", "reddit", "book")
AI_SOURCES_SHORT = ("gpt", "chatgpt", "ai", "generated")
HUMAN_LABELS = ("human", "real", "original", "0")
AI_LABELS = ("ai", "generated", "artificial", "gpt", "chatgpt", "1")
HUMAN_SCORE_LABELS = ("LABEL_0", "0", "HUMAN")
AI_SCORE_LABELS = ("LABEL_1", "1", "AI")


def mentions(text: Column, tokens: Sequence[str]) -> Column:
    """Does the text hold any of the tokens as a substring?"""
    return reduce(lambda a, b: a | b, (F.contains(text, F.lit(t)) for t in tokens), F.lit(False))


def from_source(
    source: Column | str,
    human: Sequence[str] = HUMAN_SOURCES,
    ai: Sequence[str] = AI_SOURCES,
    unknown: int = HUMAN,
) -> Column:
    """Class of a source name; a human token outweighs a machine token.

    ``unknown`` is what a source without any token gets: ``HUMAN``, or ``UNKNOWN`` to keep it apart.
    """
    name = F.lower(F.coalesce(F.col(source) if isinstance(source, str) else source, F.lit("none")))
    return F.when(mentions(name, human), HUMAN).when(mentions(name, ai), AI).otherwise(unknown).cast("int")


def from_text_label(label: Column, first: Column) -> Column:
    """Class of a free-text label; ``first`` is the label seen first in the table.

    A label without an indicator is human if it is the first one, else machine.
    """
    low = F.lower(label)
    return (
        F.when(label.isNull(), None)
        .when(mentions(low, HUMAN_LABELS), HUMAN)
        .when(mentions(low, AI_LABELS), AI)
        .when(label == first, HUMAN)
        .otherwise(AI)
        .cast("int")
    )


def strict(label: Column, codes: Mapping[str, int] = LABEL_CODES, fail: bool = True) -> Column:
    """Exact label names only; any other value fails the job (or turns null)."""
    out = F.lit(None).cast("int")
    if fail:
        out = F.raise_error(F.concat(F.lit("unmapped label: "), F.coalesce(label, F.lit("null")))).cast("int")
    for name, code in codes.items():
        out = F.when(label == name, F.lit(code).cast("int")).otherwise(out)
    return out


def from_score_label(label: Column) -> Column:
    """Class number of a predictor's label: known names, else the first digits in it, else 0."""
    up = F.upper(label)
    digits = F.regexp_extract(label, "[0-9]+", 0)
    return (
        F.when(up.isin(*HUMAN_SCORE_LABELS), HUMAN)
        .when(up.isin(*AI_SCORE_LABELS), AI)
        .when(digits != "", digits.try_cast("int"))
        .otherwise(HUMAN)
        .cast("int")
    )


def class_name(code: Column, names: Mapping[int, str] = CLASS_NAMES) -> Column:
    out = F.concat(F.lit("class_"), code.cast("string"))
    for number, name in names.items():
        out = F.when(code == number, F.lit(name)).otherwise(out)
    return out


__all__ = ["UNKNOWN", "class_name", "from_score_label", "from_source", "from_text_label", "mentions", "strict"]
