"""Queries over the test tables; importing the modules registers them."""

from __future__ import annotations

from textgauge.catalog.registry import ORACLES, QUERIES


def load() -> tuple[dict, dict]:
    from textgauge.catalog import checks, corpora, evaluation, language, serving, texts, training, tables  # noqa: F401

    return QUERIES, ORACLES
