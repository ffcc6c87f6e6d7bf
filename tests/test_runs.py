"""Counted runs of words: plain formulas, odd texts, small buffers."""

from collections import Counter
from itertools import zip_longest

import pytest
from pyspark.sql import functions as F

from textgauge.functions import runs
from textgauge.operators import sentences

TEXTS = [(1, "a b a b c"), (1, None), (2, " \u2003 "), (2, "a b\u00a0a\x1cb\u3000"), (None, "x"), (1, "a b " * 50), (2, "İ Σας. (end.) “Why?” 3. May")]


@pytest.mark.parametrize("size, ends", [(1, False), (2, False), (2, True), (3, True)])
@pytest.mark.parametrize("held", [1, 1 << 21])
def test_counts_are_those_of_plain_lists(spark, monkeypatch, size, ends, held):
    monkeypatch.setattr(runs, "HELD", held)
    monkeypatch.setattr(runs, "NUMBERED", min(held, 3))
    monkeypatch.setattr(runs, "ROWS", 2)
    want = Counter()
    for k, text in TEXTS:
        words = (text or "").split()
        want.update((k, *r) for r in (zip_longest if ends else zip)(*(words[i:] for i in range(size))))
    df = spark.createDataFrame(TEXTS, "k int, text string").coalesce(1)
    keys = ["k", *[f"w{i}" for i in range(size)]]
    got = runs.run_counts(df, F.col("text"), "k", size=size, ends=ends).groupBy(*keys).agg(F.sum("n").alias("n"))
    assert {tuple(r)[:-1]: r.n for r in got.collect()} == want


def test_pairs_are_read_once_and_counted_like_rows(spark):
    df = spark.createDataFrame(TEXTS, "k int, text string")
    want = Counter((r.word, r.mark, r.following) for r in sentences.word_pairs(df, "text").where("word <> ''").collect())
    assert {(r.word, r.mark, r.following): r.n for r in sentences.pair_counts(df, "text").collect()} == want
    shown = sentences.fit_borders(df, "text").collocations._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" not in shown and "explode" not in shown  # the texts themselves aren't read again
