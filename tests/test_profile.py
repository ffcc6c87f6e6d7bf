"""Running totals, quantiles, profiles and vocabulary against pandas and numpy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from textgauge.operators import prefix, profile, vocabulary


def frame(spark, values, groups=None):
    rows = [(float(v) if v is not None else None, int(g)) for v, g in zip(values, groups or [0] * len(values))]
    return spark.createDataFrame(rows, "v double, g int")


@pytest.mark.parametrize("shape", ["many", "skewed", "tiny", "constant", "negative"])
def test_running_totals(spark, shape):
    rng = np.random.default_rng(1)
    values = {
        "many": rng.normal(size=3000),
        # A third of the rows share one value, the rest crowd near zero.
        "skewed": np.where(np.arange(3000) % 3 == 0, 0.5, rng.exponential(1e-9, 3000)),
        "tiny": np.array([3.0, 1.0]),
        "constant": np.full(50, 7.0),
        "negative": -rng.integers(0, 400, 2000).astype(float),
    }[shape]
    df = frame(spark, values)
    for layout in (df.repartition(1), df.repartition(9)):
        out = prefix.running_totals(prefix.frequencies(layout, "v"), "v", ["n"]).orderBy("v").toPandas()
        want = pd.Series(values).value_counts().sort_index()
        assert np.array_equal(out.v, want.index) and np.array_equal(out.n, want.values)
        assert np.array_equal(out.n_upto, want.cumsum().values)
        assert set(out.n_total) == {len(values)}


@pytest.mark.parametrize("by", [[], ["g"]])
def test_summarize(spark, by):
    rng = np.random.default_rng(2)
    values = np.round(rng.gamma(2, 900, 2500))
    groups = np.where(np.arange(2500) % 10 < 7, 0, np.arange(2500) % 4).tolist()
    out = prefix.summarize(frame(spark, values, groups), "v", {"a": 0.1, "b": 0.5, "c": 0.997}, by).toPandas()
    pdf = pd.DataFrame({"v": values, "g": groups})
    for g, part in pdf.groupby("g") if by else [(None, pdf)]:
        row = out[out.g == g].iloc[0] if by else out.iloc[0]
        assert row.n == len(part) and row["min"] == part.v.min() and row["max"] == part.v.max()
        assert np.isclose(row["mean"], part.v.mean(), rtol=1e-12) and np.isclose(row["std"], part.v.std(), rtol=1e-12)
        assert np.allclose([row.a, row.b, row.c], part.v.quantile([0.1, 0.5, 0.997]))


def test_summarize_edges(spark):
    large = frame(spark, [1e12 + i for i in range(100)])
    assert np.isclose(prefix.summarize(large, "v").first()["std"], np.std(np.arange(100), ddof=1))
    one = prefix.summarize(frame(spark, [4.0, None]), "v").first()
    assert (one.n, one["mean"], one["std"], one["median"]) == (1, 4.0, None, 4.0)
    none = prefix.summarize(frame(spark, [None]), "v").first()
    assert (none.n, none["mean"], none["median"]) == (0, None, None)


def test_nulls_counts_and_shares(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b"), (None, "c")], "y int, t string")
    nulls = {r.column: (r.n_null, r.null_share) for r in profile.null_profile(df).collect()}
    assert nulls == {"y": (1, 0.25), "t": (1, 0.25)}
    assert {(r.y, r.n) for r in profile.value_counts(df, "y").collect()} == {(1, 2), (2, 1)}
    assert {(r.y, r.percent) for r in profile.class_share(df, "y").collect()} == {(1, 50.0), (2, 25.0)}
    row = profile.balance_ratio(df, "y").first()
    assert (row.classes, row.ratio, row.is_balanced) == (2, 0.5, True)
    assert profile.balance_ratio(df.where("y = 1"), "y").first().ratio == 1.0
    assert {r.null_share for r in profile.null_profile(df.limit(0)).collect()} == {None}


def test_histogram(spark):
    rng = np.random.default_rng(3)
    values = rng.integers(0, 1000, 700).astype(float)
    groups = (np.arange(700) % 2).tolist()
    out = profile.length_histogram(frame(spark, values, groups), "v", "g").toPandas()
    edges = np.histogram_bin_edges(values, 50)
    for g in (0, 1):
        want, _ = np.histogram(values[np.array(groups) == g], edges)
        got = out[out.g == g].set_index("bin").n.reindex(range(50), fill_value=0)
        assert got.tolist() == want.tolist()
    flat = profile.length_histogram(frame(spark, [5.0, 5.0]), "v", "g").first()
    assert (flat.bin, flat.n) == (0, 2)


def test_box(spark):
    values = [*range(1, 21), 100.0, -50.0]
    row = profile.box_summary(frame(spark, values), "v", "g").first()
    q1, q2, q3 = np.quantile(values, [0.25, 0.5, 0.75])
    assert (row.q1, row.median, row.q3) == (q1, q2, q3)
    assert (row.whisker_low, row.whisker_high, row.n_outliers) == (1.0, 20.0, 2)


def test_profile_rows(spark):
    df = spark.createDataFrame([(1, "ab"), (1, "ab"), (2, None)], "y int, t string")
    rows = {(r.section, r.item): (r.value, r.detail) for r in profile.dataset_profile(df, "t", "y").collect()}
    assert rows["shape", "rows"][0] == 3 and rows["duplicates", "rows"][0] == 1
    assert rows["nulls", "t"][0] == 1 and rows["bytes", "t"][0] == 4 and rows["bytes", "y"][0] == 12
    assert rows["dtype", "t"][1] == "string" and rows["labels", "1"][0] == 2
    assert rows["text_length", "mean"][0] == 2.0


def test_vocabulary(spark):
    # "the" makes up a third of all words.
    texts = [("the The a x1", 0), ("the b\tthe  c", 1), ("", 1), (None, 1), ("the d", None)] * 40
    df = spark.createDataFrame(texts, "t string, y int").repartition(6)
    sizes = {r.y: (r.n_words, r.n_occurrences) for r in vocabulary.vocabulary_size(df, "t", "y").collect()}
    assert sizes == {0: (3, 160), 1: (4, 200)}
    row = vocabulary.vocabulary_overlap(df, "t", "y").first()
    assert (row.human_words, row.ai_words, row.shared, row.human_only, row.ai_only) == (3, 4, 1, 2, 3)
    assert np.isclose(row.overlap_percent, 100 / 6)
    top = vocabulary.top_words(df, "t", "y", k=2).orderBy("y", "rank").collect()
    assert [(r.y, r.word, r.n) for r in top] == [(0, "the", 80), (0, "a", 40), (1, "the", 80), (1, "b", 40)]
    assert "the" not in {r.word for r in vocabulary.top_words(df, "t", "y", stop_words=["the"]).collect()}


def test_top_words_are_cut_before_the_shuffle(spark):
    df = spark.createDataFrame([("a b", 0)], "t string, y int")
    plan = vocabulary.top_words(df, "t", "y")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_linguistic_means(spark):
    df = spark.createDataFrame([("One, two. Three!", 0), ("No end", 0), ("", 1)], "t string, y int")
    rows = {r.y: r for r in profile.linguistic_by_class(df, "t", "y").collect()}
    assert (rows[0].sentences, rows[0].words_per_sentence, rows[0].commas) == (1.5, 1.75, 0.5)
    assert (rows[1].sentences, rows[1].words_per_sentence) == (0.0, 0.0)


def test_quantiles_search_ranges_once_per_distinct_value(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(F.length("text").alias("v"))
    df = prefix.summarize(docs, "v")
    df.collect()
    from plans import executed_scans, final_lines

    plan = df._jdf.queryExecution().executedPlan().toString()
    assert executed_scans(plan) == 1
    assert not [x for x in final_lines(plan) if "FileScan" in x and "lambda" in x]
