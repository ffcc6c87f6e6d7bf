"""Dedup, sampling, balancing and splits: invariants, brute force, skew, and independence of partitioning."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from textgauge.config import CorpusConfig, SplitConfig
from textgauge.operators import dedup, sampling
from textgauge.plans import corpus as C


def order(keys, purpose="", seed=42):
    start = f"{purpose}|{seed}" if purpose else f"{seed}"
    return sorted(keys, key=lambda k: (hashlib.md5(f"{start}|{k}".encode()).hexdigest(), k))


def table(spark, counts):
    """Keys 0.. in classes of the given sizes."""
    labels = [c for c, n in counts.items() for _ in range(n)]
    return spark.createDataFrame(list(enumerate(labels)), "k bigint, y int")


def layouts(df):
    return [df, df.repartition(1), df.repartition(7, "y" if "y" in df.columns else "k"), df.orderBy(F.desc("k"))]


def test_sample(spark):
    df = table(spark, {0: 500})
    want = set(order(range(500), "sample")[:123])
    for layout in layouts(df):
        assert {r.k for r in sampling.sample_rows(layout, 123, "k").collect()} == want
    assert sampling.sample_rows(df, 500, "k").count() == 500
    assert sampling.sample_rows(df, 10**9, "k").count() == 500
    assert sampling.sample_rows(df.limit(0), 3, "k").count() == 0
    with pytest.raises(ValueError):
        sampling.sample_rows(df, 0, "k")


@pytest.mark.parametrize("classes", [(0, 1, 2), None])
def test_balance(spark, classes):
    df = table(spark, {0: 900, 1: 40, 2: 60})
    want = set(order(range(900), "balance")[:40]) | set(range(900, 940)) | set(order(range(940, 1000), "balance")[:40])
    for layout in layouts(df):
        assert {r.k for r in sampling.balance_classes(layout, "y", "k", classes).collect()} == want


def test_many_classes_are_ranked_by_a_shuffle(spark, monkeypatch):
    df = table(spark, {0: 90, 1: 40, 2: 60})
    kept = {r.k for r in sampling.balance_classes(df, "y", "k").collect()}
    split = {r.k: r.split for r in sampling.split_rows(df, "y", "k").collect()}
    monkeypatch.setattr(sampling, "MOST_CLASSES", 2)
    assert sampling.class_list(df, "y") is None
    assert {r.k for r in sampling.balance_classes(df, "y", "k").collect()} == kept
    assert {r.k: r.split for r in sampling.split_rows(df, "y", "k").collect()} == split


def test_draws_can_follow_one_another(spark):
    df = table(spark, {0: 1500, 1: 400})
    for rows in (sampling.sample_rows(df, 300, "k"), sampling.balance_classes(df, "y", "k", (0, 1))):
        for split in (sampling.split_rows(rows, "y", "k", classes=(0, 1)), sampling.split_rows_by_hash(rows, "k")):
            found = {(r.y, r.split) for r in split.select("y", "split").distinct().collect()}
            assert found == {(y, s) for y in (0, 1) for s in ("train", "validation", "test")}


@pytest.mark.parametrize("classes", [(0, 1), None])
def test_balance_edges(spark, classes):
    assert sampling.balance_classes(table(spark, {1: 9}), "y", "k", classes).count() == 9
    assert sampling.balance_classes(table(spark, {0: 3}).limit(0), "y", "k", classes).count() == 0
    even = table(spark, {0: 10, 1: 8})
    assert sampling.balance_classes(even, "y", "k", classes, max_ratio=0.8).count() == 18
    assert sampling.balance_classes(even, "y", "k", classes, max_ratio=0.81).count() == 16
    with_null = even.unionByName(spark.createDataFrame([(100, None)], "k bigint, y int"))
    assert sampling.balance_classes(with_null, "y", "k", classes).count() == 16


@pytest.mark.parametrize("classes", [(0, 1, 2), None])
def test_split(spark, classes):
    sizes = {0: 101, 1: 7, 2: 1}
    for layout in layouts(table(spark, sizes)):
        rows = sampling.split_rows(layout, "y", "k", classes=classes).collect()
        assert len(rows) == sum(sizes.values())
        start = 0
        for label, n in sizes.items():
            held = math.ceil(n * 0.3)
            test = math.ceil(held * 0.5)
            ranked = order(range(start, start + n), "split")
            want = {k: "train" if i < n - held else "validation" if i < n - test else "test" for i, k in enumerate(ranked)}
            assert {r.k: r.split for r in rows if r.y == label} == want
            start += n


def test_split_by_hash_is_about_right(spark):
    rows = sampling.split_rows_by_hash(table(spark, {0: 4000}), "k", SplitConfig(0.2, 0.1)).groupBy("split").count().collect()
    sizes = {r["split"]: r["count"] for r in rows}
    assert abs(sizes["train"] - 2800) < 120 and abs(sizes["validation"] - 800) < 100


def test_random_order(spark):
    df = table(spark, {0: 300})
    assert [r.k for r in sampling.in_random_order(df, "k").collect()] == order(range(300))


def test_dedup_keeps_smallest_key_under_skew(spark):
    # One text holds a third of the rows; keys run against the row order.
    texts = ["hot" if i % 3 == 0 else f"t{i % 50}" if i % 2 else None for i in range(900)]
    df = spark.createDataFrame([(900 - i, t) for i, t in enumerate(texts)], "k bigint, t string")
    want = {}
    for i, t in enumerate(texts):
        want[t] = min(want.get(t, 10**9), 900 - i)
    for layout in layouts(df):
        kept = dedup.drop_duplicate_texts(layout, "t", "k").collect()
        assert {r.t: r.k for r in kept} == want and len(kept) == len(want)
        paired = layout.withColumn("k2", F.lit("a"))
        assert dedup.drop_duplicate_texts(paired, "t", ["k2", "k"]).count() == len(want)
    row = dedup.duplicate_texts(df, "t").first()
    assert (row.n_rows, row.n_distinct, row.n_duplicates) == (900, len(want), 900 - len(want))
    assert dedup.duplicate_rows(df).first().n_duplicates == 0
    pairs = spark.createDataFrame([(1, 0.0), (1, -0.0), (None, None), (None, None), (2, 0.0)], "a int, b double")
    assert dedup.duplicate_rows(pairs).first().n_duplicates == 2
    assert dedup.duplicate_rows(pairs, ["a"]).first().n_duplicates == 2
    empty = dedup.duplicate_texts(df.limit(0), "t").first()
    assert (empty.n_rows, empty.n_duplicates, empty.duplicate_share) == (0, 0, None)


RAW = [
    (1, "a" * 60, "human"), (2, "a" * 60, "gpt"), (3, "b" * 60, "gpt"), (4, "b" * 60 + "  ", "gpt"), (5, None, "gpt"),
    (6, "short", "human"), (7, "c" * 5000 + "!!!", "human"), (8, "d" * 5001, "gpt"), (9, "e " * 30, "wiki"),
    (10, "f" * 49 + "...", "human"), (11, None, None), (12, "g" * 70, "chatgpt"), (13, "h" * 80, "palm"), (14, "i" * 90, None),
]


def raw(spark):
    return spark.createDataFrame(RAW, "k bigint, text string, source string")


def expected(balance):
    seen, rows = set(), []
    for k, text, source in RAW:
        if text is None or text in seen:
            continue
        seen.add(text)
        clean = text.strip().replace("!!!", "!").replace("...", ".")
        human = source is None or any(t in source for t in ("human", "wiki"))
        if 50 <= len(clean) <= 5000:
            rows.append((k, clean, 0 if human else 1))
    if balance:
        size = min(sum(r[2] == c for r in rows) for c in (0, 1))
        keep = {k for c in (0, 1) for k in order([r[0] for r in rows if r[2] == c], "balance")[:size]}
        rows = [r for r in rows if r[0] in keep]
    return sorted(rows)


@pytest.mark.parametrize("balance", [True, False])
@pytest.mark.parametrize("key", ["k", ["k", "j"], "text_key"])
def test_corpus(spark, balance, key):
    config = CorpusConfig(balance=balance)
    df = C.label_rows(raw(spark), config)
    if key == "text_key":
        df = df.withColumn("text_key", F.lpad(F.col("k").cast("string"), 4, "0"))
    if key == ["k", "j"]:
        df = df.withColumn("j", F.lit(0))
    for layout in (df, df.repartition(5), df.orderBy(F.desc("k"))):
        built = C.build_corpus(layout, key, config)
        if key == "k":
            assert sorted((r.k, r.text, r.generated) for r in built.collect()) == expected(balance)
        else:
            want = expected(False)
            assert built.count() == len(expected(balance)) and {r.text for r in built.collect()} <= {r[1] for r in want}


def stored(spark, folder):
    def store(name, build):
        build().write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    return store


@pytest.mark.parametrize("balance", [True, False])
@pytest.mark.parametrize("dedup_on", [True, False])
def test_stages_give_the_same_corpus(spark, tmp_path, balance, dedup_on):
    config = CorpusConfig(balance=balance, drop_duplicates=dedup_on)
    df = C.label_rows(raw(spark), config)
    built = sorted(map(tuple, C.build_corpus(df, "k", config).collect()))
    staged = C.build_corpus_in_stages(df, "k", config, stored(spark, tmp_path / "a"))
    assert sorted(map(tuple, staged.collect())) == built
    if dedup_on:
        plan = staged._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # surplus keys of any size
    try:
        staged = C.build_corpus_in_stages(df, "k", config, stored(spark, tmp_path / "b"))
        assert sorted(map(tuple, staged.collect())) == built
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_corpus_without_dedup_or_other_labels(spark):
    df = C.label_rows(raw(spark))
    kept = C.build_corpus(df, "k", CorpusConfig(balance=False, drop_duplicates=False)).collect()
    assert {r.k for r in kept} == {1, 2, 3, 4, 9, 12, 13, 14, 10, 7} - {7} | ({7} if len("c" * 5000 + "!") <= 5000 else set())
    other = df.withColumn("generated", F.when(F.col("k") == 1, 5).otherwise(F.col("generated")))
    assert 1 in {r.k for r in C.build_corpus(other, "k", CorpusConfig(balance=False)).collect()}
    assert 1 not in {r.k for r in C.build_corpus(other, "k", CorpusConfig()).collect()}
    assert 2 not in {r.k for r in C.build_corpus(other, "k", CorpusConfig()).collect()}


def test_funnel_follows_the_corpus(spark):
    df = C.label_rows(raw(spark))
    steps = {r.step: r.n for r in C.corpus_funnel(df, "k").collect()}
    assert steps["input"] == len(RAW)
    assert steps["deduplicated"] == len({r[1] for r in RAW})
    assert steps["with_text"] == steps["with_label"] == steps["deduplicated"] - 1
    assert steps["length_filtered"] == len(expected(False))
    assert steps["balanced"] == len(expected(True))
    assert {r.n for r in C.corpus_funnel(df.limit(0), "k").collect()} == {0}


def test_unknown_sources(spark):
    df = spark.createDataFrame([("x",), ("x",), ("human",), (None,)], "source string")
    rows = C.unknown_sources(df, "source", ["human"], ["ai"]).collect()
    assert {(r.source, r.n) for r in rows} == {("x", 2), (None, 1)}


def test_corpus_scans_texts_twice(spark, sf):
    import __spark_entry__ as entry

    df = entry.queries()["build_corpus"](spark, sf)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    from plans import executed_scans

    assert executed_scans(plan.toString()) == 2
