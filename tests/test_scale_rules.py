"""No stale stages, no lost microseconds, no prefixes, no switches: what larger tables would meet."""

import datetime
import math
import time

import pytest
from pyspark.sql import functions as F

from textgauge.config import CorpusConfig, QualityConfig, ScoreConfig, TrainConfig
from textgauge.functions import text as X
from textgauge.functions.stats import chi2_tail
from textgauge.operators import dedup, gates, prefix, profile, vocabulary
from textgauge.operators.scoring import prediction_log, score
from textgauge.plans import corpus as C
from textgauge.plans.scoring import predictions_path
from textgauge.sources import inventory, readers, writers


def test_rows_that_differ_in_microseconds_differ(spark):
    at = datetime.datetime(2024, 1, 1, 12, 0, 0, 5)
    rows = [(1, at, 0.0, "a"), (2, at, 1.0, None)]
    moved = [(1, at + datetime.timedelta(microseconds=1), -0.0, "a"), (2, at, 1.0, "-")]
    schema = "k int, t timestamp, v double, s string"
    old, new = spark.createDataFrame(rows, schema), spark.createDataFrame(moved, schema)
    assert {r.k: r.status for r in inventory.snapshot_diff(old, new, "k").collect()} == {1: "changed", 2: "changed"}
    assert {r.status for r in inventory.snapshot_diff(old, new, "k", ["v"]).collect()} == {"unchanged"}
    for n in range(1, 7):  # the same answer whatever the number of columns
        both = old.union(new).select("t", *[F.lit(i).alias(f"c{i}") for i in range(n)])
        assert dedup.duplicate_rows(both).first().n_distinct == 2
    pairs = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "-"), ("-", None)], "a string, b string")
    assert dedup.duplicate_rows(pairs).first().n_distinct == 4


@pytest.mark.parametrize("filename", ["table.parquet", None, "missing.parquet"])
def test_corpus_job_sees_new_input(spark, tmp_path, filename):
    folder = str(tmp_path / "raw")
    table = f"{folder}/table.parquet" if filename == "table.parquet" else folder

    def job(n):
        rows = [(i, f"{i} " + "word " * 20, "human" if i % 2 else "gpt") for i in range(n)]
        spark.createDataFrame(rows, "k long, text string, source string").write.mode("overwrite").parquet(table)
        quality = QualityConfig(min_class_rows=5)
        return C.corpus_job(spark, folder, str(tmp_path / "stages"), "k", quality=quality, filename=filename).count()

    assert job(40) == 40 and job(200) == 200


def test_corpus_job_needs_files(spark, tmp_path):
    (tmp_path / "empty").mkdir()
    with pytest.raises(Exception):
        C.corpus_job(spark, str(tmp_path / "empty"), str(tmp_path / "stages"), "k")
    with pytest.raises(ValueError):
        inventory.listing(spark, str(tmp_path / "empty"))


def test_lower_case_may_lengthen_a_text(spark):
    rows = [(i, "\u0130" * (26 + i % 5) + str(i), "human" if i % 2 else "gpt") for i in range(30)]
    df = C.label_rows(spark.createDataFrame(rows, "k long, text string, source string"))
    config = CorpusConfig(lowercase=True, balance=False)
    funnel = {r.step: r.n for r in C.corpus_funnel(df, "k", config).collect()}
    assert C.build_corpus(df, "k", config).count() == funnel["length_filtered"] == 30


def test_dot_leaders_take_linear_time(spark):
    df = spark.createDataFrame([("A" + "." * 1_000_000 + "b. c!!! d",), ("...",), ("a.b",)], "t string")
    start = time.time()
    assert [r[0] for r in df.select(X.sentence_count("t")).collect()] == [3, 1, 1]
    assert time.time() - start < 20


def test_nothing_passes_on_invalid_input(spark):
    good = [(i % 2, i % 2, float(i % 2)) for i in range(100)]
    schema = "label int, prediction int, probability double"
    rows = gates.gate_rows(spark.createDataFrame(good, schema)).where("passed is not null").collect()
    assert any(r.passed for r in rows)
    for bad in ((7, 1, 0.5), (None, 1, 0.5), (1, 1, 1.5)):
        found = gates.gate_rows(spark.createDataFrame([*good, bad], schema)).where("passed is not null").collect()
        assert len(found) == len(rows) and not any(r.passed for r in found)


def test_chi_square_tail_keeps_its_digits(spark):
    def exact(x, k):
        if k % 2 == 0:
            return math.exp(-x / 2) * sum((x / 2) ** i / math.factorial(i) for i in range(k // 2))
        out = math.erfc(math.sqrt(x / 2))
        return out + sum(math.exp(-x / 2 + (i + 0.5) * math.log(x / 2) - math.lgamma(i + 1.5)) for i in range(k // 2))

    cases = [(x, k) for x in (0.01, 1.0, 5.0, 30.0, 90.0, 200.0, 900.0) for k in (1, 2, 3, 4, 9, 10)]
    df = spark.createDataFrame(cases, "x double, k int").withColumn("p", chi2_tail(F.col("x"), F.col("k")))
    for x, k, p in df.collect():
        assert p == pytest.approx(exact(x, k), rel=1e-8)


def test_ranges_change_no_result(spark):
    df = spark.range(3000).select((F.pmod(F.xxhash64("id"), F.lit(700))).alias("v"))
    freq = prefix.frequencies(df, "v")
    want = None
    for step in (2, 5, 16, 64):
        rows = sorted(map(tuple, prefix.running_totals(freq, "v", ["n"], step=step).collect()))
        want = want or rows
        assert rows == want
        assert prefix.summarize(df, "v", step=step).first()["median"] == prefix.summarize(df, "v").first()["median"]


def test_top_words_plan_is_the_same_for_any_k(spark):
    df = spark.createDataFrame([(i % 2, " ".join(f"w{j}" for j in range(i))) for i in range(60)], "y int, t string")
    plans = []
    for k in (3, 1000, 5000):
        out = vocabulary.top_words(df, "t", "y", k=k)
        plans.append(out._jdf.queryExecution().optimizedPlan().toString().count("Window ["))
        for y in (0, 1):
            rows = sorted((r["rank"], r["n"]) for r in out.where(F.col("y") == y).collect())
            assert [r[0] for r in rows] == list(range(1, min(k, 58 + y) + 1)) and rows == sorted(rows, key=lambda r: -r[1])
    assert len(set(plans)) == 1


def test_box_summary_has_every_class(spark):
    df = spark.createDataFrame([(c, float(i)) for c in (0, 1, 5) for i in range(9)], "y int, v double")
    assert {r.y for r in profile.box_summary(df, "v", "y").collect()} == {0, 1, 5}
    assert {r.y for r in profile.box_summary(df, "v", "y", [1]).collect()} == {1}


def test_no_text_in_a_shuffle(spark, tmp_path):
    rows = [(i, "text " * 50 + str(i % 700), "s") for i in range(800)]
    df = spark.createDataFrame(rows, "k long, text string, s string")
    df.write.parquet(str(tmp_path / "t"))
    kept = dedup.drop_duplicate_texts(spark.read.parquet(str(tmp_path / "t")), "text", "k", str(tmp_path / "f"))
    assert kept.count() == 700 and kept.columns == df.columns
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "hashpartitioning" not in plan


@pytest.mark.parametrize("path,want", [
    ("s3a://my.bucket/data", "s3a://my.bucket/data_predictions"),
    ("/data/v1.2/texts", "/data/v1.2/texts_predictions"),
    ("/data/v1.2/texts.csv/", "/data/v1.2/texts_predictions.csv"),
    ("texts.parquet", "texts_predictions.parquet"),
    ("/a/.hidden", "/a/.hidden_predictions"),
])
def test_predictions_path(path, want):
    assert predictions_path(path) == want


def test_csv_by_its_header(spark, tmp_path):
    df = spark.createDataFrame([("1", "a, b"), ("2", 'say "x"')], "k string, text string")
    path = writers.write_csv(df, str(tmp_path / "t.csv"))
    for multi_line in (True, False):
        back = readers.read_csv(spark, path, multi_line=multi_line)
        assert back.columns == ["k", "text"] and sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_whole_texts_by_default(spark):
    assert ScoreConfig().max_tokens is None and TrainConfig().max_tokens is None
    log = prediction_log(score(spark.createDataFrame([("abc",)], "text string"), lambda: lambda t: [[0.2, 0.8]] * len(t)))
    row = log.first()
    assert (row.text_length, row.prediction, row.failed) == (3, 1, False)
