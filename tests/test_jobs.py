"""Quality gate, sources and sinks, scoring, training and streams."""

import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from textgauge.config import CorpusConfig, QualityConfig, ScoreConfig, SplitConfig, TrainConfig
from textgauge.operators import quality, scoring
from textgauge.operators.model import train
from textgauge.operators.profile import text_length_stats
from textgauge.plans import corpus as C
from textgauge.plans.scoring import predictions_path, score_file
from textgauge.plans.training import load_model, scored_table, train_and_score, training_job
from textgauge.sources import inventory, readers, stage_cache, writers
from textgauge.streaming import scoring as streams


# ---- quality gate ----

CORPUS = "text string, generated int, source string"


def good(spark, n=120):
    rows = [(f"text number {i} with words", i % 2, "s") for i in range(2 * n)]
    return spark.createDataFrame(rows, CORPUS)


def verdicts(df, config=QualityConfig()):
    return {r["check"]: r.passed for r in quality.validation_report(df, config).collect()}


def test_good_corpus_passes(spark):
    report = verdicts(good(spark))
    assert set(report) == {"schema", "data_quality", "text_content", "labels", "class_distribution", "summary"}
    assert all(report.values())
    C.require_passed(quality.validation_report(good(spark)))


@pytest.mark.parametrize(
    "row, failed",
    [
        (("short", 0, "s"), "text_content"), ((" " * 20, 0, "s"), "text_content"), (("x" * 10001, 0, "s"), "text_content"),
        ((None, 0, "s"), "text_content"), (("long enough text", 2, "s"), "labels"), (("long enough text", None, "s"), "labels"),
    ],
)
def test_one_bad_row(spark, row, failed):
    df = good(spark).unionByName(spark.createDataFrame([row], CORPUS))
    report = verdicts(df)
    assert not report[failed] and not report["summary"]
    with pytest.raises(ValueError, match=failed):
        C.require_passed(quality.validation_report(df))


def test_columns_classes_and_nulls(spark):
    df = good(spark)
    assert verdicts(df.drop("source"))["schema"]
    without = verdicts(df.drop("generated"))
    assert not without["schema"] and not without["labels"] and not without["class_distribution"]
    assert not verdicts(good(spark, 60))["class_distribution"]
    holes = df.withColumn("source", F.when(F.rand(1) < 0.2, None).otherwise(F.col("source")))
    row = quality.check_quality(holes).first()
    assert row.high_null_columns == 1 and not row.passed and row.quality_score < 1
    status = {r.column: r.status for r in quality.check_schema(df.drop("source").withColumn("x", F.lit(1))).collect()}
    assert status == {"text": "expected", "generated": "expected", "source": "missing", "x": "extra"}


def test_null_text_reads_as_none(spark):
    df = spark.createDataFrame([(None, 0, "s"), (None, 1, "s"), ("None", 1, "s")], CORPUS)
    row = quality.check_text(df).first()
    assert (row.too_short, row.min_length, row.unique_texts, row.empty_texts) == (3, 4, 1, 0)


def test_sketched_figures_are_close(spark):
    df = good(spark, 1500).unionByName(good(spark, 500))
    exact, near = quality.check_text(df).first(), quality.check_text(df, approximate=True).first()
    assert abs(near.unique_texts - exact.unique_texts) < 0.05 * exact.unique_texts
    same = [c for c in exact.asDict() if c not in ("unique_texts", "diversity")]
    assert [near[c] for c in same] == [exact[c] for c in same]
    a = text_length_stats(df, "text", ["generated"]).orderBy("generated").collect()
    b = text_length_stats(df, "text", ["generated"], approximate=True).orderBy("generated").collect()
    for x, y in zip(a, b):
        assert (x.n, x.min, x.max) == (y.n, y.min, y.max) and abs(x.median - y.median) <= 1
        assert np.isclose(x["mean"], y["mean"]) and np.isclose(x["std"], y["std"])


def test_empty_rows_and_empty_table(spark):
    texts = spark.createDataFrame([("", ""), ("a", ""), (None, "")], "a string, b string")
    assert quality.check_quality(texts).first().empty_rows == 1
    empty = verdicts(good(spark).limit(0))
    assert not empty["data_quality"] and not empty["text_content"] and not empty["summary"]
    assert quality.check_quality(good(spark).limit(0)).first().quality_score is None
    labels = {r.label: (r.status, r.passed) for r in quality.check_labels(good(spark).where("generated = 0")).collect()}
    assert labels == {0: ("expected", True), 1: ("missing", True)}


def test_config_ranges():
    for bad in (
        lambda: CorpusConfig(min_length=9, max_length=9), lambda: QualityConfig(max_null_fraction=2),
        lambda: SplitConfig(0.6, 0.5), lambda: ScoreConfig(batch_size=0),
    ):
        with pytest.raises(ValueError):
            bad()


def test_corpus_job_reuses_its_stages(spark, tmp_path):
    source, base = str(tmp_path / "raw"), str(tmp_path / "out")
    rows = [(i, f"{'human' if i % 3 else 'gpt'} text number {i} " + "word " * 10, "human" if i % 3 else "gpt") for i in range(400)]
    raw = spark.createDataFrame(rows, "k bigint, text string, source string")
    raw.write.parquet(source)
    built = C.corpus_job(spark, source, base, "k")
    assert {r["generated"]: r["count"] for r in built.groupBy("generated").count().collect()} == {0: 134, 1: 134}
    again = C.corpus_job(spark, source, base, "k")
    assert again.inputFiles() == built.inputFiles()
    other = C.corpus_job(spark, source, base, "k", CorpusConfig(balance=False))
    assert other.count() == 400 and other.inputFiles() != built.inputFiles()
    with pytest.raises(ValueError, match="class_distribution"):
        C.corpus_job(spark, source, base, "k", sample=50)
    raw.limit(1).write.mode("append").parquet(source)
    assert C.corpus_job(spark, source, base, "k").inputFiles() != built.inputFiles()


# ---- sources and sinks ----

AWKWARD = [(1, 'say "hi"\n, ok'), (2, ""), (3, None), (4, " padded\t"), (5, "back\\slash"), (6, "a\r\nb"), (7, "é,ü"), (8, '"')]


def test_csv_roundtrip(spark, tmp_path):
    df = spark.createDataFrame(AWKWARD, "k int, t string")
    path = writers.write_table(df, str(tmp_path / "t.csv"))
    back = {r.k: r.t for r in readers.read_table(spark, path, "k int, t string").collect()}
    assert {k: back[k] for k, t in AWKWARD if t} == {k: t for k, t in AWKWARD if t}
    assert not back[2] and not back[3]  # CSV itself has one way to write both


def test_parquet_split_and_summary(spark, tmp_path):
    df = spark.createDataFrame([(1, "train"), (2, "test")], "k int, split string")
    path = writers.write_split(df, str(tmp_path / "s"))
    assert [r.k for r in readers.read_export(spark, path, "split=test").collect()] == [2]
    writers.write_summary(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    assert {r.size > 0 for r in inventory.list_files(spark, path, "*.parquet").collect()} == {True}


def test_missing_file_falls_back_to_the_folder(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "c" / "part.parquet"))
    spark.range(4).coalesce(1).write.parquet(str(tmp_path / "d"))
    assert readers.read_corpus(spark, str(tmp_path / "c"), "part.parquet").count() == 3
    assert readers.read_corpus(spark, str(tmp_path / "d"), "absent.parquet").count() == 4
    with pytest.raises(ValueError):
        readers.read_table(spark, "x.xlsx")
    with pytest.raises(ValueError, match="text"):
        readers.require_columns(spark.range(1), "text")


def test_stage_cache(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return spark.range(len(built))

    def read(**params):
        return stage_cache.cached_stage(spark, str(tmp_path), "s", params, build).count()

    assert [read(a=1), read(a=1), read(a=2), read(a=1)] == [1, 1, 2, 1] and len(built) == 2
    # Data without its marker is an interrupted stage.
    path = stage_cache.stage_path(str(tmp_path), "s", {"a": 3})
    spark.range(9).write.parquet(path)
    assert read(a=3) == 3


def test_snapshot_diff(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "d")], "k int, t string")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (3, None), (5, "e")], "k int, t string")
    diff = inventory.snapshot_diff(old, new, "k")
    assert {r.k: r.status for r in diff.collect()} == {1: "unchanged", 2: "changed", 3: "unchanged", 4: "removed", 5: "added"}
    assert tuple(inventory.apply_diff(diff).first()) == (2, 2, 0)
    assert tuple(inventory.apply_diff(diff, delete_extra=True).first()) == (2, 2, 1)


# ---- scoring ----


def predictor(log=None):
    def load():
        def predict(texts):
            if any("boom" in t for t in texts):
                raise RuntimeError("cannot score")
            return [[0.2, 0.8] if "ai" in t else [0.9, 0.1] for t in texts]

        return predict

    return load


def test_scoring_isolates_bad_rows(spark):
    texts = ["simple", "  ai   text ", "boom " + "x" * 200, None, ""] + ["filler"] * 70
    df = spark.createDataFrame(list(enumerate(texts)), "k int, text string").coalesce(1)
    rows = {r.k: r for r in scoring.score_texts(df, predictor(), ScoreConfig(batch_size=8)).collect()}
    assert len(rows) == len(texts)
    assert (rows[0].prediction, rows[0].prediction_label, rows[0].confidence) == (0, "human", 0.9)
    assert (rows[1].prediction_label, rows[1].original_text_length, rows[1].processed_text_length) == ("ai", 12, 7)
    assert rows[2].processing_error and rows[2].error_message == "cannot score" and rows[2].prediction is None
    assert rows[2].error_text == ("boom " + "x" * 95) + "..."
    assert rows[3].processing_error and rows[3].error_message == "text is null"
    assert not rows[4].processing_error and rows[0].inference_time > 0
    row = scoring.scoring_summary(scoring.score_texts(df, predictor())).first()
    assert (row.n_total, row.n_errors, row.n_successful) == (75, 2, 73)
    wrong = scoring.score_texts(df.where("k < 2"), lambda: lambda texts: [[1.0, 0.0]] * 3).collect()
    assert {r.error_message for r in wrong} == {"the predictor must return one row of probabilities per text"}


def test_score_file(spark, tmp_path):
    df = spark.createDataFrame([(1, "ai, here"), (2, "line\nbreak")], "k int, text string")
    source = writers.write_csv(df, str(tmp_path / "in.csv"))
    target = score_file(spark, source, predictor(), schema="k int, text string")
    assert target == predictions_path(source) == str(tmp_path / "in_predictions.csv")
    lines = spark.read.options(**readers.CSV_OPTIONS, multiLine=True).csv(target)
    assert lines.count() == 2 and "prob_ai" in lines.columns
    with pytest.raises(ValueError):
        score_file(spark, source, predictor(), schema="k int, words string", config=ScoreConfig(text="body"))


def test_only_the_text_goes_to_python(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = scoring.score_texts(docs, predictor())._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "MapInPandas" not in plan


# ---- training ----


def separable(spark, n=240):
    rows = [(i, f"{'alpha beta' if i % 3 else 'gamma delta'} common word{i % 7}", int(i % 3 == 0)) for i in range(n)]
    return spark.createDataFrame(rows, "k bigint, text string, generated int")


def test_training_learns_and_never_reads_the_test_rows(spark):
    config = TrainConfig(features=1 << 10, max_iter=10, reg_ladder=(0.1, 0.01, 0.001), patience=1)
    fitted, rows = train_and_score(separable(spark), "text", "generated", "k", config)
    test = scored_table(rows.where("split = 'test'"), "generated").collect()
    assert len(test) == 36 + 0 * len(fitted.history) and all(r.label == r.prediction for r in test)
    assert len(fitted.history) == 2  # no gain in the second step ends the search
    poisoned = rows.select("k", "text", "generated", "split").withColumn(
        "text", F.when(F.col("split") == "test", F.raise_error(F.lit("read"))).otherwise(F.col("text"))
    )
    assert train(poisoned, "text", "generated", config).history == fitted.history


def test_training_job(spark, tmp_path):
    config = TrainConfig(features=1 << 10, max_iter=10, reg_ladder=(0.01,))
    values, verdict = training_job(separable(spark), str(tmp_path), "text", "generated", "k", config)
    assert {r.metric: r.value for r in values.collect()}["f1"] == 1.0
    assert verdict.first().n_issues == 0
    model = load_model(str(tmp_path))
    new = spark.createDataFrame([(1, "gamma delta")], "k int, text string")
    assert scoring.score_with_model(new, model).first().prediction_label == "ai"


def test_model_scores_like_the_batch_columns(spark):
    config = TrainConfig(features=1 << 10, max_iter=5, reg_ladder=(0.01,))
    fitted, _ = train_and_score(separable(spark), "text", "generated", "k", config)
    new = spark.createDataFrame([(1, "gamma delta"), (2, None)], "k int, text string")
    rows = {r.k: r for r in scoring.score_with_model(new, fitted.model).collect()}
    assert rows[1].prediction == 1 and np.isclose(rows[1].prob_ai + rows[1].prob_human, 1)
    assert rows[2].processing_error and rows[2].prediction is None


# ---- streams ----


def test_stream_equals_batch_over_several_triggers(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    df = spark.createDataFrame([(i, "ai words here" if i % 4 else "no") for i in range(40)], "k int, text string")

    def run():
        stream = streams.read_stream(spark, source, df.schema, files_per_batch=1)
        query = streams.write_stream(
            streams.score_stream(stream, predictor()), target, str(tmp_path / "cp"), once=True
        )
        query.awaitTermination()

    shown = ["k", "input_status", "prediction", "confidence", "processing_error"]
    df.where("k < 20").repartition(3).write.parquet(source)
    run()
    df.where("k >= 20").repartition(2).write.mode("append").parquet(source)
    run()  # goes on after the first run: no row twice
    got = sorted(tuple(r) for r in readers.read_folder(spark, target).select(*shown).collect())
    assert got == sorted(tuple(r) for r in streams.score_stream(df, predictor()).select(*shown).collect())


def test_late_rows_are_dropped(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")

    def write(*minutes):
        day = datetime.datetime(2024, 1, 1)
        rows = [(day + datetime.timedelta(minutes=m), float(m), m == 1) for m in minutes]
        spark.createDataFrame(rows, "ts timestamp, value double, failed boolean").coalesce(1).write.mode("append").parquet(source)

    def run():
        schema = spark.read.parquet(source).schema
        stats = streams.scoring_stats(streams.read_stream(spark, source, schema, files_per_batch=1), F.col("failed"))
        streams.write_stream(stats, target, str(tmp_path / "cp"), once=True).awaitTermination()
        return {r.window_start.hour: (r.n_total, r.n_errors, r.mean_time) for r in readers.read_folder(spark, target).collect()}

    write(0, 1, 59, 130)
    assert run() == {0: (3, 1, 29.5)}
    write(30, 200)  # minute 30 is behind the watermark of 2:00
    assert run() == {0: (3, 1, 29.5), 2: (1, 0, 130.0)}


def test_stream_reads_a_table_of_part_files(spark, tmp_path):
    df = spark.createDataFrame([(i, f"some words {i}") for i in range(30)], "k int, text string")
    df.repartition(3).write.parquet(str(tmp_path / "in" / "documents.parquet"))
    df.withColumn("k", -F.col("k") - 1).write.parquet(str(tmp_path / "in" / "others.parquet"))
    stream = streams.read_table_stream(spark, str(tmp_path / "in"), "documents.parquet", df.schema, files_per_batch=1)
    streams.write_stream(stream, str(tmp_path / "out"), str(tmp_path / "cp"), once=True).awaitTermination()
    assert sorted(r.k for r in readers.read_folder(spark, str(tmp_path / "out")).collect()) == list(range(30))


def test_stream_score_on_a_table_of_part_files(spark, sf, tmp_path):
    from textgauge.catalog import load

    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(60)
    docs.repartition(4).write.parquet(str(tmp_path / "documents.parquet"))
    rows = load()[0]["stream_score"](spark, str(tmp_path))
    assert sorted(r.doc_id for r in rows.collect()) == sorted(r.doc_id for r in docs.collect())
