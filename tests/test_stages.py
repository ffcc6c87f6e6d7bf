"""Chained stage fingerprints and partial results per file."""

import pytest
from pyspark.sql import functions as F

from textgauge.config import SplitConfig, TrainConfig
from textgauge.operators.vocabulary import class_words
from textgauge.plans import training
from textgauge.sources import stage_cache
from textgauge.sources.inventory import listing
from textgauge.sources.stage_cache import Stage


def corpus(spark, n=240):
    rows = [(i, f"{'alpha beta' if i % 3 else 'gamma delta'} common word{i % 7}", int(i % 3 == 0)) for i in range(n)]
    return spark.createDataFrame(rows, "k bigint, text string, generated int")


def test_a_fingerprint_covers_everything_before_it():
    a = Stage("b", "one", {"x": 1}, ({"files": 3},))
    assert Stage("b", "two", {}, (a,)).path == Stage("b", "two", {}, (Stage("b", "one", {"x": 1}, ({"files": 3},)),)).path
    others = [Stage("b", "one", {"x": 2}, ({"files": 3},)), Stage("b", "one", {"x": 1}, ({"files": 4},)), Stage("b", "uno", {"x": 1}, ({"files": 3},))]
    assert len({Stage("b", "two", {}, (s,)).path for s in [a, *others]}) == 4


def test_only_what_changed_is_built_again(spark, tmp_path, monkeypatch):
    source, base, built = str(tmp_path / "in"), str(tmp_path / "stages"), []
    corpus(spark).write.parquet(source)
    complete = stage_cache.complete

    def watched(spark, stage, write):
        return complete(spark, stage, lambda path: (built.append(stage.name), write(path)))

    monkeypatch.setattr(stage_cache, "complete", watched)
    monkeypatch.setattr(training, "complete", watched)

    def run(config):
        built.clear()
        rows = spark.read.parquet(source)
        model, scored = training.staged_training(rows, listing(spark, source), base, "text", "generated", "k", config)
        return list(built), scored.count()

    config = TrainConfig(features=1 << 8, max_iter=5, reg_ladder=(0.1,))
    assert run(config) == (["split", "tokens", "model", "scores"], 240)
    assert run(config) == ([], 240)
    assert run(TrainConfig(features=1 << 8, max_iter=5, reg_ladder=(0.01,)))[0] == ["model", "scores"]
    assert run(TrainConfig(features=1 << 8, max_iter=5, reg_ladder=(0.1,), max_tokens=3))[0] == ["tokens", "model", "scores"]
    other = TrainConfig(features=1 << 8, max_iter=5, reg_ladder=(0.1,), split=SplitConfig(seed=7))
    assert run(other)[0] == ["split", "tokens", "model", "scores"]
    corpus(spark, 12).withColumn("k", F.col("k") + 1000).write.mode("append").parquet(source)
    assert run(config) == (["split", "tokens", "model", "scores"], 252)


def test_training_job_by_fingerprint(spark, tmp_path):
    config = TrainConfig(features=1 << 10, max_iter=10, reg_ladder=(0.01,))
    for _ in range(2):
        values, verdict = training.training_job(corpus(spark), str(tmp_path), "text", "generated", "k", config, source={"version": 1})
        assert {r.metric: r.value for r in values.collect()}["f1"] == 1.0
        assert verdict.first().n_issues == 0


def counts_of(rows):
    return class_words(rows, "text", "file_id").groupBy("file_id", "word").agg(F.count(F.lit(1)).alias("n"))


def totals(parts):
    return {r.word: r.n for r in parts.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def test_an_added_file_is_measured_alone(spark, tmp_path):
    folder, stage, read = str(tmp_path / "in"), Stage(str(tmp_path / "out"), "words", {"v": 1}), []

    def measure(rows):
        read.append(rows.select("file_id").distinct().count())
        return counts_of(rows)

    corpus(spark, 90).repartition(3).write.parquet(folder)
    plain = {r.word: r.n for r in class_words(corpus(spark, 90), "text", "generated").groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert totals(stage_cache.per_file(spark, folder, stage, measure)) == plain
    assert totals(stage_cache.per_file(spark, folder, stage, measure)) == plain and read == [3]
    corpus(spark, 30).coalesce(1).write.mode("append").parquet(folder)
    more = {r.word: r.n for r in class_words(spark.read.parquet(folder), "text", "generated").groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert totals(stage_cache.per_file(spark, folder, stage, measure)) == more and read == [3, 1]
    # A file that is gone no longer counts.
    gone = next(p for p in (tmp_path / "in").glob("*.parquet"))
    gone.unlink()
    left = {r.word: r.n for r in class_words(spark.read.parquet(folder), "text", "generated").groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert totals(stage_cache.per_file(spark, folder, stage, measure)) == left and read == [3, 1]
    with pytest.raises(ValueError):
        stage_cache.per_file(spark, folder, Stage(str(tmp_path / "o2"), "w", {}), measure, "*.none")


def test_a_folder_of_part_files_is_one_file(spark, tmp_path):
    folder, stage, read = str(tmp_path / "in"), Stage(str(tmp_path / "out"), "words", {"v": 1}), []

    def measure(rows):
        read.append(rows.select("file_id").distinct().count())
        return counts_of(rows)

    def plain():
        rows = spark.read.option("recursiveFileLookup", True).parquet(folder)
        return {r.word: r.n for r in class_words(rows, "text", "generated").groupBy("word").agg(F.count(F.lit(1)).alias("n")).collect()}

    for name in ("a", "b"):
        corpus(spark, 60).repartition(3).write.parquet(f"{folder}/{name}.parquet")
    assert totals(stage_cache.per_file(spark, folder, stage, measure)) == plain() and read == [2]
    corpus(spark, 30).repartition(2).write.parquet(f"{folder}/c.parquet")
    assert totals(stage_cache.per_file(spark, folder, stage, measure)) == plain() and read == [2, 1]
    # A table that has one more part is measured anew, as a whole.
    corpus(spark, 30).repartition(2).write.mode("append").parquet(f"{folder}/b.parquet")
    assert totals(stage_cache.per_file(spark, folder, stage, measure)) == plain() and read == [2, 1, 1]
