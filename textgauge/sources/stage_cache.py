"""Stage outputs that are reused while their parameters and inputs stay the same.

A stage's fingerprint covers its own parameters and the fingerprints of the stages it reads, so a change anywhere
upstream gives every later stage a new folder, and nothing stale is read.  Results that add up, such as counts, are kept
per input file: a file that is added is measured alone.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from urllib.parse import urlsplit

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgauge.functions.digests import fingerprint
from textgauge.sources.inventory import list_files


@dataclass(frozen=True)
class Stage:
    """A step of a job: its name, what shapes it, and what it reads (stages, or mappings that describe a source)."""

    base: str
    name: str
    params: Mapping
    inputs: tuple = ()

    def fingerprint(self) -> str:
        read = [i.fingerprint() if isinstance(i, Stage) else fingerprint(i) for i in self.inputs]
        return fingerprint({"stage": self.name, "params": dict(self.params), "inputs": read} if read else self.params)

    @property
    def path(self) -> str:
        return f"{self.base.rstrip('/')}/{self.name}/fp={self.fingerprint()}"

    def note(self) -> str:
        """What the mark says: parameters, and the fingerprints of the inputs."""
        read = [{"stage": i.name, "fingerprint": i.fingerprint()} if isinstance(i, Stage) else dict(i) for i in self.inputs]
        return json.dumps({**self.params, **({"inputs": read} if read else {})}, sort_keys=True, default=str)


def stage_path(base: str, stage: str, params: Mapping) -> str:
    """The folder of a stage output; every parameter of the stage is part of the fingerprint."""
    return Stage(base, stage, params).path


def is_complete(spark: SparkSession, path: str) -> bool:
    """The marker is written after the data is committed, so an interrupted stage has none."""
    try:
        return spark.read.text(f"{path}.done").limit(1).count() == 1
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return False


def complete(spark: SparkSession, stage: Stage, write: Callable[[str], object]) -> str:
    """The folder of a stage, after ``write(folder)`` filled it if it wasn't there yet."""
    if not is_complete(spark, stage.path):
        write(stage.path)
        spark.createDataFrame([(stage.note(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{stage.path}.done")
    return stage.path


def run_stage(spark: SparkSession, stage: Stage, build: Callable[[], DataFrame]) -> DataFrame:
    """Read the stage's table, building and writing it first if need be."""
    return spark.read.parquet(complete(spark, stage, lambda path: build().write.mode("overwrite").parquet(path)))


def cached_stage(
    spark: SparkSession, base: str, stage: str, params: Mapping, build: Callable[[], DataFrame]
) -> DataFrame:
    """Read the stage output for these parameters, building and writing it first if need be."""
    return run_stage(spark, Stage(base, stage, params), build)


def _tables(files: DataFrame, folder: str) -> DataFrame:
    """``path`` of every listed file and ``file_id``: that of its own path, size and time, or of all parts of its table."""
    inside = re.escape(urlsplit(folder).path.rstrip("/")) + r"/(?:[^/]+/)*?[^/]+\.parquet(?=/)"
    own = F.concat_ws("|", "path", "size", F.unix_micros("modified"))
    # The table's folder, or the file's own path.
    table = F.regexp_extract("path", f"^.*?{inside}", 0)
    files = files.select("path", F.when(table == "", F.col("path")).otherwise(table).alias("_table"), own.alias("_own"))
    known = files.groupBy("_table").agg(F.sha2(F.array_join(F.sort_array(F.collect_list("_own")), "\n"), 256).alias("file_id"))
    return files.join(F.broadcast(known), "_table").select("path", "file_id")


def per_file(
    spark: SparkSession, folder: str, stage: Stage, measure: Callable[[DataFrame], DataFrame], pattern: str = "*.parquet"
) -> DataFrame:
    """Partial results of all present files of a folder, each with ``file_id``; only files not measured before are read.

    ``measure`` turns the rows of some files, with their ``file_id``, into partial results that keep it, and which the
    caller adds up over files.  A file is known by path, size and time: a changed one is measured anew, and results of
    files that are gone are left out.  A folder ``name.parquet`` of part files is one file, known by all of its parts, so a
    large file is written and read by many tasks.  Rounds are numbered by what was known before, so a repeated one overwrites itself.
    """
    files = _tables(list_files(spark, folder, pattern), folder)
    rounds = 0
    while is_complete(spark, f"{stage.path}/round={rounds}"):
        rounds += 1
    done = [f"{stage.path}/round={i}" for i in range(rounds)]
    if done:
        known = spark.read.parquet(*[f"{d}/files" for d in done])
        files_new = files.join(known.select("file_id"), "file_id", "left_anti")
    else:
        files_new = files
    paths = {r["path"]: r["file_id"] for r in files_new.collect()}  # names of new files only
    if paths:
        here = f"{stage.path}/round={rounds}"
        spark.createDataFrame([(i, p) for p, i in paths.items()], "file_id string, path string").write.mode("overwrite").parquet(f"{here}/files")
        rows = spark.read.parquet(*paths).withColumn("_path", F.col("_metadata.file_path"))
        names = spark.read.parquet(f"{here}/files").select(F.col("path").alias("_path"), "file_id")
        measure(rows.join(F.broadcast(names), "_path").drop("_path")).write.mode("overwrite").parquet(f"{here}/parts")
        spark.createDataFrame([(stage.note(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{here}.done")
        done.append(here)
    if not done:
        raise ValueError(f"no files {pattern} at {folder}")
    parts = spark.read.parquet(*[f"{d}/parts" for d in done])
    return parts.join(F.broadcast(files.select("file_id").distinct()), "file_id", "left_semi")
