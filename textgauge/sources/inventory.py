"""What files make up a dataset, and how two versions of a table differ."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textgauge.functions.digests import names, row_digest


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Path, size and time of every file below a folder; contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", True)
        .load(folder)
    )
    return files.select("path", F.col("length").alias("size"), F.col("modificationTime").alias("modified"))


def listing(spark: SparkSession, path: str) -> dict:
    """What tells one state of a table's Parquet files from another: number, bytes, latest time, a digest of all."""
    files = list_files(spark, path, "*.parquet")
    found = files.agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("size").alias("bytes"),
        F.max("modified").alias("latest"),
        F.bit_xor(F.xxhash64("path", "size", "modified")).alias("digest"),
        F.sum(F.xxhash64("modified", "size", "path").cast("decimal(38, 0)")).alias("total"),
    ).first()
    if not found["files"]:
        raise ValueError(f"no Parquet files at {path}")
    return found.asDict()


def snapshot_diff(old: DataFrame, new: DataFrame, key, columns: Sequence[str] | None = None) -> DataFrame:
    """Per key: added, changed, unchanged or removed.  Only keys and row digests are shuffled."""
    cols = names(key)
    compared = list(columns or [c for c in new.columns if c not in cols])
    before = old.select(*cols, row_digest(old, compared).alias("_old"))
    after = new.select(*cols, row_digest(new, compared).alias("_new"))
    status = (
        F.when(F.col("_old").isNull(), "added")
        .when(F.col("_new").isNull(), "removed")
        .when(F.col("_old") == F.col("_new"), "unchanged")
        .otherwise("changed")
    )
    return before.join(after, cols, "full_outer").select(*cols, status.alias("status"))


def apply_diff(diff: DataFrame, delete_extra: bool = False) -> DataFrame:
    """How many rows a synchronisation would upload, skip and delete."""
    removed = F.count_if(F.col("status") == "removed")
    return diff.agg(
        F.count_if(F.col("status").isin("added", "changed")).alias("uploaded"),
        F.count_if(F.col("status") == "unchanged").alias("skipped"),
        (removed if delete_extra else F.lit(0)).cast("bigint").alias("deleted"),
    )
