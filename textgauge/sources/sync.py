"""Synchronising stored tables by digests: only key ranges that differ are read and rewritten.

A table is stored in ranges of its hashed keys, and next to it stands its digest tree: for each range the number of
rows, a digest that doesn't depend on their order, and the generation of files that holds them.  A synchronisation
compares the trees, descends to rows only in ranges whose digests differ, writes these as a new generation and then the
new tree.  Files are never overwritten: what the newest complete tree lists is the table, so a job that dies in between
leaves the former state, and a repeated one starts from it.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textgauge.functions.digests import names, row_digest
from textgauge.sources.inventory import apply_diff, list_files, snapshot_diff

RANGE = "_range"
TREE = "range int, generation int, n bigint, xor bigint, total decimal(38,0)"


@dataclass(frozen=True)
class SyncReport:
    uploaded: int
    skipped: int
    deleted: int
    ranges: int
    ranges_read: int


def _ranged(df: DataFrame, key, ranges: int) -> DataFrame:
    return df.withColumn(RANGE, F.pmod(F.xxhash64(*[F.col(c).cast("string") for c in names(key)]), F.lit(ranges)).cast("int"))


def digest_tree(rows: DataFrame) -> DataFrame:
    """``range, n, xor, total`` of rows that know their range; equal for equal rows in any order."""
    columns = [c for c in sorted(rows.columns) if c != RANGE]
    hashed = rows.select(F.col(RANGE).alias("range"), F.xxhash64(row_digest(rows, columns)).alias("_h"))
    total = F.sum(F.col("_h").cast("decimal(38,0)")).cast("decimal(38,0)")
    return hashed.groupBy("range").agg(F.count(F.lit(1)).alias("n"), F.bit_xor("_h").alias("xor"), total.alias("total"))


def newest(spark: SparkSession, path: str) -> int | None:
    """The last generation whose tree is complete; none where there is no table."""
    try:
        found = list_files(spark, f"{path}/done", "part-*").select(F.regexp_extract("path", r"generation=(\d+)", 1).cast("int").alias("g"))
        return found.agg(F.max("g")).first()[0]
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def read_tree(spark: SparkSession, path: str) -> DataFrame:
    """The tree of the newest complete generation."""
    generation = newest(spark, path)
    if generation is None:
        return spark.createDataFrame([], TREE)
    return spark.read.schema(TREE).parquet(f"{path}/tree/generation={generation}")


def _publish(tree: DataFrame, rows: DataFrame, path: str, generation: int) -> None:
    """Write the tree, then the mark that makes it count; the mark holds the table's schema."""
    tree.coalesce(1).write.mode("overwrite").parquet(f"{path}/tree/generation={generation}")
    done = tree.sparkSession.createDataFrame([(rows.schema.json(),)], "value string").coalesce(1)
    done.write.mode("overwrite").text(f"{path}/done/generation={generation}")


def _write_rows(rows: DataFrame, path: str, generation: int) -> DataFrame:
    """Rows by range, each range from one task; read again for their digests, so the tree says what the files hold."""
    folder = f"{path}/rows/generation={generation}"
    rows.repartition(RANGE).write.mode("overwrite").partitionBy(RANGE).parquet(folder)
    return rows.sparkSession.read.schema(rows.schema).parquet(folder)


def write_ranged(df: DataFrame, path: str, key, ranges: int = 256) -> str:
    """Store a table with its digest tree as a new generation of ``path``."""
    spark, generation = df.sparkSession, newest(df.sparkSession, path)
    generation = 0 if generation is None else generation + 1
    rows = _write_rows(_ranged(df, key, ranges), path, generation)
    tree = digest_tree(rows).select("range", F.lit(generation).alias("generation"), "n", "xor", "total")
    _publish(tree, rows, path, generation)
    return path


def read_ranged(spark: SparkSession, path: str, only: list[int] | None = None) -> DataFrame:
    """The newest rows with their range; ``only`` some ranges if given: the files of others are not opened."""
    generation = newest(spark, path)
    if generation is None:
        raise ValueError(f"no complete table at {path}")
    schema = T.StructType.fromJson(json.loads(spark.read.text(f"{path}/done/generation={generation}").first()[0]))
    tree = read_tree(spark, path)
    if only is not None:
        tree = tree.where(F.col("range").isin(only))
    out = None
    for row in tree.groupBy("generation").agg(F.array_sort(F.collect_list("range")).alias("ranges")).orderBy("generation").collect():
        part = spark.read.schema(schema).parquet(f"{path}/rows/generation={row['generation']}").where(F.col(RANGE).isin(row["ranges"]))
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def changed_ranges(source: DataFrame, target: DataFrame) -> DataFrame:
    """Ranges whose digests differ, ``range, n_source, n_target``."""
    sides = [t.select("range", F.struct("n", "xor", "total").alias(n)) for t, n in ((source, "_s"), (target, "_t"))]
    both = sides[0].join(sides[1], "range", "full_outer").where(~F.col("_s").eqNullSafe(F.col("_t")))
    zero = F.lit(0).cast("bigint")
    return both.select("range", F.coalesce("_s.n", zero).alias("n_source"), F.coalesce("_t.n", zero).alias("n_target"))


def synchronise(spark: SparkSession, source: str, target: str, key, delete_extra: bool = False) -> SyncReport:
    """Make the stored table ``target`` equal to ``source``; without ``delete_extra`` its further rows stay.

    Both are tables of ``write_ranged`` with the same number of ranges.  What reaches the driver is the list of differing
    ranges, at most one number per range.
    """
    theirs, mine = read_tree(spark, source).cache(), read_tree(spark, target).cache()
    try:
        ranges = theirs.select("range").union(mine.select("range")).distinct().count()
        total = theirs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        differ = changed_ranges(theirs, mine).collect()
        listed = sorted(r["range"] for r in differ)
        unchanged = total - sum(r["n_source"] for r in differ)
        if not listed:
            return SyncReport(0, unchanged, 0, ranges, 0)
        cols, last = names(key), newest(spark, target)
        generation = 0 if last is None else last + 1
        after = read_ranged(spark, source, listed)
        before = after.limit(0) if last is None else read_ranged(spark, target, listed)
        counts = apply_diff(snapshot_diff(before.drop(RANGE), after.drop(RANGE), key), delete_extra).first()
        rows = after if delete_extra else after.unionByName(before.join(after.select(*cols), cols, "left_anti"))
        written = _write_rows(rows, target, generation)
        kept = mine.where(~F.col("range").isin(listed))
        tree = digest_tree(written).select("range", F.lit(generation).alias("generation"), "n", "xor", "total")
        _publish(kept.unionByName(tree), written, target, generation)
        return SyncReport(counts["uploaded"], unchanged + counts["skipped"], counts["deleted"], ranges, len(listed))
    finally:
        theirs.unpersist()
        mine.unpersist()
