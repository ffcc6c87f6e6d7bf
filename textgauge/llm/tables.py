"""Helpers that the operators share: narrow inputs, stored stages, global positions."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import textgauge

from textgauge.session import scratch_path

#: Longs of 64 marks each that say which keys some rows have: 32 MB for a join at most, and of six million keys a sixth of all marks.
MARKS = 1 << 19
_shipped: set[str] = set()
#: In a worker: how to drop what each operator keeps between tasks.
_kept: dict[str, Callable[[], None]] = {}


def ship(spark: SparkSession) -> None:
    """Give this package to the tasks of a session, whatever folder it was started in; done once a session.

    Spark itself carries the archive to the executors; the driver's copy is only its source.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(textgauge.__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="textgauge-code-"), "textgauge.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for folder, _, files in os.walk(root):
            for name in sorted(f for f in files if f.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, os.path.dirname(root)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def keeps(operator: str, drop: Callable[[], None]) -> None:
    """Say how to drop what an operator keeps in a worker from task to task."""
    _kept[operator] = drop


def working(operator: str) -> None:
    """Called by a task of an operator: a worker that served others before drops what they kept."""
    import pyarrow as pa

    for other, drop in _kept.items():
        if other != operator:
            drop()
    pa.default_memory_pool().release_unused()


def narrow(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Only the named columns, under the operator's own names: further columns can't clash."""
    return df.select(*[F.col(f"`{old}`").alias(new) for new, old in columns.items()])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the folder all executors share and read again: a cut that a lost executor can't undo."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_bytes(text: str = "text") -> Column:
    return F.octet_length(F.coalesce(F.col(text), F.lit(""))).cast("long")


def ranked(df: DataFrame, order: list[Column], name: str) -> tuple[DataFrame, int]:
    """``rank`` (long, from 0) of every row in the given order, and the number of rows.

    One range shuffle of the given columns; rows are numbered inside their range as they are stored, and a
    table with one row per range, hence of proven size, supplies the offsets.
    """
    marked = stored(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftright("_at", 33)
    counts = marked.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    out = marked.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return out.withColumn("rank", F.col("_before") + inside).drop("_part", "_n", "_before", "_at"), total


def draw(seed: int, key: str) -> Column:
    """64 evenly spread bits of a row's key, as a signed long; a null key is like an empty one."""
    return F.xxhash64(F.lit(seed), F.coalesce(F.col(key).cast("string"), F.lit("")))


def below(drawn: Column, rate: Column) -> Column:
    """Whether a draw lies in the given share of all draws."""
    return (rate >= 1) | (drawn < (rate * float(1 << 64) - float(1 << 63)).cast("long"))


def met(rows: DataFrame, others: DataFrame, key: str) -> DataFrame:
    """Rows whose key is among the others', and few more: fewer rows to move before the two are joined by that key.

    A key sets one of ``64 * MARKS`` marks by its hash, and a row passes if its key's mark is set, so none is lost.  The marks
    are a table of ``MARKS`` rows at most however many keys there are; with very many keys more of the other rows pass.
    Keys of two types are left to the join.
    """
    if rows.schema[key].dataType != others.schema[key].dataType:
        return rows
    spot = F.pmod(F.xxhash64(key), F.lit(MARKS << 6))
    place = F.shiftright("_spot", 6).alias("_place")
    marks = others.select(spot.alias("_spot")).groupBy(place).agg(F.expr("bit_or(shiftleft(1L, int(_spot & 63)))").alias("_marks"))
    spots = rows.withColumn("_spot", spot)
    mine = F.expr("getbit(_marks, int(_spot & 63)) = 1")
    return spots.join(F.broadcast(marks), (F.shiftright("_spot", 6) == F.col("_place")) & mine, "left_semi").drop("_spot")


def sampled(rows: DataFrame, group: str, size: Column, each: float, total: float, drawn: Column, name: str) -> DataFrame:
    """Rows drawn so that every group holds about ``each`` at most and all together ``total``, measured by ``size``.

    The rate of a group follows from its size; the first row by draw is taken whatever the rate, so no group is without
    rows.  Rates are a stored table with a row per group, so a join with them is planned by its size.
    """
    marked = rows.withColumn("_draw", drawn)
    groups = marked.groupBy(F.col(group).alias("_group")).agg(F.sum(size).alias("_size"), F.min("_draw").alias("_least"))
    groups = stored(groups, name)
    many = groups.count()
    share = min(each, total / max(1, many))
    rates = groups.select("_group", F.least(F.lit(1.0), F.lit(share) / F.greatest("_size", F.lit(1))).alias("_rate"), "_least")
    out = marked.join(rates, F.col(group).eqNullSafe(F.col("_group")))
    return out.filter(below(F.col("_draw"), F.col("_rate")) | (F.col("_draw") == F.col("_least"))).drop("_group", "_rate", "_least", "_draw")
