"""Large CSV files with line breaks inside quoted fields, read by many tasks.

Spark cuts a text file into byte ranges at line ends, but a line may lie inside a quoted field.  Whether it does follows
from the number of quotes before it: a first pass counts the quotes of every range, a running sum over the ranges of a
file (a row per range) tells each how it begins, and a second pass joins lines to records where the count is even.  Only
what lies across a border of two ranges is shuffled, at most two pieces per range.  Records are then parsed by Spark.

Quotes must only enclose fields or stand doubled inside them, as in RFC 4180: a single quote mark inside an unquoted
field turns the rest of the file inside out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from textgauge.sources.readers import CSV_OPTIONS

WHOLE, HEAD, TAIL, TITLE = 0, 1, 2, 3
PIECES = "file string, start long, kind int, text string"


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the file and the first byte of the range they belong to; a range is read in order by one task."""
    lines = spark.read.text(path, lineSep="\n")
    return lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))


def _ranges(lines: DataFrame) -> DataFrame:
    """``file, start, odd``: whether an odd number of quotes stands before each range."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counts = lines.groupBy("file", "start").agg((F.sum(quotes) % 2).alias("_odd"))
    before = F.sum("_odd").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    return counts.select("file", "start", (F.coalesce(before, F.lit(0)) % 2).cast("int").alias("odd"))


def _joined(odd: dict[tuple[str, int], int]):
    """Whole records of a range; what precedes its first record border is a head, what follows the last one a tail."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = {}

        def piece(kind: int, text: str) -> tuple:
            return (*state["range"], kind, text)

        def end() -> list[tuple]:
            if not state or not state["held"]:
                return []
            # A range without any border is one head: its end belongs to whatever is open before it.
            return [piece(HEAD if state["head"] else TAIL, "\n".join(state["held"]))]

        def rows(found: list[tuple]) -> pa.RecordBatch:
            columns = zip(*found) if found else ((), (), (), ())
            kinds = (pa.string(), pa.int64(), pa.int32(), pa.string())
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["file", "start", "kind", "text"])

        for batch in batches:
            values, found = batch.column(0).to_pylist(), []
            quotes = pc.count_substring(batch.column(0), '"').to_numpy(zero_copy_only=False)
            files, starts = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            edges = [0, *[i for i in range(1, len(values)) if starts[i] != starts[i - 1] or files[i] != files[i - 1]], len(values)]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                if state.get("range") != (files[a], starts[a]):
                    found += end()
                    begins = odd[files[a], starts[a]]
                    state = {"range": (files[a], starts[a]), "inside": begins, "head": bool(begins), "title": starts[a] == 0, "held": []}
                open_after = (np.cumsum(quotes[a:b]) + state["inside"]) % 2
                for value, inside in zip(values[a:b], open_after.tolist(), strict=True):
                    state["held"].append(value)
                    if not inside:
                        kind = TITLE if state["title"] else HEAD if state["head"] else WHOLE
                        found.append(piece(kind, "\n".join(state["held"])))
                        state["held"], state["head"], state["title"] = [], False, False
                state["inside"] = int(open_after[-1])
            yield rows(found)
        yield rows(end())

    return run


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """``text``: the raw records of all files of a path, without the first one of each, the header.

    The header must lie in the first range.  The records across borders are found in a pass of their own.
    """
    lines = _lines(spark, path)
    # One small number per range of some 128 MB.
    odd = {(r["file"], r["start"]): r["odd"] for r in _ranges(lines).collect()}
    pieces = lines.mapInArrow(_joined(odd), PIECES)
    # A record across borders: a tail, then the heads of the ranges behind it up to the next record border.
    cut = pieces.where(F.col("kind").isin(HEAD, TAIL))
    order = Window.partitionBy("file").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    cut = cut.withColumn("_record", F.max(F.when(F.col("kind") == TAIL, F.col("start"))).over(order))
    parts = F.array_sort(F.collect_list(F.struct("start", "text")))
    across = cut.groupBy("file", "_record").agg(parts.alias("_p")).select(F.array_join("_p.text", "\n").alias("text"))
    return pieces.where(F.col("kind") == WHOLE).select("text").unionByName(across)


def read_csv_ranges(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """CSV with a header line in every file and quoted fields that may hold line breaks, cut into byte ranges.

    The same rows as the ``multiLine`` reader of ``read_csv``, but a file of any size is read by as many tasks as it has
    ranges, and line breaks inside fields stay as they are.  Blank lines between records are no rows.
    """
    kind = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kind)
    options = {"quote": CSV_OPTIONS["quote"], "escape": CSV_OPTIONS["escape"], "emptyValue": ""}
    record = F.regexp_replace("text", r"\r\z", "")
    rows = read_records(spark, path).where(F.length(F.trim(record)) > 0)
    return rows.select(F.from_csv(record, ddl, options).alias("r")).select("r.*")
