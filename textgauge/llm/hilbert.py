"""Sharding along a Hilbert curve: rows near each other in several metadata columns share a file.

Every dimension is quantised to ``bits`` bits, the cells are numbered along a Hilbert curve, rows are sorted
by that number and the sorted table is cut into runs.  A run covers a compact box of cells, and cells follow the order
of a dimension's values, so a filter on any of the dimensions skips files by their minimum and maximum.  Built-in
expressions only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textgauge.llm.tables import narrow, ranked, stored, text_bytes

BITS = 5
FINE = 64


def with_category_cells(rows: DataFrame, column: str, name: str, bits: int = BITS) -> DataFrame:
    """Add the cell of a category: its rank among the sorted values, spread evenly over the cells.

    Values keep their order along the axis, so the least and largest value of a run of cells say what it can hold.  A null
    has the cell of the empty string.  The ranks are a stored table with a row per value, joined as its size asks for.
    """
    value = F.coalesce(F.col(column).cast("string"), F.lit(""))
    values, total = ranked(rows.select(value.alias("_value")).distinct(), [F.col("_value")], "curve-categories")
    cell = F.expr(f"rank * {1 << bits} div {max(total, 1)}").cast("long")
    cells = stored(values.select("_value", cell.alias(name)), "curve-cells")
    return rows.join(cells, value == cells["_value"]).drop("_value")


def with_size_cells(rows: DataFrame, column: str, name: str, bits: int = BITS) -> DataFrame:
    """Add the cell of a count: cells hold about equal numbers of rows and keep the order of the values.

    Counts are first told apart on a logarithmic scale of ``FINE`` steps a doubling, at most ``64 * FINE`` of them; a null
    counts as 0.
    """
    value = F.greatest(F.coalesce(F.col(column), F.lit(0)).cast("long"), F.lit(0).cast("long"))
    fine = F.floor(F.log2(value + F.lit(1.0)) * FINE).cast("int")
    counts = rows.select(fine.alias("_fine")).groupBy("_fine").agg(F.count(F.lit(1)).alias("_n"))
    # A row per step of the scale, hence few in one window.
    before = F.sum("_n").over(Window.orderBy("_fine").rowsBetween(Window.unboundedPreceding, -1))
    total = F.sum("_n").over(Window.orderBy("_fine").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    counts = counts.select("_fine", F.coalesce(before, F.lit(0)).alias("_before"), total.alias("_total"))
    cells = stored(counts.select("_fine", F.expr(f"_before * {1 << bits} div _total").cast("long").alias(name)), "curve-cells")
    return rows.join(cells, fine == cells["_fine"]).drop("_fine")


def with_curve_index(df: DataFrame, axes: list[str], name: str = "curve_index", bits: int = BITS) -> DataFrame:
    """Add the position of the cell ``axes`` (longs below ``2 ** bits``) along the Hilbert curve.

    Skilling's transform: undo the reflections and exchanges from the highest bit down, Gray-encode, then
    interleave.  Each step is a projection of its own, so that Spark doesn't nest one step into the next.
    """
    n, x = len(axes), [f"_x{i}" for i in range(len(axes))]
    kept = [F.col(c) for c in df.columns]
    out = df.select(*kept, *[F.col(a).alias(t) for a, t in zip(axes, x, strict=True)])
    for level in range(bits - 1, 0, -1):
        below = (1 << level) - 1
        for i in range(n):
            first, own = F.col(x[0]), F.col(x[i])
            is_set = own.bitwiseAND(F.lit(1 << level)) != 0
            swap = first.bitwiseXOR(own).bitwiseAND(F.lit(below))
            new = {x[0]: F.when(is_set, first.bitwiseXOR(F.lit(below))).otherwise(first.bitwiseXOR(swap))}
            if i:
                new[x[i]] = F.when(is_set, own).otherwise(own.bitwiseXOR(swap))
            out = out.select(*kept, *[new.get(t, F.col(t)).alias(t) for t in x])
    for i in range(1, n):
        out = out.withColumn(x[i], F.col(x[i]).bitwiseXOR(F.col(x[i - 1])))
    flip = F.lit(0).cast("long")
    for level in range(bits - 1, 0, -1):
        low = F.lit((1 << level) - 1).cast("long")
        flip = flip.bitwiseXOR(F.when(F.col(x[-1]).bitwiseAND(F.lit(1 << level)) != 0, low).otherwise(F.lit(0)))
    out = out.withColumn("_flip", flip)
    index = F.lit(0).cast("long")
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            bit = F.shiftright(F.col(x[i]).bitwiseXOR(F.col("_flip")), level).bitwiseAND(F.lit(1))
            index = index + F.shiftleft(bit, level * n + n - 1 - i)
    return out.select(*kept, index.alias(name))


def shard_by_curve(
    docs: DataFrame,
    dimensions: Mapping[str, str] | None = None,
    shards: int = 24,
    bits: int = BITS,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Shard and slot of every row along the curve; shard counts differ by one row at most.

    ``dimensions`` maps columns to ``category`` or ``size`` (default: language, source and text bytes).
    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard, curve_index``.  ``size`` is the text's
    bytes plus 8, a null text counts as empty; a null category has the empty string's cell.  Equal cells are
    ordered by the text's checksum and the key, so copies of a text with the same metadata are neighbours;
    a large group is cut like any run.  Null keys come first; rows equal in all columns are each kept, in any
    order among themselves.  An empty table gives no rows.  ``grown_shard`` is null: the law is ``rows``.
    """
    dimensions = {"lang": "category", "source": "category", "_size": "size"} if dimensions is None else dimensions
    given = {f"_d{i}": c for i, c in enumerate(dimensions) if c != "_size"}
    rows = narrow(docs, {"doc_id": key, "_text": text, **given})
    size = text_bytes("_text")
    crc = F.crc32(F.coalesce("_text", F.lit("")).cast("binary")).alias("text_crc32")
    cells = rows.select("doc_id", (size + 8).alias("size"), crc, *given)
    names = [f"_a{i}" for i in range(len(dimensions))]
    for i, (column, kind) in enumerate(dimensions.items()):
        if kind == "category":
            cells = with_category_cells(cells, f"_d{i}", f"_a{i}", bits)
        else:
            cells = with_size_cells(cells, "size" if column == "_size" else f"_d{i}", f"_a{i}", bits)
    cells = cells.select("doc_id", "size", "text_crc32", *names)
    placed = with_curve_index(cells, names, bits=bits).drop(*names)
    out, total = ranked(placed, [F.col(c) for c in ("curve_index", "text_crc32", "doc_id")], "curve-order")
    # Row r lies in shard s if floor(s * total / shards) <= r, so the first row of a shard is known exactly.
    shard = F.expr(f"((rank + 1) * {shards} - 1) div {max(total, 1)}")
    return out.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        shard.cast("int").alias("shard"),
        (F.col("rank") - F.expr(f"(((rank + 1) * {shards} - 1) div {max(total, 1)}) * {total} div {shards}")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "curve_index",
    )


def write_shards(docs: DataFrame, plan: DataFrame, path: str, key: str = "doc_id") -> None:
    """Write whole rows as one folder per shard, sorted along the curve; ``key`` must be unique here.

    The shard is spread over as many tasks as its size asks for: rows are dealt by shard and a range of slots.
    """
    placed = docs.join(plan.select(F.col("doc_id").alias(key), "shard", "slot"), key)
    dealt = placed.repartition("shard", F.expr("slot div 1000000"))
    dealt.sortWithinPartitions("shard", "slot").drop("slot").write.partitionBy("shard").parquet(path)
