"""Packing documents into token windows by non-negative least squares over the histogram of lengths.

Ids of a document are cut into whole windows and a remainder.  The remainders' histogram (one count per length,
whatever the corpus) is to be covered by strategies: combinations of at most three lengths that fill a window
exactly.  Non-negative least squares gives each strategy's repeat count, counts are rounded down, and what they
leave over is packed greedily, largest fitting length first, again on counts.  A document finds its place by
arithmetic on its rank among remainders of its length; ids are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textgauge.llm.tables import narrow, stored
from textgauge.llm.tokens import encode, tokenizer_path

WINDOW = 2048
END = 1


def strategies(window: int) -> np.ndarray:
    """Shallow ways to fill the window, as rows padded with zeros: some thousands whatever the corpus.

    One length, two lengths, or three: a pair of equal ones with any third, or two in a ratio of 2, 3 or 4.
    """
    one = [(window, 0, 0)]
    two = [(a, window - a, 0) for a in range(1, window // 2 + 1)]
    three = [(a, r * a, window - (1 + r) * a) for r in range(1, 5) for a in range(1, (window - 1) // (1 + r) + 1)]
    return np.array(one + two + three)


def solve(counts: np.ndarray, parts: np.ndarray, rounds: int = 1000) -> np.ndarray:
    """Repeats ``x >= 0`` of every strategy that minimise ``|A x - counts|``, by accelerated projected gradient.

    ``A`` counts how often a strategy uses a length; it is used through its at most three entries a column.
    The problem's size is set by the window alone.  Columns whose lengths don't all occur can't help and stay 0.
    """
    n = len(counts)
    target = counts.astype(float)
    target[0] = 0
    used = np.where(parts > 0, counts[parts] > 0, True).all(1)
    cols = parts[used]
    x = np.zeros(len(parts))
    if not len(cols):
        return x
    flat = cols.ravel()
    # A row's sum of uses bounds the step: |A|_1 is at most 3.
    uses = np.bincount(flat, minlength=n)
    uses[0] = 0
    step = 1.0 / (3 * max(1, uses.max()))
    own = np.zeros(len(cols))
    ahead, t = own.copy(), 1.0
    for _ in range(rounds):
        covered = np.bincount(flat, np.repeat(ahead, 3), n)
        covered[0] = 0
        over = covered - target
        over[0] = 0
        new = np.maximum(0, ahead - step * over[cols].sum(1))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - own)
        own, t = new, t_new
    x[used] = own
    return x


def plan(counts: np.ndarray, window: int = WINDOW) -> list[tuple[tuple[int, ...], int]]:
    """Windows as (lengths, repeats) that use every remainder of the histogram exactly once.

    Rounded repeats of the least-squares solution come first, largest first, each cut down to what is left of
    its lengths; then greedy windows.  Both work on counts, so the time doesn't follow the corpus.
    """
    left, out = counts.astype(np.int64).copy(), []
    left[0] = 0
    parts = strategies(window)
    repeats = np.floor(solve(left, parts) + 1e-9).astype(np.int64)
    for i in np.argsort(-repeats, kind="stable"):
        if not repeats[i]:
            break
        lengths = [int(p) for p in parts[i] if p]
        need = np.bincount(lengths)
        most = int(min(repeats[i], min(left[p] // need[p] for p in set(lengths))))
        if most > 0:
            out.append((tuple(lengths), most))
            left[: len(need)] -= most * need
    open_lengths = [int(p) for p in np.flatnonzero(left)]
    while open_lengths:
        lengths, room, need = [], window, {}
        i = len(open_lengths) - 1
        while i >= 0 and room:
            p = open_lengths[i]
            if p <= room and left[p] > need.get(p, 0):
                take = min(room // p, int(left[p]) - need.get(p, 0))
                lengths += [p] * take
                need[p] = need.get(p, 0) + take
                room -= take * p
            i = min(i - 1, int(np.searchsorted(open_lengths, room, "right")) - 1)
        most = min(int(left[p]) // k for p, k in need.items())
        out.append((tuple(lengths), most))
        for p, k in need.items():
            left[p] -= most * k
            if not left[p]:
                del open_lengths[int(np.searchsorted(open_lengths, p))]
    return out


def _pieces(path: str, window: int, end: int):
    schema = pa.schema(
        [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("doc_tokens", pa.int64()), ("ids", pa.binary())]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flushed(rows: list[list]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(rows, schema, strict=True)], schema=schema)

        for batch in batches:
            keys, rows, held = batch.column(0).to_pylist(), [[], [], [], [], []], 0
            for key, ids in zip(keys, encode((t.as_py() for t in batch.column(1)), path, end), strict=True):
                total = len(ids) // 4
                for start in range(0, total, window):
                    own = ids[4 * start : 4 * (start + window)]
                    for column, value in zip(rows, (key, start, len(own) // 4, total, own), strict=True):
                        column.append(value)
                    held += len(own)
                    if held > 2 << 20:
                        yield flushed(rows)
                        rows, held = [[], [], [], [], []], 0
            yield flushed(rows)

    return cut


def pack(
    docs: DataFrame,
    window: int = WINDOW,
    end: int = END,
    tokenizer: str | None = None,
    key: str = "doc_id",
    text: str = "text",
    cuts: int = 256,
    order: DataFrame | None = None,
    period: int = 100,
    range_tokens: int = 1 << 18,
) -> tuple[DataFrame, DataFrame]:
    """Cut all documents into pieces and give each a place in a sequence of at most ``window`` tokens.

    Returns two tables.  The pieces: ``piece_id, doc_id, start, length, doc_tokens, ids`` (little-endian unsigned
    32-bit), stored in the shared folder.  The places: ``piece_id, sequence_id, offset, filled`` (tokens in the
    sequence).  Sequence ids are unique; those of whole windows have gaps.

    A null or empty text is its end token alone.  A null key is kept.  Rows with equal keys are packed like
    others; ``piece_id`` tells their pieces apart.  An empty table gives two empty tables.

    ``order`` (``doc_id, slot, byte_start``, as ``mixing.mix`` returns) makes sequences follow a mixture: they are
    planned within consecutive ranges of its order, each of whole periods of slots and about ``range_tokens`` or one
    period, and numbered range by range, whole windows included.
    """
    rows = narrow(docs, {"doc_id": key, "_text": text}).select(F.col("doc_id").cast("long"), F.col("_text").cast("binary"))
    schema = "doc_id long, start long, length long, doc_tokens long, ids binary"
    cut = rows.mapInArrow(_pieces(tokenizer or tokenizer_path(), window, end), schema)
    pieces = stored(cut.withColumn("piece_id", F.monotonically_increasing_id()), "pack-pieces")
    if order is not None:
        return pieces, _in_order(pieces, order, window, period, range_tokens)
    layout = pieces.select("piece_id", "length")

    found = layout.filter(F.col("length") < window).groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    counts = np.zeros(window + 1, np.int64)  # at most one row per length
    for r in found:
        counts[r["length"]] = r["n"]
    slots, base = [], 0
    used = np.zeros(window + 1, np.int64)
    for lengths, repeats in plan(counts, window):
        offset = 0
        for p in lengths:
            slots.append((p, int(used[p]), base, offset, sum(lengths)))
            used[p] += repeats
            offset += p
        base += repeats

    # Rank among remainders of a length.  A length with a third of the rows is cut by a hash of the piece.
    short = layout.filter(F.col("length") < window)
    short = short.withColumn("_cut", F.pmod(F.xxhash64("piece_id"), F.lit(cuts)))
    parts = short.groupBy("length", "_cut").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("length").orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("length", "_cut", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("length", "_cut").orderBy("piece_id")
    short = short.withColumn("_in", F.row_number().over(inside) - 1).join(parts, ["length", "_cut"])
    short = short.select("piece_id", "length", (F.col("_before") + F.col("_in")).alias("_rank"))
    placed = short.mapInArrow(_placed(slots), "piece_id long, sequence_id long, offset long, filled long")
    full = layout.filter(F.col("length") == window).select(
        "piece_id",
        (F.lit(base) + F.col("piece_id")).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        F.lit(window).cast("long").alias("filled"),
    )
    return pieces, placed.unionByName(full)


def _in_order(pieces: DataFrame, order: DataFrame, window: int, period: int, range_tokens: int) -> DataFrame:
    """Places within consecutive ranges of the order; what the order doesn't know comes last."""
    firsts = order.groupBy(F.col("doc_id").cast("long").alias("_k")).agg(F.min(F.struct("slot", "byte_start")).alias("_place"))
    layout = pieces.select("piece_id", "doc_id", "start", "length").join(firsts, F.col("doc_id").eqNullSafe(F.col("_k")), "left")
    slot = F.coalesce(F.col("_place.slot"), F.lit(1 << 62))
    layout = layout.select("piece_id", "doc_id", "start", "length", slot.alias("slot"), F.coalesce("_place.byte_start", F.lit(0)).alias("byte_start"))
    layout = stored(layout.withColumn("_period", F.expr(f"slot div {period}")), "pack-layout")
    # A range begins where the tokens before it pass a multiple; running sums by groups of periods, then inside them.
    periods = layout.groupBy("_period").agg(F.sum("length").alias("_n")).withColumn("_group", F.expr("_period div 1024"))
    groups = periods.groupBy("_group").agg(F.sum("_n").alias("_all"))
    earlier = F.sum("_all").over(Window.orderBy("_group").rowsBetween(Window.unboundedPreceding, -1))
    inside = F.sum("_n").over(Window.partitionBy("_group").orderBy("_period").rowsBetween(Window.unboundedPreceding, -1))
    periods = periods.join(groups.select("_group", F.coalesce(earlier, F.lit(0)).alias("_earlier")), "_group")
    periods = periods.withColumn("_before", F.col("_earlier") + F.coalesce(inside, F.lit(0)))
    # Rows of one key have one place, so a period can hold any number; then its pieces are dealt over the ranges it fills.
    cuts = F.when(F.col("_n") > 16 * range_tokens, F.ceil(F.col("_n") / range_tokens)).otherwise(1)
    periods = periods.select("_period", F.expr(f"_before div {range_tokens}").alias("_first"), cuts.cast("long").alias("_cuts"))
    rows = layout.join(periods, "_period").withColumn("_range", F.col("_first") + F.pmod(F.xxhash64("piece_id"), F.col("_cuts")))
    rows = rows.drop("_period", "_first", "_cuts")

    def place(own: pd.DataFrame) -> pd.DataFrame:
        own = own.sort_values(["slot", "byte_start", "doc_id", "start", "piece_id"], ignore_index=True)
        length = own["length"].to_numpy()
        sequence, offset, filled = (np.zeros(len(own), np.int64) for _ in range(3))
        whole = np.flatnonzero(length == window)
        sequence[whole], filled[whole] = np.arange(len(whole)), window
        # Remainders of a length, in order; each window takes the next ones.
        by_length = np.argsort(length, kind="stable")
        counts = np.bincount(length, minlength=window + 1)
        taken, base = np.cumsum(counts) - counts, len(whole)
        counts[window] = 0
        for lengths, repeats in plan(counts, window):
            at = 0
            for p in lengths:
                rows = by_length[taken[p] : taken[p] + repeats]
                sequence[rows], offset[rows], filled[rows] = base + np.arange(repeats), at, sum(lengths)
                taken[p] += repeats
                at += p
            base += repeats
        # Sequences of a range are numbered by the mean place of their tokens.
        mean = np.bincount(sequence, np.arange(len(own)) * length) / np.bincount(sequence, length)
        rank = np.empty(len(mean), np.int64)
        rank[np.argsort(mean, kind="stable")] = np.arange(len(mean))
        ids = (int(own["_range"].iloc[0]) << 32) + rank[sequence]
        return pd.DataFrame({"piece_id": own["piece_id"], "sequence_id": ids, "offset": offset, "filled": filled})

    return rows.groupBy("_range").applyInPandas(place, "piece_id long, sequence_id long, offset long, filled long")


def _placed(slots: list[tuple[int, int, int, int, int]]):
    """Look a rank up among the slots of its length; the table of slots is bounded by the window."""
    order = sorted(slots)
    table = np.array(order, np.int64).reshape(-1, 5)
    scale = np.int64(1) << 44

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = table[:, 0] * scale + table[:, 1]
        for batch in batches:
            length = batch.column(1).to_numpy(zero_copy_only=False)
            rank = batch.column(2).to_numpy(zero_copy_only=False)
            at = np.searchsorted(keys, length * scale + rank, "right") - 1
            hit = table[at]
            new = (hit[:, 2] + rank - hit[:, 1], hit[:, 3], hit[:, 4])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *map(pa.array, new)], names=["piece_id", "sequence_id", "offset", "filled"]
            )

    return place


def packed_digest(pieces: DataFrame, places: DataFrame) -> DataFrame:
    """One narrow row per piece: its place and the checksum of its ids."""
    own = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return own.join(places, "piece_id").select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "filled"
    )
