"""Mixing sources to target weights by proportionate-fair (Pfair) scheduling.

The rows of a source, in a random but repeatable order, are cut into blocks of equal bytes.  With the share
``w`` of its stream, block ``k`` (from 0) is released at slot ``floor(k / w)`` and due at ``ceil((k + 1) / w)``.
In every slot, the released block with the earliest deadline is sent.  One block per slot with shares that add
up to one is a feasible set on one processor, so every deadline is met and, after any number of slots, a stream
is less than one block away from its share.

Shares are whole numbers that add up to ``Q``; the schedule then repeats every ``Q`` slots and is a table of
that fixed size.  Rows find their slot by arithmetic on their running bytes: built-in expressions only.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textgauge.llm.tables import narrow, text_bytes

REST = "(rest)"


def schedule(shares: Mapping[str, int]) -> dict[str, list[int]]:
    """Slots of every stream in one period: earliest deadline first among the released blocks."""
    period, sent = sum(shares.values()), {s: [] for s in shares}
    for slot in range(period):
        ready = [
            (-(-(len(sent[s]) + 1) * period // q), i, s)
            for i, (s, q) in enumerate(shares.items())
            if len(sent[s]) < q and len(sent[s]) * period // q <= slot
        ]
        sent[min(ready)[2]].append(slot)
    return sent


def mix(
    docs: DataFrame,
    shares: Mapping[str, int],
    rest: int,
    block_bytes: int = 1 << 16,
    seed: int = 42,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    digits: int = 3,
) -> DataFrame:
    """Slot of every row in the mixture; ordered by (slot, byte_start, doc_id) the rows are the mixed stream.

    ``shares`` are whole numbers of blocks per period; sources not named, null included, form one stream of
    share ``rest``, so the number of streams doesn't follow the data.  Returns ``doc_id, source, stream, size,
    byte_start, block, release, deadline, slot``.

    No row is dropped or repeated: a stream that has run out leaves its slots empty and the others keep their
    proportion among themselves.  A row belongs to the block its first byte falls in; one longer than a block
    makes the following blocks of its stream empty, so the bytes sent stay on target.  A null text has no
    bytes and null keys sort first; rows equal in key may swap places.  An empty table gives no rows.
    """
    if rest < 1 or any(q < 1 for q in shares.values()) or REST in shares:
        raise ValueError("every share must be a positive whole number")
    streams = {**shares, REST: rest}
    slots, period = schedule(streams), sum(streams.values())
    rows = narrow(docs, {"doc_id": key, "source": source, "_text": text}).select(
        "doc_id",
        "source",
        F.when(F.col("source").isin(*shares), F.col("source")).otherwise(F.lit(REST)).alias("stream"),
        text_bytes("_text").alias("size"),
        F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("doc_id").cast("string")).cast("binary")).alias("_order"),
    )
    # A stream is cut by the leading digits of the random order, so no window holds a whole source.
    rows = rows.withColumn("_cut", F.substring("_order", 1, digits))
    cuts = rows.groupBy("stream", "_cut").agg(F.sum("size").alias("_bytes"))
    earlier = Window.partitionBy("stream").orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    cuts = cuts.select("stream", "_cut", F.coalesce(F.sum("_bytes").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("stream", "_cut").orderBy("_order", "doc_id")
    start = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("_start", start).join(cuts, ["stream", "_cut"])
    rows = rows.withColumn("byte_start", F.col("_before") + F.col("_start"))
    rows = rows.withColumn("block", F.expr(f"byte_start div {block_bytes}"))
    first, flat = {}, []
    for name, own in slots.items():
        first[name] = len(flat)
        flat += own
    share = F.lit(rest)
    base = F.lit(first[REST])
    for name, q in shares.items():
        share = F.when(F.col("stream") == name, q).otherwise(share)
        base = F.when(F.col("stream") == name, first[name]).otherwise(base)
    rows = rows.withColumn("_q", share.cast("long")).withColumn("_base", base.cast("int"))
    table = F.array(*[F.lit(s) for s in flat])
    slot = F.expr(f"block div _q * {period}") + F.element_at(table, (F.col("_base") + F.expr("block % _q") + 1).cast("int"))
    return rows.select(
        "doc_id",
        "source",
        "stream",
        "size",
        "byte_start",
        "block",
        F.expr(f"block * {period} div _q").alias("release"),
        F.expr(f"((block + 1) * {period} + _q - 1) div _q").alias("deadline"),
        slot.alias("slot"),
    )


def mixed(docs: DataFrame, plan: DataFrame, key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` in mixed order: the order of files and rows of what is written from it.

    Rows whose key is null or not in the plan go to the end; a key with several rows takes its first place.
    """
    places = plan.groupBy(F.col("doc_id").alias("_k")).agg(F.min(F.struct("slot", "byte_start")).alias("_place"))
    out = docs.join(places, F.col(key).eqNullSafe(F.col("_k")), "left")
    return out.orderBy(F.col("_place").asc_nulls_last(), F.col(key)).select(*[docs[c] for c in docs.columns])
