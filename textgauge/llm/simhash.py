"""Near-duplicates by SimHash, linked by a self-join of the fingerprints' binary trie.

The join walks pairs of trie nodes from the top bit down, adds up the bits in which their paths differ and gives a
pair up as soon as it exceeds its error budget.  Five tries start at the five blocks of 13 or 12 bits, each read
round the ring: for two fingerprints that differ in at most 4 bits, one start exists from which the first ``i``
blocks differ in at most ``floor(4 i / 5)`` bits, for every ``i``.  So the budget is 0 in the first block, 1 in the
first two, and so on: no link is lost and most pairs end early.

Spark spreads the work by pairs of nodes.  A pair of nodes with more fingerprints than a task should hold is walked
some levels further by Spark, into pairs of child nodes that are spread again.  Copies share a fingerprint and enter
the join once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgauge.llm.components import connected, local_components
from textgauge.llm.tables import narrow, stored

WORDS = 4
DISTANCE = 4
BLOCKS = (13, 13, 13, 13, 12)
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def fingerprint(text: bytes | None, words: int = WORDS) -> int:
    """64-bit SimHash of UTF-8 over shingles of words; 0 without words."""
    import xxhash

    digest, found = xxhash.xxh64_intdigest, (text or b"").translate(LOWER).split()
    n = len(found)
    if not n:
        return 0
    width = min(words, n)
    joined = b" ".join(found)
    lengths = np.fromiter(map(len, found), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts, ends = (ends - lengths)[: n - width + 1], ends[width - 1 :]
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), 1 << 16):
        spans = zip(starts[at : at + (1 << 16)].tolist(), ends[at : at + (1 << 16)].tolist(), strict=True)
        hashes = np.array([digest(joined[i:j], 42) for i, j in spans], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(starts), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """``doc_id, fp``: the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = np.array([fingerprint(t.as_py(), words) for t in part.column(1)], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found.view(np.int64))], names=["doc_id", "fp"])

    rows = narrow(docs, {"doc_id": key, "_text": text})
    rows = rows.select(F.col("doc_id").cast("long"), F.col("_text").cast("binary"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def budget(depth: int, start: int, distance: int = DISTANCE) -> int:
    """Bits in which two paths of this depth may differ, in the trie that starts at a block."""
    end = 0
    for i in range(5):
        end += BLOCKS[(start + i) % 5]
        if depth <= end:
            return distance * (i + 1) // 5
    return distance


def walk(values: np.ndarray, pairs: np.ndarray, depth: int, start: int, distance: int = DISTANCE) -> tuple[np.ndarray, np.ndarray]:
    """Positions of values at a small distance, below pairs of trie nodes.

    ``values`` are unsigned, sorted within every node; ``pairs`` has a row ``low, high, low, high, differing bits`` for
    each pair of nodes, as ranges of positions.  Large fronts are walked in two halves, so memory stays bounded.
    """
    found, todo = [], [(depth, pairs)]
    while todo:
        depth, now = todo.pop()
        if len(now) > 1 << 18:
            half = len(now) // 2
            todo += [(depth, now[:half]), (depth, now[half:])]
            continue
        same = now[:, 0] == now[:, 2]
        size = (now[:, 1] - now[:, 0]) * (now[:, 3] - now[:, 2])
        ready = (size <= 16) | (depth == 64)
        if ready.any():
            few, own = now[ready], size[ready]
            row = np.repeat(np.arange(len(few)), own)
            nth = np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
            wide = (few[:, 3] - few[:, 2])[row]
            a, b = few[row, 0] + nth // wide, few[row, 2] + nth % wide
            good = (a < b) | (few[row, 0] != few[row, 2])
            a, b = a[good], b[good]
            near = np.bitwise_count(values[a] ^ values[b]) <= distance
            found.append((a[near], b[near]))
        now, same = now[~ready], same[~ready]
        if not len(now):
            continue
        ones = np.concatenate([[0], np.cumsum(values >> np.uint64(63 - depth) & np.uint64(1), dtype=np.int64)])
        mid_a = now[:, 1] - (ones[now[:, 1]] - ones[now[:, 0]])
        mid_b = now[:, 3] - (ones[now[:, 3]] - ones[now[:, 2]])
        zero_a, one_a = (now[:, 0], mid_a), (mid_a, now[:, 1])
        zero_b, one_b = (now[:, 2], mid_b), (mid_b, now[:, 3])
        differ = now[:, 4]
        below = [
            np.stack([*zero_a, *zero_b, differ], 1),
            np.stack([*one_a, *one_b, differ], 1),
            np.stack([*zero_a, *one_b, differ + 1], 1),
            np.stack([*one_a, *zero_b, differ + 1], 1)[~same],
        ]
        front = np.concatenate(below)
        own = front[:, 0] == front[:, 2]
        full = (front[:, 1] > front[:, 0] + own) & (front[:, 3] > front[:, 2])
        todo.append((depth + 1, front[full & (front[:, 4] <= budget(depth + 1, start, distance))]))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def _turn(value: np.ndarray, by: int) -> np.ndarray:
    return value << np.uint64(by) | value >> np.uint64(64 - by) if by else value


def _linked(distance: int, at_once: int = 1 << 17):
    """Links below every pair of nodes of a sorted partition, thinned to a spanning forest per share of the rows."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        start, depth, a, b, side = (table.column(i).to_numpy() for i in range(5))
        rot = table.column(5).to_numpy().view(np.uint64)
        new = np.ones(len(rot), bool)
        new[1:] = (start[1:] != start[:-1]) | (depth[1:] != depth[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        low = np.flatnonzero(new)
        high = np.append(low[1:], len(rot))
        turned = np.array([0, *np.cumsum(BLOCKS)[:-1]])[start]
        fp = rot.copy()
        for by in np.unique(turned):
            fp[turned == by] = _turn(rot[turned == by], (64 - int(by)) % 64)
        nodes, place = np.unique(fp.view(np.int64), return_inverse=True)
        ends = []
        kinds = start[low] * 100 + depth[low]
        for kind in np.unique(kinds):
            lo, hi = low[kinds == kind], high[kinds == kind]
            sides = np.concatenate([[0], np.cumsum(side == 0)])
            mid = lo + sides[hi] - sides[lo]
            own = a[lo] == b[lo]
            differ = np.bitwise_count(a[lo].view(np.uint64) ^ b[lo].view(np.uint64)).astype(np.int64)
            pairs = np.stack([lo, np.where(own, hi, mid), np.where(own, lo, mid), hi, differ], 1)
            ends.append(walk(rot, pairs, int(kind) % 100, int(kind) // 100, distance))
        x = place[np.concatenate([e[0] for e in ends])]
        y = place[np.concatenate([e[1] for e in ends])]
        root = local_components(len(nodes), x, y)
        leaf = np.flatnonzero(root != np.arange(len(nodes)))
        return pa.RecordBatch.from_arrays([pa.array(nodes[leaf]), pa.array(nodes[root[leaf]])], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= at_once:
                table = pa.Table.from_batches(held).combine_chunks()
                cols = [table.column(i).to_numpy() for i in range(4)]
                edge = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], 0))
                if len(edge):  # up to the last whole pair of nodes
                    cut = int(edge[-1]) + 1
                    yield solve(table.slice(0, cut))
                    table = table.slice(cut)
                held, rows = table.to_batches(), table.num_rows
        if rows:
            yield solve(pa.Table.from_batches(held).combine_chunks())

    return run


def links(values: DataFrame, distance: int = DISTANCE, most: int = 200_000, levels: int = 3) -> DataFrame:
    """A spanning forest, per task, of the links between distinct fingerprints ``fp``: rows ``a, b``."""
    if not 0 <= distance <= 4:
        raise ValueError("the budgets of five blocks are meant for at most 4 differing bits")
    spark, offsets = values.sparkSession, [0, *np.cumsum(BLOCKS)[:-1].tolist()]
    tries = [
        F.struct(
            F.lit(i).alias("start"),
            (F.shiftleft("fp", by).bitwiseOR(F.shiftrightunsigned("fp", 64 - by)) if by else F.col("fp")).alias("rot"),
        )
        for i, by in enumerate(offsets)
    ]
    rows = values.select(F.explode(F.array(*tries)).alias("t")).select("t.start", "t.rot")
    depth = F.when(F.col("start") == 4, BLOCKS[4]).otherwise(BLOCKS[0])
    rows = rows.withColumn("depth", depth).withColumn("a", F.expr("shiftrightunsigned(rot, 64 - depth)"))
    rows = rows.select("start", "depth", "a", F.col("a").alias("b"), F.lit(0).alias("side"), "rot")
    node, ready = ["start", "depth", "a", "b"], []
    while True:
        heavy = rows.groupBy(*node).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most).drop("n")
        heavy = stored(heavy.filter(F.col("depth") < 64), "heavy-nodes")
        if heavy.isEmpty():
            ready.append(rows)
            break
        ready.append(rows.join(heavy, node, "left_anti"))
        rows = stored(_descend(rows.join(heavy, node, "left_semi"), levels, distance), "child-nodes")
    todo = ready[0]
    for more in ready[1:]:
        todo = todo.unionByName(more)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = todo.repartition(parts, *node).sortWithinPartitions(*node, "side", F.expr("rot ^ (-9223372036854775808)"))
    return dealt.mapInArrow(_linked(distance), "a long, b long")


def _descend(rows: DataFrame, levels: int, distance: int) -> DataFrame:
    """Each fingerprint once for every pair of child nodes, some levels down, that is within its budget."""
    rows = rows.withColumn("_to", F.least(F.col("depth") + levels, F.lit(64)))
    own = F.expr("shiftrightunsigned(rot, 64 - _to)")
    allowed = F.lit(distance)
    for start in range(5):
        for depth in range(63, 0, -1):
            if budget(depth, start, distance) != budget(depth + 1, start, distance):
                allowed = F.when((F.col("start") == start) & (F.col("_to") <= depth), budget(depth, start, distance)).otherwise(allowed)
    rows = rows.withColumn("_own", own).withColumn("_e", F.explode(F.expr("sequence(0, shiftleft(1, _to - depth) - 1)")))
    # The partner lies below the other node of the pair; a pair of equal nodes is kept once, smaller child first.
    tail = F.expr("_own & (shiftleft(1L, _to - depth) - 1)").bitwiseXOR(F.col("_e").cast("long"))
    other = F.expr("shiftleft(case when side = 0 then b else a end, _to - depth)").bitwiseOR(tail)
    rows = rows.withColumn("_other", other).withColumn("_same", F.col("a") == F.col("b"))
    rows = rows.filter(F.bit_count(F.col("_own").bitwiseXOR(F.col("_other"))) <= allowed)
    side = F.when(F.col("_same"), (F.col("_own") > F.col("_other")).cast("int")).otherwise(F.col("side"))
    rows = rows.withColumn("_side", side)
    return rows.select(
        "start",
        F.col("_to").alias("depth"),
        F.when(F.col("_side") == 0, F.col("_own")).otherwise(F.col("_other")).alias("a"),
        F.when(F.col("_side") == 0, F.col("_other")).otherwise(F.col("_own")).alias("b"),
        F.col("_side").alias("side"),
        "rot",
    )


def near_duplicates(docs: DataFrame, distance: int = DISTANCE, words: int = WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row.

    Rows whose fingerprints differ in at most ``distance`` bits are linked; ``component_id`` is the smallest key
    that links reach, the own one included.  A null text is like one without words: fingerprint 0.  Null keys
    are kept and never name a component unless it has no other (then null).  An empty table gives no rows.
    """
    rows = stored(fingerprints(docs, key, text, words), "simhash")
    classes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    parts = connected(links(classes.select("fp"), distance))
    named = classes.join(parts.withColumnRenamed("node", "fp"), "fp", "left")
    named = named.select("fp", "first", F.coalesce("component", "fp").alias("component"))
    named = stored(named, "simhash-named")
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    of = named.join(least, "component").select("fp", "component_id")
    return rows.join(of, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def text_hash(text: str) -> Column:
    """Tells rows of one key apart by their texts."""
    return F.xxhash64(F.col(f"`{text}`").cast("binary"))


def first_of_groups(docs: DataFrame, groups: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without all but the first of each group ``doc_id, component_id`` and, if known, ``text_hash``.

    The first row is the one with the smallest key, of equal keys the one with the smallest ``text_hash``: of rows with
    equal key and different texts each then follows the group of its own text.  Without it rows are told apart by their
    keys alone.  Repeated rows stay once; rows without a key stay.
    """
    told = "text_hash" in groups.columns
    row = F.struct(F.col("doc_id").alias("_k"), (F.col("text_hash") if told else F.lit(0).cast("long")).alias("_h"))
    groups = groups.filter("doc_id is not null").groupBy("component_id", row.alias("_r")).agg(F.count(F.lit(1)).alias("_n"))
    groups = stored(groups, "groups")
    firsts = groups.groupBy("component_id").agg(F.min("_r").alias("_r"))
    others = groups.join(firsts, ["component_id", "_r"], "left_anti").select("_r.*")
    again = groups.filter("_n > 1").join(firsts, ["component_id", "_r"], "left_semi").select("_r.*")

    def same(rows: DataFrame) -> Column:
        keys = F.col(f"`{key}`").cast("long") == rows["_k"]
        return keys & (text_hash(text) == rows["_h"]) if told else keys

    out = docs.join(others, same(others), "left_anti")
    if again.isEmpty():
        return out
    once = out.join(again, same(again), "left_semi").dropDuplicates([key, text] if told else [key])
    return out.join(again, same(again), "left_anti").unionByName(once)
