"""Near copies by the Jaccard similarity of word shingles, each link checked exactly.

Candidates come from the trie join of the 64-bit SimHashes of the shingle sets and from min-hash bands.  Texts with a
similarity of 0.8 differ in about 10 of 64 SimHash bits and often in 14, where a trie join hardly ends early; they agree
in a min-hash with a probability equal to their similarity, so one of 20 bands of five agrees for 99.96 % of the pairs
at 0.8.  A candidate becomes a link only if the exact similarity of its whole shingle sets reaches the limit.

Equal shingle sets form one class.  Classes that share a band are a bucket, and every class is compared with one of each
of its buckets, the centre: so the pairs grow with the rows, whatever the size of a bucket.  The centre is the class
whose buckets hold most classes; among the variants of a text that is one with few changes, and what is alike to any of
them is likely alike to it.  Where links leave a bucket in several parts, its classes are compared with three more, drawn
by hash, that they aren't connected with, and then dealt anew by what their centres do not explain: the smallest hashes
of the shingles that no centre so far had.  Texts on one template differ from the centre in their own words, and two that
are alike have most of these in common, so they meet in smaller buckets, round by round, until a round finds no link.  No
bucket is cut, at any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgauge.llm.components import connected
from textgauge.llm.simhash import LOWER, links, text_hash
from textgauge.llm.tables import narrow, stored, working

WORDS = 5
PERCENT = 80
BANDS, ROWS = 20, 5
KEPT, DRAWN = 16, 3
_rng = np.random.default_rng(42)
FACTORS = _rng.integers(0, 1 << 63, (BANDS * ROWS, 1), np.uint64) * np.uint64(2) + np.uint64(1)
TERMS = _rng.integers(0, 1 << 63, (BANDS * ROWS, 1), np.uint64)


def shingles(text: bytes | None, words: int = WORDS) -> tuple[np.ndarray, int]:
    """Sorted distinct hashes of the shingles of a UTF-8 text, and its SimHash; nothing and 0 without words."""
    import xxhash

    digest, found = xxhash.xxh64_intdigest, (text or b"").translate(LOWER).split()
    n = len(found)
    if not n:
        return np.zeros(0, np.uint64), 0
    width = min(words, n)
    joined = b" ".join(found)
    lengths = np.fromiter(map(len, found), np.int64, n)
    ends = np.cumsum(lengths + 1) - 1
    starts, ends = (ends - lengths)[: n - width + 1], ends[width - 1 :]
    hashes = np.fromiter((digest(joined[i:j], 42) for i, j in zip(starts.tolist(), ends.tolist(), strict=True)), np.uint64, len(starts))
    own, ones = np.unique(hashes), np.zeros(64, np.int64)
    for at in range(0, len(own), 1 << 16):
        bits = own[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(bits, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return own, int(np.packbits(2 * ones > len(own), bitorder="little").view("<u8")[0])


def bands(own: np.ndarray) -> list[int]:
    """A digest per band of min-hashes; none for an empty set."""
    import xxhash

    if not len(own):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(own), 1 << 12):
        least = np.minimum(least, (own[at : at + (1 << 12)] * FACTORS + TERMS).min(1))
    rows = least.astype("<u8").reshape(BANDS, ROWS)
    return [xxhash.xxh64_intdigest(row.tobytes(), i) for i, row in enumerate(rows)]


def _class(own: np.ndarray) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(own.astype("<u8").tobytes(), 7)


def _long(values: list[int]) -> pa.Array:
    return pa.array(np.array(values, np.uint64).view(np.int64))


def _rows(docs: DataFrame, key: str, text: str) -> DataFrame:
    rows = narrow(docs, {"doc_id": key, "_text": text})
    return rows.select(F.col("doc_id").cast("long"), F.col("_text").cast("binary"), text_hash("_text").alias("text_hash"))


def signatures(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """``doc_id, text_hash, set`` (digest of the shingle set), ``n`` (its size), ``fp, bands`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        working("near-dedup")
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [shingles(t.as_py(), words) for t in part.column(1)]
                each = [bands(own) for own, _ in found]
                flat = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, each)]), pa.int32()), _long([d for b in each for d in b]))
                columns = [_long([_class(own) for own, _ in found]), pa.array([len(own) for own, _ in found], pa.int64()), _long([fp for _, fp in found]), flat]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), *columns], names=["doc_id", "text_hash", "set", "n", "fp", "bands"])

    return _rows(docs, key, text).mapInArrow(run, "doc_id long, text_hash long, set long, n long, fp long, bands array<long>")


def sets_of(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """``set, hashes`` of every row: whole shingle sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        working("near-dedup")
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                found = [shingles(t.as_py(), words)[0] for t in batch.column(1).slice(at, 64)]
                flat = pa.array(np.concatenate(found).view(np.int64))
                lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, found)]), pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([_long([_class(own) for own in found]), lists], names=["set", "hashes"])

    return _rows(docs, key, text).mapInArrow(run, "set long, hashes array<long>")


def _pair(x: str, y: str):
    return F.struct(F.least(x, y).alias("a"), F.greatest(x, y).alias("b"))


def _sets(wanted: DataFrame, docs: DataFrame, classes: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """The shingle sets of the wanted classes, stored; of each the row with its smallest key is cut into shingles again."""
    keys = stored(wanted.join(classes, "set").select(F.col("first").alias("_k"), "set"), "near-keys")
    chosen = docs.join(keys.select("_k").distinct(), F.col(f"`{key}`").cast("long").eqNullSafe(F.col("_k")), "left_semi")
    sets = sets_of(chosen, key, text, words).join(keys.select("set"), "set", "left_semi")
    return stored(sets.dropDuplicates(["set"]), "near-sets")


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs ``a, b`` with both sets as ``_x, _y``: a set travels with the pairs of its class ``a``, a centre's once."""
    both = pairs.join(sets.select(F.col("set").alias("a"), F.col("hashes").alias("_x")), "a")
    return both.join(sets.select(F.col("set").alias("b"), F.col("hashes").alias("_y")), "b")


def _checked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose exact similarity reaches the limit."""
    shared = F.size(F.array_intersect("_x", "_y"))
    good = shared * 100 >= (F.size("_x") + F.size("_y") - shared) * percent
    return _with_sets(pairs, sets).filter(good).select("a", "b")


def _open(members: DataFrame, parts: DataFrame | None, drawn: int = 0) -> DataFrame:
    """``key, set, n, score, part`` and ``centre`` (a struct of the last four) of all rows of buckets whose classes lie in several parts.

    One centre of a bucket is its class with the largest score; ``drawn`` further ones have the smallest hashes.
    """
    if parts is None:
        at = members.withColumn("part", F.col("set"))
    else:
        at = members.join(parts.withColumnRenamed("node", "set"), "set", "left").withColumn("part", F.coalesce("component", "set"))
    at = stored(at.select("key", "set", "n", "score", "part"), "near-members")
    own = F.struct("score", "set", "n", "part")
    chosen = [F.max(own)] + [F.min_by(own, F.xxhash64("set", "key", F.lit(i))) for i in range(drawn)]
    sides = [F.min("part").alias("_low"), F.max("part").alias("_high")]
    buckets = at.groupBy("key").agg(*[c.alias(f"_c{i}") for i, c in enumerate(chosen)], *sides).filter("_low < _high")
    buckets = buckets.select("key", F.explode(F.array(*[f"_c{i}" for i in range(drawn + 1)])).alias("centre"))
    return at.join(buckets, "key").filter(F.col("set") != F.col("centre.set"))


def _pairs(rows: DataFrame, percent: int) -> DataFrame:
    """``a, b``: classes and centres that aren't connected yet and whose sizes allow the similarity."""
    fit = F.least("n", "centre.n") * 100 >= F.greatest("n", "centre.n") * percent
    return rows.filter(fit & (F.col("part") != F.col("centre.part"))).select(_pair("set", "centre.set").alias("p")).select("p.*").distinct()


def _unexplained(rows: DataFrame, left: DataFrame, sets: DataFrame) -> DataFrame:
    """``set, n, score, left``: the shingles of the classes of open buckets that no centre had, the best centre of each taken off."""
    best = rows.groupBy("set", "n", "score").agg(F.max("centre").alias("_c")).select("set", "n", "score", F.col("_c.set").alias("_centre"))
    own = best.join(left.select("set", "left"), "set").join(sets.select(F.col("set").alias("_centre"), F.col("hashes").alias("_c")), "_centre")
    return own.select("set", "n", "score", F.array_except("left", "_c").alias("left")).filter(F.size("left") > 0)


def near_copies(docs: DataFrame, percent: int = PERCENT, words: int = WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_hash, component_id`` of every row.

    Rows whose sets of shingles of ``words`` words have a Jaccard similarity of ``percent`` or more are linked;
    ``component_id`` is the smallest key that links reach, the own one included.  A text of fewer words is one shingle;
    texts without words, null included, are equal.  Null keys name a component only if it has no other.  ``text_hash``
    tells rows of one key apart.
    """
    rows = stored(signatures(docs, key, text, words), "near-signatures")
    classes = rows.groupBy("set", "n", "fp", "bands").agg(F.min("doc_id").alias("first"))
    classes = stored(classes, "near-classes")
    spread = classes.select(F.explode("bands").alias("key"), "set", "n")
    shared = spread.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    members = stored(spread.join(shared, "key"), "near-buckets")
    # How many classes the buckets of a class hold together.
    scores = members.groupBy("set").agg(F.sum("_n").alias("score"))
    members = stored(members.drop("_n").join(scores, "set"), "near-buckets")

    own = classes.groupBy("fp").agg(F.min("set").alias("_of"))
    tries = links(own.select("fp")).join(own.select(F.col("fp").alias("a"), F.col("_of").alias("_x")), "a")
    tries = tries.join(own.select(F.col("fp").alias("b"), F.col("_of").alias("_y")), "b").select(_pair("_x", "_y").alias("p"))
    same = classes.join(own, "fp").filter("set != _of").select(_pair("set", "_of").alias("p"))
    tries = stored(tries.union(same).select("p.*"), "near-tries")

    named = members.select("set").union(tries.select("a")).union(tries.select("b")).distinct()
    sets = _sets(named, docs, classes, key, text, words)
    seen = stored(_pairs(_open(members, None), percent).union(tries).distinct(), "near-candidates")
    found = stored(_checked(seen, sets, percent), "near-links")
    parts = stored(connected(found), "near-parts")
    left, rounds = sets.withColumnRenamed("hashes", "left"), 0
    while True:
        pairs = _pairs(_open(members, parts, DRAWN), percent)
        pairs = stored(pairs.join(seen, ["a", "b"], "left_anti"), "near-candidates")
        new = stored(_checked(pairs, sets, percent), "near-links")
        none = new.isEmpty()
        if none and rounds:
            break
        if not none:
            found, seen = found.union(new), seen.union(pairs)
            parts = stored(connected(found), "near-parts")
        left = stored(_unexplained(_open(members, parts), left, sets), "near-left")
        members = left.select(F.explode(F.slice("left", 1, KEPT)).alias("key"), "set", "n", "score")
        rounds += 1

    named = classes.join(parts.withColumnRenamed("node", "set"), "set", "left")
    named = stored(named.select("set", "first", F.coalesce("component", "set").alias("component")), "near-named")
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    of = named.join(least, "component").select("set", "component_id")
    return rows.join(of, "set").select("doc_id", "text_hash", "component_id")
