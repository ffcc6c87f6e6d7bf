"""Document fingerprints by consistent weighted sampling.

A text is a weighted set: its words with their counts.  For each of ``SAMPLES`` samples and each word, Gamma(2, 1)
values ``r`` and ``c`` and a uniform ``b``, all hashed from the word, give ``t = floor(ln w / r + b)`` and
``ln a = ln c - r (t - b) - r``; the sample is the (word, t) with the least ``a``.  Two texts share a sample with a
probability equal to their generalised Jaccard similarity, the sum of the smaller weights over that of the larger.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from textgauge.llm.tables import narrow, stored, text_bytes

SAMPLES = 64
CACHED = 120_000
EMPTY = np.full(SAMPLES, 0xFFFF, np.uint16)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A finaliser of 64-bit integers that spreads every bit."""
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


def candidates(words: list[str], weights: list[int]) -> np.ndarray:
    """A row per weighted word: for every sample ``ln a`` in the upper, a mark of (word, t) in the lower 32 bits."""
    import xxhash

    seeds = np.array([xxhash.xxh64_intdigest(w.encode(), 7) for w in words], np.uint64)[:, None]
    steps = np.arange(1, 5 * SAMPLES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    drawn = _mixed(seeds + steps)
    u = ((drawn >> np.uint64(40)).astype(np.float32) + np.float32(0.5)) * np.float32(2.0**-24)
    u1, u2, u3, u4, b = (u[:, i * SAMPLES : (i + 1) * SAMPLES] for i in range(5))
    r = -np.log(u1 * u2)
    t = np.floor(np.log(np.array(weights, np.float32))[:, None] / r + b)
    a = np.log(-np.log(u3 * u4)) - r * (t - b) - r
    bits = np.ascontiguousarray(a, np.float32).view(np.uint32)
    order = np.where(bits >> 31, ~bits, bits | np.uint32(1 << 31)).astype(np.uint64)
    mark = _mixed(drawn[:, :SAMPLES] + t.astype(np.int64).astype(np.uint64)) & np.uint64(0xFFFFFFFF)
    return order << np.uint64(32) | mark


class Sampler:
    """Fingerprints of texts; rows of weighted words are kept up to a fixed number."""

    def __init__(self):
        self.place: dict[tuple[str, int], int] = {}
        self.rows = np.zeros((CACHED, SAMPLES), np.uint64)

    def fingerprint(self, text: str) -> np.ndarray:
        """16 bits of every sample; all ones without words."""
        terms = list(Counter(text.split()).items())
        if not terms:
            return EMPTY
        least = None
        for at in range(0, len(terms), 1 << 14):
            part = terms[at : at + (1 << 14)]
            new = [t for t in part if t not in self.place]
            if len(self.place) + len(new) > CACHED:
                self.place.clear()
                new = part
            if new:
                first = len(self.place)
                self.rows[first : first + len(new)] = candidates([t[0] for t in new], [t[1] for t in new])
                self.place.update(zip(new, range(first, first + len(new))))
            low = self.rows[np.fromiter(map(self.place.__getitem__, part), np.int64, len(part))].min(0)
            least = low if least is None else np.minimum(least, low)
        return (least & np.uint64(0xFFFF)).astype(np.uint16)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal samples: the estimate of the generalised Jaccard similarity."""
    return float(np.mean(a == b))


def edit(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many, or all, of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_samplers: list[Sampler] = []


def _sampler() -> Sampler:
    if not _samplers:
        _samplers.append(Sampler())
    return _samplers[0]


RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
FIELDS = [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
          ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]


def _described(key, text: str, own: np.ndarray, following: str, next_own: np.ndarray) -> tuple:
    changed = edit(text, following)
    other = _sampler().fingerprint(changed)
    digest = hashlib.sha256(changed.encode()).hexdigest()
    return key, len(text), digest, own.tobytes().hex(), other.tobytes().hex(), likeness(own, other), likeness(own, next_own)


def _walk():
    schema = pa.schema([*FIELDS, ("part", pa.int32()), ("edge", pa.int32()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, sampler, last, rows = TaskContext.get().partitionId(), _sampler(), None, []
        blank = (None,) * 6
        for batch in batches:
            for key, value in zip(batch.column(0), batch.column(1), strict=True):
                key, text = key.as_py(), value.as_py() or ""
                own = sampler.fingerprint(text)
                if last is None:
                    rows.append((key, *blank, part, 1, text))
                else:
                    rows.append((*_described(*last, text, own), part, 0, None))
                last = key, text, own
                if len(rows) >= 256:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
                    rows = []
        if last is not None:
            rows.append((last[0], *blank, part, 2, last[1]))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    return run


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema, sampler = pa.schema(FIELDS), _sampler()
    for batch in batches:
        rows = []
        for key, text, following in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            rows.append(_described(key, text, sampler.fingerprint(text), following, sampler.fingerprint(following)))
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def compare_edited(docs: DataFrame, bytes_per_task: int = 16 << 20, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of every whole text and of its edited text, and their likeness to each other and the next one's.

    The next document is the one before it by ascending key; null keys come last, the last is followed by the first, and
    rows with equal keys follow each other in the order of a hash of their texts.  A null text is empty; two texts without
    words are alike (1.0), a text without words and one with words are not.  A single row is its own next.

    Texts are dealt once into ranges of keys and compared within a range; what is cut by the ranges' borders, one
    first and one last text a range, is joined afterwards.
    """
    rows = narrow(docs, {"doc_id": key, "_text": text})
    total = rows.agg(F.sum(text_bytes("_text") + 1)).first()[0] or 0
    tasks = max(-(-total // bytes_per_task), docs.sparkSession.sparkContext.defaultParallelism)
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("_text")]
    rows = rows.select(F.col("doc_id").cast("long"), "_text")
    dealt = rows.repartitionByRange(int(tasks), *order).sortWithinPartitions(*order)
    walked = stored(dealt.mapInArrow(_walk(), f"{RESULT}, part int, edge int, text string"), "weighted-walk")
    firsts = walked.filter("edge = 1").select("part", F.col("text").alias("following"))
    parts = walked.filter("edge = 1").select("part")  # a row per range
    least = F.min("part").over(Window.partitionBy())
    heirs = parts.select(F.col("part").alias("own"), F.coalesce(F.lead("part").over(Window.orderBy("part")), least).alias("part"))
    lasts = walked.filter("edge = 2").select("doc_id", "text", F.col("part").alias("own"))
    ends = lasts.join(heirs, "own").join(firsts, "part").select("doc_id", "text", "following").mapInArrow(_joined, RESULT)
    return walked.filter("edge = 0").drop("part", "edge", "text").unionByName(ends)
