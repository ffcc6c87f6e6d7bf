"""Logistic regression for a whole list of penalties in the same passes over the features.

Every penalty has a search of its own (limited-memory quasi-Newton steps with backtracking), but all searches put their
next trial points into one pass: a task computes margins, losses and gradients of all of them at once, so a pass reads
the features a single time whatever the number of penalties.  Searches that have ended drop out of later passes.

The objective is mean logistic loss plus half the penalty times the squared weights of standardised features; the
intercept is free.  The driver holds the weights: features times penalties, a size set by the settings alone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CHUNK = 1 << 14
BLOCK_ROWS = 4096
TASK_ROWS = 20_000
AT_DRIVER = 128 << 20


@dataclass
class Weights:
    """One fitted penalty: weights of the raw features, intercept, objective after each step."""

    penalty: float
    weights: np.ndarray
    intercept: float
    objective: list[float] = field(default_factory=list)


class _Search:
    """Quasi-Newton steps for one penalty, fed with one loss and gradient at a time."""

    def __init__(self, start: np.ndarray, penalty: float, free: np.ndarray, steps: int, tolerance: float, memory: int = 7):
        self.at, self.penalty, self.free, self.steps, self.tolerance, self.memory = start, penalty, free, steps, tolerance, memory
        self.trial, self.value, self.slope, self.way, self.length = start, None, None, None, 1.0
        self.pairs, self.done, self.history, self.halved = [], False, [], 0

    def feed(self, loss: float, gradient: np.ndarray) -> None:
        """Take the mean loss and its gradient at the trial point, and choose the next one."""
        kept = np.where(self.free, 0.0, self.trial)
        value, slope = loss + 0.5 * self.penalty * float(kept @ kept), gradient + self.penalty * kept
        if self.value is not None:
            gain = 1e-4 * self.length * float(self.slope @ self.way)
            if value > self.value + gain and self.halved < 20:
                self.length, self.halved = self.length / 2, self.halved + 1
                self.trial = self.at + self.length * self.way
                return
            step, turn = self.trial - self.at, slope - self.slope
            if float(step @ turn) > 1e-12:
                self.pairs = [*self.pairs[-self.memory + 1 :], (step, turn, 1 / float(step @ turn))]
            small = abs(self.value - value) <= self.tolerance * max(abs(value), abs(self.value), 1e-12)
        else:
            small = False
        self.at, self.value, self.slope = self.trial, value, slope
        self.history.append(value)
        if small or len(self.history) > self.steps or float(np.abs(slope).max(initial=0)) < 1e-9:
            self.done = True
            return
        self.way, self.halved = -self._scaled(slope), 0
        if float(self.way @ slope) >= 0:
            self.way, self.pairs = -slope, []
        self.length = 1.0 if self.pairs else min(1.0, 1.0 / max(float(np.linalg.norm(slope)), 1e-12))
        self.trial = self.at + self.length * self.way

    def _scaled(self, slope: np.ndarray) -> np.ndarray:
        q, shares = slope.copy(), []
        for step, turn, rho in reversed(self.pairs):
            share = rho * float(step @ q)
            shares.append(share)
            q -= share * turn
        if self.pairs:
            step, turn, _ = self.pairs[-1]
            q *= float(step @ turn) / float(turn @ turn)
        for (step, turn, rho), share in zip(self.pairs, reversed(shares), strict=True):
            q += (share - rho * float(turn @ q)) * step
        return q


def feature_blocks(rows: DataFrame, label: str, features: str = "features") -> DataFrame:
    """Sparse or dense feature vectors as blocks of rows: labels, row sizes, feature numbers and values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                labels, sizes, numbers, values = part.column(0).to_numpy(zero_copy_only=False), [], [], []
                for vector in part.column(1):
                    own, found = vector["values"].values.to_numpy(zero_copy_only=False), vector["indices"].as_py()
                    index = np.arange(len(own)) if found is None else np.array(found, np.int32)
                    sizes.append(len(own))
                    numbers.append(index.astype("<i4"))
                    values.append(own.astype("<f8"))
                data = [labels.astype("<f8"), np.array(sizes, "<i8"), np.concatenate(numbers), np.concatenate(values)]
                yield pa.RecordBatch.from_arrays([pa.array([d.tobytes()], pa.binary()) for d in data], names=["labels", "sizes", "numbers", "values"])

    return rows.select(F.col(label).cast("double"), features).mapInArrow(run, "labels binary, sizes binary, numbers binary, values binary")


def _opened(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    for i in range(batch.num_rows):
        yield tuple(np.frombuffer(batch.column(c)[i].as_py(), kind) for c, kind in enumerate(("<f8", "<i8", "<i4", "<f8")))


def _summed(blocks: DataFrame, work, width: int, tasks: int, passes: int = 1) -> np.ndarray:
    """Sum over all tasks of a vector that ``work`` makes of a task's blocks.

    Vectors are cut into chunks that Spark adds up; the driver does where those of all tasks are small, over so many
    ``passes`` together.  What it gets in the other case doesn't depend on the number of tasks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for block in _opened(batch):
                own = work(*block)
                total = own if total is None else total + own
        if total is not None:
            cut = range(0, width, CHUNK)
            parts = [pa.array([i // CHUNK for i in cut], pa.int32()), pa.array([total[i : i + CHUNK].astype("<f8").tobytes() for i in cut], pa.binary())]
            yield pa.RecordBatch.from_arrays(parts, names=["chunk", "sums"])

    def add(own: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(x, "<f8") for x in own["sums"]], axis=0)
        return pd.DataFrame({"chunk": own["chunk"].iloc[:1], "sums": [total.astype("<f8").tobytes()]})

    chunks = blocks.mapInArrow(run, "chunk int, sums binary")
    if tasks > 1 and passes * tasks * width * 8 > AT_DRIVER:
        chunks = chunks.groupBy("chunk").applyInPandas(add, "chunk int, sums binary")
    total = np.zeros(width)
    for r in chunks.collect():
        at = r["chunk"] * CHUNK
        total[at : at + CHUNK] += np.frombuffer(r["sums"], "<f8")
    return total


def sums_of_block(weights: np.ndarray, base: np.ndarray, at: np.ndarray, labels: np.ndarray, sizes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Gradients, misses and losses of a block of rows under the weights of every penalty, a row of ``weights`` each.

    One penalty after the other: a number per value is held at a time, not one per value and penalty.  The last weight
    is that of the features left out.
    """
    full = np.flatnonzero(sizes)
    starts, at = (np.cumsum(sizes) - sizes)[full], at.astype(np.int64)
    slopes, missed, lost = [], [], []
    for own, first in zip(weights, base, strict=True):
        margin = np.full(len(labels), first)
        if len(full):
            margin[full] += np.add.reduceat(own[at] * values, starts)
        miss = 1 / (1 + np.exp(-np.clip(margin, -500, 500))) - labels
        slopes.append(np.bincount(at, values * np.repeat(miss, sizes), len(own))[:-1])
        missed.append(miss.sum())
        lost.append((np.logaddexp(0, margin) - labels * margin).sum())
    return np.concatenate([*slopes, missed, lost])


def fit_penalties(
    rows: DataFrame, label: str, penalties: Sequence[float], size: int, steps: int = 50, tolerance: float = 1e-6, features: str = "features"
) -> list[Weights]:
    """Weights for every penalty, from at most about ``steps`` passes over ``rows`` (labels 0 and 1, vectors of ``size``).

    A feature that never varies has weight 0.  Without rows, or with one class, all weights are 0 and the intercept is
    that of the class shares (at most 1e9 to either side).
    """
    spark = rows.sparkSession
    # Every task of a pass sends one vector of sums: as many tasks as the rows ask for, at most one per core.
    tasks = max(1, min(spark.sparkContext.defaultParallelism, -(-rows.count() // TASK_ROWS)))
    blocks = feature_blocks(rows.coalesce(tasks), label, features).persist(StorageLevel.MEMORY_AND_DISK)
    try:

        def moments(labels, sizes, numbers, values):
            own = np.zeros(2 * size + 2)
            own[:size] = np.bincount(numbers, values, size)
            own[size : 2 * size] = np.bincount(numbers, values * values, size)
            own[2 * size :] = len(labels), labels.sum()
            return own

        sums = _summed(blocks, moments, 2 * size + 2, tasks)
        n, ones = sums[2 * size], sums[2 * size + 1]
        intercept = float(np.clip(np.log(ones) - np.log(n - ones), -1e9, 1e9)) if 0 < ones < n else (1e9 if n and ones else -1e9 if n else 0.0)
        if not 0 < ones < n:
            return [Weights(p, np.zeros(size), intercept) for p in penalties]
        mean = sums[:size] / n
        spread = np.sqrt(np.maximum(0, (sums[size : 2 * size] - n * mean * mean) / max(1, n - 1)))
        # A sum of squares that is no more than rounding is no spread.
        active = np.flatnonzero(spread * spread * max(1, n - 1) > 1e-12 * np.maximum(1e-300, sums[size : 2 * size]))
        mean, scale, many = mean[active], 1 / spread[active], len(active)
        free = np.append(np.zeros(many, bool), True)
        start = np.append(np.zeros(many), intercept)
        searches = [_Search(start, p, free, steps, tolerance) for p in penalties]
        place = np.full(size, many, np.int32)
        place[active] = np.arange(many)
        shared_place = spark.sparkContext.broadcast(place)
        while open_ := [s for s in searches if not s.done]:
            k = len(open_)
            raw = np.stack([s.trial[:many] * scale for s in open_], 1)
            base = np.array([s.trial[many] for s in open_]) - mean @ raw
            shared = spark.sparkContext.broadcast((np.hstack([raw.T, np.zeros((k, 1))]), base))

            def gradients(labels, sizes, numbers, values):
                weights, base = shared.value
                return sums_of_block(weights, base, shared_place.value[numbers], labels, sizes, values)

            sums = _summed(blocks, gradients, k * many + 2 * k, tasks, steps)
            for j, search in enumerate(open_):
                missed = sums[k * many + j]
                slope = (sums[j * many : (j + 1) * many] - mean * missed) * scale
                search.feed(float(sums[k * many + k + j]) / n, np.append(slope, missed) / n)
            shared.destroy()
        shared_place.destroy()
        out = []
        for p, s in zip(penalties, searches, strict=True):
            weights = np.zeros(size)
            weights[active] = s.at[:many] * scale
            out.append(Weights(p, weights, float(s.at[many] - mean @ weights[active]), s.history))
        return out
    finally:
        blocks.unpersist()


def confusion(rows: DataFrame, label: str, fits: Sequence[Weights], features: str = "features") -> list[np.ndarray]:
    """For every fit the counts of (label, prediction) as a two by two table, from one pass over the rows."""
    spark, k = rows.sparkSession, len(fits)
    shared = spark.sparkContext.broadcast((np.stack([f.weights for f in fits], 1), np.array([f.intercept for f in fits])))

    def counts(labels, sizes, numbers, values):
        weights, base = shared.value
        ends = np.cumsum(sizes)
        running = np.zeros((len(values) + 1, k))
        np.cumsum(weights[numbers] * values[:, None], axis=0, out=running[1:])
        chosen = base + running[ends] - running[ends - sizes] > 0
        kind = 2 * labels[:, None].astype(np.int64) + chosen
        return np.concatenate([np.bincount(kind[:, j], minlength=4) for j in range(k)])

    # A few numbers a task.
    found = _summed(feature_blocks(rows, label, features), counts, 4 * k, 1).reshape(k, 2, 2)
    shared.destroy()
    return list(found.astype(np.int64))


def weighted_scores(table: np.ndarray) -> dict:
    """Accuracy and support-weighted precision, recall and F1 of a table of (label, prediction) counts."""
    hits, support, predicted = np.diag(table).astype(float), table.sum(1), table.sum(0)
    n = support.sum()
    if not n:
        return dict.fromkeys(("accuracy", "precision", "recall", "f1"))

    def mean(part: np.ndarray, whole: np.ndarray) -> float:
        return float(np.divide(part, whole, out=np.zeros(len(part)), where=whole > 0) @ support / n)

    return {"accuracy": float(hits.sum() / n), "precision": mean(hits, predicted), "recall": mean(hits, support), "f1": mean(2 * hits, support + predicted)}
