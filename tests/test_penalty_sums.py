"""Sums of a block of rows for many penalties: right with empty rows, and without a number per value and penalty."""

import tracemalloc

import numpy as np

from textgauge.operators.penalties import sums_of_block


def test_sums_of_a_block():
    rng = np.random.default_rng(3)
    sizes = np.array([0, 3, 0, 5, 1, 0])
    at, values, labels = rng.integers(0, 7, 9).astype(np.int32), rng.normal(size=9), np.array([0.0, 1, 1, 0, 1, 0])
    weights, base = np.hstack([rng.normal(size=(2, 6)), np.zeros((2, 1))]), np.array([0.3, -0.2])
    dense = np.zeros((6, 7))
    np.add.at(dense, (np.repeat(np.arange(6), sizes), at), values)
    margin = base + dense @ weights.T
    miss = 1 / (1 + np.exp(-margin)) - labels[:, None]
    loss = np.logaddexp(0, margin) - labels[:, None] * margin
    want = np.concatenate([(dense.T @ miss)[:-1].T.ravel(), miss.sum(0), loss.sum(0)])
    assert np.allclose(sums_of_block(weights, base, at, labels, sizes, values), want)
    none = sums_of_block(weights, base, at[:0], labels, np.zeros(6, np.int64), values[:0])
    assert not none[:12].any()


def test_memory_does_not_grow_with_the_penalties():
    n = 400_000
    at, values, sizes, labels = np.arange(n, dtype=np.int32) % 50, np.ones(n), np.full(400, 1000), np.arange(400) % 2.0
    tracemalloc.start()
    sums_of_block(np.zeros((7, 51)), np.zeros(7), at, labels, sizes, values)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 6 * 8 * n
