"""Connected components of a graph given by its links: alternating large and small stars.

Every round replaces each node's links by links to its smallest neighbour, first for larger neighbours, then for
smaller ones; links become stars around the smallest node in a number of rounds that grows with the logarithm of
the longest path.  All steps are aggregates and equi-joins that Spark spreads and whose skew it can split; each
round is stored, so a lost executor repeats one round at most.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgauge.llm.tables import stored


def connected(links: DataFrame) -> DataFrame:
    """``node, component`` (smallest node) of every node in ``a, b`` (longs, not null); loops are ignored."""
    links = links.filter(F.col("a") != F.col("b"))
    stars = stored(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "links")
    state = _state(stars)
    while state[0]:
        both = stars.select("u", "v").union(stars.select(F.col("v"), F.col("u")))
        least = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        large = both.filter(F.col("v") > F.col("u")).join(least, "u")
        large = large.select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.when(F.col("v") != F.col("m"), F.col("v")).otherwise(F.col("u")).alias("u"), F.col("m").alias("v"))
        stars = stored(small.distinct(), "stars")
        before, state = state, _state(stars)
        if state == before:
            break
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).union(stars.select("v", "v").distinct())


def _state(stars: DataFrame) -> tuple:
    return tuple(stars.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.max(F.xxhash64("v", "u"))).first())


def local_components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest reachable node of 0..n-1 over the links a-b, in memory: for one task's bounded share of links."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while True:
            jumped = new[new]
            if (jumped == new).all():
                break
            new = jumped
        if (new == root).all():
            return root
        root = new
