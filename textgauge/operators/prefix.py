"""Running totals and exact quantiles without a single-task window.

The input is pre-aggregated to one row per distinct value, so a value that many rows share
costs one row.  Distinct values are cut into ranges at a few hundred sampled values; windows run
inside a range and the small table of range totals supplies what lies before each range.  The sample
is the set of values with the smallest hashes: bounded, spread evenly over the distinct values, and
the same however the data is partitioned, so a lost task or a second evaluation cuts the ranges alike.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

STEP = 64


def _sample(freq: DataFrame, order: str, step: int) -> DataFrame:
    # Ordering by every column keeps them all in the plan, so the shuffle behind ``freq`` is the one
    # that the other uses of ``freq`` have, and runs once.
    others = [c for c in freq.columns if c != order]
    return freq.orderBy(F.xxhash64(order), order, *others).limit(step * step).select(F.col(order).alias("_v"))


def _cuts(freq: DataFrame, order: str, step: int) -> Column:
    """At most ``step * step`` sorted values in runs of ``step``, with the last value of each run: a scalar subquery."""
    found = _sample(freq, order, step).agg(F.array_sort(F.collect_set("_v")).alias("_s"))
    runs = F.transform(F.sequence(F.lit(0), F.lit(step - 1)), lambda i: F.slice("_s", i * step + 1, F.lit(step)))
    found = found.select(runs.alias("runs"))
    return found.select(F.struct("runs", F.transform("runs", lambda r: F.array_max(r)).alias("lasts")).alias("_c")).scalar()


def _with_range(freq: DataFrame, order: str, step: int) -> DataFrame:
    """Add ``_range``: a number that rises with the value and changes at every cut.

    The run is found first, then the place in it: 2 * step comparisons.  Never null: a join on a nullable
    column would add a null filter, which would be pushed below the aggregate behind ``freq`` and search
    the cuts for every row instead of every distinct value.
    """
    value = F.col(order)
    run = F.size(F.filter("_cuts.lasts", lambda c: c < value))
    place = F.size(F.filter(F.get("_cuts.runs", F.col("_run")), lambda c: c < value))
    marked = freq.withColumn("_cuts", _cuts(freq, order, step)).withColumn("_run", run)
    ranged = F.coalesce(F.col("_run") * step, F.lit(0)) + F.coalesce(F.greatest(place, F.lit(0)), F.lit(0))
    return marked.withColumn("_range", ranged).drop("_cuts", "_run")


def running_totals(
    freq: DataFrame, order: str, sums: Sequence[str], by: Sequence[str] = (), step: int = STEP
) -> DataFrame:
    """Add ``<s>_upto`` (running sum in ascending ``order``, own row included) and ``<s>_total``.

    ``freq`` has one row per (by, order) and no null in either.  Values are cut into ``step * step`` ranges: a range
    should fit a task, and any number gives the same result.
    """
    by = list(by)
    ranged = _with_range(freq, order, step)
    totals = ranged.groupBy(*by, "_range").agg(*[F.sum(s).alias(f"_{s}") for s in sums])
    group = Window.partitionBy(*by) if by else Window.partitionBy()
    ahead = group.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by,
        "_range",
        *[F.coalesce(F.sum(f"_{s}").over(ahead), F.lit(0)).alias(f"_{s}_before") for s in sums],
        *[F.sum(f"_{s}").over(group).alias(f"{s}_total") for s in sums],
    )
    inside = (
        Window.partitionBy(*by, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = ranged.select("*", *[F.sum(s).over(inside).alias(f"{s}_upto") for s in sums])
    joined = local.join(offsets, [*by, "_range"])
    for s in sums:
        joined = joined.withColumn(f"{s}_upto", F.col(f"{s}_upto") + F.col(f"_{s}_before"))
    return joined.drop("_range", *[f"_{s}_before" for s in sums])


def frequencies(df: DataFrame, value: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per (by, value) with its row count ``n``; nulls are left out."""
    kept = df.where(F.col(value).isNotNull())
    for b in by:
        kept = kept.where(F.col(b).isNotNull())
    return kept.groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))


def _at_rank(rank: Column, value: str) -> Column:
    """Value that holds a 0-based rank."""
    upto = F.col("n_upto")
    return F.max(F.when((upto - F.col("n") <= rank) & (rank < upto), F.col(value)))


def quantile_columns(value: str, probs: dict[str, float]) -> list[Column]:
    """Aggregates over ``running_totals`` output: linear interpolation between the two nearest ranks."""
    out = []
    for name, p in probs.items():
        position = F.lit(float(p)) * (F.col("n_total") - 1).cast("double")
        low, high = F.floor(position), F.ceil(position)
        share = F.max(position - low)
        a, b = _at_rank(low, value), _at_rank(high, value)
        out.append((a + (b - a) * share).cast("double").alias(name))
    return out


def summarize(
    df: DataFrame, value: str, probs: dict[str, float] | None = None, by: Sequence[str] = (), step: int = STEP
) -> DataFrame:
    """Count, min, max, mean, sample standard deviation and exact quantiles per group.

    Everything is computed from the distinct values, so the data is shuffled once, combined map-side.
    """
    probs = {"median": 0.5} if probs is None else probs
    freq = frequencies(df, value, by)
    cum = running_totals(freq, value, ["n"], by, step)
    # Sums are taken around a sampled middle value, which keeps the variance free of cancellation.
    centre = _sample(freq, value, step).agg(F.percentile_approx("_v", 0.5).cast("double").alias("_m")).scalar()
    cum = cum.withColumn("_d", F.col(value).cast("double") - centre)
    n = F.sum("n").cast("double")
    first, second = F.sum(F.col("n") * F.col("_d")), F.sum(F.col("n") * F.col("_d") * F.col("_d"))
    aggs = [
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        (F.max(centre) + first / n).alias("mean"),
        F.when(n > 1, F.sqrt(F.greatest(F.lit(0.0), second - first * first / n) / (n - 1))).alias("std"),
        *quantile_columns(value, probs),
    ]
    return cum.groupBy(*by).agg(*aggs) if by else cum.agg(*aggs)
