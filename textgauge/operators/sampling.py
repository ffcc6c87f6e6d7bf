"""Repeatable sampling, balancing and splitting.

Random order is the md5 of the operator's name, seed and key; so a sample, a balanced table and a split are drawn
independently of each other and can follow one another.  Instead of ranking all rows, the job finds the *threshold
digest* at which a class reaches its target size, and keeps rows up to it with a map-side filter:

1. count rows per (class, leading digest digits) - at most 65,536 small rows per class;
2. find the bucket where the target falls;
3. rank only the rows of that bucket and read off the row at the target.

Texts are never shuffled for this; only (class, key, digest) rows of one bucket are.  Thresholds are
kept in a map with one entry per class.  A class list that isn't given is counted first, a small job of its own.
Only where there are too many classes for a map does ``class_rank`` compute every row's rank, by a shuffle on
(class, bucket); both give the same rows.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from textgauge.config import SEED, SplitConfig
from textgauge.functions.digests import key_struct, names, order_bucket, order_digest

SAMPLE, BALANCE, SPLIT = "sample", "balance", "split"
MOST_CLASSES = 1000


def class_list(df: DataFrame, label: str) -> list | None:
    """The classes of a table, or nothing if there are more than a map in every task should hold."""
    most = MOST_CLASSES
    found = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_n")).select(label).take(most + 1)
    return [r[0] for r in found] if len(found) <= most else None


def _narrow(df: DataFrame, key, seed: int, label: str | None, classes: Sequence | None, purpose: str) -> DataFrame:
    code = F.col(label) if label else F.lit(0)
    rows = df.select(code.alias("_c"), key_struct(key).alias("_k"), order_digest(key, seed, purpose).alias("_h"))
    if label:
        rows = rows.where(F.col("_c").isNotNull())
        if classes is not None:
            rows = rows.where(F.col("_c").isin(*classes))
    return rows.withColumn("_b", order_bucket(F.col("_h")))


def _bucket_totals(narrow: DataFrame) -> DataFrame:
    """Rows per (class, bucket) with the running total and the class size."""
    counts = narrow.groupBy("_c", "_b").agg(F.count(F.lit(1)).alias("_n"))
    group = Window.partitionBy("_c")
    upto = group.orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return counts.select(
        "_c", "_b", "_n", F.sum("_n").over(upto).alias("_upto"), F.sum("_n").over(group).alias("_size")
    )


def _common_size(narrow: DataFrame, max_ratio: float | None) -> Column:
    """Size of the smallest class as a scalar subquery; null if there is nothing to cut."""
    sizes = narrow.groupBy("_c").agg(F.count(F.lit(1)).alias("_n"))
    low = F.min("_n")
    uneven = F.count(F.lit(1)) > 1
    if max_ratio is not None:
        uneven = uneven & ((low / F.max("_n")) < max_ratio)
    return sizes.agg(F.when(uneven, low).alias("_x")).scalar()


def thresholds(narrow: DataFrame, targets: Sequence[Callable[[Column], Column]]) -> Column:
    """Scalar map class -> cut number -> (digest, key) of the row where a target is reached.

    ``targets`` give the number of rows up to each cut from the class size.  A cut beyond the class has
    no entry; a cut at zero rows has an empty digest, which lies before every row.
    """
    totals = _bucket_totals(narrow)
    wanted = F.array(*[F.struct(F.lit(i).alias("cut"), t(F.col("_size")).cast("bigint").alias("target"))
                       for i, t in enumerate(targets)])
    before = F.col("_upto") - F.col("_n")
    hit = ((before < F.col("_w.target")) & (F.col("_w.target") <= F.col("_upto"))) | (
        (F.col("_w.target") <= 0) & (before == 0)
    )
    cuts = totals.withColumn("_w", F.explode(wanted)).where(hit).select(
        "_c",
        F.struct(F.col("_b").alias("b"), F.col("_w.cut").alias("cut"), (F.col("_w.target") - before).alias("nth")).alias("_w"),
    )
    per_class = cuts.groupBy("_c").agg(F.collect_list("_w").alias("_ws"))
    lookup = per_class.agg(F.map_from_entries(F.collect_list(F.struct("_c", "_ws"))).alias("_m")).scalar()
    near = narrow.withColumn("_ws", F.element_at(lookup, F.col("_c"))).withColumn(
        "_w", F.explode(F.filter("_ws", lambda w: w["b"] == F.col("_b")))
    )
    place = Window.partitionBy("_c", "_w.cut", "_b").orderBy("_h", "_k")
    at = near.withColumn("_rn", F.row_number().over(place)).where(
        F.col("_rn") == F.greatest(F.col("_w.nth"), F.lit(1))
    )
    digest = F.when(F.col("_w.nth") > 0, F.col("_h")).otherwise("")
    entry = F.struct(F.col("_w.cut"), F.struct(digest.alias("h"), F.col("_k").alias("k")))
    found = at.groupBy("_c").agg(F.map_from_entries(F.collect_list(entry)).alias("_t"))
    return found.agg(F.map_from_entries(F.collect_list(F.struct("_c", "_t"))).alias("_m")).scalar()


def within(limits: Column, code: Column, cut: int, key, seed: int, purpose: str) -> Column:
    """Is this row at or before the threshold of its class?  True where there is no threshold."""
    limit = F.element_at(F.element_at(limits, code), F.lit(cut))
    here = F.struct(order_digest(key, seed, purpose).alias("h"), key_struct(key).alias("k"))
    return F.coalesce(here <= limit, F.lit(True))


def class_rank(df: DataFrame, label: str, key, seed: int = SEED, purpose: str = BALANCE) -> DataFrame:
    """``(key, label, class_rank, class_size)``: each row's place in the random order of its class.

    One shuffle of narrow rows by (class, bucket); a large class spreads over all buckets.
    """
    narrow = _narrow(df, key, seed, label, None, purpose)
    place = Window.partitionBy("_c", "_b").orderBy("_h", "_k")
    totals = _bucket_totals(narrow).select(
        "_c", "_b", (F.col("_upto") - F.col("_n")).alias("_before"), F.col("_size").alias("class_size")
    )
    ranked = narrow.withColumn("_rn", F.row_number().over(place)).join(totals, ["_c", "_b"])
    return ranked.select(
        *[F.col(f"_k.{k}").alias(k) for k in names(key)],
        F.col("_c").alias(label),
        (F.col("_before") + F.col("_rn")).cast("bigint").alias("class_rank"),
        F.col("class_size").cast("bigint"),
    )


def sample_rows(df: DataFrame, n: int, key, seed: int = SEED) -> DataFrame:
    """Exactly ``n`` rows in random order of the key, or all rows if there are no more."""
    if n <= 0:
        raise ValueError("n must be positive")
    limits = thresholds(_narrow(df, key, seed, None, None, SAMPLE), [lambda size: F.lit(n)])
    return df.where(within(limits, F.lit(0), 0, key, seed, SAMPLE))


def balance_classes(
    df: DataFrame,
    label: str,
    key,
    classes: Sequence | None = None,
    max_ratio: float | None = None,
    seed: int = SEED,
) -> DataFrame:
    """Cut every class to the size of the smallest; a single class stays as it is.

    With ``max_ratio`` this happens only if smallest/largest lies below it.  Rows without a label
    (or, when ``classes`` is given, with another label) are dropped.
    """
    classes = class_list(df, label) if classes is None else classes
    narrow = _narrow(df, key, seed, label, classes, BALANCE)
    common = _common_size(narrow, max_ratio)
    if classes is None:
        ranks = class_rank(df, label, key, seed)
        keep = ranks.where(F.col("class_rank") <= F.coalesce(common, F.col("class_size"))).select(*names(key))
        return df.join(keep, names(key), "left_semi")
    limits = thresholds(narrow, [lambda size: F.coalesce(common, size)])
    return df.where(F.col(label).isin(*classes) & within(limits, F.col(label), 0, key, seed, BALANCE))


def _share(size: Column, share: float) -> Column:
    return F.ceil(size.cast("double") * F.lit(float(share))).cast("bigint")


def split_rows(
    df: DataFrame, label: str, key, config: SplitConfig = SplitConfig(), classes: Sequence | None = None
) -> DataFrame:
    """Add ``split`` = train / validation / test, stratified by class, in random order of the key."""
    held = config.validation + config.test

    def train_end(size: Column) -> Column:
        return size - _share(size, held)

    def validation_end(size: Column) -> Column:
        return size - _share(_share(size, held), config.test / held)

    classes = class_list(df, label) if classes is None else classes
    if classes is None:
        ranks = class_rank(df, label, key, config.seed, SPLIT).drop(label)
        rank, size = F.col("class_rank"), F.col("class_size")
        split = F.when(rank <= train_end(size), "train").when(rank <= validation_end(size), "validation")
        return df.join(ranks, names(key)).withColumn("split", split.otherwise("test")).drop("class_rank", "class_size")
    limits = thresholds(_narrow(df, key, config.seed, label, classes, SPLIT), [train_end, validation_end])
    split = (
        F.when(within(limits, F.col(label), 0, key, config.seed, SPLIT), "train")
        .when(within(limits, F.col(label), 1, key, config.seed, SPLIT), "validation")
        .otherwise("test")
    )
    return df.where(F.col(label).isin(*classes)).withColumn("split", split)


def split_rows_by_hash(df: DataFrame, key, config: SplitConfig = SplitConfig()) -> DataFrame:
    """Approximate split by digest value alone: no shuffle, sizes right only on average."""
    place = F.conv(F.substring(order_digest(key, config.seed, SPLIT), 1, 8), 16, 10).cast("double") / float(1 << 32)
    train = 1.0 - config.validation - config.test
    split = F.when(place < train, "train").when(place < train + config.validation, "validation").otherwise("test")
    return df.withColumn("split", split)


def split_sizes(df: DataFrame, label: str) -> DataFrame:
    """Rows per split and class, and their share of the table."""
    counts = df.groupBy("split", label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.withColumn("share", F.col("n").cast("double") / total)


def shuffle_key(df: DataFrame, key, seed: int = SEED) -> DataFrame:
    """Add the random order as a column; a table itself has no order."""
    return df.withColumn("shuffle_key", order_digest(key, seed))


def in_random_order(df: DataFrame, key, seed: int = SEED) -> DataFrame:
    """Rows range-partitioned and sorted by the random order, ready to be written."""
    marked = shuffle_key(df, key, seed)
    return marked.repartitionByRange("shuffle_key").sortWithinPartitions("shuffle_key").drop("shuffle_key")
