"""How filters interact: survivors of every subset of five filters by a Gray-code walk, and what each order removes.

A document's failures are a mask of five bits, so the corpus shrinks to at most 32 cells of counts per part.  The walk
visits all subsets of filters so that one filter is switched on or off at a time.  Every cell keeps how many active
filters it fails; when that number leaves zero the cell's documents leave the survivors, when it returns to zero they
come back.  The 32 states are stored, and what a filter removes after others is the difference of two of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgauge.llm.tables import narrow, stored

FILTERS = "ABCDE"
LEAST_WORDS = 200
DISTINCT_PERCENT = 50
CAPITAL_PERCENT = 2
SIGNS = b"#$%&*|"
CAPITALS = bytes(range(65, 91))
INNER = bytes(range(0x80, 0xC0))


def failures(text: bytes | None) -> int:
    """Failures of the first four filters, which look at one text alone; bit 0 is filter A."""
    text = text or b""
    words = text.split()
    points = len(text) if text.isascii() else len(text.translate(None, INNER))
    a = len(words) < LEAST_WORDS
    b = 100 * len(set(words)) < DISTINCT_PERCENT * len(words)
    c = 100 * (len(text) - len(text.translate(None, CAPITALS))) > CAPITAL_PERCENT * points
    d = len(text.translate(None, SIGNS)) < len(text)
    return a | b << 1 | c << 2 | d << 3


def _looked_at(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["doc_id", "part", "mask", "digest"]
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            few = batch.slice(at, 256)
            texts = [t.as_py() or b"" for t in few.column(2)]
            masks = pa.array([failures(t) for t in texts], pa.int32())
            digests = pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([few.column(0), few.column(1), masks, digests], names=names)


def masks(docs: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``doc_id, part, mask, n``: failures of all five filters, with equal rows counted.

    Filter E fails a row if a smaller key has the same text; a null key neither fails it nor makes others fail.
    """
    rows = narrow(docs, {"doc_id": key, "_part": part, "_text": text})
    rows = rows.select(F.col("doc_id").cast("long"), F.coalesce(F.col("_part").cast("string"), F.lit("")), F.col("_text").cast("binary"))
    looked = rows.mapInArrow(_looked_at, "doc_id long, part string, mask int, digest binary")
    looked = stored(looked.groupBy("doc_id", "part", "mask", "digest").agg(F.count(F.lit(1)).alias("n")), "filter-masks")
    firsts = looked.filter("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    # Joined by text and key: the rows of one text spread over all tasks.
    firsts = firsts.withColumn("_first", F.lit(True))
    keyed = looked.filter("doc_id is not null").join(firsts, ["digest", "doc_id"], "left")
    copy = F.when(F.col("_first").isNull(), 1 << 4).otherwise(0)
    keyed = keyed.select("doc_id", "part", F.col("mask").bitwiseOR(copy).alias("mask"), "n")
    return keyed.unionByName(looked.filter("doc_id is null").select("doc_id", "part", "mask", "n"))


def cells(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """``part, mask, n, good, toxic``: documents of every part and mask; a document is good or toxic if any of its labels says so."""
    rows = masks(docs, key, text, part)
    known = narrow(labels, {"doc_id": key, "_quality": "quality", "_toxic": "toxic"}).filter("doc_id is not null")
    known = known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.col("_quality") == 1).alias("good"), F.max(F.col("_toxic") == 1).alias("toxic")
    )
    keyed = rows.filter("doc_id is not null").join(known, "doc_id", "left")
    unkeyed = rows.filter("doc_id is null").withColumn("good", F.lit(None).cast("boolean")).withColumn("toxic", F.lit(None).cast("boolean"))
    both = keyed.unionByName(unkeyed)

    def total(when):
        return F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0)).cast("long")

    return both.groupBy("part", "mask").agg(F.sum("n").alias("n"), total(F.col("good")).alias("good"), total(F.col("toxic")).alias("toxic"))


def walk(counts: np.ndarray) -> np.ndarray:
    """Survivors of every subset of filters, a row per subset, from counts with a row per mask."""
    many = len(counts)
    bits = many.bit_length() - 1
    states, failed, alive = np.zeros_like(counts), [0] * many, counts.sum(0)
    states[0] = alive
    subset = 0
    for step in range(1, many):
        # The lowest set bit of the step is the filter that a Gray code switches.
        turned = (step & -step).bit_length() - 1
        subset ^= 1 << turned
        on = subset >> turned & 1
        for mask in range(many):
            if mask >> turned & 1:
                failed[mask] += 1 if on else -1
                if on and failed[mask] == 1:
                    alive = alive - counts[mask]
                elif not on and failed[mask] == 0:
                    alive = alive + counts[mask]
        states[subset] = alive
    assert bits == 0 or subset == 1 << bits - 1
    return states


def steps(counts: np.ndarray, filters: str = FILTERS) -> list[tuple]:
    """``filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley`` of all orders."""
    states, k = walk(counts), len(filters)
    failing = [int(counts[[m for m in range(len(counts)) if m >> f & 1], 0].sum()) for f in range(k)]
    shapley = [0] * k
    for subset in range(len(counts)):
        weight = factorial(subset.bit_count()) * factorial(max(0, k - 1 - subset.bit_count()))
        for f in range(k):
            if not subset >> f & 1:
                shapley[f] += weight * int(states[subset, 0] - states[subset | 1 << f, 0])
    out = []
    for order in permutations(range(k)):
        before, name = 0, "".join(filters[f] for f in order)
        for i, f in enumerate(order):
            after = before | 1 << f
            removed, good, toxic = (int(x) for x in states[before] - states[after])
            out.append((name, i + 1, int(states[after, 0]), removed, failing[f] - removed, int(counts[1 << f, 0]), good, toxic, shapley[f]))
            before = after
    return out


COLUMNS = "filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "source") -> DataFrame:
    """What each of five filters removes at each step of all 120 orders, per part: 600 rows a part.

    Filters: A fewer than 200 words, B fewer than half of the words distinct, C over two percent capitals, D any of
    ``#$%&*|``, E an equal text with a smaller key anywhere in the table.  A null text is empty and a null part the empty
    name; rows with equal keys are each counted, and both pass E if none is smaller.  An empty table gives no rows.
    """
    names = [c.split()[0] for c in COLUMNS.split(", ")]

    def of_part(own: pd.DataFrame) -> pd.DataFrame:
        counts = np.zeros((1 << len(FILTERS), 3), np.int64)
        counts[own["mask"].to_numpy()] = own[["n", "good", "toxic"]].to_numpy()
        rows = pd.DataFrame(steps(counts), columns=names)
        rows.insert(0, "part", own["part"].iloc[0])
        return rows

    found = cells(docs, labels, key, text, part)
    return found.groupBy("part").applyInPandas(of_part, f"part string, {COLUMNS}")


AUDIT_SQL = r"""with looked as (
    select doc_id, coalesce(source, '') as part, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as words
    from (select *, coalesce(text, '') as t from documents)),
  labelled as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels where doc_id is not null group by doc_id),
  failing as (
    select d.doc_id, part, coalesce(good, false) as good, coalesce(toxic, false) as toxic,
        case when len(words) < 200 then 'A' else '' end
        || case when 100 * len(list_distinct(words)) < 50 * len(words) then 'B' else '' end
        || case when 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) then 'C' else '' end
        || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end
        || case when d.doc_id > min(d.doc_id) over (partition by t) then 'E' else '' end as fails
    from looked d left join labelled l on d.doc_id = l.doc_id),
  cells as (select part, fails, count(*) as n, count(*) filter (good) as good, count(*) filter (toxic) as toxic from failing group by part, fails),
  letters as (select unnest(['A', 'B', 'C', 'D', 'E']) as f),
  orders as (
    select a.f || b.f || c.f || d.f || e.f as filter_order
    from letters a join letters b on b.f <> a.f join letters c on c.f not in (a.f, b.f)
    join letters d on d.f not in (a.f, b.f, c.f) join letters e on e.f not in (a.f, b.f, c.f, d.f)),
  places as (select filter_order, step, filter_order[step] as f, filter_order[1:step - 1] as earlier from orders, (select unnest(range(1, 6))::int as step)),
  counted as (
    select part, filter_order, step, f,
        sum(case when fails = translate(fails, earlier || f, '') then n else 0 end)::bigint as kept,
        sum(case when contains(fails, f) and fails = translate(fails, earlier, '') then n else 0 end)::bigint as removed,
        sum(case when contains(fails, f) and fails <> translate(fails, earlier, '') then n else 0 end)::bigint as redundant,
        sum(case when fails = f then n else 0 end)::bigint as unique_fails,
        sum(case when contains(fails, f) and fails = translate(fails, earlier, '') then good else 0 end)::bigint as good_lost,
        sum(case when contains(fails, f) and fails = translate(fails, earlier, '') then toxic else 0 end)::bigint as toxic_lost
    from cells, places group by part, filter_order, step, f)
  select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    (sum(removed) over (partition by part, f))::bigint as shapley from counted"""
