"""Mixing: deadlines and deviation.  Shards: the curve, equal counts, files that filters can skip."""

import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from textgauge.llm import hilbert, mixing


@pytest.mark.parametrize("shares", [{"a": 1}, {"a": 1, "b": 1}, {"a": 50, "b": 30, "c": 19, "d": 1}, {f"s{i}": i + 1 for i in range(13)}])
def test_schedule_is_proportionate_and_fair(shares):
    slots, period = mixing.schedule(shares), sum(shares.values())
    owner = {slot: s for s, own in slots.items() for slot in own}
    assert sorted(owner) == list(range(period))
    sent = Counter()
    for slot in range(period):
        s = owner[slot]
        k = sent[s]
        assert k * period // shares[s] <= slot < -(-(k + 1) * period // shares[s])  # released, not late
        sent[s] += 1
        for other, q in shares.items():
            assert abs(sent[other] - q * (slot + 1) / period) < 1


SHARES, REST = {"a": 5, "b": 2}, 3


def test_mixture_follows_the_shares(spark):
    rows = [(i, "x" * (20 + i % 50), "a" if i % 3 == 0 else "bcd"[i % 5 % 3]) for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    block = 1000
    plan = mixing.mix(docs, SHARES, REST, block_bytes=block).collect()
    assert len(plan) == len(rows)
    for r in plan:
        assert r.release <= r.slot < r.deadline
    last = {s: max(r.slot for r in plan if r.stream == s) for s in ("a", "b", mixing.REST)}
    sent, until = Counter(), min(last.values())
    slots = {}
    for r in plan:
        slots.setdefault(r.slot, []).append(r)
    for slot in range(until):
        for r in slots[slot]:
            sent[r.stream] += r.size
        for s, q in {**SHARES, mixing.REST: REST}.items():
            # Less than one block by the schedule, and the text that runs over a block's end.
            assert abs(sent[s] - q * (slot + 1) * block / 10) < block + 70


def test_mix_of_odd_rows(odd_docs, no_docs):
    plan = mixing.mix(odd_docs, SHARES, REST)
    rows = plan.collect()
    assert len(rows) == odd_docs.count() and all(r.release <= r.slot < r.deadline for r in rows)
    assert {r.stream for r in rows if r.source is None} == {mixing.REST}
    out = mixing.mixed(odd_docs, plan)
    assert out.columns == odd_docs.columns and sorted(map(str, out.collect())) == sorted(map(str, odd_docs.collect()))
    assert mixing.mix(no_docs, SHARES, REST).collect() == []
    for shares, rest in (({"a": 0}, 1), ({"a": 1}, 0), ({mixing.REST: 1}, 1)):
        with pytest.raises(ValueError):
            mixing.mix(no_docs, shares, rest)


@pytest.mark.parametrize("dimensions,bits", [(2, 3), (3, 3), (4, 2)])
def test_curve_visits_neighbours(spark, dimensions, bits):
    """Every cell once, and consecutive cells differ by one in one dimension."""
    cells = spark.range(1 << dimensions * bits)
    for i in range(dimensions):
        cells = cells.withColumn(f"d{i}", F.expr(f"(id >> {i * bits}) & {(1 << bits) - 1}"))
    rows = hilbert.with_curve_index(cells, [f"d{i}" for i in range(dimensions)], bits=bits).orderBy("curve_index").collect()
    assert [r.curve_index for r in rows] == list(range(len(rows)))
    for a, b in zip(rows, rows[1:]):
        assert sum(abs(a[f"d{i}"] - b[f"d{i}"]) for i in range(dimensions)) == 1


def check_shards(docs, shards):
    rows = hilbert.shard_by_curve(docs, shards=shards).collect()
    texts = sorted((str(r.doc_id), len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == texts
    own = {}
    for r in rows:
        own.setdefault(r.shard, []).append(r)
    counts = [len(own.get(s, [])) for s in range(shards)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(rows) and max(own, default=0) < shards
    ordered = []
    for s in sorted(own):
        part = sorted(own[s], key=lambda r: r.slot)
        assert [r.slot for r in part] == list(range(len(part)))
        ordered += [r.curve_index for r in part]
    assert ordered == sorted(ordered)
    assert {(r.law, r.grown_shard) for r in rows} <= {("rows", None)}
    return rows


@pytest.mark.parametrize("shards", [1, 7, 24])
def test_shards(documents, odd_docs, no_docs, shards):
    check_shards(documents, shards)
    check_shards(odd_docs, shards)
    assert check_shards(no_docs, shards) == []


def test_files_can_be_skipped(spark, documents, tmp_path):
    path = str(tmp_path / "shards")
    hilbert.write_shards(documents, hilbert.shard_by_curve(documents, shards=8), path)
    back = spark.read.parquet(path)
    assert sorted(map(str, back.drop("shard").collect())) == sorted(map(str, documents.collect()))
    boxes = back.groupBy("shard").agg(F.collect_set("lang").alias("langs"), F.min("n_chars").alias("low"), F.max("n_chars").alias("high")).collect()
    assert len(boxes) == 8 and sum(len(b.langs) for b in boxes) < 8 * 4 * 0.8


def test_filters_on_any_dimension_skip_shards(spark):
    """Shards that a filter reads by least and largest value, for every value of every dimension."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    plan = hilbert.shard_by_curve(docs, shards=24).select("doc_id", "shard", "size")
    rows = docs.select("doc_id", "lang", "source").join(plan, "doc_id").collect()
    for column, most in (("lang", 12), ("source", 14), ("size", 14)):
        boxes, holds = {}, {}
        for r in rows:
            low, high = boxes.get(r.shard, (r[column], r[column]))
            boxes[r.shard] = min(low, r[column]), max(high, r[column])
            holds.setdefault(r[column], set()).add(r.shard)
        read = {v: sum(low <= v <= high for low, high in boxes.values()) for v in holds}
        if column == "size":
            read = {v: n for v, n in read.items() if v % 7 == 0}
        print(column, sorted(read.values()), [len(holds[v]) for v in sorted(holds)][:24])
        assert sum(read.values()) / len(read) <= most


def test_category_cells_keep_the_order(spark):
    rows = spark.createDataFrame([("b",), (None,), ("a",), ("z",), ("a",)], "c string")
    cells = {r.c: r.cell for r in hilbert.with_category_cells(rows, "c", "cell", 3).collect()}
    assert cells == {None: 0, "a": 2, "b": 4, "z": 6}
    many = spark.range(5000).selectExpr("lpad(id, 5, '0') as c")
    got = [r.cell for r in hilbert.with_category_cells(many, "c", "cell", 5).orderBy("c").collect()]
    assert got == sorted(got) and set(got) == set(range(32))
