"""Packed sequences follow the mixture."""

import random
from collections import Counter

import corpus_pipeline as P
from textgauge.llm import mixing, packing


def test_leading_sequences_hold_the_shares(spark):
    rng, shares = random.Random(4), {"a": 6, "b": 1}
    words = "the cat sat on a mat while old dogs ran over green hills and far away".split()
    # b has two thirds of all rows and an eighth of the mixture; some texts are longer than a window.
    rows = [(i, " ".join(rng.choices(words, k=rng.choice([20, 60, 150, 400, 2500]))), "abb"[i % 3]) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    order = mixing.mix(docs, shares, 1, block_bytes=8000)
    got = packing.packed_digest(*packing.pack(docs, order=order, period=8, range_tokens=16000)).collect()
    source = {i: s for i, _, s in rows}
    docs_tokens = {r.doc_id: r.doc_tokens for r in got}
    total = Counter()
    for k, n in docs_tokens.items():
        total[source[k]] += n
    assert sum(r.length for r in got) == sum(total.values())
    sequences = {}
    for r in got:
        sequences.setdefault(r.sequence_id, []).append(r)
    for own in sequences.values():  # places don't overlap and fill what they say
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert {r.filled for r in own} == {at} and at <= packing.WINDOW
    sent, checked = Counter(), 0
    for key in sorted(sequences):
        for r in sequences[key]:
            sent[source[r.doc_id]] += r.length
        if sent["a"] > 0.9 * total["a"]:
            break
        if sum(sent.values()) > 60_000:  # several ranges
            checked += 1
            assert abs(sent["a"] / sum(sent.values()) - 6 / 7) < 0.07
    assert checked > 10


def test_stage_follows_the_mixture(spark, sf):
    """A source with a large share and few rows is used up long before one with a small share and many."""
    text = "the cat sat on a mat while old dogs ran over green hills and far away " * 40
    rows = [(i, text[: 1500 + i % 700], "src0" if i % 5 == 0 else "src1") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = P.packing_stage(spark, docs, sf).collect()
    at = {k: n for n, k in enumerate(sorted({r.sequence_id for r in got}))}
    last = {s: max(at[r.sequence_id] for r in got if (r.doc_id % 5 == 0) == (s == "src0")) for s in ("src0", "src1")}
    assert last["src0"] < 0.75 * last["src1"]


def test_rows_without_a_key_spread_over_ranges(spark):
    """A third of the rows has no key, hence one place in the order; no group of the planning holds them all."""
    text = "the cat sat on a mat while old dogs ran over green hills and far away " * 3
    rows = [(None if i % 3 == 0 else i, text + str(i), "ab"[i % 2]) for i in range(1800)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(5)
    order = mixing.mix(docs, {"a": 1, "b": 1}, 1, block_bytes=2000)
    got = packing.packed_digest(*packing.pack(docs, order=order, period=3, range_tokens=1000)).collect()
    assert len(got) == 1800 and sum(r.doc_id is None for r in got) == 600
    total, ranges = sum(r.length for r in got), Counter()
    for r in got:
        ranges[r.sequence_id >> 32] += r.length
    assert max(ranges.values()) < 17_000 < total / 3
    places = {(r.sequence_id, r.offset) for r in got}
    assert len(places) == 1800
    for key in {r.sequence_id for r in got}:
        own = sorted((r.offset, r.length) for r in got if r.sequence_id == key)
        assert [a for a, _ in own] == [sum(n for _, n in own[:i]) for i in range(len(own))]
