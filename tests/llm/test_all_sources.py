"""op1: the one-block bound holds for every source of the table."""

from collections import Counter

from textgauge.llm import mixing
from textgauge.llm.queries import QUERIES, REST, SHARES


def test_every_source_has_its_stream(spark, documents, sf):
    sources = {r.source for r in documents.select("source").distinct().collect()}
    assert len(sources) == 20
    rows = QUERIES["op1_pfair_mix"](spark, sf).collect()
    assert all(r.stream == r.source for r in rows)
    assert all(r.release <= r.slot < r.deadline for r in rows)


def test_every_source_is_within_a_block_of_its_share(spark, documents):
    block, period = 1000, sum(SHARES.values()) + REST
    rows = mixing.mix(documents, SHARES, REST, block_bytes=block).collect()
    longest, last, slots = max(r.size for r in rows), {}, {}
    for r in rows:
        last[r.source] = max(last.get(r.source, 0), r.slot)
        slots.setdefault(r.slot, []).append(r)
    sent = Counter()
    for slot in range(min(last.values())):
        for r in slots.get(slot, []):
            sent[r.source] += r.size
        for name in last:
            assert abs(sent[name] - SHARES[name] * (slot + 1) * block / period) < block + longest
    assert set(last) <= set(SHARES) and mixing.REST not in last
