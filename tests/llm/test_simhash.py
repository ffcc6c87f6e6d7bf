"""SimHash groups against all pairs; the trie walk against all pairs of planted fingerprints."""

import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from textgauge.llm import simhash
from textgauge.llm.components import connected, local_components


def plain_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0d]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0


def reach(keys, values, distance=4):
    """Smallest key reachable, by all pairs."""
    own = np.array(values, np.uint64)
    near = np.bitwise_count(own[:, None] ^ own[None, :]) <= distance
    root = local_components(len(own), *np.nonzero(near))
    least = {}
    for key, r in zip(keys, root):
        if key is not None:
            least[r] = min(key, least.get(r, key))
    return [least.get(r) for r in root]


def check(docs):
    rows = docs.select("doc_id", "text").collect()
    values = [plain_fingerprint(r.text) for r in rows]
    groups = reach([r.doc_id for r in rows], values)
    want = sorted((str(r.doc_id), f"{v:016x}", str(g)) for r, v, g in zip(rows, values, groups))
    assert sorted((str(a), b, str(c)) for a, b, c in simhash.near_duplicates(docs).collect()) == want


def test_documents(documents):
    check(documents)


def test_odd_rows(odd_docs, no_docs):
    check(odd_docs)
    assert simhash.near_duplicates(no_docs).collect() == []
    kept = simhash.first_of_groups(odd_docs, simhash.near_duplicates(odd_docs))
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.filter("doc_id is not null").collect()) == [1, 2, 4, 7, 8, 9]


def planted(n=3000, seed=1):
    """Random fingerprints, chains of near ones, and a dense cluster."""
    r = np.random.default_rng(seed)
    base = r.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + r.integers(0, 2, n).astype(np.uint64)
    flip = [base]
    for bits in (1, 2, 4, 5):
        mask = np.zeros(n // 4, np.uint64)
        for _ in range(bits):
            mask |= np.uint64(1) << r.integers(0, 64, n // 4).astype(np.uint64)
        flip.append(base[: n // 4] ^ mask)
    centre = base[0]
    flip.append(centre ^ (np.uint64(1) << r.integers(0, 64, 400).astype(np.uint64)) ^ (np.uint64(1) << r.integers(0, 64, 400).astype(np.uint64)))
    return np.unique(np.concatenate(flip))


def linked_groups(spark, values, **options):
    df = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    found = dict(connected(simhash.links(df, **options)).collect())
    return [found.get(int(v), int(v)) for v in values.view(np.int64)]


def test_trie_walk_loses_no_link(spark):
    values = planted()
    own = values.view(np.int64).tolist()
    want = reach(own, values)
    assert linked_groups(spark, values) == want
    # Pairs of nodes over the bound are walked by Spark first; the bound changes nothing else.
    assert linked_groups(spark, values, most=20, levels=4) == want
    for distance in (0, 1, 3):
        assert linked_groups(spark, values[:1500], distance=distance) == reach(own[:1500], values[:1500], distance)


def test_hash_is_sparks(spark):
    text = "größer ist besser als klein"
    row = spark.range(1).select(F.xxhash64(F.lit(text))).first()[0]
    assert row & (1 << 64) - 1 == xxhash.xxh64_intdigest(text.encode(), 42)


def test_components(spark):
    chain = [(i, i + 1) for i in range(40)] + [(100, 7), (50, 50)] + [(200 + i, 300) for i in range(50)]
    found = dict(connected(spark.createDataFrame(chain, "a long, b long")).collect())
    assert all(found[i] == 0 for i in range(41)) and found[100] == 0 and found[300] == 200
    assert 50 not in found
