"""Weighted fingerprints: the collision rate, the edited texts, odd rows."""

import hashlib
import random
from collections import Counter

import numpy as np

from textgauge.llm import weighted


def jaccard(a, b):
    """Generalised: the sum of the smaller weights over the sum of the larger."""
    a, b = Counter(a.split()), Counter(b.split())
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_collision_rate_is_the_generalised_jaccard_similarity():
    rng, sampler = random.Random(4), weighted.Sampler()
    errors = []
    for i in range(150):
        words = [f"w{i}x{rng.randrange(40)}" for _ in range(200)]
        cut = rng.randrange(1, 200)
        other = [f"w{i}x{rng.randrange(60)}" for _ in range(cut)] + words[cut:]
        a, b = " ".join(words), " ".join(other)
        errors.append(weighted.likeness(sampler.fingerprint(a), sampler.fingerprint(b)) - jaccard(a, b))
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 0.08


def test_weights_count():
    sampler = weighted.Sampler()
    a, b = "x " * 90 + "y " * 10, "x " * 10 + "y " * 90
    assert weighted.likeness(sampler.fingerprint(a), sampler.fingerprint(b)) < 0.35  # true value 1 / 9


def plain_rows(docs):
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: -r.doc_id)
    texts = [r.text or "" for r in rows]
    for r, text, following in zip(rows, texts, texts[1:] + texts[:1]):
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        yield r.doc_id, len(text), hashlib.sha256(changed.encode()).hexdigest(), text, changed, following


def test_documents(documents):
    found = {r.doc_id: r for r in weighted.compare_edited(documents, bytes_per_task=50_000).collect()}
    sampler, close = weighted.Sampler(), []
    for key, n, digest, text, changed, following in plain_rows(documents):
        r = found.pop(key)
        assert (r.n_chars, r.edited_sha256) == (n, digest)
        assert r.fingerprint == sampler.fingerprint(text).tobytes().hex()
        assert r.edited_fingerprint == sampler.fingerprint(changed).tobytes().hex()
        close.append((r.near_edited - jaccard(text, changed), r.near_next - jaccard(text, following)))
    assert not found
    assert np.abs(np.mean(close, 0)).max() < 0.03 and np.std(close, 0).max() < 0.1


def test_odd_rows(odd_docs, no_docs, spark):
    rows = weighted.compare_edited(odd_docs, bytes_per_task=100).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert by_id[4].fingerprint == by_id[5].fingerprint
    assert by_id[2].n_chars == by_id[3].n_chars == 0 and by_id[3].near_next == 1.0
    assert by_id[4].near_next == by_id[2].near_next == 0.0
    assert weighted.compare_edited(no_docs).collect() == []
    one = weighted.compare_edited(spark.createDataFrame([(1, "a b c d")], "doc_id long, text string")).collect()
    assert one[0].near_next == 1.0 and len(one) == 1


def test_kept_rows_change_nothing(monkeypatch):
    text = " ".join(f"w{i % 700}" for i in range(2000))
    plain = weighted.Sampler().fingerprint(text)
    monkeypatch.setattr(weighted, "CACHED", 1 << 14)
    sampler = weighted.Sampler()
    for i in range(5):
        sampler.fingerprint(" ".join(f"v{i}x{j}" for j in range(9000)))
    assert (sampler.fingerprint(text) == plain).all()
