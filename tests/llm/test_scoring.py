"""Deleted interpolation against plain counting and plain expectation-maximisation."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest

from textgauge.llm import scoring


def tokens(text):
    return [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()] + ["END"]


def plain(rows):
    """Rows as the operator returns them, the weights, and the pieces of the model."""
    docs = [(k, tokens(t)) for k, t in rows]
    crc = lambda s: zlib.crc32(s.encode())
    name = lambda k: "" if k is None else str(k)
    held = [crc(name(k)) % 5 == 1 for k, _ in docs]
    back = [crc("deleted|" + name(k)) % 20 == 0 for k, _ in docs]

    def counted(chosen):
        words, pairs, context = Counter(), Counter(), Counter()
        for w in chosen:
            words.update(w)
            pairs.update(zip(["START", *w], w))
            context.update(["START", *w[:-1]])
        return words, pairs, context

    def three(w, v, model):
        words, pairs, context = model
        n, c = sum(words.values()), context[v]
        return c, [pairs[v, w] / c if c else 0.0, words[w] / max(1, n), 1 / (len(words) + 1)]

    main = counted([w for (_, w), h, b in zip(docs, held, back) if not h and not b])
    events = [three(w, v, main) for (_, t), h, b in zip(docs, held, back) if not h and b for v, w in zip(["START", *t], t)]
    weights = [[0, 0.5, 0.5], *[[1 / 3] * 3 for _ in range(64)]]
    last = None
    for _ in range(40 if events else 0):
        share, likelihood = {}, 0.0
        for c, p in events:
            b = c.bit_length()
            terms = [x * y for x, y in zip(weights[b], p)]
            likelihood += math.log(sum(terms))
            s = share.setdefault(b, [0.0, 1.0, 1.0] if b == 0 else [1.0, 1.0, 1.0])
            for k in range(3):
                s[k] += terms[k] / sum(terms)
        for b in range(65):
            if b in share:
                weights[b] = [x / sum(share[b]) for x in share[b]]
            elif b > 1:
                weights[b] = weights[b - 1]
        if last is not None and likelihood / len(events) - last < 1e-5:
            break
        last = likelihood / len(events)
    full = counted([w for (_, w), h in zip(docs, held) if not h])
    n, v = sum(full[0].values()), len(full[0])
    out = []
    for (k, t), h in zip(docs, held):
        base = sum(math.log10((full[0][w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        score = 0.0
        for u, w in zip(["START", *t], t):
            c, p = three(w, u, full)
            score += math.log10(sum(x * y for x, y in zip(weights[c.bit_length()], p)))
        out.append((k, h, len(t), sum(full[0][w] > 0 for w in t), n, base, score))
    return out, weights


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[2], r[6]))


def check(mine, want):
    want = sorted(want, key=lambda r: (r[0] is None, r[0] or 0, r[2], r[6]))
    assert [r[:5] for r in mine] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in mine], [r[5:] for r in want], rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("batch_bytes, range_bytes", [(scoring.BATCH_BYTES, scoring.RANGE_BYTES), (20_000, 5_000)])
def test_documents(documents, batch_bytes, range_bytes):
    want, weights = plain([(r.doc_id, r.text) for r in documents.collect()])
    docs = documents.repartition(3)
    model, _, _ = scoring.fit(docs, batch_bytes=batch_bytes, range_bytes=range_bytes)
    assert np.allclose(model.weights, weights, atol=1e-9) and model.rounds > 1
    mine = rows_of(scoring.score_documents(docs, batch_bytes=batch_bytes, range_bytes=range_bytes))
    check(mine, want)
    held = [r for r in mine if r[1]]
    assert sum(r[6] for r in held) > sum(r[5] for r in held)


def test_probabilities_of_all_words_and_an_unknown_one_add_up_to_one():
    weights = np.random.default_rng(1).dirichlet([1, 1, 1], scoring.BUCKETS)
    weights[0] = 0, 0.4, 0.6
    words, pairs = np.array([5, 3, 2, 0]), np.array([2, 1, 0, 0])
    model = scoring.Model(weights, 10, 3)
    for context, pair in ((3, pairs), (0, 0 * pairs)):
        assert model.probability(np.full(4, context), pair, words).sum() == pytest.approx(1)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    check(rows_of(scoring.score_documents(odd_docs)), plain(rows)[0])
    assert scoring.score_documents(no_docs).collect() == []
    # Without training documents.
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 == 1]
    only = spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string")
    check(rows_of(scoring.score_documents(only)), plain([(i, "a b") for i in held])[0])


def test_all_tokens_the_same(spark):
    rows = [(i, "spam " * (i % 50)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    check(rows_of(scoring.score_documents(docs, batch_bytes=500)), plain(rows)[0])


def test_hashes_survive_packing():
    values = np.unique(np.random.default_rng(2).integers(0, 1 << 64, 5000, np.uint64))
    assert (scoring._sorted(scoring._steps(values)) == values).all()
    assert (scoring._values(scoring._planes(values)) == values).all()
    assert len(scoring._sorted(scoring._steps(values[:0]))) == 0
