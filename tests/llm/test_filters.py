"""The filter audit against plain loops over documents, filters and orders."""

from itertools import permutations
from math import factorial

import numpy as np
import pytest

from textgauge.llm import filters

SPACE = " \t\n\x0b\x0c\r"


def plain_fails(rows):
    out = []
    for key, text, _ in rows:
        text, words, word = text or "", [], ""
        for c in text + " ":
            if c in SPACE:
                words += [word] if word else []
                word = ""
            else:
                word += c
        fails = ""
        fails += "A" if len(words) < 200 else ""
        fails += "B" if 100 * len(set(words)) < 50 * len(words) else ""
        fails += "C" if 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text) else ""
        fails += "D" if any(c in "#$%&*|" for c in text) else ""
        fails += "E" if key is not None and any(k is not None and k < key and (t or "") == text for k, t, _ in rows) else ""
        out.append(fails)
    return out


def plain_audit(rows, labels):
    fails, out = plain_fails(rows), set()
    good = {k for k, q, _ in labels if q == 1 and k is not None}
    toxic = {k for k, _, t in labels if t == 1 and k is not None}
    for part in {p or "" for _, _, p in rows}:
        own = [(k, f) for (k, _, p), f in zip(rows, fails) if (p or "") == part]
        found, shapley = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left, gone = own, []
            for step, f in enumerate(order, 1):
                lost = [(k, x) for k, x in left if f in x]
                left = [(k, x) for k, x in left if f not in x]
                shapley[f] += len(lost)
                found.append(("".join(order), step, f, len(left), len(lost), sum(f in x for _, x in gone), sum(x == f for _, x in own), sum(k in good for k, _ in lost), sum(k in toxic for k, _ in lost)))
                gone = gone + lost
        out |= {(part, *row[:2], *row[3:], shapley[row[2]]) for row in found}
    return out


def as_set(df):
    rows = df.collect()
    names = ["part", *[c.split()[0] for c in filters.COLUMNS.split(", ")]]
    out = {tuple(r[c] for c in names) for r in rows}
    assert len(out) == len(rows) and sorted(df.columns) == sorted(names)
    return out


def test_walk_counts_the_survivors_of_every_subset():
    rng = np.random.default_rng(3)
    counts = rng.integers(0, 50, (32, 3))
    counts[rng.integers(0, 32, 6)] = 0
    states = filters.walk(counts)
    for subset in range(32):
        assert (states[subset] == sum(counts[m] for m in range(32) if not m & subset)).all()
    rows = filters.steps(counts)
    assert len(rows) == 600
    assert {r[-1] for r in rows if r[0][r[1] - 1] == "C"} == {sum(r[3] for r in rows if r[0][r[1] - 1] == "C")}
    assert sum({r[0][r[1] - 1]: r[-1] for r in rows}.values()) == factorial(5) * int(counts[1:, 0].sum())


def test_documents(spark, documents, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = [(r.doc_id, r.text, r.source) for r in documents.collect()]
    marks = [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()]
    assert as_set(filters.audit(documents, labels)) == plain_audit(rows, marks)


def test_odd_rows(spark, odd_docs, no_docs):
    long = " ".join(f"w{i}" for i in range(300))
    more = spark.createDataFrame(
        [(10, long, "en", "a", 1, 1, "x", "y"), (11, long, "en", None, 1, 1, "x", "y"), (None, long, "en", "a", 1, 1, "x", "y"), (10, long, "en", "a", 1, 1, "x", "y"), (12, long + " $", "en", "", 1, 1, "x", "y"), (13, "É" * 99 + "A B", "en", "a", 1, 1, "x", "y")],
        odd_docs.schema,
    )
    docs = odd_docs.union(more)
    marks = [(1, 1, 0), (1, 0, 1), (5, 1, None), (None, 1, 1), (10, None, 1), (99, 1, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int, toxic int").selectExpr("*", "'x' as text", "1 as mask")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    assert as_set(filters.audit(docs, labels)) == plain_audit(rows, marks)
    assert as_set(filters.audit(docs, labels.limit(0))) == plain_audit(rows, [])
    assert filters.audit(no_docs, labels).collect() == []


@pytest.mark.parametrize("text, want", [(None, "A"), ("", "A"), ("a " * 200, "B"), ("Ab" * 5, "AC"), ("x|y", "AD"), ("é" * 49 + "A", "A")])
def test_limits(text, want):
    mask = filters.failures(None if text is None else text.encode())
    assert "".join(f for i, f in enumerate("ABCDE") if mask >> i & 1) == want
