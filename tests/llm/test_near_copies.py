"""The near-dedup stage against exact 5-word Jaccard similarities of all pairs."""

import random

import corpus_pipeline as P
from textgauge.llm import minhash


def shingle_set(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def exact_groups(texts):
    keys, sets, root = sorted(texts), {k: shingle_set(t) for k, t in texts.items()}, {k: k for k in texts}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            shared = len(sets[a] & sets[b])
            if sets[a] == sets[b] or shared * 5 >= 4 * (len(sets[a]) + len(sets[b]) - shared):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {k: top(k) for k in keys}


def planted():
    """Copies with words replaced, at similarities on both sides of 0.8, and a large group around one text."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(4000)]
    texts = {}
    for _ in range(40):
        base = rng.choices(words, k=200)
        for n in (0, 2, 3, 4, 5, 6):
            copy = list(base)
            for at in rng.sample(range(200), n):
                copy[at] = rng.choice(words)
            texts[len(texts)] = " ".join(copy)
    hub = rng.choices(words, k=200)
    for _ in range(120):
        copy = list(hub)
        for at in rng.sample(range(200), rng.choice([1, 2, 4])):
            copy[at] = rng.choice(words)
        texts[len(texts)] = " ".join(copy)
    return texts


def template(pairs=200, boilerplate=200, own=29, changed=1, seed=11):
    """Texts on one template: two and two share their own words but for a few, all others only the boilerplate."""
    rng = random.Random(seed)
    words = [f"t{i}" for i in range(6000)]
    common, texts = rng.choices(words, k=boilerplate), {}
    for _ in range(pairs):
        first = rng.choices(words, k=own)
        second = list(first)
        for at in rng.sample(range(own), changed):
            second[at] = rng.choice(words)
        for tail in (first, second):
            texts[len(texts)] = " ".join(common + tail)
    return texts


def test_stage_keeps_one_of_each_group_at_similarity_08(spark, sf):
    texts = planted()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    want = exact_groups(texts)
    assert {r.doc_id: r.component_id for r in minhash.near_copies(docs).collect()} == want
    assert {r.doc_id for r in P.near_dedup_stage(spark, docs, sf).collect()} == set(want.values())


def test_pairs_on_one_template_are_found(spark):
    texts = template()
    want = exact_groups(texts)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in minhash.near_copies(docs).collect()}
    linked = [k for k, v in want.items() if v != k]
    assert len(linked) >= 190 and all(want[v] == want[k] for k, v in got.items())
    assert sum(got[k] == want[k] for k in linked) >= 0.99 * len(linked)


def test_candidates_grow_with_the_rows(spark, monkeypatch):
    """Twice the texts on one template give about twice the pairs, not four times."""
    made = []

    def counted(pairs, sets, percent, check=minhash._checked):
        made[-1] += pairs.count()
        return check(pairs, sets, percent)

    monkeypatch.setattr(minhash, "_checked", counted)
    for pairs in (100, 200):
        made.append(0)
        docs = spark.createDataFrame(list(template(pairs).items()), "doc_id long, text string").repartition(4)
        minhash.near_copies(docs)
    assert made[1] < 2.6 * made[0]


def test_rows_with_one_key_follow_their_own_texts(spark, sf):
    texts = planted()
    rows = [(1, texts[0]), (5, texts[0]), (5, texts[100]), (5, texts[100]), (7, texts[200]), (7, texts[200] + " end"), (None, texts[0]), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [tuple(r) for r in P.near_dedup_stage(spark, docs, sf).collect()]
    assert len(kept) == len(set(kept))
    assert {r for r in kept if r[0] is None} == {(None, texts[0]), (None, None)}
    assert {r for r in kept if r[0] in (1, 5)} == {(1, texts[0]), (5, texts[100])}
    assert sum(r[0] == 7 for r in kept) == 1


def test_odd_rows(odd_docs, no_docs):
    rows = minhash.near_copies(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    of = {r.doc_id: r.component_id for r in rows if r.doc_id is not None}
    assert (of[1], of[4], of[5], of[9]) == (1, 4, 4, 9) and of[2] == of[3] == of[6] == 2
    assert sorted(str(r.component_id) for r in rows if r.doc_id is None) == ["2", "9"]
    assert minhash.near_copies(no_docs).collect() == []
