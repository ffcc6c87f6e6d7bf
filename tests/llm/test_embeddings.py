"""Vector links against all pairs."""

import numpy as np
import pytest

from textgauge.llm import embeddings
from textgauge.llm.components import local_components


def brute(keys, vectors, cosine=0.95):
    n = len(keys)
    good = [i for i, v in enumerate(vectors) if v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    near = np.zeros((n, n), bool)
    for i in good:
        for j in good:
            if i != j and len(vectors[i]) == len(vectors[j]):
                a, b = np.array(vectors[i], float), np.array(vectors[j], float)
                near[i, j] = a @ b / np.sqrt((a @ a) * (b @ b)) >= cosine
    root = local_components(n, *np.nonzero(near | np.eye(n, dtype=bool)))
    least = {}
    for k, r in zip(keys, root):
        if k is not None:
            least[r] = min(k, least.get(r, k))
    return [(k, int(near[i].sum()), least.get(r)) for i, (k, r) in enumerate(zip(keys, root))]


def test_table(spark, sf):
    """The table's vectors and slightly moved copies of every third."""
    rows = spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    moved = np.random.default_rng(5).normal(0, 0.03, (len(rows), 64))
    data = [(r.vec_id, r.embedding) for r in rows]
    data += [(1000 + r.vec_id, (np.array(r.embedding) + m).tolist()) for r, m in list(zip(rows, moved))[::3]]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    rows = df.collect()
    x = embeddings.unit(np.array([r.embedding for r in rows], float))
    want = (x @ x.T >= 0.95).sum(1) - 1
    found = {r.vec_id: r for r in embeddings.near_duplicates(df).collect()}
    got = np.array([found[r.vec_id].n_links for r in rows])
    assert len(found) == len(rows) and (got <= want).all()
    assert got.sum() >= 0.99 * want.sum() > 0
    # All lists probed: every link is found.
    every = {r.vec_id: r.n_links for r in embeddings.near_duplicates(df, probes=10**6).collect()}
    assert [every[r.vec_id] for r in rows] == want.tolist()


def test_odd_vectors(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 5))
    rows = [(i, v.tolist(), "x") for i, v in enumerate(np.concatenate([base, base * 3 + rng.normal(0, 0.05, base.shape)]))]
    rows += [(100, None, "x"), (101, [0.0] * 5, "x"), (102, [1.0, None, 2.0, 3.0, 4.0], None), (103, [float("nan")] * 5, "x")]
    rows += [(104, [float("inf"), 1.0, 1.0, 1.0, 1.0], "x"), (105, [], "x"), (106, [1.0, 2.0], "x"), (107, [2.0, 4.0], "x")]
    rows += [(None, base[0].tolist(), "x"), (3, base[3].tolist(), "x"), (108, [1e200, 1e200, 0.0, 0.0, 0.0], "x"), (109, [2e200, 2e200, 0.0, 0.0, 0.0], "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, unit string")
    want = [w for w in brute([r[0] for r in rows], [r[1] for r in rows]) if w[0] not in (108, 109)] + [(108, 1, 108), (109, 1, 108)]
    found = embeddings.near_duplicates(df, lists=4, probes=4).collect()
    assert sorted((str(r.vec_id), r.n_links, str(r.component_id)) for r in found) == sorted((str(a), b, str(c)) for a, b, c in want)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in found)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert embeddings.near_duplicates(df).collect() == []


@pytest.mark.parametrize("chunk", [7, 4096])
def test_chunks_of_a_hot_list_lose_no_link(spark, chunk):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(60, 8)), 1 + rng.normal(0, 0.2, (60, 8))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    classes = embeddings.directions(df).filter("unit is not null").withColumnRenamed("vec_id", "id")
    got = {tuple(r) for r in embeddings.links(classes, lists=2, probes=2, chunk=chunk).collect()}
    u = embeddings.unit(x)
    assert got == {(a, b) for a, b in zip(*np.nonzero(u @ u.T >= 0.95)) if a < b}


@pytest.mark.parametrize("chunk", [7, 4096])
@pytest.mark.parametrize("probes", [1, 2, 4])
def test_counts_and_forest_are_those_of_the_links(spark, chunk, probes):
    """Also where only one of two vectors asks the other's list."""
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(60, 8)), 1 + rng.normal(0, 0.25, (80, 8))])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    classes = embeddings.directions(df).filter("unit is not null").withColumnRenamed("vec_id", "id").selectExpr("*", "1 + id % 3 as copies")
    options = {"lists": 6, "probes": probes, "chunk": chunk}
    pairs = [tuple(r) for r in embeddings.links(classes, **options).collect()]
    want, root = {}, local_components(len(x), *np.array(pairs).T)
    for a, b in pairs:
        want[a] = want.get(a, 0) + 1 + b % 3
        want[b] = want.get(b, 0) + 1 + a % 3
    counts, forest = embeddings.degrees(classes, **options)
    assert {r.id: r.others for r in counts.collect()} == want
    assert local_components(len(x), *np.array([tuple(r) for r in forest.collect()]).T).tolist() == root.tolist()


def test_a_dense_group_returns_rows_not_links(spark):
    x = 1 + np.random.default_rng(4).normal(0, 0.05, (600, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    classes = embeddings.directions(df).filter("unit is not null").withColumnRenamed("vec_id", "id")
    counts, forest = embeddings.degrees(classes, lists=20)
    assert {r.others for r in counts.collect()} == {599}
    # At most one row for each vector that a task holds, against 179,700 links.
    assert forest.count() <= 600 * 20 + 600
    assert {r.others for r in embeddings.degrees(classes)[0].collect()} == {599}


def test_lists_follow_the_table(spark):
    """A list grows with the root of the rows; recall stays."""
    compared = {}
    for n in (2000, 8000):
        rng = np.random.default_rng(6)
        x = rng.normal(size=(n // 2, 16))
        x = np.concatenate([x, x + rng.normal(0, 0.05, x.shape)])
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
        classes = embeddings.directions(df).filter("unit is not null").withColumnRenamed("vec_id", "id").cache()
        (model,) = embeddings.train(classes).values()
        compared[n] = 8 * n / len(model.centres) / n
        linked = {tuple(r) for r in embeddings.links(classes).collect()}
        assert sum((i, i + n // 2) in linked for i in range(n // 2)) >= 0.99 * (n // 2)
    assert compared[8000] <= 0.51 * compared[2000]
