"""Near-duplicate vectors by product quantisation with coarse inverted lists.

A sample of the vectors trains coarse centres and, for each of ``PARTS`` subspaces, a codebook of what is left after
the centre is taken away.  Every vector is stored in the list of its nearest centre as one code a subspace.  As a
query it probes the lists of its ``probes`` nearest centres: the distance to a code is the sum of entries of a table
of distances between the query's residual and the codebook (asymmetric: the query isn't quantised).  What comes
within reach by that estimate, less the code's own error, is compared by its exact cosine in double precision, and only that decides.

Spark deals queries and codes by list.  A list with more rows than a task should hold is cut into chunks, every pair
of chunks being a task of its own, so a centre that holds a third of all vectors is spread.  Equal directions enter
once: copies are one row of the index.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgauge.llm.components import connected, local_components
from textgauge.llm.tables import draw, narrow, sampled, stored

PARTS = 8
CODES = 64


def unit(vectors: np.ndarray) -> np.ndarray:
    """Directions of finite, non-zero rows; scaled by the largest component first, so nothing overflows."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def k_means(rows: np.ndarray, k: int, rounds: int = 12, seed: int = 42) -> np.ndarray:
    """Lloyd's iterations from distinct random rows; a centre that loses its rows stays where it was."""
    rng = np.random.default_rng(seed)
    centres = rows[rng.permutation(len(rows))[:k]].copy()
    for _ in range(rounds):
        own = nearest(rows, centres, 1)[:, 0]
        n = np.bincount(own, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, own, rows)
        centres = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], centres)
    return centres


def nearest(rows: np.ndarray, centres: np.ndarray, k: int) -> np.ndarray:
    """Indices of the k nearest centres of every row, nearest first."""
    out = []
    for at in range(0, len(rows), 4096):
        part = rows[at : at + 4096]
        d = (centres * centres).sum(1) - 2 * part @ centres.T
        if k < len(centres):
            some = np.argpartition(d, k - 1, axis=1)[:, :k]
        else:
            some = np.broadcast_to(np.arange(len(centres)), d.shape)
        order = np.argsort(np.take_along_axis(d, some, 1), axis=1, kind="stable")
        out.append(np.take_along_axis(some, order, 1))
    return np.concatenate(out) if out else np.zeros((0, k), np.int64)


class Quantiser:
    """Coarse centres and a residual codebook per subspace, for vectors of one length."""

    def __init__(self, sample: np.ndarray, lists: int, seed: int = 42):
        self.centres = k_means(sample, min(lists, len(sample)), seed=seed).astype(np.float32)
        rest = sample - self.centres[nearest(sample, self.centres, 1)[:, 0]]
        edges = np.linspace(0, sample.shape[1], min(PARTS, sample.shape[1]) + 1).astype(int)
        self.cuts = list(zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True))
        self.books = [k_means(rest[:, a:b], min(CODES, len(rest)), seed=seed + i).astype(np.float32) for i, (a, b) in enumerate(self.cuts)]

    def codes(self, rows: np.ndarray, lists: np.ndarray) -> np.ndarray:
        rest = rows - self.centres[lists]
        return np.stack([nearest(rest[:, a:b], book, 1)[:, 0] for (a, b), book in zip(self.cuts, self.books, strict=True)], 1).astype(np.uint8)

    def errors(self, rows: np.ndarray, list_id: int, codes: np.ndarray) -> np.ndarray:
        """Distances between the vectors of one list and their codes."""
        near = np.concatenate([book[codes[:, i]] for i, book in enumerate(self.books)], 1) + self.centres[list_id]
        return np.sqrt(((rows - near) ** 2).sum(1))

    def distances(self, query: np.ndarray, list_id: int, codes: np.ndarray) -> np.ndarray:
        """Estimated distances of queries (rows) to the codes of one list, by table look-up."""
        rest = query - self.centres[list_id]
        total = np.zeros((len(query), len(codes)), np.float32)
        for i, ((a, b), book) in enumerate(zip(self.cuts, self.books, strict=True)):
            part = rest[:, a:b]
            table = (part * part).sum(1)[:, None] - 2 * part @ book.T + (book * book).sum(1)
            total += table[:, codes[:, i]]
        return np.sqrt(np.maximum(total, 0))


def train(classes: DataFrame, lists: int | None = None, sample_rows: int = 16_384, seed: int = 42) -> dict[int, Quantiser]:
    """A quantiser for every vector length, fitted on at most about ``sample_rows`` directions drawn by hash, of all
    lengths together at most about four times as many, and at least one of each.

    There are four lists per root of all rows of a length unless given, at most one per sampled row: so a list grows
    with the root of the table only.
    """
    total = {r["n"]: r["rows"] for r in classes.groupBy("n").agg(F.count(F.lit(1)).alias("rows")).collect()}  # a row per length
    drawn = sampled(classes, "n", F.lit(1), sample_rows, 4 * sample_rows, draw(seed, "id"), "pq-rates")
    table = drawn.select("id", "n", "unit").orderBy("n", "id").toArrow()
    found: dict[int, list] = {}
    for n, row in zip(table.column("n").to_pylist(), table.column("unit").to_pylist(), strict=True):
        found.setdefault(n, []).append(np.frombuffer(row, "<f8"))
    return {
        n: Quantiser(np.stack(rows).astype(np.float32), lists or max(1, min(len(rows), int(4 * total[n] ** 0.5))), seed) for n, rows in found.items()
    }


def directions(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``vec_id, n, unit``: the direction as little-endian doubles; null for what links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, lengths, out = batch.column(0), [], []
            for row in batch.column(1).to_pylist():
                bad = row is None or not len(row) or any(x is None for x in row)
                own = None if bad else np.array(row, float)
                if own is None or not np.isfinite(own).all() or not own.any():
                    lengths.append(None)
                    out.append(None)
                else:
                    lengths.append(len(own))
                    out.append((unit(own[None])[0] + 0.0).astype("<f8").tobytes())
            yield pa.RecordBatch.from_arrays([keys, pa.array(lengths, pa.int32()), pa.array(out, pa.binary())], names=["vec_id", "n", "unit"])

    rows = narrow(vectors, {"vec_id": key, "_v": vector}).select(F.col("vec_id").cast("long"), F.col("_v").cast("array<double>"))
    return rows.mapInArrow(run, "vec_id long, n int, unit binary")


def lists_to_ask(rows: np.ndarray, centres: np.ndarray, probes: int, reach: float) -> list[np.ndarray]:
    """For every row the lists of its ``probes`` nearest centres, the nearest first, and of all centres within reach.

    In a group as dense as the reach its vectors lie in any of the lists whose centres it holds, so all of them are asked.
    """
    out = []
    for at in range(0, len(rows), 1024):
        part = rows[at : at + 1024]
        first = nearest(part, centres, min(probes, len(centres)))
        square = (part * part).sum(1)[:, None] - 2 * part @ centres.T + (centres * centres).sum(1)
        for own, near in zip(first, square <= reach * reach, strict=True):
            more = np.flatnonzero(near)
            out.append(np.concatenate([own, more[~np.isin(more, own)]]) if len(more) else own)
    return out


INDEX = "id long, n int, list int, role int, copies long, home int, probes binary, code binary, unit binary"


def _assigned(model, probes: int, reach: float):
    """Rows of the index and of the queries: list, code and role; where a query is at home, and which lists a code's vector asks."""
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    schema = pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in INDEX.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = model.value
        for batch in batches:
            ids, sizes, units, copies = (batch.column(i).to_pylist() for i in range(4))
            for n in set(sizes):
                q = index.get(n)
                some = [i for i, s in enumerate(sizes) if s == n]
                rows = np.stack([np.frombuffer(units[i], "<f8") for i in some]).astype(np.float32)
                if q is None:  # a length that the sample doesn't hold: one list, no codes
                    lists, codes = [np.zeros(1, int)] * len(some), np.zeros((len(some), 0), np.uint8)
                else:
                    lists = lists_to_ask(rows, q.centres, probes, reach)
                    codes = q.codes(rows, np.array([own[0] for own in lists]))
                out = [(ids[i], n, int(own[0]), 0, copies[i], int(own[0]), own.astype("<i4").tobytes(), code.tobytes(), units[i]) for i, own, code in zip(some, lists, codes, strict=True)]
                out += [(ids[i], n, int(at), 1, copies[i], int(own[0]), None, None, units[i]) for i, own in zip(some, lists, strict=True) for at in own]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema)], schema=schema)

    return run


def _compared(model, cosine: float, all_pairs: bool):
    """Links between the queries and the codes of one chunk pair of a list; tasks hold one such pair at a time.

    Rows ``a, b, n``: every link with 0, or, for counts, the copies of linked vectors by id (``b`` null) and the links of a
    spanning forest with 0.  A link is counted for the query, and for the code's vector too unless that, as a query, asks
    the list where this one is at home and so counts it itself.  So what a task returns follows its rows, not its links.
    """
    reach = (2 - 2 * cosine) ** 0.5
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())])

    def solve(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        n, list_id, index = key[0].as_py(), key[1].as_py(), model.value
        q = index.get(n)
        ids, others = left.column("id").to_numpy(), right.column("id").to_numpy()
        mine = np.stack([np.frombuffer(u, "<f8") for u in left.column("unit").to_pylist()])
        theirs = np.stack([np.frombuffer(u, "<f8") for u in right.column("unit").to_pylist()])
        home, probed = left.column("home").to_numpy(), [np.frombuffer(x, "<i4") for x in right.column("probes").to_pylist()]
        asked = np.full((len(probed), max(map(len, probed))), -1, np.int32)
        for row, own in zip(asked, probed, strict=True):
            row[: len(own)] = own
        weight, others_weight = left.column("copies").to_numpy(), right.column("copies").to_numpy()
        codes = None if q is None else np.stack([np.frombuffer(c, np.uint8) for c in right.column("code").to_pylist()])
        # By the triangle inequality an estimate exceeds the true distance by the code's own error at most.
        limit = None if q is None else reach + q.errors(theirs.astype(np.float32), list_id, codes) + 1e-4
        found, seen, counts = [], np.zeros(len(ids), np.int64), np.zeros(len(others), np.int64)
        nodes, place = np.unique(np.concatenate([ids, others]), return_inverse=True)
        root = np.arange(len(nodes))
        for at in range(0, len(mine), 512):
            part = mine[at : at + 512]
            if q is None:
                a, b = (x.ravel() for x in np.indices((len(part), len(theirs))))
            else:
                a, b = np.nonzero(q.distances(part.astype(np.float32), list_id, codes) <= limit)
            different = ids[at + a] != others[b]
            a, b = a[different], b[different]
            for i in range(0, len(a), 1 << 16):
                x, y = a[i : i + (1 << 16)], b[i : i + (1 << 16)]
                near = (part[x] * theirs[y]).sum(1) >= cosine
                x, y = at + x[near], y[near]
                if all_pairs:
                    found.append((ids[x], others[y]))
                elif len(x):
                    np.add.at(seen, x, others_weight[y])
                    alone = ~(asked[y] == home[x][:, None]).any(1)
                    np.add.at(counts, y[alone], weight[x[alone]])
                    leaf = np.flatnonzero(root != np.arange(len(root)))
                    root = local_components(len(nodes), np.concatenate([leaf, place[x]]), np.concatenate([root[leaf], place[len(ids) + y]]))
        if all_pairs:
            a, b = (np.concatenate([np.zeros(0, np.int64), *(f[i] for f in found)]) for i in range(2))
            return pa.table([pa.array(a), pa.array(b), pa.array(np.zeros(len(a), np.int64))], schema=schema)
        leaf, x, y = np.flatnonzero(root != np.arange(len(root))), np.flatnonzero(seen), np.flatnonzero(counts)
        return pa.table(
            [
                pa.array(np.concatenate([ids[x], others[y], nodes[leaf]])),
                pa.array([None] * (len(x) + len(y)) + nodes[root[leaf]].tolist(), pa.int64()),
                pa.array(np.concatenate([seen[x], counts[y], np.zeros(len(leaf), np.int64)])),
            ],
            schema=schema,
        )

    return solve


def _searched(classes: DataFrame, cosine: float, probes: int, lists: int | None, chunk: int, all_pairs: bool) -> DataFrame:
    from textgauge.llm.language import Shared

    model = Shared(classes, train(classes, lists))
    copies = F.col("copies") if "copies" in classes.columns else F.lit(1).cast("long")
    rows = stored(classes.select("id", "n", "unit", copies.alias("copies")).mapInArrow(_assigned(model, probes, (2 - 2 * cosine) ** 0.5), INDEX), "pq-index")
    # Chunks of a list by its sizes in both roles: two numbers a list.
    sizes = rows.groupBy("n", "list").agg(F.count(F.when(F.col("role") == 0, 1)).alias("codes"), F.count(F.when(F.col("role") == 1, 1)).alias("asks"))
    sizes = sizes.select("n", "list", F.ceil(F.col("codes") / chunk).cast("int").alias("cs"), F.ceil(F.col("asks") / chunk).cast("int").alias("qs"))
    cut = rows.join(sizes, ["n", "list"]).filter("cs > 0 and qs > 0")
    own = F.pmod(F.xxhash64("id"), F.when(F.col("role") == 0, F.col("cs")).otherwise(F.col("qs"))).cast("int")
    all_of_other = F.when(F.col("role") == 0, F.col("qs")).otherwise(F.col("cs"))
    cut = cut.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), all_of_other - 1)))
    asks = cut.filter("role = 1").select("n", "list", F.col("_own").alias("q"), F.col("_other").alias("c"), "id", "copies", "home", "unit")
    codes = cut.filter("role = 0").select("n", "list", F.col("_other").alias("q"), F.col("_own").alias("c"), "id", "copies", "probes", "unit", "code")
    key = ["n", "list", "q", "c"]
    # Columns of their own for both sides: they come from the same rows.
    asks, codes = (df.select(*[F.col(c).alias(c) for c in df.columns]) for df in (asks, codes))
    return asks.groupBy(*key).cogroup(codes.groupBy(*key)).applyInArrow(_compared(model, cosine, all_pairs), "a long, b long, n long")


def links(classes: DataFrame, cosine: float = 0.95, probes: int = 8, lists: int | None = None, chunk: int = 4096) -> DataFrame:
    """``a, b`` (a < b, each once): pairs of classes ``id, n, unit`` at a cosine of at least ``cosine``."""
    found = _searched(classes, cosine, probes, lists, chunk, True)
    return stored(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "pq-links")


def degrees(classes: DataFrame, cosine: float = 0.95, probes: int = 8, lists: int | None = None, chunk: int = 4096) -> tuple[DataFrame, DataFrame]:
    """``id, others`` (copies of all vectors linked with a class) and ``a, b`` (a spanning forest of the links, per task).

    The links themselves are neither returned nor stored, so a dense group costs rows, not the square of them.
    """
    found = stored(_searched(classes, cosine, probes, lists, chunk, False), "pq-found")
    counts = found.filter("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("n").alias("others"))
    return counts, found.filter("b is not null").select("a", "b")


def near_duplicates(
    vectors: DataFrame, cosine: float = 0.95, probes: int = 8, lists: int | None = None, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of every row.

    ``n_links`` counts the other rows linked directly, copies included; ``component_id`` is the smallest key that
    links reach, the own one included.  Vectors of different lengths, and those that are null, zero, empty or hold
    null or non-finite components, link with nothing.  Null keys are kept; such a row is never ``kept`` as the
    first of its group (false).  An empty table gives no rows.
    """
    rows = stored(directions(vectors, key, vector), "pq-directions")
    # The class of a direction is named by a number of its own: keys may be null or repeated.
    groups = rows.filter("unit is not null").groupBy("n", "unit").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies"))
    classes = stored(groups.withColumn("id", F.monotonically_increasing_id()), "pq-classes")
    others, forest = degrees(classes, cosine, probes, lists)
    parts = connected(forest).withColumnRenamed("node", "id")
    named = classes.join(parts, "id", "left").join(others, "id", "left")
    named = stored(named.withColumn("component", F.coalesce("component", "id")), "pq-named")
    least = named.groupBy("component").agg(F.min("first").alias("component_id"))
    of = named.join(least, "component").select("n", "unit", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), "component_id")
    out = rows.join(of, ["n", "unit"], "left")
    component = F.when(F.col("unit").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
