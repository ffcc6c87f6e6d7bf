"""Language-model scores by deleted interpolation of word bigrams, words and the uniform distribution.

    P(w | v) = a(b) c(v w) / c(v) + b(b) c(w) / N + u(b) / (V + 1),    b = bit length of c(v)

The three weights of every bucket of context frequencies are learned by expectation-maximisation on the counts of
documents held back from counting (one in ``DELETED`` of the training documents); the counts that score are those of
all training documents.  Every document begins with a start mark, which is a context only, and ends with an end token.

Counting follows the corpus.  Documents become batches of bounded bytes whose tokens are stored as codes.  A batch asks
for the counts of its distinct words and bigrams, as sorted 64-bit hashes cut into ranges; the task of a range adds up
what all batches bring and answers each in its order, so a frequent word is one entry per batch.  The number of
ranges follows the bytes of the table.  A batch and its answers meet again by the batch's number.  Nothing of the size
of the vocabulary is broadcast or collected: the driver sees totals and a row per bucket.

Equal hashes of different words or bigrams would share a count; of a billion words some 0.03 pairs do.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgauge.llm.simhash import LOWER
from textgauge.llm.tables import narrow, stored, text_bytes

FOLDS, HELD_OUT = 5, 1
DELETED = 20
BATCH_BYTES = 4 << 20
RANGE_BYTES = 8 << 20
BUCKETS = 65
ROUNDS, GAIN = 40, 1e-5
MAIN, BACK, TEST = 0, 1, 2
START, END = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
BATCH = "batch long, role int, keys array<long>, sizes array<int>, codes binary, words binary"
ASKED = "range int, batch long, role int, words binary, words_n binary, pairs binary, pairs_n binary"
ANSWERED = "range int, batch long, role int, words binary, pairs binary, main_words binary, main_pairs binary, tokens long, kinds long, main_tokens long, main_kinds long"


def role(key: int | None, deleted: int = DELETED) -> int:
    """Whether a document is counted, held back to learn the weights, or held out of training; a null key is like an empty one."""
    name = "" if key is None else str(key)
    if zlib.crc32(name.encode()) % FOLDS == HELD_OUT:
        return TEST
    return BACK if zlib.crc32(f"deleted|{name}".encode()) % deleted == 0 else MAIN


class _Codes(dict):
    """Words met in a batch, numbered; the hash of each stands in ``hashes``.  The end token is the first."""

    def __init__(self):
        import xxhash

        super().__init__({b"\n": 0})
        self.digest, self.hashes = xxhash.xxh64_intdigest, [int(END)]

    def __missing__(self, word: bytes) -> int:
        code = self[word] = len(self)
        self.hashes.append(self.digest(word, 42))
        return code


class _Batch:
    def __init__(self):
        self.codes, self.keys, self.tokens, self.bytes = _Codes(), [], [], 0

    def add(self, key: int | None, text: bytes) -> None:
        words = text.translate(LOWER).split()
        words.append(b"\n")
        self.keys.append(key)
        self.tokens.append(np.fromiter(map(self.codes.__getitem__, words), np.uint32, len(words)))
        self.bytes += len(text) + 64


def _zipped(codes: np.ndarray) -> bytes:
    """Word codes, the first met being the smallest, with their bytes of one weight side by side."""
    import zstandard

    planes = codes.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unzipped(data: bytes) -> np.ndarray:
    import zstandard

    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(4, -1)
    return planes.T.copy().view("<u4").ravel()


def _batches(batch_bytes: int, deleted: int):
    from pyspark import TaskContext

    schema = pa.schema([("batch", pa.int64()), ("role", pa.int32()), ("keys", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32())), ("codes", pa.binary()), ("words", pa.binary())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made, open_ = TaskContext.get().partitionId() << 33, 0, {}

        def row(kind: int, full: _Batch) -> pa.RecordBatch:
            sizes = [len(t) for t in full.tokens]
            values = [base + made, kind, full.keys, sizes, _zipped(np.concatenate(full.tokens)), np.array(full.codes.hashes, "<u8").tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema, strict=True)], schema=schema)

        for part in parts:
            for key, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                kind = role(key, deleted)
                own = open_.setdefault(kind, _Batch())
                own.add(key, text.as_py() or b"")
                if own.bytes >= batch_bytes:
                    yield row(kind, open_.pop(kind))
                    made += 1
        for kind in sorted(open_):
            yield row(kind, open_[kind])
            made += 1

    return run


def token_batches(docs: DataFrame, key: str = "doc_id", text: str = "text", batch_bytes: int = BATCH_BYTES, deleted: int = DELETED) -> DataFrame:
    """All tokens as stored batches of documents of one role: word codes in order, and the words' hashes by code."""
    rows = narrow(docs, {"doc_id": key, "_text": text})
    rows = rows.select(F.col("doc_id").cast("long"), F.col("_text").cast("binary"))
    return stored(rows.mapInArrow(_batches(batch_bytes, deleted), BATCH), "lm-batches")


class _Grams:
    """The tokens of a batch: their words and pairs, and the sorted distinct hashes of both."""

    def __init__(self, sizes: list[int], codes: bytes, words: bytes):
        self.codes, hashes = _unzipped(codes), np.frombuffer(words, "<u8")
        self.starts = np.cumsum([0, *sizes])[:-1]
        # The start mark stands behind the words.
        self.hashes = np.append(hashes, START)
        self.before = np.empty_like(self.codes)
        self.before[1:], self.before[self.starts] = self.codes[:-1], len(hashes)
        self.order = np.argsort(self.hashes)
        pairs = self.hashes[self.before] * np.uint64(0xFF51AFD7ED558CCD) + self.hashes[self.codes]
        pairs = (pairs ^ pairs >> np.uint64(31)) * np.uint64(0xC4CEB9FE1A85EC53)
        self.pairs = pairs ^ pairs >> np.uint64(29)

    def word_counts(self) -> np.ndarray:
        counts = np.bincount(self.codes, minlength=len(self.hashes))
        counts[-1] = len(self.starts)
        return counts[self.order]


def _planes(values: np.ndarray) -> bytes:
    """Unsigned values with their bytes of one weight side by side, as many as the largest needs; the first byte says how many."""
    values = values.astype("<u8")
    width = max(1, -(-int(values.max()).bit_length() // 8)) if len(values) else 1
    return bytes([width]) + values.view(np.uint8).reshape(-1, 8).T[:width].tobytes()


def _values(data: bytes) -> np.ndarray:
    width, planes = data[0], np.frombuffer(data, np.uint8, offset=1)
    out = np.zeros((len(planes) // width, 8), np.uint8)
    out[:, :width] = planes.reshape(width, -1).T
    return out.view("<u8").ravel()


def _steps(values: np.ndarray) -> bytes:
    """Sorted values as the differences between neighbours."""
    return _planes(np.diff(values, prepend=np.uint64(0)))


def _sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_values(data), dtype=np.uint64)


def _range_of(hashes: np.ndarray, ranges: int) -> np.ndarray:
    """The range of each hash: equal shares of all hashes, in order."""
    return (hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)


def _ask(ranges: int):
    """What each batch wants to know, cut by ranges of hashes."""
    names = [c.split()[0] for c in ASKED.split(", ")]
    kinds = [pa.int32(), pa.int64(), pa.int32(), *[pa.binary()] * 4]

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in rows:
            for at in range(part.num_rows):
                row = part.slice(at, 1).to_pylist()[0]
                grams = _Grams(row["sizes"], row["codes"], row["words"])
                words, counts = grams.hashes[grams.order], grams.word_counts()
                pairs, pair_counts = np.unique(grams.pairs, return_counts=True)
                of_words, of_pairs = _range_of(words, ranges), _range_of(pairs, ranges)
                met = np.union1d(of_words, of_pairs)
                low = [np.searchsorted(own, met) for own in (of_words, of_pairs)]
                high = [np.searchsorted(own, met, "right") for own in (of_words, of_pairs)]
                out = [[] for _ in names]
                for i, a, b, c, d in zip(met.tolist(), low[0], high[0], low[1], high[1], strict=True):
                    none = row["role"] == TEST
                    values = [i, row["batch"], row["role"], _steps(words[a:b]), b"" if none else _planes(counts[a:b]), _steps(pairs[c:d]), b"" if none else _planes(pair_counts[c:d])]
                    for column, value in zip(out, values, strict=True):
                        column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=names)

    return run


def _answer(asked: pa.Table) -> pa.Table:
    """Adds up the counts of one range of hashes and answers every batch in the order of its hashes."""
    roles, number = asked.column("role").to_pylist(), asked.num_rows
    answers, totals = {}, {}
    for what in ("words", "pairs"):
        hashes = [_sorted(x.as_py()) for x in asked.column(what)]
        counts = [_values(x.as_py()).astype(np.int64) if r != TEST else np.zeros(len(h), np.int64) for x, r, h in zip(asked.column(f"{what}_n"), roles, hashes, strict=True)]
        ends = np.cumsum([len(h) for h in hashes])
        known, at = np.unique(np.concatenate(hashes), return_inverse=True)
        every, main = np.zeros(len(known), np.int64), np.zeros(len(known), np.int64)
        for end, own, r in zip(ends, counts, roles, strict=True):
            place = at[end - len(own) : end]  # distinct within a batch
            every[place] += own
            if r == MAIN:
                main[place] += own
        answers[what] = [_planes(every[at[end - len(h) : end]]) for end, h in zip(ends, hashes, strict=True)]
        answers[f"main_{what}"] = [_planes(main[at[end - len(h) : end]]) if r == BACK else None for end, h, r in zip(ends, hashes, roles, strict=True)]
        if what == "words":
            token = known != START
            totals = {"tokens": every[token].sum(), "kinds": (every[token] > 0).sum(), "main_tokens": main[token].sum(), "main_kinds": (main[token] > 0).sum()}
    columns = {"range": asked.column("range"), "batch": asked.column("batch"), "role": asked.column("role")}
    columns |= {c: pa.array(answers[c], pa.binary()) for c in ("words", "pairs", "main_words", "main_pairs")}
    # The totals of the range stand in one of its rows.
    columns |= {c: pa.array([int(v), *[0] * (number - 1)], pa.int64()) for c, v in totals.items()}
    return pa.table(columns)


@dataclass
class Model:
    """Weights of pairs, words and the uniform distribution by bucket, and the tokens and distinct tokens counted."""

    weights: np.ndarray
    tokens: int
    kinds: int
    rounds: int = 0

    def probability(self, context: np.ndarray, pair: np.ndarray, word: np.ndarray) -> np.ndarray:
        w = self.weights[_bucket(context)]
        high = np.divide(pair, context, out=np.zeros(len(pair)), where=context > 0)
        return w[:, 0] * high + w[:, 1] * word / max(1, self.tokens) + w[:, 2] / (self.kinds + 1)


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.frexp(context.astype(float))[1]


def _of_batch(answers: pa.Table, batch: pa.Table, prefix: str = "") -> tuple[_Grams, np.ndarray, np.ndarray, np.ndarray, dict]:
    """Of every token of a batch: the counts of its context, of the pair and of the word."""
    row = batch.to_pylist()[0]
    grams = _Grams(row["sizes"], row["codes"], row["words"])
    order = np.argsort(answers.column("range").to_numpy())

    def counts(what: str) -> np.ndarray:
        own = answers.column(prefix + what)
        return np.concatenate([_values(own[int(i)].as_py()) for i in order]).astype(np.int64)

    words = np.empty(len(grams.hashes), np.int64)
    words[grams.order] = counts("words")
    pairs = counts("pairs")[np.unique(grams.pairs, return_inverse=True)[1]]
    return grams, words[grams.before], pairs, words[grams.codes], row


def _held_back(answers: pa.Table, batch: pa.Table) -> pa.Table:
    """How often each combination of main counts stands behind a token of a held-back batch."""
    _, *counts, _ = _of_batch(answers, batch, "main_")
    rows, n = np.unique(np.stack(counts, 1), axis=0, return_counts=True)
    return pa.table({"bucket": pa.array(_bucket(rows[:, 0]), pa.int32()), "context": rows[:, 0], "pair": rows[:, 1], "word": rows[:, 2], "n": n})


def learn(counts: DataFrame, tokens: int, kinds: int, rounds: int = ROUNDS, gain: float = GAIN) -> tuple[np.ndarray, int]:
    """Weights by expectation-maximisation over rows ``bucket, context, pair, word, n`` of held-back tokens.

    Every round is one aggregate with a row per bucket.  One token is added to each weight's share, so none is zero;
    where the context was never met the pair has no weight.  A bucket without tokens takes the weights of the next lower one.
    It ends when a round gains less than ``gain`` (natural logarithm, per token).
    """
    weights = np.full((BUCKETS, 3), 1 / 3)
    weights[0] = 0, 0.5, 0.5
    high = F.when(F.col("context") > 0, F.col("pair") / F.col("context")).otherwise(0.0)
    parts = [high, F.col("word") / max(1, tokens), F.lit(1 / (kinds + 1))]
    last, done = None, 0
    for done in range(1, rounds + 1):
        terms = [F.array(*[F.lit(float(w)) for w in weights[:, k]])[F.col("bucket")] * p for k, p in enumerate(parts)]
        rows = counts.select("bucket", "n", *[t.alias(f"t{k}") for k, t in enumerate(terms)]).withColumn("all", F.col("t0") + F.col("t1") + F.col("t2"))
        shares = [F.sum(F.col("n") * F.col(f"t{k}") / F.col("all")).alias(f"s{k}") for k in range(3)]
        found = rows.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.log("all")).alias("likelihood"), *shares).collect()
        if not found:
            return weights, 0
        share = {r["bucket"]: np.array([r["s0"], r["s1"], r["s2"]]) for r in found}
        for b in range(BUCKETS):
            if b in share:
                weights[b] = share[b] + (1 if b else (0, 1, 1))
                weights[b] /= weights[b].sum()
            elif b > 1:
                weights[b] = weights[b - 1]
        mean = sum(r["likelihood"] for r in found) / sum(r["n"] for r in found)
        if last is not None and mean - last < gain:
            break
        last = mean
    return weights, done


def _scored(model: Model):
    def run(answers: pa.Table, batch: pa.Table) -> pa.Table:
        grams, context, pair, word, row = _of_batch(answers, batch)
        score = np.log10(model.probability(context, pair, word))
        base = np.log10((word + 0.5) / (model.tokens + 0.5 * (model.kinds + 1)))
        many, at = len(row["keys"]), grams.starts
        return pa.table(
            {
                "doc_id": pa.array(row["keys"], pa.int64()),
                "held_out": pa.array([row["role"] == TEST] * many),
                "n_tokens": pa.array(row["sizes"], pa.int64()),
                "n_known": pa.array(np.add.reduceat((word > 0).astype(np.int64), at)),
                "train_tokens": pa.array([model.tokens] * many, pa.int64()),
                "base_score": pa.array(np.add.reduceat(base, at)),
                "score": pa.array(np.add.reduceat(score, at)),
            }
        )

    return run


def fit(docs: DataFrame, key: str = "doc_id", text: str = "text", batch_bytes: int = BATCH_BYTES, range_bytes: int = RANGE_BYTES, deleted: int = DELETED) -> tuple[Model, DataFrame, DataFrame]:
    """The model, the stored batches of all documents, and the stored counts of their words and pairs."""
    batches = token_batches(docs, key, text, batch_bytes, deleted)
    size = narrow(docs, {"_text": text}).agg(F.sum(text_bytes("_text"))).first()[0] or 0
    ranges = max(16, -(-int(size) // range_bytes))
    asked = batches.mapInArrow(_ask(ranges), ASKED)
    answers = stored(asked.groupBy("range").applyInArrow(_answer, ANSWERED), "lm-counts")
    names = ["tokens", "kinds", "main_tokens", "main_kinds"]
    total = answers.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names]).first()
    back = _met(answers.filter(F.col("role") == BACK), batches.filter(F.col("role") == BACK), _held_back, "bucket int, context long, pair long, word long, n long")
    back = stored(back.groupBy("bucket", "context", "pair", "word").agg(F.sum("n").alias("n")), "lm-held-back")
    weights, rounds = learn(back, total["main_tokens"], total["main_kinds"])
    return Model(weights, total["tokens"], total["kinds"], rounds), batches, answers


def _met(answers: DataFrame, batches: DataFrame, work, schema: str) -> DataFrame:
    return answers.groupBy("batch").cogroup(batches.groupBy("batch")).applyInArrow(work, schema)


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def score_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", batch_bytes: int = BATCH_BYTES, range_bytes: int = RANGE_BYTES, deleted: int = DELETED) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    ``score`` is the log10 probability of the whole text under the model, ``base_score`` that of words with 0.5 added to
    each count.  A null or empty text is its end token; a null key trains; rows with equal keys play one role and are
    each scored; an empty table gives no rows.  Without training documents every token is unknown.
    """
    model, batches, answers = fit(docs, key, text, batch_bytes, range_bytes, deleted)
    return _met(answers, batches, _scored(model), SCORED)
