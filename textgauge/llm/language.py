"""Language identification by prediction by partial matching (PPM).

Every language has a tree of byte contexts of up to ``ORDER`` bytes with the counts of what followed.  A byte costs
``-log2`` of its share among what followed its longest known context; one that never followed costs an escape
(method C: as likely as the number of different followers) and is coded from the context shortened by a byte, in
the end evenly among all 256.  The statistics are frozen after training, and a text belongs to the language in
which its exact code is shortest.

Coded are the words of the text, runs of letters in lower case as UTF-8 between two blanks; contexts end at the
blank before the word.  A word therefore costs the same wherever it stands and workers keep the costs of words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textgauge.llm.tables import draw, keeps, narrow, sampled, text_bytes, working

ORDER = 4
WORD = re.compile(r"[^\W\d_]+")
#: Letters with the marks that other scripts write on them; slower, so only for texts that have such marks.
MARKED_WORD = regex.compile(r"[\p{L}\p{Nl}\p{No}][\p{L}\p{Nl}\p{No}\p{M}]*")
MARK = regex.compile(r"\p{M}")
LATIN = re.compile(r"[\x00-\u02FF\u2000-\u206F]*")
CACHED = 200_000
MOST_COSTS = 1 << 26
UNKNOWN = "und"


def words_of(text: str) -> list[str]:
    """Words of a lower-cased text: runs of letters, and of the combining marks on them."""
    if LATIN.fullmatch(text) or not MARK.search(text):
        return WORD.findall(text)
    return MARKED_WORD.findall(text)


def remainder(key: str, parts: int) -> Column:
    """crc32 of the key as text, modulo the parts; a null key is the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def gram_counts(words: Counter, order: int = ORDER) -> Counter:
    """How often each context of up to ``order`` bytes was followed by each byte; keys hold both."""
    out = Counter()
    for word, n in words.items():
        coded = b" " + word.encode() + b" "
        for i in range(1, len(coded)):
            for k in range(min(order, i) + 1):
                out[coded[i - k : i + 1]] += n
    return out


class ContextTrees:
    """Frozen statistics of all languages: one table of costs by gram, one of escape costs by context.

    The tables have a column per language.  With so many languages that they would exceed ``MOST_COSTS`` numbers, the
    longest contexts are left out, one length after the other; no language is.
    """

    def __init__(self, counts: dict[str, dict[bytes, int]], order: int = ORDER):
        self.langs = sorted(counts)
        lengths = Counter(len(g) for g in {g for c in counts.values() for g in c})
        while order > 0 and 2 * len(self.langs) * sum(n for k, n in lengths.items() if k <= order + 1) > MOST_COSTS:
            order -= 1
        self.order = order
        self.rows: dict[bytes, int] = {}
        self.escapes: dict[bytes, int] = {}
        grams = sorted({g for c in counts.values() for g in c if len(g) <= order + 1}, key=len)
        self.rows = {g: i for i, g in enumerate(grams)}
        table = np.zeros((len(grams), len(self.langs)), np.float32 if order < ORDER else np.float64)
        for j, lang in enumerate(self.langs):
            for gram, n in counts[lang].items():
                if len(gram) <= order + 1:
                    table[self.rows[gram], j] = n
        contexts = {}
        for gram in grams:
            contexts.setdefault(gram[:-1], []).append(self.rows[gram])
        self.escapes = {c: i for i, c in enumerate(contexts)}
        escape = np.zeros((len(contexts), len(self.langs)), table.dtype)
        total = np.zeros_like(escape)
        for context, i in self.escapes.items():
            own = table[contexts[context]]
            followers = (own > 0).sum(0)
            total[i] = own.sum(0) + followers
            # A context that a language never met is passed over at no cost.
            escape[i] = np.where(followers > 0, np.log2(np.maximum(total[i], 1)) - np.log2(np.maximum(followers, 1)), 0)
        cost = np.zeros_like(table)
        for gram, i in self.rows.items():  # shorter grams first
            e = self.escapes[gram[:-1]]
            shorter = cost[self.rows[gram[1:]]] if len(gram) > 1 else 8.0
            seen = np.log2(np.maximum(total[e], 1)) - np.log2(np.maximum(table[i], 1))
            cost[i] = np.where(table[i] > 0, seen, escape[e] + shorter)
        # Last row: coded evenly.
        self.cost = np.concatenate([cost, np.full((1, len(self.langs)), 8.0, table.dtype), escape]).astype(np.float32)
        self.even, self.first_escape = len(grams), len(grams) + 1

    def steps(self, word: str) -> list[int]:
        """Rows of the cost table that add up to the word's code lengths."""
        coded, out, rows, escapes = b" " + word.encode() + b" ", [], self.rows, self.escapes
        for i in range(1, len(coded)):
            for k in range(min(self.order, i), -1, -1):
                row = rows.get(coded[i - k : i + 1])
                if row is not None:
                    out.append(row)
                    break
                e = escapes.get(coded[i - k : i])
                if e is not None:
                    out.append(self.first_escape + e)
            else:
                out.append(self.even)
        return out


class Scorer:
    """Code lengths of texts, with the words' costs kept up to a fixed number."""

    def __init__(self, trees: ContextTrees):
        self.trees, self.place = trees, {}
        # Fewer words are kept, and a text is taken in smaller parts, where there are very many languages.
        many = max(1, len(trees.langs))
        self.costs = np.zeros((max(256, min(CACHED, MOST_COSTS // many)), many), np.float32)
        self.part, self.at_once = min(1 << 16, len(self.costs)), max(16, MOST_COSTS // (16 * many))

    def _learn(self, words: list[str]) -> np.ndarray:
        steps = [self.trees.steps(w) for w in words]
        at = np.cumsum([0, *map(len, steps)])[:-1]
        return np.add.reduceat(self.trees.cost[np.fromiter((r for s in steps for r in s), np.int64)], at, axis=0)

    def bits(self, words: list[str]) -> np.ndarray:
        """Bits of all words together in every language."""
        total = np.zeros(self.costs.shape[1])
        for at in range(0, len(words), self.part):
            part = words[at : at + self.part]
            new = [w for w in set(part) if w not in self.place]
            if len(self.place) + len(new) > len(self.costs):
                self.place.clear()
                new = list(set(part))
            if new:
                first = len(self.place)
                for i in range(0, len(new), self.at_once):
                    some = new[i : i + self.at_once]
                    self.costs[first + i : first + i + len(some)] = self._learn(some)
                self.place.update(zip(new, range(first, first + len(new))))
            total += self.costs[np.fromiter(map(self.place.__getitem__, part), np.int64, len(part))].sum(0, dtype=np.float64)
        return total

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, its share after one average word, bits per coded byte."""
        lowered = (text or "").lower()
        words = words_of(lowered)
        if not self.trees.langs or not any(any(map(str.isalpha, w)) for w in words):
            return UNKNOWN, 0.0, 0.0
        bits = self.bits(words)
        best = int(np.argmin(bits))
        share = 1 / float(np.exp2(np.maximum((bits[best] - bits) / len(words), -1000)).sum())
        return self.trees.langs[best], share, float(bits[best]) / (len(" ".join(words).encode()) + 1)


def train(
    docs: DataFrame,
    max_bytes: int = 2 << 20,
    seed: int = 42,
    order: int = ORDER,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    total_bytes: int = 64 << 20,
) -> ContextTrees:
    """Context trees from labelled rows (text and language not null).

    Of every language about ``max_bytes`` of whole texts are read at most, of all together about ``total_bytes``: rows
    are taken by a hash of the key at the rate that these bounds allow, and at least one of each language.  Without such
    rows the trees know no language and predict ``und``.  With very many languages contexts are shorter, see
    ``ContextTrees``.
    """
    rows = narrow(docs, {"_key": key, "_text": text, "_lang": lang}).filter("_text is not null and _lang is not null")
    sample = sampled(rows, "_lang", text_bytes("_text") + 1, max_bytes, total_bytes, draw(seed, "_key"), "language-rates")
    schema = pa.schema([("lang", pa.string()), ("gram", pa.binary()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str, Counter] = {}
        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words.setdefault(name, Counter()).update(words_of(value.lower()))
        for name, own in words.items():
            grams = gram_counts(own, order)
            columns = [pa.array([name] * len(grams), pa.string()), pa.array(grams.keys(), pa.binary()), pa.array(grams.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    found = sample.select("_lang", "_text").mapInArrow(run, "lang string, gram binary, n long")
    counts: dict[str, dict[bytes, int]] = {}
    table = found.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()  # bounded by the sample
    for name, gram, n in zip(*(table.column(c).to_pylist() for c in ("lang", "gram", "n")), strict=True):
        counts.setdefault(name, {})[gram] = n
    return ContextTrees(counts, order)


_scorers: dict[int, Scorer] = {}
_read: list = []


def _drop() -> None:
    """Forget the model and its words; the broadcast stays and can be read again."""
    _scorers.clear()
    while _read:
        vars(_read.pop()).pop("_value", None)


keeps("language", _drop)


def shared_scorer(broadcast) -> Scorer:
    """One scorer per worker and model; the last model only."""
    if broadcast.id not in _scorers:
        _drop()
        _scorers[broadcast.id] = Scorer(broadcast.value)
        _read.append(broadcast.sent)
    return _scorers[broadcast.id]


class Shared:
    """A model that every task reads from Spark's broadcast; its size is bounded by the training sample."""

    def __init__(self, docs: DataFrame, value):
        self.sent = docs.sparkSession.sparkContext.broadcast(value)
        self.id = int(self.sent._jbroadcast.id())

    def __getstate__(self):
        return {"sent": self.sent, "id": self.id}

    @property
    def value(self):
        return self.sent.value


def identify(docs: DataFrame, trees: ContextTrees, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, bits_per_byte`` of every whole text.

    ``score`` is the language's share among all, were each to code one word of the text's average cost.  A text
    that is null or has no letter is ``und`` with score 0.  Equal lengths go to the first language by name.  Rows
    with equal or null keys are each kept; an empty table gives no rows.
    """
    model = Shared(docs, trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        working("language")
        scorer = shared_scorer(model)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [scorer.predict(t.as_py()) for t in part.column(1)]
                columns = [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.string(), pa.float64(), pa.float64()))]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=["doc_id", "lang_pred", "score", "bits_per_byte"])

    rows = narrow(docs, {"doc_id": key, "_text": text}).select(F.col("doc_id").cast("long"), F.col("_text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, bits_per_byte double")


def held_out_languages(docs: DataFrame) -> DataFrame:
    """Train on the rows whose key's checksum isn't 2 modulo 4 and predict all."""
    trees = train(docs.filter(remainder("doc_id", 4) != 2))
    return identify(docs, trees).select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "bits_per_byte")


def recognised(docs: DataFrame, trees: ContextTrees, most_bits: float = 6.0, text: str = "text") -> DataFrame:
    """The rows whose text is in a known language; their columns as they were.

    Rejected are null texts, texts without letters, and texts whose code in their best language takes more than
    ``most_bits`` a byte, hardly less than without any model.
    """
    model = Shared(docs, trees)

    @F.pandas_udf("boolean")
    def known(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        working("language")
        scorer = shared_scorer(model)
        for texts in batches:
            found = map(scorer.predict, (t if isinstance(t, str) else None for t in texts))
            yield pd.Series([lang != UNKNOWN and bits <= most_bits for lang, _, bits in found], dtype=bool)

    return docs.filter(known(F.col(text)))
