"""Secret scans: fixed patterns, and two character Markov models for what no pattern names.

Two chains of order two over characters are trained from labelled samples, one on random strings (keys,
tokens, digests), one on ordinary identifiers and words.  A run of key characters is a secret where the
log-likelihood ratio of the two chains, per character and in total, exceeds limits set on the labelled samples.

The labels come from the corpus: in a bounded sample of documents, values that the fixed patterns find are random
strings, words and long runs of letters are ordinary.  A seeded generator adds random strings to the first, and to
the second identifiers composed of the sample's words as paths, names and versions are, with numbers; so a corpus
with few secrets trains the same model.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textgauge.llm.language import Shared
from textgauge.llm.tables import below, draw, narrow, text_bytes, working

# The base patterns, in the order in which kinds are listed.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]{12,}")  # AKIA and more, 16 characters or more
HEX = re.compile(r"[0-9a-f]{32,}")
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "markov")

RUN = re.compile(r"(?<![^\W_])[A-Za-z0-9+/_=-]{20,}(?![^\W_])")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
PLACE = {c: i for i, c in enumerate(ALPHABET)}
N = len(ALPHABET)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """Spans of the fixed patterns as (start, kind, end), leftmost and not overlapping within a kind."""
    out = []
    lowered = text.lower()
    if any(word in lowered for word in KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def runs(text: str) -> Iterator[re.Match]:
    """Candidates: runs of key characters that don't continue a longer word."""
    return RUN.finditer(text)


def shown(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


class Chain:
    """A Markov chain of order two over the key characters; seldom seen pairs lean on order one, then none."""

    def __init__(self, samples: Counter):
        one, two, three = np.zeros(N + 1), np.zeros((N + 1, N)), np.zeros((N + 1, N + 1, N))
        for text, n in samples.items():
            a = b = N  # before the first character
            for c in map(PLACE.__getitem__, text):
                one[c] += n
                two[b, c] += n
                three[a, b, c] += n
                a, b = b, c
        p1 = (one[:N] + 1) / (one.sum() + N)
        p2 = (two + 20 * p1) / (two.sum(1, keepdims=True) + 20)
        self.log = np.log((three + 20 * p2[None]) / (three.sum(2, keepdims=True) + 20)).astype(np.float32)

    def score(self, text: str) -> float:
        codes = [N, N, *map(PLACE.__getitem__, text)]
        return float(self.log[codes[:-2], codes[1:-1], codes[2:]].sum())


class Detector:
    """Both chains and the least ratio per character of a secret.

    No ordinary sample of a run's length reaches it, and all but ``missed`` of fresh random strings do.
    """

    def __init__(self, random_strings: Counter, ordinary: Counter, margin: float = 0.05, missed: float = 0.02):
        self.random, self.ordinary = Chain(random_strings), Chain(ordinary)
        highest = max((self.ratio(t) / len(t) for t in ordinary if len(t) >= 20), default=0.0)
        fresh = sorted(self.ratio(t) / len(t) for t in generated(2000, seed=44))
        self.limit = max(highest + margin, fresh[int(missed * len(fresh))])

    def ratio(self, text: str) -> float:
        return self.random.score(text) - self.ordinary.score(text)

    def accepts(self, text: str) -> bool:
        """A ratio above the limit, and both of digits and letters: what only letters spell may be a name."""
        if not (any(c.isdigit() for c in text) and any(c.isalpha() for c in text)):
            return False
        return self.ratio(text) > self.limit * len(text)

    def spans(self, text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        """Base spans, and those of the chains that touch no base span."""
        base = base_spans(text)
        more = []
        for m in runs(text):
            touched = any(start < m.end() and m.start() < end for start, _, end in base)
            if not touched and self.accepts(m.group()):
                more.append((m.start(), 3, m.end()))
        return base, more


def generated(n: int = 600, seed: int = 42) -> Counter:
    """Random strings of the usual alphabets and lengths."""
    rng = random.Random(seed)
    kinds = ["0123456789abcdef", ALPHABET[:62], ALPHABET[:64], ALPHABET[26:62], ALPHABET[:26] + ALPHABET[52:62]]
    return Counter("".join(rng.choices(rng.choice(kinds), k=rng.randrange(20, 65))) for _ in range(n))


def composed(words: list[str], n: int = 3000, seed: int = 43) -> Counter:
    """Identifiers made of words: paths, snake, kebab and camel case, with numbers behind or between."""
    rng, out = random.Random(seed), Counter()
    for _ in range(n if words else 0):
        joint = rng.choice(["_", "-", "/", "", "+", "="])
        cases = rng.choice([[str.lower], [str.title], [str.upper], [str.title, str.title, str.upper]])
        parts = []
        while sum(map(len, parts)) < rng.randrange(16, 44):
            word = rng.choice(cases)(rng.choice(words)[:20])
            parts.append(word + str(rng.randrange(10 ** rng.randrange(1, 5))) * (rng.random() < 0.35))
        out[joint.join(parts)] += 1
    return out


def train(docs: DataFrame, max_bytes: int = 16 << 20, most_runs: int = 50_000, seed: int = 42, key: str = "doc_id", text: str = "text") -> Detector:
    """A detector from a sample of about ``max_bytes`` of whole texts, drawn by a hash of the key.

    Of the sample's ordinary runs the ``most_runs`` first by hash are fitted; base patterns' values are random.
    """
    rows = narrow(docs, {"_key": key, "_text": text}).filter("_text is not null")
    total = rows.agg(F.sum(text_bytes("_text") + 1)).first()[0] or 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                base = base_spans(value)
                for start, kind, end in base:
                    own = value[start:end]
                    own = ASSIGN.match(own).group(2) if kind == 0 else own
                    found["random", "".join(c for c in own if c in PLACE)] += 1
                for m in runs(value):
                    if not any(start < m.end() and m.start() < end for start, _, end in base):
                        # What holds digits has no label: it may be a key that no pattern names.
                        if not any(c.isdigit() for c in m.group()):
                            found["ordinary", m.group()] += 1
                for word in value.split():
                    if word.isascii() and word.isalpha() and len(word) < 20:
                        found["ordinary", word] += 1
        columns = [pa.array([k[i] for k in found], pa.string()) for i in range(2)] + [pa.array(found.values(), pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["label", "value", "n"])

    sample = rows.filter(below(draw(seed, "_key"), F.lit(min(1.0, max_bytes / total)))).select("_text")
    counts = sample.mapInArrow(run, "label string, value string, n long").groupBy("label", "value").agg(F.sum("n").alias("n"))
    order = F.xxhash64(F.lit(seed), "value")
    parts = [counts.filter(F.col("label") == k).orderBy(order, "value").limit(most_runs) for k in ("random", "ordinary")]
    table = parts[0].unionByName(parts[1]).toArrow()  # at most 2 * most_runs rows of the bounded sample
    both = {"random": generated(), "ordinary": Counter()}
    for label, value, n in zip(*(table.column(c).to_pylist() for c in ("label", "value", "n")), strict=True):
        both[label][value] += n
    words = sorted(w for w in both["ordinary"] if len(w) > 1)
    return Detector(both["random"], both["ordinary"] + composed(words))


def scan(docs: DataFrame, detector: Detector, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, base, more`` of every whole text: spans as arrays of (start, kind, end) in code points.

    Null and empty texts have no spans.  Rows with equal or null keys are each kept; an empty table gives no rows.
    """
    model = Shared(docs, detector)
    span = pa.list_(pa.struct([("start", pa.int64()), ("kind", pa.string()), ("end", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("base", span), ("more", span)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        working("secrets")
        own = model.value
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [own.spans(t.as_py() or "") for t in part.column(1)]
                columns = [
                    pa.array([[{"start": a, "kind": KINDS[k], "end": b} for a, k, b in f[i]] for f in found], span) for i in range(2)
                ]
                yield pa.RecordBatch.from_arrays([part.column(0), *columns], schema=schema)

    rows = narrow(docs, {"doc_id": key, "_text": text}).select(F.col("doc_id").cast("long"), F.col("_text").cast("string"))
    kind = "array<struct<start: long, kind: string, end: long>>"
    return rows.mapInArrow(run, f"doc_id long, base {kind}, more {kind}")


def secret_digest(docs: DataFrame) -> DataFrame:
    """Counts, checksum and list of the spans of every document."""
    found = scan(docs, train(docs))
    order = F.array(*[F.lit(k) for k in KINDS])

    def listed(spans):
        ranked = F.transform(spans, lambda s: F.struct(s["start"], F.array_position(order, s["kind"]), s["end"], s["kind"].alias("kind")))
        sorted_spans = F.array_sort(ranked)
        return F.concat_ws(",", F.transform(sorted_spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def number(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[number(k).alias(f"n_{k}") for k in KINDS[:3]],
        F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        listed(F.concat("base", "more")).alias("spans"),
    )


def digest(spans: list[tuple[int, int, int]]) -> str:
    return hashlib.sha256(shown(spans).encode()).hexdigest()


def masked(docs: DataFrame, detector: Detector, mask: str = "[secret]", text: str = "text", length: str = "n_chars") -> DataFrame:
    """All rows with their secrets replaced by ``mask``; other texts are untouched, ``length`` follows the text."""
    model = Shared(docs, detector)

    @F.pandas_udf("string")
    def hide(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        working("secrets")
        own = model.value
        for texts in batches:
            out = []
            for value in texts:
                if isinstance(value, str):
                    base, more = own.spans(value)
                    merged = []
                    for start, _, end in sorted(base + more):
                        if merged and start < merged[-1][1]:
                            merged[-1][1] = max(merged[-1][1], end)
                        else:
                            merged.append([start, end])
                    for start, end in reversed(merged):
                        value = value[:start] + mask + value[end:]
                out.append(value if isinstance(value, str) else None)
            yield pd.Series(out, dtype=object)

    out = docs.withColumn(text, hide(F.col(text)))
    if length in docs.columns:
        same = F.length(text).cast(docs.schema[length].dataType)
        out = out.withColumn(length, F.when(F.col(text).isNull(), F.col(length)).otherwise(same))
    return out.select(*docs.columns)

