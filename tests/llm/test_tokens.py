"""Token files and packing against the tokenizer applied to whole texts."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from textgauge.llm import packing, tokens, wavelet
from textgauge.llm.tokens import encode, tokenizer_path


@pytest.fixture(scope="module")
def plain():
    tokenizer = Tokenizer.from_file(tokenizer_path())
    return lambda text, end: [*tokenizer.encode(text or "", add_special_tokens=False).ids, end]


def test_chunks_equal_whole_texts(plain):
    rng = random.Random(1)
    parts = list("abcXYZ '&<|>\n\t\x1c\x1f\x85\xa0éÉßÖñİıſKǅ̈09٣ªº×÷Å漢ΑΣς🙂") + ["<|endoftext|>", "<|startoftext|>", "'s", "'LL", "d'll"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(60))) for _ in range(3000)]
    for text, ids in zip(texts, encode([t.encode() for t in texts], tokenizer_path(), 7)):
        assert np.frombuffer(ids, "<u4").tolist() == plain(text, 7), text


def texts_of_plain_letters(n, seed):
    rng = random.Random(seed)
    parts = list("abcdestrvXYZ ''&.,!09\n\t\r\x0b\x1c\x7fàÀéÉßÿ") + ["'s", "'LL", "d'll", "it's", "'re", "'Ve", "''s", "word", "longer-than-sixteen-bytes", "Überlängenwörter", "x" * 17]
    return ["".join(rng.choices(parts, k=rng.randrange(80))) for _ in range(n)]


@pytest.mark.parametrize("together, most", [(1 << 21, 400_000), (200, 400_000), (3000, 300), (60, 1)])
def test_plain_texts_together(plain, monkeypatch, together, most):
    """Pieces by arrays, in groups of any size, with tables that overflow, and texts cut into parts."""
    monkeypatch.setattr(tokens, "TOGETHER", together)
    monkeypatch.setattr(tokens, "_loaded", {})
    texts = [*texts_of_plain_letters(800, together), "", " ", "'", "'s", "s'", "a\0b \0", "x" * 5000, "y z" * 900, "é" * 400 + "'s"]
    list(encode([], tokenizer_path()))
    tokens._loaded[tokenizer_path()].table.most = most
    for _ in range(2):
        for text, ids in zip(texts, encode([t.encode() for t in texts], tokenizer_path(), 7), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == plain(text, 7), text
    table = tokens._loaded[tokenizer_path()].table
    assert len(table.start) == len(table.size) and table.size.sum() == len(table.flat)


def test_wavelet_queries():
    rng = np.random.default_rng(3)
    ids = np.concatenate([rng.integers(0, 49408, 5000), np.full(300_000, 17), rng.integers(0, 9, 70_000)])
    found = wavelet.WaveletFile(wavelet.encode_file(ids, np.array([0, 4000]), [5, None]))
    assert (found.ids() == ids).all() and found.keys == [5, None] and found.starts.tolist() == [0, 4000, len(ids)]
    for at in [0, 4999, 5000, len(ids) - 1, *rng.integers(0, len(ids), 40).tolist()]:
        token = int(ids[at])
        places = np.flatnonzero(ids == token)
        assert found.access(at) == token
        assert found.count(token) == len(places) and found.count(token, at) == (places < at).sum()
        nth = int(rng.integers(0, len(places)))
        assert found.locate(token, nth) == places[nth]
    assert found.count(49407) == (ids == 49407).sum() and found.count(1 << 20) == 0
    with pytest.raises(IndexError):
        found.locate(17, 10**9)
    with pytest.raises(IndexError):
        found.access(len(ids))


@pytest.mark.parametrize("ids", [[], [0], [3] * 10, [70_000, 1]])
def test_small_files(ids):
    found = wavelet.WaveletFile(wavelet.encode_file(np.array(ids, np.int64), np.array([0]), [1]))
    assert found.ids().tolist() == ids and [found.access(i) for i in range(len(ids))] == ids


def token_rows(docs, plain):
    rows, start = [], 0
    for r in sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0)):
        ids = plain(r.text, 2)
        rows.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return rows


def test_files_round_trip(spark, documents, plain):
    found = wavelet.token_digest(spark, documents).collect()
    assert sorted(map(tuple, found)) == token_rows(documents, plain)


def test_files_of_odd_rows(spark, odd_docs, no_docs, plain, tmp_path):
    found = {(r.doc_id, r.n_tokens, r.ids_crc32) for r in wavelet.token_digest(spark, odd_docs).collect()}
    assert found == {(a, c, d) for a, _, c, d in token_rows(odd_docs, plain)}
    starts = sorted((r.start, r.n_tokens) for r in wavelet.token_digest(spark, odd_docs).collect())
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:])) and starts[0][0] == 0
    assert wavelet.token_digest(spark, no_docs).collect() == []
    listed = wavelet.write_tokens(odd_docs, str(tmp_path / "f"), tokens_per_file=100).collect()
    assert sum(r.n_docs for r in listed) == odd_docs.count()


def check_packing(docs, plain, window):
    pieces, places = packing.pack(docs, window=window)
    rows = packing.packed_digest(pieces, places).collect()
    texts = defaultdict(list)
    for r in docs.select("doc_id", "text").collect():
        texts[r.doc_id].append(plain(r.text, 1))
    want = sorted(
        (str(k), s, len(ids[s : s + window]), zlib.crc32(np.array(ids[s : s + window], "<u4").tobytes()), len(ids))
        for k, own in texts.items() for ids in own for s in range(0, len(ids), window)
    )
    assert sorted((str(r.doc_id), r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length, r.filled))
    for own in sequences.values():
        own.sort()
        assert own[0][0] == 0 and all(a + n == b for (a, n, _), (b, _, _) in zip(own, own[1:]))
        assert own[-1][0] + own[-1][1] == own[0][2] <= window
    return sum(n for own in sequences.values() for _, n, _ in own) / (len(sequences) * window)


def test_packing(documents, odd_docs, no_docs, plain):
    assert check_packing(documents, plain, 2048) > 0.9
    check_packing(odd_docs, plain, 2048)
    check_packing(odd_docs, plain, 8)
    pieces, places = packing.pack(no_docs)
    assert packing.packed_digest(pieces, places).collect() == []


@pytest.mark.parametrize("n", [1, 300, 250_000, 10**12])
def test_plan_uses_every_remainder_once(n):
    counts = np.r_[np.random.default_rng(n).multinomial(n, np.r_[0, np.ones(2047) / 2047]), 0].astype(np.int64)
    counts[7] += n  # a length with half of all rows
    used, windows = np.zeros(2049, np.int64), 0
    for lengths, repeats in packing.plan(counts):
        assert sum(lengths) <= 2048 and repeats > 0
        for p in lengths:
            used[p] += repeats
        windows += repeats
    assert (used == counts).all()
    if n > 1000:
        assert (counts * np.arange(2049)).sum() / (windows * 2048) > 0.99
