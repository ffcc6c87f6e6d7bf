"""Languages: code lengths against a plain coder, held-out accuracy, odd rows."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from textgauge.llm import language

WORDS = {
    "aa": Counter({"the": 30, "then": 9, "cat": 7, "hat": 5, "über": 2}),
    "bb": Counter({"der": 25, "den": 12, "katze": 6, "hut": 4, "über": 8}),
}


def plain_bits(words, word, order):
    """Method C by its definition: from the longest known context down, escapes on the way."""
    follow = defaultdict(Counter)
    for w, n in words.items():
        coded = b" " + w.encode() + b" "
        for i in range(1, len(coded)):
            for k in range(min(order, i) + 1):
                follow[coded[i - k : i]][coded[i]] += n
    coded, bits = b" " + word.encode() + b" ", 0.0
    for i in range(1, len(coded)):
        for k in range(min(order, i), -1, -1):
            seen = follow.get(coded[i - k : i])
            if seen is None:
                continue
            total = sum(seen.values()) + len(seen)
            if coded[i] in seen:
                bits -= math.log2(seen[coded[i]] / total)
                break
            bits -= math.log2(len(seen) / total)
        else:
            bits += 8
    return bits


@pytest.mark.parametrize("order", [0, 2, 4])
def test_exact_code_lengths(order):
    trees = language.ContextTrees({k: language.gram_counts(w, order) for k, w in WORDS.items()}, order)
    scorer = language.Scorer(trees)
    for word in ["the", "thee", "über", "katzen", "xyz", "漢字", "h"]:
        want = [plain_bits(WORDS[k], word, order) for k in ("aa", "bb")]
        assert np.allclose(scorer.bits([word]), want, rtol=1e-4)
    assert np.allclose(scorer.bits(["the", "hat", "the"]), 2 * scorer.bits(["the"]) + scorer.bits(["hat"]), rtol=1e-4)


def test_held_out_accuracy(documents):
    found = {r.doc_id: r for r in language.held_out_languages(documents).collect()}
    rows = documents.collect()
    assert len(found) == len(rows)
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert {r.doc_id for r in held} == {k for k, r in found.items() if r.held_out}
    assert np.mean([found[r.doc_id].lang_pred == r.lang for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in found.values())


def test_odd_rows(odd_docs, no_docs):
    trees = language.train(odd_docs)
    found = language.identify(odd_docs, trees).collect()
    assert len(found) == odd_docs.count()
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    for key in (2, 3, 6, 7):  # null, empty, blank, no letters
        assert (by_id[key].lang_pred, by_id[key].score) == ("und", 0.0)
    assert by_id[9].lang_pred == "de" and by_id[1].lang_pred == "en"
    assert language.held_out_languages(no_docs).collect() == []
    nothing = language.identify(odd_docs, language.train(no_docs)).collect()
    assert {r.lang_pred for r in nothing} == {"und"}
