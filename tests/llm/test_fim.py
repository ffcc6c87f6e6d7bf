"""Fill-in-the-middle: the skip list against the plain pattern, the transformation against plain slicing, odd rows."""

import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from textgauge.llm import fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
TEXTS = st.text(st.sampled_from("ab \t\n\x0b é漢😀<>PSM"), max_size=200)


def plain(key, text):
    text = text or ""
    units = UNIT.findall(text)
    drawn = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(drawn[i : i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return len(units), "plain", None, None, text
    low, high = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    if h4 % 100 < 80:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(2, 9))
def test_every_rank_is_reached_exactly(text, fan):
    units, data = UNIT.findall(text), text.encode()
    lanes = fim.SkipList(data, fan)
    assert lanes.n == len(units)
    for rank in range(lanes.n + 1):
        before = "".join(units[:rank])
        assert lanes.reach(rank) == (rank, len(before), len(before.encode()))


def test_links_carry_the_widths_below_them():
    lanes = fim.SkipList(("wörd " * 5000).encode(), 8).lanes
    assert len(lanes) == 5
    for upper, lower in zip(lanes[1:], lanes):
        for i, width in enumerate(upper):
            assert width == [sum(w[j] for w in lower[8 * i : 8 * i + 8]) for j in range(3)]


@settings(max_examples=150, deadline=None)
@given(st.integers(0, 10**12), TEXTS)
def test_transform_is_plain_slicing(key, text):
    cut = fim.transform(key, text.encode())
    assert (cut.n, cut.form, cut.prefix_chars, cut.middle_chars, cut.output.decode()) == plain(key, text)


def test_outputs_and_their_restored_texts(spark, odd_docs, no_docs, documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()] + [(i, t) for i, t in enumerate(["a<b <<P", "<", "x <S", "<P> a", " \n", "é 漢 😀 x"] * 30, 10**6)]
    for docs, rows in [(spark.createDataFrame(rows, "doc_id long, text string"), rows), (odd_docs, [(r.doc_id, r.text) for r in odd_docs.collect()])]:
        got = fim.fill_in_middle(docs).withColumn("back", fim.restored()).collect()
        mine = sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.back) for r in got), key=str)
        assert mine == sorted(((k, *plain(k, t), t or "") for k, t in rows), key=str)
    assert {r.form for r in got} <= {"plain", "spm", "psm"}
    assert fim.fim_digest(no_docs).collect() == []


def test_rates(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "'one two three four' as text")
    forms = {r.form: r["count"] for r in fim.fill_in_middle(docs).groupBy("form").count().collect()}
    assert abs(forms["plain"] - 2000) < 150 and abs(forms["psm"] - 400) < 90


def test_a_very_long_text(spark):
    text = ("mot été " * 400_000) + " "
    docs = spark.createDataFrame([(i, text) for i in range(4)], "doc_id long, text string")
    for r in fim.fim_digest(docs).collect():
        want = plain(r.doc_id, text)
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == want[:4]
        assert r.output_sha256 == hashlib.sha256(want[4].encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256(text.encode()).hexdigest()
