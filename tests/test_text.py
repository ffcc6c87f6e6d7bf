"""Text and label expressions against plain Python on hand-written and generated strings."""

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from textgauge.config import CorpusConfig
from textgauge.functions import labels as L
from textgauge.functions import text as X
from textgauge.operators import profile
from textgauge.operators.labelling import label_violations, normalize_labels
from textgauge.operators.processing import filter_length, filter_tokens, finalize, process_texts
from textgauge.operators.scoring import confidence_bands, input_status

EDGES = [
    None, "", "   ", "\t\n  ", "a...b!!!??", "wait..  what\t\tnow", "café naïve ² x²",
    "é combining", "emoji \U0001f600 here", "tab\tend\t", "　wide　space ", "it's \"quoted\" - yes; no: 5%",
    "no end", "One. Two! Three? Four", "...", "?! ?!", "a.b.c", "line\r\nbreak", "x\x1cy\x1fz\x85w", "1,000.50 $",
]


def py_clean(t, special=False):
    if t is None:
        return ""
    t = re.sub(r"\s+", " ", t.strip())
    if special:
        t = re.sub(r"[^\w\s.,!?;:\"'-]", "", t)
    for mark in ".!?":
        t = re.sub(f"[{mark}]{{2,}}", mark, t)
    return t.strip()


def py_sentences(t):
    if t is None or not t.strip():
        return 0
    t = t.strip()
    return len(re.findall(r"[.!?]+(?:\s|\Z)", t)) + (t[-1] not in ".!?")


def run(spark, texts, **columns):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return df.select("i", *[c.alias(n) for n, c in columns.items()]).orderBy("i").collect()


def check(spark, texts):
    rows = run(
        spark, texts, clean=X.clean("t"), strict=X.clean("t", drop_special=True), light=X.clean_light("t"),
        words=X.word_count("t"), chars=X.char_count("t"), blank=X.is_blank("t"), sentences=X.sentence_count("t"),
        commas=X.count_of("t", ","), split=F.size(F.filter(X.words("t"), lambda w: w != "")), strip=X.strip("t"),
    )
    for t, r in zip(texts, rows):
        assert r.clean == py_clean(t)
        assert r.strict == py_clean(t, special=True)
        assert r.light == ("" if t is None else re.sub(r"\s+", " ", t.strip()))
        assert r.blank == (t is None or not t.strip())
        assert r.sentences == py_sentences(t)
        if t is not None:
            assert (r.words, r.chars, r.commas) == (len(t.split()), len(t), t.count(","))
            assert r.split == len(t.split())
            assert r.strip == t.strip()


def test_edges(spark):
    check(spark, EDGES)


@pytest.mark.parametrize("special", [False, True])
def test_processed_columns(spark, special):
    df = spark.createDataFrame(list(enumerate([*EDGES, "a @ b", " @ "])), "i int, text string")
    rows = process_texts(df, CorpusConfig(drop_special=special)).orderBy("i").collect()
    for r in rows:
        want = py_clean(r.text, special)
        assert (r.processed_text, r.text_length, r.word_count) == (want, len(want), len(want.split()))
    limits = CorpusConfig(drop_special=special, min_length=3, max_length=9)
    kept = {r.i for r in filter_length(process_texts(df, limits), limits).collect()}
    assert kept == {r.i for r in rows if 3 <= r.text_length <= 9}
    few = filter_tokens(df.na.drop(), "text", 3).collect()
    assert few and all(r.n_tokens <= 3 for r in few)
    final = finalize(process_texts(df.withColumn("generated", F.lit(1))), ["i"])
    assert final.columns == ["i", "text", "generated"]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(st.sampled_from("aZ9 \t\n  é中.!?,;'\"-_@#²\U0001f600"), max_size=40), min_size=20, max_size=60))
def test_generated(spark, texts):
    check(spark, texts)


def test_space_and_word_classes_cover_every_character(spark):
    points = [c for c in range(1, 0x10000) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame([(c, chr(c)) for c in points], "c int, t string")
    spaces = {r.c for r in df.where(F.col("t").rlike(f"^[{X.SPACE}]\\z")).collect()}
    words = {r.c for r in df.where(F.col("t").rlike(f"^[{X.WORD}]\\z")).collect()}
    others = {r.c for r in df.where(F.col("t").rlike(f"^[^{X.WORD}{X.SPACE}]\\z")).collect()}
    assert spaces == {c for c in points if re.match(r"\s", chr(c))}
    assert others == set(points) - words - spaces
    # Python and the JVM know slightly different versions of the character tables.
    assert len(words ^ {c for c in points if re.match(r"\w", chr(c))}) < 400


def test_tokens(spark):
    (row,) = run(spark, ["Hi, you! x_1 é"], n=X.token_count("t"), all=X.tokens("t"), cut=X.tokens("t", 2))
    assert row.n == 6 and row.all == ["hi", ",", "you", "!", "x_1", "é"] and row.cut == ["hi", ","]


@pytest.mark.parametrize(
    "source, code",
    [
        (None, 0), ("openai-webtext reddit", 0), ("Facebook", 0), ("email", 1), ("GPT-4", 1), ("Wikipedia", 0),
        ("PaLM", 1), ("unknown", -1), ("", -1), ("Claude", 1), ("web", -1),
    ],
)
def test_sources(spark, source, code):
    df = spark.createDataFrame([(source,)], "s string")
    keep, default = df.select(L.from_source("s", unknown=L.UNKNOWN), L.from_source("s")).first()
    assert keep == (-1 if source is None else code)
    assert default == max(code, 0)


def labels_of(spark, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"k int, y {kind}")
    return [r.y for r in normalize_labels(df, "y", "k").orderBy("k").collect()]


def test_label_mapping(spark):
    assert labels_of(spark, ["human", "ai", "10", "GPT", "original"]) == [0, 1, 0, 1, 0]
    assert labels_of(spark, ["foo", "bar", "foo", None]) == [0, 1, 0, None]
    # A label without indicator is human only while the mapping is empty.
    assert labels_of(spark, ["human", "foo"]) == [0, 1]
    assert labels_of(spark, ["0", "1", "7"]) == [0, 1, 7]
    assert labels_of(spark, [0.0, 1.0], "double") == [0, 1]


def test_strict_labels(spark):
    df = spark.createDataFrame([("human",), ("ai",), ("bot",)], "y string")
    assert [r.y for r in df.where("y <> 'bot'").select(L.strict(F.col("y")).alias("y")).collect()] == [0, 1]
    assert [r.y for r in df.select(L.strict(F.col("y"), fail=False).alias("y")).collect()] == [0, 1, None]
    assert label_violations(df, "y").collect() == [("bot", 1)]
    with pytest.raises(Exception, match="unmapped label: bot"):
        df.select(L.strict(F.col("y"))).collect()


def test_score_labels(spark):
    df = spark.createDataFrame([("LABEL_0",), ("label_1",), ("Human",), ("AI",), ("class 12b3",), ("none",)], "y string")
    assert [r[0] for r in df.select(L.from_score_label(F.col("y"))).collect()] == [0, 1, 0, 1, 12, 0]


def test_bands_and_gate(spark):
    df = spark.createDataFrame([(0.95,), (0.9,), (0.75,), (0.65,), (0.5,)], "c double")
    coarse, fine = confidence_bands("c")
    assert [tuple(r) for r in df.select(coarse, fine).collect()] == [
        ("High", "Very High"), ("Medium", "High"), ("Medium", "Medium"), ("Low", "Low"), ("Low", "Very Low"),
    ]
    texts = run(spark, [None, " \t", "two words", "three short words"], s=input_status("t"))
    assert [r.s for r in texts] == ["empty", "empty", "too short", "ok"]


def test_preview_and_short_texts(spark):
    df = spark.createDataFrame([(3, "c" * 101), (1, "a" * 100), (2, "b"), (4, None)], "k int, t string")
    assert [r.t for r in profile.preview(df, "t", "k").collect()] == ["a" * 100, "b", "c" * 100 + "..."]
    assert tuple(profile.short_texts(df, "t").first()) == (1, 1, 2)
