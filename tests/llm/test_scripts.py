"""Languages in scripts of several bytes a letter pass the stage as Latin ones do."""

import random

from textgauge.llm import language


def test_labelled_language_of_another_script_stays(spark):
    rng = random.Random(6)
    letters = {"zh": [chr(c) for c in range(0x4E00, 0x4E00 + 1500)], "en": list("abcdefghijklmnopqrstuvwxyz")}

    def text(lang, n):
        return " ".join("".join(rng.choices(letters[lang], k=rng.randrange(2, 6))) for _ in range(n))

    rows = [(i, text(lang, 60), lang) for i, lang in enumerate(["zh", "en"] * 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    trees = language.train(docs.filter("doc_id < 40"))
    kept = {r.doc_id for r in language.recognised(docs.filter("doc_id >= 40"), trees).collect()}
    assert kept == set(range(40, 80))


def test_bits_are_per_coded_byte():
    trees = language.ContextTrees({"none": {}})
    for word in ("hat", "über", "漢字", "हिन्दी"):
        lang, _, bits = language.Scorer(trees).predict(word)
        words = language.WORD.findall(word)
        coded = sum(len(w.encode()) + 1 for w in words)
        assert (lang, bits) == ("none", 8.0) and coded > 0
