"""Every stage of the pipeline against a plain version on its own input."""

import re

import pytest
from test_near_copies import exact_groups

import corpus_pipeline as P
from textgauge.llm import language, mixing, secrets
from textgauge.llm.tables import stored


@pytest.fixture(scope="module")
def inputs(spark, documents, sf):
    docs, out = documents, []
    for name, stage in P.STAGES:
        out.append(docs)
        docs = stored(stage(spark, docs, sf), "test-pipeline")
        if name != P.STAGES[-1][0]:
            assert docs.columns == documents.columns and [t for _, t in docs.dtypes] == [t for _, t in documents.dtypes]
    return [*out, docs]


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_language_keeps_what_it_recognises(inputs):
    docs, kept = by_id(inputs[0]), by_id(inputs[1])
    scorer = language.Scorer(language.train(inputs[0]))
    for key, row in docs.items():
        lang, _, bits = scorer.predict(row.text)
        assert (key in kept) == (lang != "und" and bits <= 6)
    assert all(kept[k] == docs[k] for k in kept) and len(kept) > 0.95 * len(docs)


def test_one_of_each_group_stays(inputs):
    docs, kept = by_id(inputs[1]), by_id(inputs[2])
    groups = exact_groups({k: r.text for k, r in docs.items()})
    assert set(kept) == set(groups.values()) and all(kept[k] == docs[k] for k in kept)


def test_secrets_are_masked(inputs):
    docs, kept = by_id(inputs[2]), by_id(inputs[3])
    assert docs.keys() == kept.keys()
    for key, row in docs.items():
        base = secrets.base_spans(row.text)
        assert kept[key].n_chars == len(kept[key].text)
        assert not secrets.base_spans(kept[key].text)
        if not base:
            assert kept[key] == row
        else:
            parts = kept[key].text.split("[secret]")
            assert re.fullmatch(".*".join(map(re.escape, parts)), row.text, re.S)


def test_mixing_orders_all_rows(inputs):
    docs, kept = by_id(inputs[3]), inputs[4].collect()
    assert {r.doc_id: r for r in kept} == docs and len(kept) == len(docs)
    plan = mixing.mix(inputs[3], P.SHARES, P.REST).collect()
    order = [r.doc_id for r in sorted(plan, key=lambda r: (r.slot, r.byte_start, r.doc_id))]
    got = [r.doc_id for r in kept]
    empty = {r.doc_id for r in plan if r.size == 0}
    assert [k for k in got if k not in empty] == [k for k in order if k not in empty]


def test_all_tokens_are_packed(inputs):
    rows = inputs[5].collect()
    assert {r.doc_id for r in rows} == set(by_id(inputs[4]))
    totals = {}
    for r in rows:
        totals[r.doc_id] = totals.get(r.doc_id, 0) + r.length
    assert all(totals[r.doc_id] == r.doc_tokens for r in rows)


def test_odd_rows_and_empty_tables(spark, odd_docs, no_docs, sf):
    for docs in (odd_docs, no_docs):
        for name, stage in P.STAGES:
            docs = stored(stage(spark, docs, sf), "test-odd")
    assert docs.count() == 0
    docs = odd_docs
    for name, stage in P.STAGES[:-1]:
        docs = stored(stage(spark, docs, sf), "test-odd")
        assert docs.columns == odd_docs.columns
    assert {1, 4, 9} <= {r.doc_id for r in docs.collect()}
