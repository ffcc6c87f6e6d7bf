"""Queries of the table quality gate."""

from __future__ import annotations

from textgauge.catalog.registry import LABELLED, labelled, query, rounded, table
from textgauge.config import QualityConfig
from textgauge.operators import quality

DOCS = QualityConfig(expected_columns=("text", "generated", "source", "licence"), label="generated")


@query(
    "check_schema",
    """select (select count(*) from documents) as n_rows, c as "column", t as dtype, s as status, true as passed from (values
        ('doc_id', 'bigint', 'extra'), ('text', 'string', 'expected'), ('lang', 'string', 'extra'), ('source', 'string', 'expected'),
        ('n_chars', 'bigint', 'extra'), ('generated', 'int', 'expected'), ('licence', null, 'missing')) v(c, t, s)""",
)
def _(spark, sf):
    return quality.check_schema(labelled(spark, sf), DOCS)


_JOINED = "(select d.doc_id, d.text, d.lang, l.quality from documents d left join labels l on d.doc_id = l.doc_id)"


@query(
    "check_quality",
    f"""with t as {_JOINED},
    n as (select count(*) as n, greatest(count(*) filter (where doc_id is null), count(*) filter (where text is null),
        count(*) filter (where lang is null), count(*) filter (where quality is null)) / cast(count(*) as double) as worst,
        cast(count(*) filter (where quality is null) / cast(count(*) as double) > 0.05 as bigint) as high from t),
    d as (select count(*) as k from (select distinct * from t))
    select n as n_rows, round(worst, 6) as worst_null_share, high as high_null_columns, n - k as duplicate_rows,
        round((n - k) / cast(n as double), 6) as duplicate_share, cast(0 as bigint) as empty_rows,
        round(1.0e0 - worst - (n - k) / cast(n as double), 6) as quality_score, worst <= 0.05 as passed from n, d""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return rounded(quality.check_quality(docs.select("doc_id", "text", "lang", "quality")))


_TEXT = """select count(*) as n_rows, min(length(t)) as min_length, max(length(t)) as max_length,
    round(avg(length(t)), 6) as mean_length, count(*) filter (where length(t) < 10) as too_short,
    count(*) filter (where length(t) > 10000) as too_long,
    count(*) filter (where length(t) between 10 and 10000) as within_range,
    count(*) filter (where trim(t) = '') as empty_texts, count(distinct t) as unique_texts,
    round(count(distinct t) / cast(count(*) as double), 6) as diversity,
    count(*) filter (where length(t) < 10 or length(t) > 10000 or trim(t) = '') = 0 as passed
  from (select coalesce(text, 'None') as t from documents)"""


@query("check_text", _TEXT)
def _(spark, sf):
    return rounded(quality.check_text(table(spark, sf, "documents")))


_LABELS = """select cast(label as integer) as label, n, case when label is null then 'null' when label not in (1, 2, 11) then 'unexpected'
    when n = 0 then 'missing' else 'expected' end as status, label is not null and label in (1, 2, 11) as passed
  from (select label, sum(n)::bigint as n from (select label, count(*) as n from embeddings group by label
    union all select * from (values (1, 0), (2, 0), (11, 0)) e(label, n)) group by label)"""


@query("check_labels", _LABELS)
def _(spark, sf):
    return quality.check_labels(table(spark, sf, "embeddings"), QualityConfig(label="label", expected_labels=(1, 2, 11)))


_CLASSES = """with c as (select quality as label, count(*) as n from labels where quality is not null group by quality)
  select label, n, round(n * 100.0e0 / (select count(*) from labels), 6) as percent, n >= 100 as sufficient,
    round((select min(n) / cast(max(n) as double) from c), 6) as balance_ratio,
    (select min(n) / cast(max(n) as double) from c) >= 0.5 as is_balanced, (select min(n) from c) >= 100 as passed from c"""


@query("check_classes", _CLASSES)
def _(spark, sf):
    return rounded(quality.check_classes(table(spark, sf, "labels"), QualityConfig(label="quality")))


@query(
    "validation_report",
    f"""with t as (select doc_id, text, lang, source, n_chars, generated from {LABELLED}),
    d as (select count(*) as k from (select distinct * from t)),
    c as (select generated, count(*) as n from t group by generated),
    r as (select 'schema' as "check", 'rows' as metric, cast(count(*) as double) as value, true as passed from t
      union all select 'data_quality', 'quality_score', 1.0e0 - (count(*) - (select k from d)) / cast(count(*) as double), true from t
      union all select 'text_content', 'diversity', count(distinct text) / cast(count(*) as double),
        count(*) filter (where length(text) < 10 or length(text) > 10000 or trim(text) = '') = 0 from t
      union all select 'labels', 'failed_labels', cast(count(*) filter (where generated not in (0, 1)) as double),
        count(*) filter (where generated not in (0, 1)) = 0 from c
      union all select 'class_distribution', 'balance_ratio', min(n) / cast(max(n) as double), min(n) >= 100 from c)
    select "check", metric, round(value, 6) as value, passed from r
    union all select 'summary', 'success_rate', round(count(*) filter (where passed) / cast(count(*) as double), 6), bool_and(passed) from r""",
)
def _(spark, sf):
    return rounded(quality.validation_report(labelled(spark, sf)))
