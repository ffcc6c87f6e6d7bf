"""Queries over whole corpora: dedup, sampling, splits, profiles, vocabulary, the corpus job."""

from __future__ import annotations

from pyspark.sql import functions as F

from textgauge.catalog.registry import (
    AI, HUMAN, LABELLED, ROLES, SPACE, labelled, query, roles, rounded, sql_clean, sql_words, table,
)
from textgauge.config import CorpusConfig, QualityConfig
from textgauge.functions import text as X
from textgauge.operators import dedup, profile, sampling, vocabulary
from textgauge.operators.prefix import summarize
from textgauge.plans import corpus as C
from textgauge.session import scratch_path
from textgauge.sources.stage_cache import cached_stage



def order(purpose: str, key: str = "doc_id") -> str:
    """Random order of an operator in SQL."""
    return f"md5('{purpose}|42|' || " + " || '|' || ".join(key.split(", ")) + f"), {key}"


@query(
    "dedup_text",
    "select doc_id, md5(text) as digest, source from documents qualify row_number() over (partition by text order by doc_id) = 1",
)
def _(spark, sf):
    docs = dedup.drop_duplicate_texts(table(spark, sf, "documents"), "text", "doc_id", scratch_path(spark, "dedup"))
    return docs.select("doc_id", F.md5("text").alias("digest"), "source")


@query(
    "dedup_text_composite_key",
    """select conv_id, turn from conversations
    qualify row_number() over (partition by text order by conv_id, turn) = 1""",
)
def _(spark, sf):
    talks = table(spark, sf, "conversations")
    return dedup.drop_duplicate_texts(talks, "text", ["conv_id", "turn"]).select("conv_id", "turn")


@query(
    "duplicate_counts",
    """select 'text' as scope, count(*) as n_rows, count(distinct text) as n_distinct,
        count(*) - count(distinct text) as n_duplicates,
        round((count(*) - count(distinct text)) / cast(count(*) as double), 6) as duplicate_share from documents
    union all
    select 'row', (select count(*) from lineitem), count(*), (select count(*) from lineitem) - count(*),
        round(((select count(*) from lineitem) - count(*)) / cast((select count(*) from lineitem) as double), 6)
    from (select distinct l_partkey, l_suppkey, l_quantity from lineitem)""",
)
def _(spark, sf):
    texts = dedup.duplicate_texts(table(spark, sf, "documents"), "text").withColumn("scope", F.lit("text"))
    items = table(spark, sf, "lineitem")
    rows = dedup.duplicate_rows(items, ["l_partkey", "l_suppkey", "l_quantity"]).withColumn("scope", F.lit("row"))
    return rounded(texts.unionByName(rows))


@query("sample_n", f"select doc_id, source from documents order by {order('sample')} limit 300")
def _(spark, sf):
    return sampling.sample_rows(table(spark, sf, "documents"), 300, "doc_id").select("doc_id", "source")


@query(
    "duplicate_counts_events",
    """select count(*) as n_rows, (select count(*) from (select distinct * from {e})) as n_distinct,
        count(*) - (select count(*) from (select distinct * from {e})) as n_duplicates,
        round((count(*) - (select count(*) from (select distinct * from {e}))) / cast(count(*) as double), 6) as duplicate_share
    from {e}""".format(e="(select * from events union all select * from events where user_id % 5 = 0 union all select event_id, ts + interval 1 microsecond, user_id, event_type, value, props from events where user_id % 7 = 0)"),
)
def _(spark, sf):
    events = table(spark, sf, "events")
    again = events.where("user_id % 5 = 0")
    moved = events.where("user_id % 7 = 0").withColumn("ts", F.expr("ts + interval 1 microsecond"))
    return rounded(dedup.duplicate_rows(events.union(again).union(moved)))


_BALANCED = """with t as (select {cols}, {label}, row_number() over (partition by {label} order by {order}) as rn,
    count(*) over (partition by {label}) as size from {source}),
  s as (select min(size) as low, max(size) as high, count(distinct {label}) as k from t)
  select {cols}, cast({label} as integer) as {label} from t, s where {keep}"""


@query(
    "balance_classes",
    _BALANCED.format(cols="doc_id", label="generated", order=order("balance"), source=LABELLED, keep="rn <= low"),
)
def _(spark, sf):
    return sampling.balance_classes(labelled(spark, sf), "generated", "doc_id", (0, 1)).select("doc_id", "generated")


@query(
    "balance_classes_open",
    _BALANCED.format(cols="doc_id", label="generated", order=order("balance"), source=LABELLED, keep="rn <= low"),
)
def _(spark, sf):
    return sampling.balance_classes(labelled(spark, sf), "generated", "doc_id").select("doc_id", "generated")


@query(
    "balance_if_skewed",
    _BALANCED.format(
        cols="conv_id, turn", label="generated", order=order("balance", "conv_id, turn"), source=ROLES,
        keep="rn <= case when low / cast(high as double) < 0.8 then low else size end",
    ),
)
def _(spark, sf):
    talks = sampling.balance_classes(roles(spark, sf), "generated", ["conv_id", "turn"], (0, 1), max_ratio=0.8)
    return talks.select("conv_id", "turn", "generated")


_SAMPLED = f"(select * from {LABELLED} qualify row_number() over (order by {order('sample')}) <= 150)"
_EVEN = f"""(select * from (select *, row_number() over (partition by generated order by {order("balance")}) as rank,
    count(*) over (partition by generated) as whole from {LABELLED}) where rank <= (select min(n) from (select count(*) as n from {LABELLED} group by generated)))"""
_THEN_SPLIT = f"""select doc_id, cast(generated as integer) as generated, case when rn <= size - held then 'train'
    when rn <= size - cast(ceil(held * 0.5) as bigint) then 'validation' else 'test' end as split,
    case when u < 0.7 then 'train' when u < 0.85 then 'validation' else 'test' end as approximate
  from (select doc_id, generated, row_number() over (partition by generated order by {order("split")}) as rn,
      cast(('0x' || substring(md5('split|42|' || doc_id), 1, 8)) as bigint) / cast(4294967296 as double) as u,
      count(*) over (partition by generated) as size,
      cast(ceil(count(*) over (partition by generated) * cast(0.3 as double)) as bigint) as held from {{source}})"""


def _both_splits(rows):
    rows = sampling.split_rows(rows.select("doc_id", "generated"), "generated", "doc_id", classes=(0, 1))
    exact = rows.withColumnRenamed("split", "_exact")
    both = sampling.split_rows_by_hash(exact, "doc_id")
    return both.select("doc_id", "generated", F.col("_exact").alias("split"), F.col("split").alias("approximate"))


@query("sample_then_split", _THEN_SPLIT.format(source=_SAMPLED))
def _(spark, sf):
    return _both_splits(sampling.sample_rows(labelled(spark, sf), 150, "doc_id"))


@query("balance_then_split", _THEN_SPLIT.format(source=_EVEN))
def _(spark, sf):
    return _both_splits(sampling.balance_classes(labelled(spark, sf), "generated", "doc_id", (0, 1)))


@query("shuffle_key", "select doc_id, md5('42|' || doc_id) as shuffle_key from documents")
def _(spark, sf):
    return sampling.shuffle_key(table(spark, sf, "documents"), "doc_id").select("doc_id", "shuffle_key")


_SPLIT = f"""(select doc_id, generated, case when rn <= size - held then 'train'
    when rn <= size - cast(ceil(held * 0.5) as bigint) then 'validation' else 'test' end as split
  from (select doc_id, generated, row_number() over (partition by generated order by {order("split")}) as rn,
      count(*) over (partition by generated) as size,
      cast(ceil(count(*) over (partition by generated) * cast(0.3 as double)) as bigint) as held from {LABELLED}))"""


@query("stratified_split", f"select doc_id, cast(generated as integer) as generated, split from {_SPLIT}")
def _(spark, sf):
    rows = sampling.split_rows(labelled(spark, sf), "generated", "doc_id", classes=(0, 1))
    return rows.select("doc_id", "generated", "split")


@query("stratified_split_open", f"select doc_id, cast(generated as integer) as generated, split from {_SPLIT}")
def _(spark, sf):
    return sampling.split_rows(labelled(spark, sf), "generated", "doc_id").select("doc_id", "generated", "split")


@query(
    "split_sizes",
    f"""select split, cast(generated as integer) as generated, count(*) as n,
        round(count(*) / cast((select count(*) from documents) as double), 6) as share from {_SPLIT} group by split, generated""",
)
def _(spark, sf):
    rows = sampling.split_rows(labelled(spark, sf), "generated", "doc_id", classes=(0, 1))
    return rounded(sampling.split_sizes(rows, "generated"))


@query(
    "approximate_split",
    """select split, count(*) as n from (select case when u < 0.7 then 'train' when u < 0.85 then 'validation' else 'test' end as split
      from (select cast(('0x' || substring(md5('split|42|' || doc_id), 1, 8)) as bigint) / cast(4294967296 as double) as u from documents))
    group by split""",
)
def _(spark, sf):
    rows = sampling.split_rows_by_hash(table(spark, sf, "documents"), "doc_id")
    return rows.groupBy("split").agg(F.count(F.lit(1)).alias("n"))


# ---- profiles ----

_NULLS = """select '{c}' as "column", count(*) filter (where {c} is null) as n_null,
    round(count(*) filter (where {c} is null) / cast(count(*) as double), 6) as null_share
  from (select d.*, l.quality, l.toxic from documents d left join labels l on d.doc_id = l.doc_id)"""


@query(
    "null_profile",
    " union all ".join(_NULLS.format(c=c) for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")),
)
def _(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return rounded(profile.null_profile(docs))


@query("value_counts", "select source, count(*) as n from documents where source is not null group by source")
def _(spark, sf):
    return profile.value_counts(table(spark, sf, "documents"), "source")


@query(
    "class_share",
    f"""select cast(generated as integer) as generated, count(*) as n,
        round(count(*) * 100.0e0 / (select count(*) from documents), 6) as percent from {LABELLED} group by generated""",
)
def _(spark, sf):
    return rounded(profile.class_share(labelled(spark, sf), "generated"))


@query(
    "balance_ratio",
    """select count(*) as classes, min(n) as smallest, max(n) as largest,
        round(min(n) / cast(max(n) as double), 6) as ratio, min(n) / cast(max(n) as double) >= 0.5 as is_balanced
    from (select quality, count(*) as n from labels where quality is not null group by quality)""",
)
def _(spark, sf):
    return rounded(profile.balance_ratio(table(spark, sf, "labels"), "quality"))


_STATS = """count(*) as n, cast(min(v) as bigint) as min, cast(max(v) as bigint) as max, round(avg(v), 6) as mean,
    round(stddev_samp(v), 6) as std, round(quantile_cont(v, 0.5), 6) as median"""


@query("text_length_stats", f"select {_STATS} from (select cast(length(text) as double) as v from documents)")
def _(spark, sf):
    return rounded(profile.text_length_stats(table(spark, sf, "documents"), "text"))


@query(
    "text_length_describe",
    """select count(*) as n, cast(min(v) as bigint) as min, cast(max(v) as bigint) as max, round(avg(v), 6) as mean,
        round(stddev_samp(v), 6) as std, round(quantile_cont(v, 0.25), 6) as q1, round(quantile_cont(v, 0.5), 6) as median,
        round(quantile_cont(v, 0.75), 6) as q3 from (select cast(length(text) as double) as v from documents)""",
)
def _(spark, sf):
    lengths = X.compute_once(table(spark, sf, "documents").select("text"), length=X.char_count("text"))
    return rounded(summarize(lengths, "length", profile.QUARTILES))


@query(
    "text_length_stats_by_source",
    f"select source, {_STATS} from (select source, cast(length(text) as double) as v from documents) group by source",
)
def _(spark, sf):
    return rounded(profile.text_length_stats(table(spark, sf, "documents"), "text", ["source"]))


@query(
    "length_by_class",
    f"""select cast(generated as integer) as generated, measure, count(*) as n, round(avg(v), 6) as mean,
        round(quantile_cont(v, 0.5), 6) as median, round(stddev_samp(v), 6) as std
    from (select generated, 'chars' as measure, cast(length(text) as double) as v from {LABELLED}
      union all select generated, 'words', cast({sql_words('text')} as double) from {LABELLED})
    group by generated, measure""",
)
def _(spark, sf):
    return rounded(profile.length_by_class(labelled(spark, sf), "text", "generated"))


_HISTOGRAM = """select cast(generated as integer) as generated, cast(bin as integer) as bin,
    round(low + bin * width, 6) as lower, round(low + (bin + 1) * width, 6) as upper, count(*) as n
  from (select generated, low, width, least(floor((v - low) / width), 49) as bin
    from (select generated, {value} as v from {source}),
      (select min({value}) as low, (max({value}) - min({value})) / 50.0e0 as width from {source}))
  group by generated, bin, low, width"""


@query("length_histogram", _HISTOGRAM.format(value="cast(length(text) as double)", source=LABELLED))
def _(spark, sf):
    rows = X.compute_once(labelled(spark, sf).select("generated", "text"), chars=X.char_count("text"))
    return rounded(profile.length_histogram(rows, "chars", "generated"))


@query("word_histogram", _HISTOGRAM.format(value=f"cast({sql_words('text')} as double)", source=LABELLED))
def _(spark, sf):
    rows = X.compute_once(labelled(spark, sf).select("generated", "text"), words=X.word_count("text"))
    return rounded(profile.length_histogram(rows, "words", "generated"))


@query(
    "box_summary",
    f"""with t as (select generated, cast(length(text) as double) as v from {LABELLED}),
    q as (select generated, quantile_cont(v, 0.25) as q1, quantile_cont(v, 0.5) as median, quantile_cont(v, 0.75) as q3 from t group by generated),
    u as (select t.generated, v, q1, median, q3, v between q1 - (q3 - q1) * 1.5e0 and q3 + (q3 - q1) * 1.5e0 as inside from t join q on t.generated = q.generated)
    select cast(generated as integer) as generated, max(q1) as q1, max(median) as median, max(q3) as q3,
        min(v) filter (where inside) as whisker_low, max(v) filter (where inside) as whisker_high,
        count(*) filter (where not inside) as n_outliers from u group by generated""",
)
def _(spark, sf):
    rows = X.compute_once(labelled(spark, sf).select("generated", "text"), chars=X.char_count("text"))
    return profile.box_summary(rows, "chars", "generated")


def _profile_sql() -> str:
    types = {"doc_id": "bigint", "text": "string", "lang": "string", "source": "string", "n_chars": "bigint"}
    parts = ["select 'shape' as section, 'rows' as item, cast(count(*) as double) as value, cast(null as varchar) as detail from documents",
             "select 'shape', 'columns', 5.0e0, null"]
    for c, t in types.items():
        size = f"sum(strlen({c}))" if t == "string" else "count(*) * 8"
        parts += [
            f"select 'dtype', '{c}', null, '{t}'",
            f"select 'nulls', '{c}', cast(count(*) filter (where {c} is null) as double), null from documents",
            f"select 'bytes', '{c}', cast({size} as double), null from documents",
        ]
    parts += [
        "select 'text_length', 'mean', round(avg(length(text)), 6), null from documents",
        "select 'text_length', 'min', cast(min(length(text)) as double), null from documents",
        "select 'text_length', 'max', cast(max(length(text)) as double), null from documents",
        "select 'duplicates', 'rows', cast((select count(*) from documents) - count(*) as double), null from (select distinct * from documents)",
        "select 'labels', source, cast(count(*) as double), null from documents group by source",
    ]
    return " union all ".join(parts)


@query("dataset_profile", _profile_sql())
def _(spark, sf):
    return rounded(profile.dataset_profile(table(spark, sf, "documents"), "text", "source"))


# ---- vocabulary ----

_WORDS = f"(select generated, unnest(string_split_regex(lower(text), '[{SPACE}]+')) as word from {LABELLED})"


@query(
    "vocabulary_size",
    f"""select cast(generated as integer) as generated, count(distinct word) as n_words, count(*) as n_occurrences
    from {_WORDS} where word <> '' group by generated""",
)
def _(spark, sf):
    return vocabulary.vocabulary_size(labelled(spark, sf), "text", "generated")


@query(
    "vocabulary_overlap",
    f"""with w as (select distinct generated, word from {_WORDS} where word <> ''),
    h as (select word from w where generated = 0), a as (select word from w where generated = 1),
    n as (select (select count(*) from h) as human_words, (select count(*) from a) as ai_words,
        (select count(*) from (select word from h intersect select word from a)) as shared)
    select human_words, ai_words, shared, human_words - shared as human_only, ai_words - shared as ai_only,
        round(shared * 100.0e0 / (human_words + ai_words - shared), 6) as overlap_percent from n""",
)
def _(spark, sf):
    return rounded(vocabulary.vocabulary_overlap(labelled(spark, sf), "text", "generated"))


@query(
    "top_words",
    f"""select cast(generated as integer) as generated, cast(rank as integer) as rank, word, n from (
      select generated, word, count(*) as n, row_number() over (partition by generated order by count(*) desc, word) as rank
      from {_WORDS} where word <> '' group by generated, word) where rank <= 100""",
)
def _(spark, sf):
    return vocabulary.top_words(labelled(spark, sf), "text", "generated")


@query(
    "top_words_5000",
    f"""select cast(generated as integer) as generated, cast(rank as integer) as rank, word, n from (
      select generated, word, count(*) as n, row_number() over (partition by generated order by count(*) desc, word) as rank
      from {_WORDS} where word <> '' group by generated, word) where rank <= 5000""",
)
def _(spark, sf):
    return vocabulary.top_words(labelled(spark, sf), "text", "generated", k=5000)


@query(
    "top_bigrams",
    f"""select cast(generated as integer) as generated, cast(rank as integer) as rank, word, n from (
      select generated, word, count(*) as n, row_number() over (partition by generated order by count(*) desc, word) as rank
      from (select generated, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) as word from (
        select generated, list_filter(string_split_regex(lower(text), '[{SPACE}]+'), lambda x: x <> '') as w from {LABELLED}))
      group by generated, word) where rank <= 100""",
)
def _(spark, sf):
    return vocabulary.top_words(labelled(spark, sf), "text", "generated", size=2)


# ---- the corpus job ----


def corpus_sql(source: str, key: str, text: str, src: str, drop: str = "true", balance: bool = True) -> str:
    """Oracle of the corpus job; ``key`` lists the key columns."""
    keep = "rn <= (select min(size) from ranked)" if balance else "true"
    return f"""(with firsts as (select * from {source} where {text} is not null
        qualify row_number() over (partition by {text} order by {key}) = 1),
      cleaned as (select {key}, {sql_clean(text)} as text, generated, {src} from firsts),
      ranked as (select *, row_number() over (partition by generated order by {order("balance", key)}) as rn,
          count(*) over (partition by generated) as size from cleaned where length(text) between 50 and 5000 and {drop})
      select {key}, text, cast(generated as integer) as generated, {src} from ranked where {keep})"""


@query("build_corpus", corpus_sql(LABELLED, "doc_id", "text", "source"))
def _(spark, sf):
    return C.build_corpus(labelled(spark, sf), "doc_id")


@query("build_corpus_conversations", corpus_sql(ROLES, "conv_id, turn", "text", "role"))
def _(spark, sf):
    return C.build_corpus(roles(spark, sf), ["conv_id", "turn"], CorpusConfig(source="role"))


@query("build_corpus_unbalanced", corpus_sql(LABELLED, "doc_id", "text", "source", balance=False))
def _(spark, sf):
    return C.build_corpus(labelled(spark, sf), "doc_id", CorpusConfig(balance=False))


@query("corpus_job", corpus_sql(LABELLED, "doc_id", "text", "source"))
def _(spark, sf):
    # The smaller class has fewer rows here than the default gate asks for; ``corpus_job_events`` meets the defaults.
    return C.corpus_job(
        spark, sf, scratch_path(spark, "corpus"), "doc_id", quality=QualityConfig(min_class_rows=1),
        filename="documents.parquet", human=HUMAN, ai=AI,
    )


@query("build_corpus_staged", corpus_sql(LABELLED, "doc_id", "text", "source"))
def _(spark, sf):
    base = scratch_path(spark, "staged")

    def store(name, build):
        return cached_stage(spark, base, name, {}, build)

    return C.build_corpus_in_stages(labelled(spark, sf), "doc_id", CorpusConfig(), store)


_EVENT_TEXT = "'Event ' || event_id || ' of user ' || user_id || ': ' || event_type || ', as the log of this service keeps it.'"
_EVENTS = f"""(select event_id, {_EVENT_TEXT} as text, case when user_id % 2 = 0 then 'even' else 'odd' end as source,
    case when user_id % 2 = 0 then 0 else 1 end as generated from events)"""


@query("corpus_job_events", corpus_sql(_EVENTS, "event_id", "text", "source"))
def _(spark, sf):
    """The job with its default gates, over a table whose classes are large enough for them."""
    raw = table(spark, sf, "events").select(
        "event_id",
        F.expr(_EVENT_TEXT).alias("text"),
        F.when(F.col("user_id") % 2 == 0, "even").otherwise("odd").alias("source"),
    )
    folder = scratch_path(spark, "events-raw")
    raw.write.parquet(folder)
    return C.corpus_job(spark, folder, scratch_path(spark, "events-corpus"), "event_id", human=("even",), ai=("odd",))


@query(
    "corpus_class_counts",
    f"select generated, count(*) as n from {corpus_sql(ROLES, 'conv_id, turn', 'text', 'role')} group by generated",
)
def _(spark, sf):
    built = C.build_corpus(roles(spark, sf), ["conv_id", "turn"], CorpusConfig(source="role"))
    return profile.value_counts(built, "generated")


@query(
    "preprocess_funnel",
    f"""with firsts as (select * from {LABELLED} qualify row_number() over (partition by text order by doc_id) = 1),
    fit as (select generated from firsts where text is not null and length({sql_clean('text')}) between 50 and 5000),
    per as (select generated, count(*) as n from fit group by generated)
    select 0 as position, 'input' as step, count(*) as n from documents
    union all select 1, 'deduplicated', count(*) from firsts
    union all select 2, 'with_text', count(*) from firsts where text is not null
    union all select 3, 'with_label', count(*) from firsts where text is not null and generated is not null
    union all select 4, 'length_filtered', count(*) from fit
    union all select 5, 'balanced', cast(min(n) * count(*) as bigint) from per""",
)
def _(spark, sf):
    return C.corpus_funnel(labelled(spark, sf), "doc_id")


_META = corpus_sql(LABELLED, "doc_id", "text", "source")


@query(
    "corpus_metadata",
    f"""with c as {_META}
    select 'shape' as section, 'rows' as item, cast(count(*) as double) as value from c
    union all select 'shape', 'columns', 4.0e0
    union all select 'length', 'min', cast(min(length(text)) as double) from c
    union all select 'length', 'max', cast(max(length(text)) as double) from c
    union all select 'length', 'mean', round(avg(length(text)), 6) from c
    union all select 'class', cast(generated as varchar), cast(count(*) as double) from c group by generated
    union all select 'parameter', p, v from (values ('drop_duplicates', 1.0e0), ('min_length', 50.0e0), ('max_length', 5000.0e0),
        ('lowercase', 0.0e0), ('strip_whitespace', 1.0e0), ('drop_special', 0.0e0), ('balance', 1.0e0), ('seed', 42.0e0)) t(p, v)""",
)
def _(spark, sf):
    return rounded(C.corpus_metadata(C.build_corpus(labelled(spark, sf), "doc_id")))
