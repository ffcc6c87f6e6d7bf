"""Row-wise queries: labels, cleaning, text measures, filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from textgauge.catalog.registry import (
    AI, GENERATED, HUMAN, LABELLED, SCORED, SPACE, labelled, query, roles, rounded, scored, sql_clean, sql_light,
    sql_words, table,
)
from textgauge.functions import labels as L
from textgauge.functions import text as X
from textgauge.operators import processing as P
from textgauge.operators import profile
from textgauge.operators.labelling import label_violations, normalize_labels
from textgauge.operators.scoring import confidence_bands, input_status
from textgauge.plans.corpus import unknown_sources

WORD = r"\p{L}\p{N}_"


@query("label_from_source", f"select doc_id, cast({GENERATED.format(unknown=0)} as integer) as generated from documents")
def _(spark, sf):
    return labelled(spark, sf).select("doc_id", "generated")


@query("label_keep_unknown", f"select doc_id, cast({GENERATED.format(unknown=-1)} as integer) as generated from documents")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    return docs.select("doc_id", L.from_source("source", HUMAN, AI, unknown=L.UNKNOWN).alias("generated"))


@query(
    "unknown_sources",
    f"select source, count(*) as n from (select source, {GENERATED.format(unknown=-1)} as g from documents) where g = -1 group by source",
)
def _(spark, sf):
    return unknown_sources(table(spark, sf, "documents"), "source", HUMAN, AI)


@query(
    "label_mapping",
    """with f as (select role as first_role from conversations order by conv_id, turn limit 1)
    select conv_id, turn, cast(case
        when contains(lower(role), 'human') or contains(lower(role), 'real') or contains(lower(role), 'original')
          or contains(lower(role), '0') then 0
        when contains(lower(role), 'ai') or contains(lower(role), 'generated') or contains(lower(role), 'artificial')
          or contains(lower(role), 'gpt') or contains(lower(role), '1') then 1
        when role = (select first_role from f) then 0 else 1 end as integer) as label
    from conversations""",
)
def _(spark, sf):
    talks = table(spark, sf, "conversations").withColumn("label", F.col("role"))
    return normalize_labels(talks, "label", ["conv_id", "turn"]).select("conv_id", "turn", "label")


@query(
    "label_strict",
    "select conv_id, turn, cast(case role when 'user' then 0 when 'assistant' then 1 when 'system' then 0 end as integer) as label from conversations",
)
def _(spark, sf):
    codes = {"user": 0, "assistant": 1, "system": 0}
    return table(spark, sf, "conversations").select("conv_id", "turn", L.strict(F.col("role"), codes).alias("label"))


@query(
    "label_violations",
    "select role as label, count(*) as n from conversations where role is null or role not in ('user', 'assistant') group by role",
)
def _(spark, sf):
    return label_violations(table(spark, sf, "conversations"), "role", {"user": 0, "assistant": 1})


@query(
    "parse_score_label",
    """select conv_id, turn, cast(case when upper(l) in ('LABEL_0', '0', 'HUMAN') then 0
        when upper(l) in ('LABEL_1', '1', 'AI') then 1
        when regexp_extract(l, '[0-9]+') <> '' then cast(regexp_extract(l, '[0-9]+') as integer) else 0 end as integer) as code
    from (select conv_id, turn, case when role = 'system' then role else 'label_' || turn end as l from conversations)""",
)
def _(spark, sf):
    name = F.when(F.col("role") == "system", F.col("role")).otherwise(F.concat(F.lit("label_"), F.col("turn").cast("string")))
    return table(spark, sf, "conversations").select("conv_id", "turn", L.from_score_label(name).alias("code"))


@query("clean_text", f"select doc_id, {sql_clean('text')} as text from documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.clean("text").alias("text"))


_KEEP = f"regexp_replace(regexp_replace(text, '[{SPACE}]+', ' ', 'g'), '[^{WORD}{SPACE}.,!?;:\"''\\-]', '', 'g')"


_SHORTENED = f"regexp_replace(regexp_replace(regexp_replace({_KEEP}, '\\.{{2,}}', '.', 'g'), '!{{2,}}', '!', 'g'), '\\?{{2,}}', '?', 'g')"


@query("clean_text_strict", f"select doc_id, trim({_SHORTENED}) as text from documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.clean("text", drop_special=True).alias("text"))


@query("clean_text_light", f"select doc_id, {sql_light('text')} as text from documents")
def _(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.clean_light("text").alias("text"))


@query(
    "text_stats",
    f"select doc_id, cast(length(t) as bigint) as text_length, {sql_words('t')} as word_count from (select doc_id, {sql_clean('text')} as t from documents)",
)
def _(spark, sf):
    return P.process_texts(table(spark, sf, "documents")).select("doc_id", "text_length", "word_count")


@query(
    "punctuation_counts",
    r"""select doc_id, cast(len(regexp_extract_all(text, ',')) as bigint) as commas,
        cast(len(regexp_extract_all(text, '\.')) as bigint) as periods,
        cast(len(regexp_extract_all(text, '!')) as bigint) as exclamations,
        cast(len(regexp_extract_all(text, '\?')) as bigint) as questions from documents""",
)
def _(spark, sf):
    marks = {"commas": ",", "periods": ".", "exclamations": "!", "questions": "?"}
    return table(spark, sf, "documents").select("doc_id", *[X.count_of("text", m).alias(n) for n, m in marks.items()])


_SENTENCES = f"""(select *, cast(len(regexp_extract_all(body, '[.!?]+([{SPACE}]|\\z)'))
    + case when body <> '' and not regexp_matches(body, '[.!?]\\z') then 1 else 0 end as bigint) as sentences
  from (select *, regexp_replace(text, '^[{SPACE}]+|[{SPACE}]+\\z', '', 'g') as body from {LABELLED}))"""


@query(
    "sentence_stats",
    f"""select doc_id, sentences, round(case when sentences > 0 then cast({sql_words('text')} as double) / sentences
        else 0 end, 6) as words_per_sentence from {_SENTENCES}""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents")
    return rounded(
        docs.select(
            "doc_id", X.sentence_count("text").alias("sentences"), X.words_per_sentence("text").alias("words_per_sentence")
        )
    )


@query(
    "linguistic_by_class",
    f"""select cast(generated as integer) as generated, round(avg(cast(sentences as double)), 6) as sentences,
        round(avg(case when sentences > 0 then cast({sql_words('text')} as double) / sentences else 0 end), 6) as words_per_sentence,
        round(avg(length(text) - length(replace(text, ',', ''))), 6) as commas,
        round(avg(length(text) - length(replace(text, '.', ''))), 6) as periods
    from {_SENTENCES} group by generated""",
)
def _(spark, sf):
    return rounded(profile.linguistic_by_class(labelled(spark, sf), "text", "generated"))


@query(
    "token_filter",
    f"""select doc_id, n_tokens from (select doc_id,
        cast(len(regexp_extract_all(text, '[{WORD}]+|[^{WORD}{SPACE}]')) as bigint) as n_tokens from documents)
    where n_tokens <= 500""",
)
def _(spark, sf):
    return P.filter_tokens(table(spark, sf, "documents"), "text").select("doc_id", "n_tokens")


@query(
    "length_filter",
    f"""select doc_id, text_length from (select doc_id, cast(length({sql_clean('text')}) as bigint) as text_length from documents)
    where text_length between 50 and 5000""",
)
def _(spark, sf):
    return P.filter_length(P.process_texts(table(spark, sf, "documents"))).select("doc_id", "text_length")


@query(
    "short_texts",
    """select count(*) filter (where length(text) < 10) as n_very_short,
        count(*) filter (where length(text) < 50) as n_dropped,
        count(*) filter (where length(text) >= 50) as n_kept from documents""",
)
def _(spark, sf):
    return profile.short_texts(table(spark, sf, "documents"), "text")


@query(
    "drop_nulls",
    """select d.doc_id, l.quality from documents d left join labels l on d.doc_id = l.doc_id
    where d.text is not null and l.quality is not null""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return P.drop_missing(docs, "text", "quality").select("doc_id", "quality")


@query(
    "finalize",
    f"select doc_id, {sql_clean('text')} as text, cast(generated as integer) as generated, source from {LABELLED}",
)
def _(spark, sf):
    return P.finalize(P.process_texts(labelled(spark, sf)), ["doc_id"])


@query(
    "preview",
    """select doc_id, case when length(text) > 100 then substring(text, 1, 100) || '...' else text end as text, source
    from documents order by doc_id limit 3""",
)
def _(spark, sf):
    return profile.preview(table(spark, sf, "documents").select("doc_id", "text", "source"), "text", "doc_id")


@query(
    "confidence_bands",
    f"""select doc_id, case when c > 0.9 then 'High' when c > 0.7 then 'Medium' else 'Low' end as coarse,
        case when c > 0.9 then 'Very High' when c > 0.8 then 'High' when c > 0.7 then 'Medium' when c > 0.6 then 'Low'
        else 'Very Low' end as fine
    from (select doc_id, greatest(probability, 1.0e0 - probability) as c from {SCORED})""",
)
def _(spark, sf):
    coarse, fine = confidence_bands(F.greatest("probability", 1.0 - F.col("probability")))
    return scored(spark, sf).select("doc_id", coarse.alias("coarse"), fine.alias("fine"))


@query(
    "input_gate",
    f"""select conv_id, turn, case when text is null or not regexp_matches(text, '[^{SPACE}]') then 'empty'
        when {sql_words('text')} < 3 then 'too short' else 'ok' end as status from conversations""",
)
def _(spark, sf):
    return roles(spark, sf).select("conv_id", "turn", input_status("text").alias("status"))
