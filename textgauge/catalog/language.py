"""Queries of what is learnt about the language of a corpus: sentence borders and phrases."""

from __future__ import annotations

from pyspark.sql import functions as F

from textgauge.catalog.registry import LABELLED, SPACE, labelled, query, rounded, sql_light, table
from textgauge.operators import sentences, subwords
from textgauge.operators.vocabulary import phrases


def _llr(k: str, a: str, b: str, n: str) -> str:
    """Log-likelihood ratio of b coming after a, as in the operators."""

    def part(x: str, m: str, p: str) -> str:
        return f"(({x}) * ln(greatest({p}, 1e-10)) + (({m}) - ({x})) * ln(greatest(1 - ({p}), 1e-10)))"

    p, inside = f"({b}) / ({n})::double", f"({k}) / ({a})::double"
    outside = f"(case when ({n}) > ({a}) then (({b}) - ({k})) / (({n}) - ({a}))::double else 0 end)"
    rest, others = f"({b}) - ({k})", f"({n}) - ({a})"
    return f"2 * ({part(k, a, inside)} + {part(rest, others, outside)} - {part(k, a, p)} - {part(rest, others, p)})"


_CLOSING = sentences.CLOSING.replace("'", "''")
_BORDERS = f"""with split as (select doc_id, list_filter(string_split({sql_light('text')}, ' '), lambda x: x <> '') as w from documents),
  placed as (select doc_id, unnest(range(1, len(w) + 1)) as i, w from split),
  raw as (select doc_id, i, rtrim(w[i], '{_CLOSING}') as bare, rtrim(w[i + 1], '{_CLOSING}') as nxt from placed),
  pairs as (select doc_id, case when right(bare, 1) = '.' then '.' when right(bare, 1) in ('!', '?') then '!' else '' end as mark,
      lower(regexp_replace(bare, '\\.\\z', '')) as word, lower(regexp_replace(nxt, '\\.\\z', '')) as following,
      coalesce(upper(ltrim(nxt, '"''“‘«([{{')[1]) = ltrim(nxt, '"''“‘«([{{')[1] and lower(ltrim(nxt, '"''“‘«([{{')[1]) <> ltrim(nxt, '"''“‘«([{{')[1], false) as upper from raw),
  types as (select word, count(*) filter (mark = '.') as with_period, count(*) filter (mark <> '.') as without from pairs where word <> '' group by word),
  share as (select sum(with_period) / sum(with_period + without)::double as p from types),
  measured as (select *, length(word) - length(replace(word, '.', '')) as dots from types, share where with_period > 0 and regexp_matches(word, '\\p{{L}}')),
  judged as (select word, with_period, without, 2 * (with_period * ln(0.99e0) + without * ln(0.01e0)
      - with_period * ln(greatest(p, 1e-10)) - without * ln(greatest(1 - p, 1e-10)))
      * exp(-(length(word) - dots)) * (dots + 1) * pow((length(word) - dots)::double, -without) as score from measured),
  short as (select * from judged where score >= 0.3),
  counted as (select p.word, mark, following, s.word is not null as abbreviated, count(*) as n from pairs p left join short s on p.word = s.word where p.word <> '' group by all),
  marked as (select *, mark = '!' or (mark = '.' and not abbreviated) as ends from counted),
  overall as (select sum(n)::bigint as n, coalesce(sum(n) filter (ends), 0)::bigint as e from marked),
  totals as (select word, sum(n)::bigint as n_all from marked group by word),
  after as (select following as word, coalesce(sum(n) filter (ends), 0)::bigint as n_start from marked where following is not null group by following),
  starters as (select * from (select word, n_start, n_all, n, e, {_llr('n_start', 'e', 'n_all', 'n')} as score from totals join after using (word), overall where n_start > 0)
    where regexp_full_match(word, '\\p{{L}}+') and n_start / e::double > n_all / n::double and score >= 30),
  around as (select word, following, sum(n)::bigint as n_pair from marked where mark = '.' and following is not null
      and (abbreviated or regexp_full_match(word, '[0-9]+')) group by word, following),
  firsts as (select word, sum(n)::bigint as n_first from marked where mark = '.' group by word),
  collocations as (select * from (select a.word, a.following, n_pair, n_first, t.n_all, o.n, {_llr('n_pair', 'n_first', 't.n_all', 'o.n')} as score
      from around a join firsts f on a.word = f.word join totals t on t.word = a.following, overall o where n_pair > 1)
    where n_pair / n_first::double > n_all / n::double and score >= 7.88)"""


def _borders(spark, sf):
    docs = table(spark, sf, "documents")
    return docs, sentences.fit_borders(docs, "text")


@query("sentence_abbreviations", f"{_BORDERS} select word, with_period, without, round(score, 6) as score from short")
def _(spark, sf):
    return rounded(_borders(spark, sf)[1].abbreviations)


@query("sentence_starters", f"{_BORDERS} select word, n_start, round(score, 4) as score from starters")
def _(spark, sf):
    return rounded(_borders(spark, sf)[1].starters, 4)


@query("sentence_collocations", f"{_BORDERS} select word, following, n_pair, round(score, 4) as score from collocations")
def _(spark, sf):
    return rounded(_borders(spark, sf)[1].collocations, 4)


@query(
    "trained_sentences",
    f"""{_BORDERS}, cut as (select p.doc_id, p.following is null or p.mark = '!' or (p.mark = '.' and c.word is null
          and (s.word is null or (p.upper and t.word is not null))) as here
        from pairs p left join short s on s.word = p.word left join starters t on t.word = p.following
        left join collocations c on c.word = p.word and c.following = p.following)
      select d.doc_id, count(*) filter (here) as n_sentences from documents d left join cut on cut.doc_id = d.doc_id group by d.doc_id""",
)
def _(spark, sf):
    docs, borders = _borders(spark, sf)
    return sentences.trained_sentence_counts(docs, "text", "doc_id", borders)


@query(
    "phrases",
    f"""with split as (select generated, list_filter(regexp_split_to_array(lower(coalesce(text, 'None')), '[{SPACE}]+'), lambda x: x <> '') as w from {LABELLED}),
      placed as (select generated, unnest(range(1, len(w) + 1)) as i, w from split),
      words as (select generated, w[i] as word, count(*) as n from placed group by all),
      total as (select generated, sum(n)::bigint as n_total from words group by generated),
      pairs as (select generated, w[i] as a, w[i + 1] as b, count(*) as k from placed where i < len(w) group by all),
      scored as (select p.generated, a, b, k, x.n as na, y.n as nb, n_total from pairs p join words x on x.generated = p.generated and x.word = a
        join words y on y.generated = p.generated and y.word = b join total t on t.generated = p.generated),
      found as (select *, {_llr('k', 'na', 'nb', 'n_total')} as score from scored where k / na::double > nb / n_total::double),
      kept as (select * from found where score > 30),
      taken as (select generated, word, sum(k)::bigint as gone from (select generated, a as word, k from kept union all select generated, b, k from kept) group by all)
      select generated, word, n - coalesce(gone, 0) as n, null::double as score from words left join taken using (generated, word) where n > coalesce(gone, 0)
      union all select generated, a || ' ' || b, k, round(score, 4) from kept""",
)
def _(spark, sf):
    return rounded(phrases(labelled(spark, sf), "text", "generated"), 4)


def _model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@query("subword_counts")
def _(spark, sf):
    return subwords.subword_counts(table(spark, sf, "documents"), "text", "doc_id", _model())


@query("subword_filter")
def _(spark, sf):
    return subwords.filter_subwords(table(spark, sf, "documents"), "text", "doc_id", _model()).select("doc_id", "n_subwords")


@query(
    "word_pieces_total",
    f"""with words as (select unnest(list_filter(string_split({sql_light('text')}, ' '), lambda x: x <> '')) as word from documents)
      select count(distinct word) as n_words, count(*) as n_occurrences, true as all_have_pieces from words""",
)
def _(spark, sf):
    pieces = subwords.word_pieces(table(spark, sf, "documents"), "text", _model())
    return pieces.agg(F.count(F.lit(1)).alias("n_words"), F.sum("n").alias("n_occurrences"), F.bool_and(F.col("pieces") > 0).alias("all_have_pieces"))
