"""Registered queries of the subpackage over the test tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from textgauge.catalog.registry import table
from textgauge.llm import embeddings, filters, fim, hilbert, language, mixing, packing, scoring, secrets, simhash, toxicity, wavelet, weighted
from textgauge.llm.tables import ship

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Every source of the tables has its own stream; the rest is for null and unknown names.
SHARES = {"src0": 10, **{f"src{i}": 6 for i in range(1, 10)}, **{f"src{i}": 3 for i in range(10, 20)}}
REST = 6


def query(name: str, sql: str | None = None):
    def add(fn):
        def with_package(spark, sf):
            ship(spark)
            return fn(spark, sf)

        QUERIES[name] = with_package
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def _mix_sql(block: int = 1 << 16) -> str:
    """The schedule slot by slot in a recursive query, then running bytes over whole streams."""
    names = [*SHARES, mixing.REST]
    shares = [*SHARES.values(), REST]
    period = sum(shares)
    listed = ", ".join(f"'{s}'" for s in SHARES)
    return f"""with recursive share as (
        select unnest([{", ".join(f"'{n}'" for n in names)}]) as stream, unnest({shares}) as q,
            unnest(range(1, {len(names) + 1})) as i),
    sent(slot, pick, counts) as (
        select -1::bigint, 0::bigint, list_transform({shares}, lambda x: 0::bigint)
        union all
        select slot + 1, best, list_transform(counts, lambda c, i: case when i = best then c + 1 else c end)
        from (select slot, counts, list_min(list_transform(list_filter(range(1, {len(names) + 1}),
                lambda i: counts[i] < ({shares})[i] and counts[i] * {period} // ({shares})[i] <= slot + 1),
                lambda i: ((counts[i] + 1) * {period} + ({shares})[i] - 1) // ({shares})[i] * 1000 + i)) % 1000 as best
            from sent where slot + 1 < {period})),
    timetable as (
        select stream, q, slot, row_number() over (partition by stream order by slot) - 1 as nth
        from sent join share on pick = i where pick > 0),
    rows as (
        select doc_id, source, case when source in ({listed}) then source else '{mixing.REST}' end as stream,
            coalesce(strlen(text), 0) as size, md5('42|' || doc_id) as o from documents),
    placed as (
        select *, cast(coalesce(sum(size) over (partition by stream order by o, doc_id
            rows between unbounded preceding and 1 preceding), 0) as bigint) as byte_start from rows),
    blocks as (select *, byte_start // {block} as block from placed)
    select doc_id, source, b.stream, size, byte_start, block, block * {period} // t.q as release,
        ((block + 1) * {period} + t.q - 1) // t.q as deadline, block // t.q * {period} + slot as slot
    from blocks b join timetable t on b.stream = t.stream and block % t.q = nth"""


@query("op1_pfair_mix", _mix_sql())
def _(spark, sf):
    return mixing.mix(table(spark, sf, "documents"), SHARES, REST)


@query("op8_hilbert_shards")
def _(spark, sf):
    return hilbert.shard_by_curve(table(spark, sf, "documents"))


@query("op10_nnls_packing")
def _(spark, sf):
    return packing.packed_digest(*packing.pack(table(spark, sf, "documents")))


@query("op2_simhash_groups")
def _(spark, sf):
    return simhash.near_duplicates(table(spark, sf, "documents"))


@query("op9_wavelet_tokens")
def _(spark, sf):
    return wavelet.token_digest(spark, table(spark, sf, "documents"))


@query("op4_ppm_languages")
def _(spark, sf):
    return language.held_out_languages(table(spark, sf, "documents"))


@query("op5_weighted_fingerprints")
def _(spark, sf):
    return weighted.compare_edited(table(spark, sf, "documents"))


@query("op6_markov_secrets")
def _(spark, sf):
    return secrets.secret_digest(table(spark, sf, "documents"))


@query("op7_cnn_toxicity")
def _(spark, sf):
    return toxicity.held_out_toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op3_pq_neighbours")
def _(spark, sf):
    return embeddings.near_duplicates(table(spark, sf, "embeddings"))


@query("op11_filter_audit", filters.AUDIT_SQL)
def _(spark, sf):
    return filters.audit(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op12_interpolated_scores")
def _(spark, sf):
    return scoring.score_documents(table(spark, sf, "documents"))


@query("op13_fill_in_middle", fim.DIGEST_SQL)
def _(spark, sf):
    return fim.fim_digest(table(spark, sf, "documents"))
