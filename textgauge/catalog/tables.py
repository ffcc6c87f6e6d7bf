"""Queries of stored tables: synchronisation by digests, large CSV files, totals of a stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from textgauge.catalog.registry import SPACE, query, rounded, sql_clean, table
from textgauge.catalog.serving import _DIFF, _snapshots
from textgauge.operators.vocabulary import word_counts
from textgauge.session import scratch_path
from textgauge.sources import csv_ranges, stage_cache, sync, writers
from textgauge.streaming import scoring as streams
from textgauge.streaming import totals

_NEW = f"""(select doc_id, {sql_clean('text')} as text, source from documents qualify row_number() over (partition by documents.text order by doc_id) = 1)"""


def _synchronised(spark, sf, delete_extra):
    before, after = _snapshots(spark, sf)
    base = scratch_path(spark, "sync")
    source, target = (sync.write_ranged(rows, f"{base}/{name}", "doc_id", 64) for name, rows in (("source", after), ("target", before)))
    return target, sync.synchronise(spark, source, target, "doc_id", delete_extra)


@query("synchronised_table", f"select doc_id, md5(text) as digest, source from {_NEW}")
def _(spark, sf):
    target, _ = _synchronised(spark, sf, True)
    return sync.read_ranged(spark, target).select("doc_id", F.md5("text").alias("digest"), "source")


@query(
    "synchronise_report",
    f"""select count(*) filter (where status in ('added', 'changed')) as uploaded, count(*) filter (where status = 'unchanged') as skipped,
        0::bigint as deleted from {_DIFF}""",
)
def _(spark, sf):
    report = _synchronised(spark, sf, False)[1]
    return spark.range(1).select(*[F.lit(getattr(report, c)).cast("bigint").alias(c) for c in ("uploaded", "skipped", "deleted")])


@query("csv_by_ranges", "select doc_id, text, lang, source, n_chars from documents")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    path = writers.write_csv(docs, scratch_path(spark, "csv-ranges"))
    return csv_ranges.read_csv_ranges(spark, path, docs.schema)


_PARTS = 4


@query(
    "scoring_totals_stream",
    f"""with counted as (select event_id % {_PARTS} as batch, event_type, count(*) as n, count(*) filter (where value is null or value < 10) as bad, coalesce(sum(value) filter (where value >= 10), 0) as t
        from events group by all),
      cells as (select b.batch, k.event_type, coalesce(n, 0) as n, coalesce(bad, 0) as bad, coalesce(t, 0) as t, n is not null as seen
        from (select unnest(range({_PARTS})) as batch) b cross join (select distinct event_type from events) k left join counted c on c.batch = b.batch and c.event_type = k.event_type),
      running as (select batch, event_type, seen, sum(n) over w as n_total, sum(bad) over w as n_errors, sum(t) over w as total_time from cells
        window w as (partition by event_type order by batch))
      select batch, event_type, n_total::bigint as n_total, n_errors::bigint as n_errors, (n_total - n_errors)::bigint as n_successful, round(total_time, 4) as total_time,
        round(case when n_total > n_errors then total_time / (n_total - n_errors) end, 4) as mean_time from running where seen""",
)
def _(spark, sf):
    events = table(spark, sf, "events")
    base = scratch_path(spark, "totals")
    for part in range(_PARTS):
        # New files appear, and the stream is started anew from its checkpoint.
        events.where(F.col("event_id") % _PARTS == part).write.mode("append").parquet(f"{base}/log")
        log = streams.read_stream(spark, f"{base}/log", events.schema)
        failed = F.col("value").isNull() | (F.col("value") < 10)
        counts = totals.running_totals(log, failed, ["event_type"])
        totals.write_totals(counts, f"{base}/totals", f"{base}/checkpoint", once=True).awaitTermination()
    return rounded(totals.totals_history(spark, f"{base}/totals"), 4)


@query(
    "incremental_word_counts",
    f"""with words as (select unnest(list_filter(regexp_split_to_array(lower(coalesce(text, 'None')), '[{SPACE}]+'), lambda x: x <> '')) as word from documents)
      select word, count(*) as n, 4::bigint as files, 1::bigint as files_read_last from words group by word""",
)
def _(spark, sf):
    """Counts per file: the last of four files is added later and measured alone."""
    docs, base = table(spark, sf, "documents"), scratch_path(spark, "partials")
    stage, read = stage_cache.Stage(f"{base}/out", "words", {"size": 1}), []

    def measure(rows):
        read.append(rows.select("file_id").distinct().count())
        return word_counts(rows, "text", "file_id")

    for parts in ((0, 1, 2), (3,)):
        for part in parts:
            mine = F.pmod(F.coalesce("doc_id", F.lit(0)), F.lit(4)) == part
            docs.where(mine).write.parquet(f"{base}/in/part-{part}.parquet")
        found = stage_cache.per_file(spark, f"{base}/in", stage, measure)
    files = found.select("file_id").distinct().count()
    counts = found.groupBy("word").agg(F.sum("n").alias("n"))
    return counts.select("word", "n", F.lit(files).cast("bigint").alias("files"), F.lit(read[-1]).cast("bigint").alias("files_read_last"))
