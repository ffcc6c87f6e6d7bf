"""Queries of sources and sinks, training, scoring and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from textgauge.catalog.registry import ROLES, SPACE, query, roles, rounded, sql_clean, sql_light, table
from textgauge.config import ScoreConfig, TrainConfig
from textgauge.operators import dedup, scoring
from textgauge.operators.gates import gate_rows
from textgauge.operators.metrics import classification_metrics
from textgauge.operators.model import with_tokens
from textgauge.plans.scoring import score_file
from textgauge.plans.training import load_model, scored_table, train_and_score
from textgauge.functions import text as X
from textgauge.session import scratch_path
from textgauge.sources import inventory, readers, stage_cache, writers
from textgauge.streaming import scoring as streams


@query("read_corpus", "select doc_id, lang, source, n_chars, md5(text) as digest from documents")
def _(spark, sf):
    docs = readers.read_corpus(spark, sf, "documents.parquet")
    return docs.select("doc_id", "lang", "source", "n_chars", F.md5("text").alias("digest"))


@query("csv_roundtrip", "select doc_id, text, lang, source, n_chars from documents")
def _(spark, sf):
    docs = table(spark, sf, "documents")
    path = writers.write_csv(docs, scratch_path(spark, "csv"))
    return readers.read_csv(spark, path, docs.schema)


@query(
    "partitioned_roundtrip",
    """select doc_id, md5(text) as digest, case when u < 0.7 then 'train' when u < 0.85 then 'validation' else 'test' end as split
      from (select *, cast(('0x' || substring(md5('split|42|' || doc_id), 1, 8)) as bigint) / cast(4294967296 as double) as u from documents)""",
)
def _(spark, sf):
    from textgauge.operators.sampling import split_rows_by_hash

    path = writers.write_split(split_rows_by_hash(table(spark, sf, "documents"), "doc_id"), scratch_path(spark, "split"))
    return readers.read_folder(spark, path).select("doc_id", F.md5("text").alias("digest"), "split")


@query("dataset_inventory")
def _(spark, sf):
    return inventory.list_files(spark, sf, "*.parquet")


def _snapshots(spark, sf):
    """Before: all but very short documents.  After: distinct texts, cleaned."""
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    before = docs.where(F.length("text") >= 50)
    after = dedup.drop_duplicate_texts(docs, "text", "doc_id").withColumn("text", X.clean("text"))
    return before, after


_DIFF = f"""(with o as (select doc_id, text, source from documents where length(text) >= 50),
    n as (select doc_id, {sql_clean('text')} as text, source from documents
      qualify row_number() over (partition by documents.text order by doc_id) = 1)
  select coalesce(o.doc_id, n.doc_id) as doc_id, case when o.doc_id is null then 'added' when n.doc_id is null then 'removed'
    when o.text = n.text and o.source = n.source then 'unchanged' else 'changed' end as status
  from o full outer join n on o.doc_id = n.doc_id)"""


@query("snapshot_diff", f"select doc_id, status from {_DIFF}")
def _(spark, sf):
    return inventory.snapshot_diff(*_snapshots(spark, sf), "doc_id")


@query(
    "snapshot_sync",
    f"""select count(*) filter (where status in ('added', 'changed')) as uploaded, count(*) filter (where status = 'unchanged') as skipped,
        count(*) filter (where status = 'removed') as deleted from {_DIFF}""",
)
def _(spark, sf):
    return inventory.apply_diff(inventory.snapshot_diff(*_snapshots(spark, sf), "doc_id"), delete_extra=True)


@query(
    "snapshot_diff_events",
    "select event_id, case when user_id % 3 = 0 then 'changed' else 'unchanged' end as status from events",
)
def _(spark, sf):
    before = table(spark, sf, "events")
    later = F.expr("ts + interval 3 microseconds")
    after = before.withColumn("ts", F.when(F.col("user_id") % 3 == 0, later).otherwise(F.col("ts")))
    return inventory.snapshot_diff(before, after, "event_id")


@query("stage_cache", f"select conv_id, turn, cast(generated as integer) as generated from {ROLES}")
def _(spark, sf):
    base, params = scratch_path(spark, "stages"), {"input": sf, "human": "user", "ai": "assistant"}

    def build():
        return roles(spark, sf).select("conv_id", "turn", "generated")

    stage_cache.cached_stage(spark, base, "labels", params, build)
    return stage_cache.cached_stage(spark, base, "labels", params, build)  # read, not built again


# ---- scoring with a plug-in predictor ----


def by_length():
    """A stand-in predictor: the longer the text, the likelier it is machine text."""

    def load():
        def predict(texts):
            share = [min(1.0, len(t) / 5000.0) for t in texts]
            return [[1.0 - p, p] for p in share]

        return predict

    return load


def picky():
    """Like ``by_length`` but refuses texts of fewer than 200 characters."""

    def load():
        def predict(texts):
            if any(len(t) < 200 for t in texts):
                raise ValueError("text too short")
            return [[1.0 - min(1.0, len(t) / 5000.0), min(1.0, len(t) / 5000.0)] for t in texts]

        return predict

    return load


_SHOWN = [
    "doc_id", "prediction", "prediction_label", "confidence", "original_text_length", "processed_text_length",
    "processing_error", "prob_human", "prob_ai",
]


def _scored_sql(bad: str = "false", extra: str = "") -> str:
    def good(value: str) -> str:
        return f"case when not ({bad}) then {value} end"

    return f"""select doc_id{extra}, {good("case when p > 1 - p then 1 else 0 end")} as prediction,
        {good("case when p > 1 - p then 'ai' else 'human' end")} as prediction_label,
        round({good("greatest(p, 1 - p)")}, 6) as confidence, cast(length(text) as bigint) as original_text_length,
        cast(length(t) as bigint) as processed_text_length, {bad} as processing_error,
        round({good("1 - p")}, 6) as prob_human, round({good("p")}, 6) as prob_ai
    from (select *, least(1.0e0, length(t) / 5000.0e0) as p from (select *, {sql_light('text')} as t from documents))"""


@query("score_texts", _scored_sql())
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return rounded(scoring.score_texts(docs, by_length()).select(*_SHOWN))


@query("score_file", _scored_sql())
def _(spark, sf):
    target = scratch_path(spark, "scored") + ".parquet"
    score_file(spark, f"{sf}/documents.parquet", by_length(), target)
    return rounded(readers.read_table(spark, target).select(*_SHOWN))


_SHORT = "length(t) < 200"


@query(
    "score_errors",
    f"""select s.*, case when processing_error then 'text too short' end as error_message,
        case when processing_error then case when length(text) > 100 then substring(text, 1, 100) || '...' else text end end as error_text
    from ({_scored_sql(_SHORT)}) s join documents d on s.doc_id = d.doc_id""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return rounded(scoring.score_texts(docs, picky()).select(*_SHOWN, "error_message", "error_text"))


@query(
    "scoring_summary",
    f"""select count(*) as n_total, count(*) filter (where not processing_error) as n_successful,
        count(*) filter (where processing_error) as n_errors, round(avg(confidence), 6) as mean_confidence
    from ({_scored_sql(_SHORT)})""",
)
def _(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return rounded(scoring.scoring_summary(scoring.score_texts(docs, picky())).drop("mean_time"))


# ---- the classifier ----

_fits: dict[tuple, str] = {}


def _fitted(spark, sf) -> str:
    """Folder of the model and the scored rows; one fit per session and tables serves all queries below."""
    at = (spark.sparkContext.applicationId, sf)
    if at not in _fits:
        folder = scratch_path(spark, "training")
        keys = ["conv_id", "turn"]
        fitted, rows = train_and_score(roles(spark, sf), "text", "generated", keys, TrainConfig(), folder=folder)
        fitted.model.write().save(f"{folder}/model")
        rows.write.parquet(f"{folder}/scores")
        _fits[at] = folder
    return _fits[at]


def _trained(spark, sf):
    return spark.read.parquet(f"{_fitted(spark, sf)}/scores")


_PARTS = """(select conv_id, turn, text, cast(generated as integer) as generated, case when rn <= size - held then 'train'
    when rn <= size - cast(ceil(held * 0.5) as bigint) then 'validation' else 'test' end as split
  from (select conv_id, turn, text, generated, size, cast(ceil(size * cast(0.3 as double)) as bigint) as held, row_number() over (
        partition by generated order by md5('split|42|' || conv_id || '|' || turn), conv_id, turn) as rn
      from (select *, count(*) over (partition by generated) as size from {roles})))"""
_PARTS = _PARTS.format(roles=ROLES)


@query("train_and_score", f"select conv_id, turn, split, generated, true as consistent from {_PARTS}")
def _(spark, sf):
    # The scores themselves depend on the fit; what follows from them is compared.
    p = F.col("prob_ai")
    consistent = (
        p.between(0, 1)
        & (F.abs(F.col("prob_human") + p - 1) < 1e-9)
        & (F.abs(F.col("confidence") - F.greatest(p, 1 - p)) < 1e-9)
        & (F.col("prediction") == (p > F.col("prob_human")).cast("int"))
        & (F.col("prediction_label") == F.when(F.col("prediction") == 1, "ai").otherwise("human"))
        & ~F.col("processing_error")
    )
    return _trained(spark, sf).select("conv_id", "turn", "split", "generated", consistent.alias("consistent"))


@query(
    "evaluate_test_split",
    f"select generated as label, count(*) as support, true as in_range from {_PARTS} where split = 'test' group by generated",
)
def _(spark, sf):
    test = scored_table(_trained(spark, sf).where("split = 'test'"), "generated")
    row = classification_metrics(test).select(F.least("accuracy", "f1").alias("low"), F.greatest("accuracy", "f1").alias("high"))
    inside = row.select(((F.col("low") >= 0) & (F.col("high") <= 1)).alias("ok")).scalar()
    return test.groupBy("label").agg(F.count(F.lit(1)).alias("support")).withColumn("in_range", inside)


@query(
    "gate_trained_model",
    """select * from (values ('thresholds', 'accuracy', 0.85e0), ('thresholds', 'f1', 0.85e0), ('thresholds', 'precision', 0.8e0),
        ('thresholds', 'recall', 0.8e0), ('thresholds', 'roc_auc', 0.85e0), ('calibration', 'brier_score', 0.25e0),
        ('calibration', 'expected_calibration_error', 0.1e0)) t(gate, item, bound)""",
)
def _(spark, sf):
    rows = gate_rows(scored_table(_trained(spark, sf).where("split = 'test'"), "generated"))
    return rows.where("gate in ('thresholds', 'calibration') and passed is not null").select("gate", "item", "bound")


_WITH_MODEL = f"""select doc_id, cast(length(text) as bigint) as original_text_length,
    cast(length({sql_light('text')}) as bigint) as processed_text_length, false as processing_error, true as consistent from documents"""


def _follows(scored):
    p = F.col("prob_ai")
    consistent = (F.abs(F.col("confidence") - F.greatest(p, "prob_human")) < 1e-9) & (
        F.col("prediction") == (p > F.col("prob_human")).cast("int")
    )
    shown = ["doc_id", "original_text_length", "processed_text_length", "processing_error"]
    return scored.select(*shown, consistent.alias("consistent"))


@query("score_file_with_model", _WITH_MODEL)
def _(spark, sf):
    target = scratch_path(spark, "scored") + ".parquet"
    score_file(spark, f"{sf}/documents.parquet", load_model(_fitted(spark, sf)), target)
    return _follows(readers.read_table(spark, target))


@query("stream_score_with_model", _WITH_MODEL)
def _(spark, sf):
    texts = streams.read_table_stream(spark, sf, "documents.parquet", table(spark, sf, "documents").schema)
    target = scratch_path(spark, "stream-model")
    rows = streams.score_stream(texts, load_model(_fitted(spark, sf)))
    streams.write_stream(rows, target, f"{target}-checkpoint", once=True).awaitTermination()
    return _follows(readers.read_folder(spark, target))


@query(
    "tokenize_truncate",
    f"""select doc_id, len(t) as n_tokens, md5(array_to_string(t, ' ')) as digest from (select doc_id, list_slice(
        regexp_extract_all(lower({sql_light('text')}), '[\\p{{L}}\\p{{N}}_]+|[^\\p{{L}}\\p{{N}}_{SPACE}]'), 1, 512) as t from documents)""",
)
def _(spark, sf):
    rows = with_tokens(table(spark, sf, "documents"), "text", 512)
    return rows.select("doc_id", F.size("tokens").cast("long").alias("n_tokens"), F.md5(F.array_join("tokens", " ")).alias("digest"))


@query("read_export", "select doc_id, md5(text) as digest, lang, source, n_chars from documents")
def _(spark, sf):
    folder = scratch_path(spark, "export")
    writers.write_parquet(table(spark, sf, "documents"), f"{folder}/train")
    return readers.read_export(spark, folder).select("doc_id", F.md5("text").alias("digest"), "lang", "source", "n_chars")


# ---- streams ----


@query(
    "stream_score",
    _scored_sql(extra=f", case when not regexp_matches(text, '[^{SPACE}]') then 'empty' when len(regexp_extract_all(text, '[^{SPACE}]+')) < 3 then 'too short' else 'ok' end as input_status"),
)
def _(spark, sf):
    schema = table(spark, sf, "documents").schema
    texts = streams.read_table_stream(spark, sf, "documents.parquet", schema)
    target = scratch_path(spark, "stream")
    rows = streams.score_stream(texts, by_length(), ScoreConfig())
    streams.write_stream(rows, target, f"{target}-checkpoint", once=True).awaitTermination()
    return rounded(readers.read_folder(spark, target).select("input_status", *_SHOWN))


_HOURS = """select date_trunc('hour', ts) as window_start, date_trunc('hour', ts) + interval 1 hour as window_end,
    count(*) as n_total, count(*) filter (where event_type = 'error') as n_errors,
    round(avg(value) filter (where event_type <> 'error'), 6) as mean_time from events group by 1, 2"""


@query("scoring_stats_hourly", _HOURS)
def _(spark, sf):
    return rounded(streams.scoring_stats(table(spark, sf, "events"), F.col("event_type") == "error"))


@query(
    "scoring_stats_stream",
    f"select * from ({_HOURS}) where window_end <= (select max(ts) - interval 10 minutes from events)",
)
def _(spark, sf):
    schema = table(spark, sf, "events").schema
    log = streams.read_table_stream(spark, sf, "events.parquet", schema)
    target = scratch_path(spark, "stats")
    stats = streams.scoring_stats(log, F.col("event_type") == "error")
    streams.write_stream(stats, target, f"{target}-checkpoint", once=True).awaitTermination()
    return rounded(readers.read_folder(spark, target))

