"""Totals since the start of a stream: right after every batch, and nothing counted twice after a restart."""

import os

from pyspark.sql import functions as F

from textgauge.streaming import scoring as streams
from textgauge.streaming import totals

SCHEMA = "k int, kind string, value double, failed boolean"


def rows(low, high):
    return [(i, "abc"[i % 3], float(i), i % 5 == 0) for i in range(low, high)]


def plain(found, by_kind=True):
    out = {}
    for _, kind, value, failed in found:
        n = out.setdefault(kind if by_kind else None, [0, 0, 0.0])
        n[0] += 1
        n[1] += failed
        n[2] += 0.0 if failed else value
    return {k: (n, bad, n - bad, t, t / (n - bad) if n > bad else None) for k, (n, bad, t) in out.items()}


def run(spark, base, by):
    log = streams.read_stream(spark, f"{base}/in", spark.createDataFrame([], SCHEMA).schema)
    counts = totals.running_totals(log, F.col("failed"), by)
    totals.write_totals(counts, f"{base}/out", f"{base}/cp", once=True).awaitTermination()
    return totals.totals_history(spark, f"{base}/out")


def shown(df, by):
    return {r[by[0]] if by else None: (r.n_total, r.n_errors, r.n_successful, r.total_time, r.mean_time) for r in df.collect()}


def test_totals_after_every_batch_and_after_a_restart(spark, tmp_path):
    for by in ([], ["kind"]):
        base, seen = str(tmp_path / f"by{len(by)}"), []
        for batch, (low, high) in enumerate([(0, 30), (30, 31), (31, 70)]):
            spark.createDataFrame(rows(low, high), SCHEMA).coalesce(2).write.mode("append").parquet(f"{base}/in")
            seen += rows(low, high)
            history = run(spark, base, by)
            after = shown(history.where(F.col("batch") == batch), by)
            want = plain(seen, bool(by))
            assert after == {k: want[k] for k in after} and set(after) == ({r[1] for r in rows(low, high)} if by else {None})
            assert shown(totals.current_totals(history, by), by) == want
        # The process died before the last batch was marked as done: it runs again.
        os.remove(f"{base}/cp/commits/2")
        for name in os.listdir(f"{base}/cp/commits"):
            if name.startswith(".2."):
                os.remove(f"{base}/cp/commits/{name}")
        assert shown(totals.current_totals(run(spark, base, by), by), by) == plain(seen, bool(by))
        assert shown(totals.running_totals(spark.read.parquet(f"{base}/in"), F.col("failed"), by), by) == plain(seen, bool(by))


def test_unknown_outcomes_are_errors(spark):
    log = spark.createDataFrame([(1, "a", 1.0, None), (2, "a", None, False)], SCHEMA)
    row = totals.running_totals(log, F.col("failed")).first()
    assert (row.n_total, row.n_errors, row.n_successful, row.total_time, row.mean_time) == (2, 1, 1, 0.0, 0.0)
