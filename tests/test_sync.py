"""Synchronisation by digest trees: equal tables afterwards, unchanged ranges unread, interrupted jobs harmless."""

import pytest
from pyspark.sql import functions as F

from textgauge.sources import sync
from textgauge.sources.sync import RANGE, SyncReport


def rows_of(df):
    return sorted(map(str, df.drop(RANGE).collect()))


def table(spark, n=400):
    return spark.range(n).selectExpr("id as k", "concat('text ', id) as text", "id * 0.5 as x", "if(id % 9 = 0, null, array(id)) as l")


def test_a_new_target_receives_all(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    sync.write_ranged(table(spark), source, "k", 16)
    report = sync.synchronise(spark, source, target, "k")
    assert (report.uploaded, report.skipped, report.deleted, report.ranges_read) == (400, 0, 0, 16)
    assert rows_of(sync.read_ranged(spark, target)) == rows_of(table(spark))
    again = sync.synchronise(spark, source, target, "k")
    assert again == SyncReport(0, 400, 0, 16, 0)


@pytest.mark.parametrize("delete_extra", [False, True])
def test_only_ranges_that_differ_are_read_and_written(spark, tmp_path, delete_extra):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    before = table(spark)
    sync.write_ranged(before, target, "k", 64)
    after = before.where("k <> 17").withColumn("text", F.when(F.col("k") == 5, "new").otherwise(F.col("text")))
    after = after.union(spark.range(1000, 1001).selectExpr("id", "'added'", "0.0", "null"))
    sync.write_ranged(after, source, "k", 64)
    touched = {r[RANGE] for r in sync._ranged(spark.createDataFrame([(5,), (17,), (1000,)], "k bigint"), "k", 64).collect()}
    old = {r.range: r.generation for r in sync.read_tree(spark, target).collect()}
    report = sync.synchronise(spark, source, target, "k", delete_extra)
    assert (report.uploaded, report.deleted, report.ranges_read) == (2, int(delete_extra), len(touched))
    assert report.skipped == 398
    want = after if delete_extra else after.union(before.where("k = 17"))
    got = sync.read_ranged(spark, target)
    assert rows_of(got) == rows_of(want)
    # Ranges that are equal stay in the files of the first generation, and reading some ranges opens only their files.
    tree = {r.range: r.generation for r in sync.read_tree(spark, target).collect()}
    assert {r for r in tree if tree[r] != old.get(r)} <= touched and len(touched) < 10
    files = sync.read_ranged(spark, target, sorted(touched)).inputFiles()
    assert files and all(int(f.split(f"{RANGE}=")[1].split("/")[0]) in touched for f in files)
    plan = sync.read_ranged(spark, source, sorted(touched))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_range" in plan or "PartitionFilters: [_range" in plan
    assert sync.synchronise(spark, source, target, "k", delete_extra).uploaded == 0


def test_an_interrupted_write_changes_nothing(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    sync.write_ranged(table(spark), target, "k", 8)
    sync.write_ranged(table(spark, 410), source, "k", 8)
    # Rows of the next generation without their tree: the job died in between.
    sync._write_rows(sync._ranged(table(spark, 3), "k", 8), target, 1)
    assert rows_of(sync.read_ranged(spark, target)) == rows_of(table(spark))
    assert sync.synchronise(spark, source, target, "k").uploaded == 10
    assert rows_of(sync.read_ranged(spark, target)) == rows_of(table(spark, 410))


def test_all_rows_deleted_and_an_empty_source(spark, tmp_path):
    source, target = str(tmp_path / "s"), str(tmp_path / "t")
    sync.write_ranged(table(spark, 0), source, "k", 8)
    sync.write_ranged(table(spark, 20), target, "k", 8)
    assert sync.synchronise(spark, source, target, "k").deleted == 0
    assert sync.read_ranged(spark, target).count() == 20
    assert sync.synchronise(spark, source, target, "k", True).deleted == 20
    assert sync.read_ranged(spark, target).count() == 0 and sync.read_ranged(spark, target).columns[0] == "k"
    with pytest.raises(ValueError):
        sync.read_ranged(spark, str(tmp_path / "none"))


def test_digests_do_not_depend_on_the_order_and_see_repeated_rows(spark):
    rows = sync._ranged(table(spark, 50), "k", 4)
    a = {r.range: r for r in sync.digest_tree(rows).collect()}
    b = {r.range: r for r in sync.digest_tree(rows.orderBy(F.desc("k")).repartition(7)).collect()}
    assert a == b
    twice = {r.range: r for r in sync.digest_tree(rows.union(rows).union(rows)).collect()}
    assert all(twice[r] != a[r] for r in a)
