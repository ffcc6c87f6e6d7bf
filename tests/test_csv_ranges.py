"""CSV by byte ranges against the reader that takes a file as one task."""

import random

import pytest

from textgauge.sources import csv_ranges, readers, writers

SCHEMA = "k int, text string, note string, x double"


def both(spark, path, ends="\n"):
    want = readers.read_csv(spark, path, SCHEMA).collect()
    got = csv_ranges.read_csv_ranges(spark, path, SCHEMA).collect()
    # The other reader turns the file's own line ends inside fields into line feeds.
    assert sorted(str(r).replace(repr(ends)[1:-1], "\\n") for r in got) == sorted(map(str, want))
    return len(got)


@pytest.fixture
def small_ranges(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before[0])
    spark.conf.set("spark.sql.files.openCostInBytes", before[1])


def rows(n=300, seed=1):
    rng = random.Random(seed)
    bits = ["a", "b c", "\n", "\n\n", '"', '""', ",", "\r\n", "é漢", " ", "'", "x" * 50]
    out = [(i, "".join(rng.choices(bits, k=rng.randrange(12))), rng.choice([None, "", "n", '"\n"']), rng.choice([None, 1.5])) for i in range(n)]
    return [*out, (n, "long\n" * 900, None, 0.0), (n + 1, '"', '"', None)]


def test_records_across_ranges(spark, tmp_path, small_ranges):
    path = writers.write_csv(spark.createDataFrame(rows(), SCHEMA).coalesce(1), str(tmp_path / "one.csv"))
    assert csv_ranges._lines(spark, path).rdd.getNumPartitions() > 15
    assert both(spark, path) == 302


def test_several_files(spark, tmp_path, small_ranges):
    path = writers.write_csv(spark.createDataFrame(rows(200, 2), SCHEMA).repartition(5), str(tmp_path / "many.csv"))
    assert both(spark, path) == 202


def test_other_line_ends_and_no_last_one(spark, tmp_path, small_ranges):
    (tmp_path / "a.csv").write_bytes(b'k,text,note,x\r\n1,"two\r\nlines",n,1.5\r\n\r\n2,plain,,\r\n3,"""q""",z,2')
    assert both(spark, str(tmp_path / "a.csv"), "\r\n") == 3
    (tmp_path / "b.csv").write_bytes(b"k,text,note,x\n")
    assert both(spark, str(tmp_path / "b.csv")) == 0


def test_a_record_longer_than_many_ranges(spark, tmp_path, small_ranges):
    (tmp_path / "c.csv").write_text('k,text,note,x\n1,"' + "line with, commas\n" * 600 + '",n,1\n2,b,c,3\n3,"x\ny",,\n')
    assert both(spark, str(tmp_path / "c.csv")) == 3


def test_read_table_takes_single_lines(spark, tmp_path):
    path = writers.write_csv(spark.createDataFrame([(1, "a", "b", 1.0)], SCHEMA), str(tmp_path / "t.csv"))
    assert readers.read_table(spark, path, SCHEMA, multi_line=False).collect() == readers.read_table(spark, path, SCHEMA).collect()
