"""Table and summary writers.  Output is a folder of part files, written by all tasks at once."""

from __future__ import annotations

from pyspark.sql import DataFrame

from textgauge.sources.readers import CSV_OPTIONS


def write_parquet(df: DataFrame, path: str, by: str | None = None, mode: str = "overwrite") -> str:
    writer = df.write.mode(mode)
    (writer.partitionBy(by) if by else writer).parquet(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """CSV that ``read_csv`` reads back unchanged: quoted, inner white space and line breaks kept."""
    df.write.mode(mode).options(
        **CSV_OPTIONS, quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, emptyValue=""
    ).csv(path)
    return path


def write_table(df: DataFrame, path: str, format: str | None = None) -> str:
    """Writer by the path's suffix, or in the given format where it has none; anything but Parquet becomes CSV."""
    name = path.rstrip("/").rpartition("/")[2]
    if format in ("parquet", "pq") and "." not in name:
        return write_parquet(df, path)
    if path.rstrip("/").lower().endswith((".parquet", ".pq")):
        return write_parquet(df, path)
    return write_csv(df, path)


def write_split(df: DataFrame, path: str) -> str:
    """One folder per split, so that reading a split prunes the others."""
    return write_parquet(df, path, by="split")


def write_summary(summary: DataFrame, path: str) -> str:
    """JSON lines of an aggregated (hence small) table, in one file."""
    # Aggregated and stored rows first: the one task only writes.
    summary.repartition(1).write.mode("overwrite").json(path)
    return path
