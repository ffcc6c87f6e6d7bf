"""Table readers.  Every path may be local, ``hdfs://`` or ``s3a://``."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CSV_OPTIONS = {"header": True, "quote": '"', "escape": '"'}


def read_folder(spark: SparkSession, folder: str) -> DataFrame:
    """All Parquet files of a folder."""
    return spark.read.option("pathGlobFilter", "*.parquet").parquet(folder)


def locate_corpus(spark: SparkSession, folder: str, filename: str | None = None) -> str:
    """The path of the named Parquet table of a folder; if it is missing, the folder's."""
    if filename:
        path = f"{folder.rstrip('/')}/{filename}"
        try:
            spark.read.format("binaryFile").load(path)  # resolves the path, reads nothing
            return path
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
    return folder


def read_corpus(spark: SparkSession, folder: str, filename: str | None = None) -> DataFrame:
    """The named Parquet table of a folder; if it is missing, all Parquet files there."""
    path = locate_corpus(spark, folder, filename)
    return read_folder(spark, path) if path == folder else spark.read.parquet(path)


def read_export(spark: SparkSession, folder: str, split: str = "train", format: str = "parquet") -> DataFrame:
    """One split of an exported dataset, kept as a subfolder of Parquet or JSON-lines files."""
    return spark.read.format(format).load(f"{folder.rstrip('/')}/{split}")


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, multi_line: bool = True
) -> DataFrame:
    """CSV with header; quoted fields may hold line breaks and doubled quotes.

    Without a schema the header names the columns and all are strings.  Files whose fields hold no line breaks
    can be split among tasks: pass ``multi_line=False``.
    """
    reader = spark.read.options(**CSV_OPTIONS, multiLine=multi_line, emptyValue="")
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def read_table(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None, format: str | None = None, multi_line: bool = True
) -> DataFrame:
    """Reader by suffix: CSV or Parquet.

    With a schema, ``read_csv_ranges`` reads large CSV files with line breaks in fields by many tasks.
    """
    kind = format or path.rstrip("/").rsplit(".", 1)[-1].lower()
    if kind == "csv":
        return read_csv(spark, path, schema, multi_line)
    if kind in ("parquet", "pq"):
        return spark.read.parquet(path)
    raise ValueError(f"unsupported table format: {kind}")


def require_columns(df: DataFrame, *columns: str) -> DataFrame:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"missing columns: {', '.join(absent)}")
    return df
