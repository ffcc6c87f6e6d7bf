"""Named queries over the test tables, each with independent SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles to a fixed number of places: the order of summation shows in the last digits."""
    return df.select(*[F.round(F.col(c), places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# The documents carry sources src0..src19.  src1 also matches src10..src19, as a substring.
HUMAN = ("src1",)
AI = ("src2", "src3")
# In conversations the role stands for the source; the system role is unknown.
HUMAN_ROLES = ("user",)
AI_ROLES = ("assistant",)

# ---- pieces of oracle SQL ----
SPACE = (
    r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
    r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
GENERATED = """case when contains(lower(coalesce(source, 'none')), 'src1') then 0
    when contains(lower(coalesce(source, 'none')), 'src2') or contains(lower(coalesce(source, 'none')), 'src3') then 1
    else {unknown} end"""
LABELLED = f"(select *, {GENERATED.format(unknown=0)} as generated from documents)"
ROLES = """(select *, case when contains(lower(role), 'user') then 0
    when contains(lower(role), 'assistant') then 1 else 0 end as generated from conversations)"""


def sql_light(text: str) -> str:
    return f"trim(regexp_replace({text}, '[{SPACE}]+', ' ', 'g'))"


def sql_clean(text: str) -> str:
    out = f"regexp_replace({text}, '[{SPACE}]+', ' ', 'g')"
    for mark in (r"\.", "!", r"\?"):
        keep = mark.replace("\\", "")
        out = f"regexp_replace({out}, '{mark}{{2,}}', '{keep}', 'g')"
    return f"coalesce(trim({out}), '')"


def sql_words(text: str) -> str:
    return f"cast(len(regexp_extract_all({text}, '[^{SPACE}]+')) as bigint)"


SCORED = """(select d.doc_id, l.quality as label,
    least(1.0e0, cast(d.n_chars as double) / cast(5000 as double)) as probability,
    case when cast(d.n_chars as double) / cast(5000 as double) > 0.5e0 then 1 else 0 end as prediction
  from documents d join labels l on d.doc_id = l.doc_id)"""


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    from textgauge.functions.labels import from_source

    return table(spark, folder, "documents").withColumn("generated", from_source("source", HUMAN, AI))


def roles(spark: SparkSession, folder: str) -> DataFrame:
    from textgauge.functions.labels import from_source

    return table(spark, folder, "conversations").withColumn("generated", from_source("role", HUMAN_ROLES, AI_ROLES))


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Deterministic stand-in for a scored test set: skewed classes and ties at 1.0."""
    share = F.col("n_chars").cast("double") / F.lit(5000.0)
    return (
        table(spark, folder, "documents")
        .select("doc_id", "n_chars")
        .join(table(spark, folder, "labels").select("doc_id", "quality"), "doc_id")
        .select(
            "doc_id",
            F.col("quality").alias("label"),
            F.least(F.lit(1.0), share).alias("probability"),
            F.when(share > 0.5, 1).otherwise(0).alias("prediction"),
        )
    )
