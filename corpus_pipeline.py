"""A training corpus from ``documents`` in stages; every stage is written and the next one reads it.

Each stage works on all that its predecessor kept, and all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from textgauge.llm import language, minhash, packing, secrets, simhash
from textgauge.llm.mixing import mix, mixed
from textgauge.llm.queries import REST, SHARES
from textgauge.llm.tables import ship, stored


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without texts that are null, have no letters, or are in none of the languages that ``lang`` names."""
    return language.recognised(docs, language.train(docs))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of every group linked by similarities of 0.8 or more."""
    return simhash.first_of_groups(docs, minhash.near_copies(docs))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with ``[secret]`` in place of every secret; ``n_chars`` follows the text."""
    return secrets.masked(docs, secrets.train(docs))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mixture: files and rows follow it."""
    return mixed(docs, mix(docs, SHARES, REST))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of at most 2048 tokens, in the order of the mixture."""
    order = mix(docs, SHARES, REST).select("doc_id", "slot", "byte_start")
    return packing.packed_digest(*packing.pack(docs, order=order, period=sum(SHARES.values()) + REST))


def _with_package(stage):
    """The stage, with this code given to the tasks first."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ship(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [
    ("language ID", _with_package(language_stage)),
    ("SimHash near-dedup", _with_package(near_dedup_stage)),
    ("secret scans", _with_package(secrets_stage)),
    ("mixing sources", _with_package(mixing_stage)),
    ("packing", _with_package(packing_stage)),
]

# Fitted models, hashes and tokenizers are not SQL; the tests hold every stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.lower().replace(' ', '-')}")
    return docs
