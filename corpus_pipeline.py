"""A training corpus in five stages over documents: rules, exact dedup, near-dedup, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept; all but the last
return the columns of documents. run() writes each stage's result as Parquet to the shared folder and reads it again.
Nulls, empty texts and repeated rows are handled as the operators say: null and empty texts fail the
rules; the dedup stages keep one row of each group, one without an id only when none of the group has one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from meterloom.llm import bpe, exact_dedup, mixing, near_copies, quality_rules
from meterloom.llm.common import stored


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_passing(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(docs, stored(exact_dedup.exact_dedup(docs), "pipeline-exact"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 or more of their five-word shingles, one stays."""
    return near_copies.keep_one(docs, shingle=5, similarity=0.8)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as many times as the mix takes them."""
    return mixing.repeat_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and the digests of ids and decoded text."""
    return bpe.bpe_digests(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", rules),
    ("exact dedup", exact),
    ("SimHash near-dedup", near),
    ("mixing", mix),
    ("BPE", encode),
]

#: SQL can't express XXH64 fingerprints, the dual's rates and BPE.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
