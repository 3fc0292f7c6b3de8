"""From raw documents to packed training sequences.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is written as
Parquet before the next one reads it. All but the last return the columns of documents.
"""
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from parlance.llm.mixing import mixed
from parlance.llm.neardup import deduplicated
from parlance.llm.packing import pack
from parlance.llm.pii import rewritten
from parlance.llm.quality import apply_policy
from parlance.llm.store import stored

KEY = "pseudonym key of this corpus"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass policy v1 of the quality rules."""
    return apply_policy(docs, "v1")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five words, similarity 0.8."""
    return deduplicated(docs, width=5, percent=80)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by pseudonyms of the same format."""
    return rewritten(docs, KEY)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix of sources takes it."""
    return mixed(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their place in sequences of 2048 ids."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", quality_rules), ("near duplicates", near_duplicates), ("pii", pii),
    ("mixing", mixing), ("packing", packing),
]

# Hashing, Newton steps and tokenizers have no SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a directory."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
