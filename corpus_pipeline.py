"""Documents to training shards: languages, near copies, test items, mixture, shards.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written to the shared folder and
read again as the next stage's documents. All but the last return the columns of documents.

Null or empty text is in no known language, so the first stage lets it go. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.session import with_folder
from cohortmill.llm import decontam, langid, mixing, probminhash, sharding
from cohortmill.llm.common import documents_only, table
from cohortmill.sources.checkpoints import written

SHARDS = 8


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the labelled languages."""
    return langid.known_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return probminhash.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of test items."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of their sources takes them."""
    return mixing.mixed_documents(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents and their shard."""
    docs = documents_only(docs)
    return docs.withColumn("shard", sharding.shard_of(sharding.stable_key(F.col("doc_id")), SHARDS))


STAGES = [
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("sharding", shards),
]

# Cross-parsing and ProbMinHash are not for SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder of tables."""
    with_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir))
    return docs
