"""One query per operator over its whole table, with the parameters meant for production."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill.llm import (
    blob_ledger,
    chunks,
    decontam,
    disclosure,
    fertility,
    langid,
    line_chunks,
    mixing,
    periodic,
    phrases,
    probminhash,
    sharding,
    wrappers,
)
from cohortmill.llm.common import table
from cohortmill.sources.checkpoints import new_path


def op1_automaton_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents inside windows of ten words of test items."""
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_gear_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place of every chunk of text that documents hold twice or more."""
    return chunks.repeated(table(spark, sf_dir, "documents"))


def op3_blob_ledger_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents, by a ledger that has seen them with an earlier version of one rule: the second scan looks for
    that rule's new version alone, and the findings of the others come from the ledger."""
    ledger = blob_ledger.BlobLedger(spark, new_path(spark, "ledger"))
    docs = table(spark, sf_dir, "documents")
    ledger.scan(docs, blob_ledger.EARLIER_RULES)
    return blob_ledger.report(ledger.scan(docs))


def op4_disclosure_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in all documents, and the terms that disclose it."""
    return disclosure.report(table(spark, sf_dir, "documents"))


def op5_probminhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of near-duplicate documents."""
    found = probminhash.classify(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "same_text_id", "class_id", "kept")


def op6_fair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources mixed to weights 1, 2, 3 in turn, up to three times each."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op7_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word and token measures of every document, and which pass the rules and bands."""
    return fertility.judge(table(spark, sf_dir, "documents"), ["doc_id"])


def op8_line_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the chunks of lines that another place keeps."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_chunks.deduplicated(docs)


def op9_cross_parsing_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from three quarters of them."""
    return langid.predict(table(spark, sf_dir, "documents"))


def op10_jump_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in eight shards by their ids."""
    placed = sharding.assign(table(spark, sf_dir, "documents"), 8)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op11_minimizer_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in all documents, one of ten with a planted tail."""
    return periodic.report(table(spark, sf_dir, "documents"))


def op12_wrapper_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages by the wrappers of their hosts."""
    return wrappers.extract(table(spark, sf_dir, "pages"))


def op13_automaton_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first phrases of each language by the weight of their lowest cut."""
    return phrases.top(phrases.collocations(table(spark, sf_dir, "documents")))


QUERIES = {
    "op1_automaton_decontamination": op1_automaton_decontamination,
    "op2_gear_chunk_dedup": op2_gear_chunk_dedup,
    "op3_blob_ledger_secrets": op3_blob_ledger_secrets,
    "op4_disclosure_personal_data": op4_disclosure_personal_data,
    "op5_probminhash_dedup": op5_probminhash_dedup,
    "op6_fair_mixing": op6_fair_mixing,
    "op7_tokeniser_fertility": op7_tokeniser_fertility,
    "op8_line_chunk_dedup": op8_line_chunk_dedup,
    "op9_cross_parsing_language": op9_cross_parsing_language,
    "op10_jump_sharding": op10_jump_sharding,
    "op11_minimizer_runs": op11_minimizer_runs,
    "op12_wrapper_extraction": op12_wrapper_extraction,
    "op13_automaton_phrases": op13_automaton_phrases,
}
