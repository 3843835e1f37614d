"""Registered queries: against SQL where there is some, and the pipeline against its operators' promises."""

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from checks.compare import differences, duck
from cohortmill.llm import decontam
from cohortmill.llm.oracles import ORACLES
from cohortmill.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
# No SQL for hashes drawn in numpy, trained models, tokenisers, iterations and searches of all periods; see the operators' tests.
WITHOUT_SQL = {
    "op2_gear_chunk_dedup",
    "op4_disclosure_personal_data",
    "op5_probminhash_dedup",
    "op7_tokeniser_fertility",
    "op9_cross_parsing_language",
    "op11_minimizer_runs",
}


def test_registered():
    assert set(QUERIES) - set(ORACLES) == WITHOUT_SQL
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert differences(entry.queries()[name](spark, SF), duck(SF), entry.oracle_sql()[name]) == []


def test_pipeline(spark):
    rows = corpus_pipeline.run(spark, SF)
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    assert decontam.report(rows, benchmark).filter("contaminated").count() == 0
    assert {row.shard for row in rows.collect()} <= set(range(8))
    repeats = rows.groupBy("doc_id", "shard").count()
    assert repeats.filter("count > 3").count() == 0
    assert repeats.select("doc_id").distinct().count() == repeats.count()
