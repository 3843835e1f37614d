"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names, for every operator."""

import pytest

import corpus_pipeline
from cohortmill.llm import blob_ledger, chunks, decontam, disclosure, fertility, langid, line_chunks, mixing
from cohortmill.llm import periodic, phrases, probminhash, sharding
from cohortmill.sources.checkpoints import new_path

ITEMS = "item_id long, text string"


def _items(docs):
    return docs.sparkSession.createDataFrame([(1, "same row"), (None, "word word x"), (2, None), (3, " ")], ITEMS)


def _ledger(docs):
    spark = docs.sparkSession
    return blob_ledger.report(blob_ledger.BlobLedger(spark, new_path(spark, "ledger")).scan(docs))


PER_ROW = {
    "1": lambda docs: decontam.report(docs, _items(docs)),
    "3": _ledger,
    "4": disclosure.report,
    "4 text": disclosure.sanitised,
    "5": probminhash.classify,
    "6": mixing.mix,
    "7": lambda docs: fertility.judge(docs, ["doc_id"]),
    "8": line_chunks.deduplicated,
    "9": langid.predict,
    "10": lambda docs: sharding.assign(docs, 8),
    "11": periodic.report,
    "11 text": periodic.detect,
    "2 text": chunks.deduplicated,
}
OTHERS = {
    "1 text": lambda docs: decontam.decontaminate(docs, _items(docs)),
    "2": chunks.repeated,
    "5 text": probminhash.deduplicated,
    "6 text": mixing.mixed_documents,
    "9 text": langid.known_language,
    "13": lambda docs: phrases.top(phrases.collocations(docs, least=2)),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_one_row_each_for_odd_rows(clashing, name):
    rows = PER_ROW[name](clashing).collect()
    assert sorted(str(row.doc_id) for row in rows) == sorted(str(row.doc_id) for row in clashing.collect())


@pytest.mark.parametrize("name", OTHERS)
def test_odd_rows_do_not_fail(clashing, name):
    OTHERS[name](clashing).collect()


@pytest.mark.parametrize("name", [*PER_ROW, *OTHERS])
def test_empty_table(odd, name):
    empty = odd.filter("false")
    assert (PER_ROW | OTHERS)[name](empty).collect() == []


def test_stages_on_odd_and_empty_tables(odd, clashing, monkeypatch):
    items = _items(odd)
    monkeypatch.setattr(corpus_pipeline, "table", lambda spark, sf_dir, name: items)
    for docs in (clashing, odd.filter("false")):
        for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(odd.sparkSession, docs, "")
            out.collect()
            if number < 4:
                assert out.columns == odd.columns


def test_null_and_empty_results(odd):
    judged = {(row.doc_id, row.kept) for row in fertility.judge(odd, ["doc_id"]).collect()}
    assert (1, False) in judged and (2, False) in judged
    languages = {row.doc_id: row.lang_pred for row in langid.predict(odd).collect()}
    assert languages[1] == languages[2] == languages[3] == languages[7] == "und"
    classes = {row.doc_id: row for row in probminhash.classify(odd).collect()}
    assert classes[1].class_id == 1 and classes[5].class_id == 4 and not classes[5].kept
    assert sum(row.doc_id == 6 for row in probminhash.deduplicated(odd).collect()) == 1
    placed = {row.doc_id: row for row in sharding.assign(odd, 8).collect()}
    assert placed[1].size == 1 and placed[1].text_crc32 == 0
