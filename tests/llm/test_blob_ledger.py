"""Versions of paths, and scans of what a ledger has not seen."""

from cohortmill.llm import blob_ledger
from cohortmill.sources.checkpoints import new_path

KEY = "AKIA" + "A1B2C3D4E5F6G7H8"
LOW = "0123456789abcdef01234567"  # 24 characters: found by the current rule alone


def _spans(rows):
    return {(row.path, row.version): [(s.kind, s.start, s.end) for s in row.spans] for row in rows.collect()}


def test_findings_of_an_old_version_are_kept(spark, make):
    ledger = blob_ledger.BlobLedger(spark, new_path(spark, "ledger"))
    ledger.scan(make([(1, f"x {KEY}"), (2, "nothing"), (3, f"x {KEY}"), (None, None)]))
    now = ledger.scan(make([(1, "taken out"), (2, "nothing"), (4, f"y {LOW}"), (4, f"y {LOW}")]))
    assert sorted((row.doc_id, len(row.spans)) for row in now.collect()) == [(1, 0), (2, 0), (4, 1), (4, 1)]
    assert _spans(ledger.history()) == {
        ("1", 1): [("access", 2, 22)],
        ("1", 2): [],
        ("2", 1): [],
        ("3", 1): [("access", 2, 22)],
        ("4", 2): [("hex", 2, 26)],
        (None, 1): [],
    }
    again = blob_ledger.BlobLedger(spark, ledger.path)
    again.scan(make([(1, f"x {KEY}")]), version=9)
    assert {key for key in _spans(again.history())} == {key for key in _spans(ledger.history())}  # nothing new at path 1


def test_a_raised_rule_version_is_all_that_is_scanned(spark, make, monkeypatch):
    ledger = blob_ledger.BlobLedger(spark, new_path(spark, "ledger"))
    docs = make([(1, f"x {KEY} {LOW}"), (2, f"password = {'b' * 40}")])
    early = {row.doc_id: [s.kind for s in row.spans] for row in ledger.scan(docs, blob_ledger.EARLIER_RULES).collect()}
    assert early == {1: ["access"], 2: ["assign", "hex"]}
    asked = []
    real = blob_ledger.spans.found
    monkeypatch.setattr(
        blob_ledger.spans, "found", lambda df, *args: asked.extend(row.missing for row in df.select("missing").collect()) or real(df, *args)
    )
    late = {row.doc_id: [(s.kind, s.start, s.end) for s in row.spans] for row in ledger.scan(docs).collect()}
    assert asked == [["hex@1"]] * 2
    assert late[1] == [("access", 2, 22), ("hex", 23, 47)]
    assert [kind for kind, _, _ in late[2]] == ["assign", "hex"]
    assert ledger.unseen(docs.select("doc_id", blob_ledger.blob_of(docs["text"]).alias("blob")), blob_ledger.RULES).count() == 0
