"""Periodic runs against a search of every lag and every stretch."""

import hashlib
import zlib

import numpy as np
import pytest

from cohortmill.llm import periodic

SF = "/root/testdata/sf0.001"


def brute_runs(words):
    """(start, length, period) of all runs: every lag's stretches, kept if no smaller lag holds on the stretch."""
    n, found = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(24, 3 * q):
                part = words[i : i + length]
                if all(any(part[x] != part[x + p] for x in range(length - p)) for p in range(1, q)):
                    found.append((i, length, q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_row(doc_id, text):
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")]
    h = None if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h is not None and h % 10 == 0 and words:
        g, n = h // 10, len(words)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2])) if found else None
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    shown = (best[0], best[1], best[2], 1000 * best[1] // best[2]) if best else (None,) * 4
    return (doc_id, len(found), *shown, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest())


@pytest.mark.parametrize("seed", range(60))
def test_runs_equal_brute_force(seed):
    rng = np.random.default_rng(seed)
    parts = []
    for _ in range(rng.integers(1, 6)):
        parts.append(rng.integers(0, rng.choice([2, 5, 1000]), rng.integers(0, 60)))
        unit = rng.integers(0, rng.choice([1, 2, 3, 1000]), rng.integers(1, 45))
        inner = np.tile(unit, rng.integers(1, 5))
        parts.append(np.tile(np.concatenate([inner, unit[: rng.integers(0, len(unit) + 1)]]), rng.integers(1, 6)))
    words = np.concatenate(parts)
    assert [(r.start, r.length, r.period) for r in periodic.runs(words)] == brute_runs(words.tolist())


@pytest.mark.parametrize("period", [1, 7, 8, 9, 12, 13, 14, 19, 20, 29, 30, 31, 64, 100, 333])
@pytest.mark.parametrize("extra", [-1, 0, 1])
def test_shortest_run_of_each_scale(period, extra):
    rng = np.random.default_rng(period)
    length = max(24, 3 * period) + extra
    run = np.resize(rng.permutation(period), length)
    words = np.concatenate([10_000 + np.arange(50), run, 20_000 + np.arange(50)])
    found = [(r.start, r.length, r.period) for r in periodic.runs(words)]
    assert found == ([(50, length, period)] if extra >= 0 else [])


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    expected = sorted(map(str, (brute_row(row.doc_id, row.text) for row in docs.collect() if (row.text or "").count(" ") < 700)))
    got = {row.doc_id: tuple(row) for row in periodic.report(docs).collect()}
    short = [got[row.doc_id] for row in docs.collect() if (row.text or "").count(" ") < 700]
    assert sorted(map(str, short)) == expected
    assert any(row[1] for row in short)


def test_collapsed_text_and_groups(spark, make, monkeypatch):
    looped = "start here " + "the same few words " * 9 + "and the end"
    rows = [(1, looped), (2, looped), (3, None), (4, " \n"), (5, "a " * 24), (6, "a " * 23)]
    out = {row.doc_id: row for row in periodic.detect(make(rows)).collect()}
    assert out[1].collapsed == "start here the same few words and the end"
    assert (out[1].start, out[1].length, out[1].period, out[1].exponent_milli) == (2, 36, 4, 9000)
    assert out[2].runs == out[1].runs == "2,36,4\n"
    assert (out[3].n_words, out[3].n_runs, out[3].start, out[3].collapsed) == (0, 0, None, "")
    assert out[5].collapsed == "a" and out[6].n_runs == 0
    whole = [list(r) for _, _, r in periodic.searched(enumerate([looped.encode().split()] * 50))]
    monkeypatch.setattr(periodic, "GROUP_WORDS", 40)
    assert [list(r) for _, _, r in periodic.searched(enumerate([looped.encode().split()] * 50))] == whole


def test_very_long_text(make):
    unit = [f"w{i}" for i in range(20_000)]
    text = " ".join(["x", *unit * 3, "y"])
    row = periodic.detect(make([(1, text)])).first()
    assert (row.n_runs, row.start, row.length, row.period) == (1, 1, 60_000, 20_000)
