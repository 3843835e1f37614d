"""Line chunks against a plain loop over pairs of lines, and how much of planted blocks goes."""

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from cohortmill.llm import line_chunks


def brute(rows):
    """(doc_id, text, chunks, lines) with every pair of neighbouring lines with words kept at its first place only."""
    places = defaultdict(set)
    split = []
    for doc_id, text in rows:
        lines = [] if text is None else text.split("\n")
        worded = [i for i, line in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", line)]
        split.append((doc_id, text, lines, list(zip(worded, worded[1:]))))
        for first, last in split[-1][3]:
            places["\n".join(lines[first : last + 1])].add((doc_id is None, doc_id or 0, text, first))
    out = []
    for doc_id, text, lines, pairs in split:
        gone = set()
        for first, last in pairs:
            # Texts of one id don't clash here, so their order by digest doesn't matter.
            own = places["\n".join(lines[first : last + 1])]
            if (doc_id is None, doc_id or 0, text, first) != min(own, key=lambda p: (p[0], p[1], p[3])):
                gone.update(range(first, last + 1))
        kept = "\n".join(line for i, line in enumerate(lines) if i not in gone) if gone else text
        out.append((doc_id, kept, sum(i in gone and i - 1 not in gone for i in range(len(lines))), len(gone)))
    return sorted(out, key=str)


def found(make, rows):
    out = line_chunks.deduplicated(make(rows))
    return sorted(((r.doc_id, r.text, r.n_removed_chunks, r.n_removed_lines) for r in out.collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(make, seed):
    rng = random.Random(seed)
    pool = ["", " ", "a", "b", "c", "d e", "line", "é", "x\r"] + [f"own {i}" for i in range(15)]
    rows = [(i if i else None, "\n".join(rng.choices(pool, k=rng.randint(0, 12)))) for i in range(80)]
    rows += [(200, None), (201, ""), (202, "\n".join(["loop", "round"] * 300)), rows[5], (203, rows[6][1])]
    assert found(make, rows) == brute(rows)


@pytest.mark.parametrize("k", [2, 3, 4, 6, 10, 20])
def test_blocks_of_every_size_are_found(make, k):
    """The block goes from one of two documents with other lines around it; at least nine lines in ten do."""
    rng = random.Random(k)
    rows, planted = [], 0
    for pair in range(60):
        block = [f"block {pair} line {i} {rng.random()}" for i in range(k)]
        for side in (0, 1):
            around = [f"own {pair} {side} {i} {rng.random()}" for i in range(20)]
            at = rng.randint(0, 20)
            rows.append((2 * pair + side, "\n".join([*around[:at], *block, *around[at:]])))
        planted += k
    out = {row[0]: row for row in found(make, rows)}
    removed = sum(row[3] for row in out.values())
    assert 0.9 * planted <= removed <= planted
    for doc_id, text in rows:
        if doc_id % 2 == 0:
            assert out[doc_id][1] == text


def test_every_line_that_goes_stands_elsewhere(make):
    rng = random.Random(9)
    pool = [f"l{i}" for i in range(12)]
    rows = [(i, "\n".join(rng.choices(pool, k=rng.randint(2, 15)))) for i in range(60)]
    kept = {line for row in found(make, rows) for line in (row[1] or "").split("\n")}
    assert {line for _, text in rows for line in text.split("\n")} <= kept


def test_bytes_decide_where_digests_are_equal(make, monkeypatch):
    rows = [(i, f"one {i}\ntwo {i}\nthree") for i in range(40)]
    monkeypatch.setattr(line_chunks, "_digest", lambda text: F.unhex(F.substring(F.md5(text.cast("binary")), 1, 1).cast("string")))
    assert [row[1] for row in found(make, rows)] == [text for _, text in sorted(rows, key=str)]
