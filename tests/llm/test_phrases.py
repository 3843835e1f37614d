"""Phrases against counts of all stretches of words."""

import random
import re
from collections import Counter, defaultdict

import pytest

from cohortmill.llm import phrases


def brute(rows, least, rows_of_lang):
    counts, totals = defaultdict(Counter), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for i in range(len(words)):
                for k in range(1, 6):
                    if i + k <= len(words):
                        counts[lang or "und"][tuple(words[i : i + k])] += 1
    out = []
    for lang, f in counts.items():
        n = totals[lang]
        scored = []
        for phrase, a in f.items():
            if len(phrase) < 2 or a < least:
                continue
            if any(
                len(other) > len(phrase) and 100 * b >= 100 * a and any(other[i : i + len(phrase)] == phrase for i in range(len(other)))
                for other, b in f.items()
                if b >= least
            ):
                continue
            cuts = [(1000 * a * n // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:rows_of_lang], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def _docs(spark, rows):
    return spark.createDataFrame(rows, "lang string, text string")


@pytest.mark.parametrize(("seed", "bits", "shard"), [(0, 7, 50), (1, 10, 400), (2, 22, 10**6)])
def test_equals_brute_force(spark, seed, bits, shard):
    rng = random.Random(seed)
    words = ["A", "b", "C1", "é", "x\x00y", "x\x01", "\x01\x02", "z\x7f", "the", "word"]
    rows = []
    for _ in range(150):
        tokens = rng.choices(words, weights=range(1, 11), k=rng.randint(0, 60))
        if rng.random() < 0.3:
            tokens += ["only", "here", "together"]
        rows.append((rng.choice(["en", "en", "fr", None]), "".join(t + rng.choice([" ", " ", " ", "\t ", ". ", "\n"]) for t in tokens)))
    found = phrases.top(phrases.collocations(_docs(spark, rows).repartition(5), 7, bits, shard), 40).collect()
    assert sorted(map(tuple, found)) == brute(rows, 7, 40)
    assert found


def test_borders_of_ranges(spark):
    """One first word has all phrases, so every range begins inside it."""
    rng = random.Random(5)
    rows = [("en", " ".join(["a", "a", rng.choice("bcdefgh"), rng.choice("bcdefgh"), rng.choice("ab"), "."] * 3)) for _ in range(400)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    try:
        found = phrases.top(phrases.collocations(_docs(spark, rows), 5), 2000).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sorted(map(tuple, found)) == brute(rows, 5, 2000)


def test_counts_beyond_64_bits(spark):
    """1000 a n passes 64 bits; l and r stay exact."""
    big = 3_000_000_000
    frequent = spark.createDataFrame([("en", "u", 3 * big), ("en", "v", 2 * big), ("en", "u\x00v", big)], "lang string, run string, weight long")
    firsts = {row.run: row.found for row in phrases.parts(frequent, False).collect()}
    assert firsts["u\x00v"] == [3 * big]
    path = phrases.Path()
    closed = [state for run in (["u"], ["u", "v"], ["w"]) for state in path.move(run, big)] + list(path.close())
    assert closed == [(["u", "v"], big), (["u"], 2 * big), (["w"], big)]
