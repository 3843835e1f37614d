"""Shares of disclosure against counts of all pairs, and texts with very many entities."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from cohortmill.llm import disclosure

EMAIL = re.compile(r"[a-z0-9]+@[a-z0-9]+\.example")


def brute(texts, threshold, smoothing):
    """All pairs of an entity and a term by plain counts of documents and of different texts."""
    n = len(texts)
    entities, terms, pairs = Counter(), Counter(), Counter()
    evidence = defaultdict(set)
    for text in texts:
        found = {x for m in EMAIL.findall(text.lower()) for x in (f"email:{m}", f"email of {m.split('@')[1]}", "email")}
        words = {w for w in re.findall(r"[^\W\d_]+", EMAIL.sub(" ", text.lower())) if len(w) >= 3}
        entities.update(found)
        terms.update(words)
        for entity in found:
            for word in words:
                pairs[entity, word] += 1
                evidence[entity, word].add(text)
    out = {}
    for (entity, word), both in pairs.items():
        k = len(evidence[entity, word])
        if k < 2 or entities[entity] == n:
            continue
        content = math.log2(n / entities[entity])
        share = math.log2(n * both / (terms[word] * entities[entity])) / content
        share *= (k - 1) * content / ((k - 1) * content + smoothing)
        if share >= threshold:
            out[entity, word] = (round(share, 9), both == terms[word])
    return out


def corpus(seed):
    rng = random.Random(seed)
    words = [f"{a}{b}{c}" for a in "bcdf" for b in "aeiou" for c in ("rk", "nt", "lm", "ss")]
    texts = []
    for _ in range(200):
        tokens = rng.choices(words, weights=[1 / (i + 1) for i in range(len(words))], k=rng.randint(3, 25))
        for _ in range(rng.choice([0, 0, 1, 2])):
            domain = rng.choice(["aa", "bb", "cc"])
            tokens.insert(rng.randint(0, len(tokens)), f"{rng.choice('xyz')}{rng.randint(1, 4)}@{domain}.example")
            tokens += rng.choice([["Secretword"], [f"Office{domain}"], ["İstanbul"], []])
        texts.append(" ".join(tokens))
    return texts + texts[:5]


@pytest.mark.parametrize(("seed", "threshold"), [(1, 0.8), (2, 0.5), (3, 0.3)])
def test_shares_equal_brute_force(spark, make, seed, threshold):
    texts = corpus(seed)
    docs = make(list(enumerate(texts)))
    found = disclosure.personal(docs).filter(F.size("found") > 0)
    own = disclosure.plain(F.col("text")).alias("plain")
    found = found.select("doc_id", F.md5("text").alias("digest"), "text", own, "found", disclosure._masked().alias("masked"))
    found = found.withColumn("masked", disclosure.plain(F.col("masked")))
    told = disclosure.disclosing(docs, found, threshold=threshold).collect()
    got = {(row.entity, row.term): (round(row.share, 9), row.alone) for row in told}
    wanted = brute([text.replace("İ", "i") for text in texts], threshold, disclosure.SMOOTHING)
    assert got == wanted
    assert wanted or threshold == 0.8


def test_a_text_with_thousands_of_entities(make):
    """The values share a domain, so the text's terms meet the domain, not each value."""
    many = " ".join(f"u{i}@big.example" for i in range(5000))
    rows = [(1, f"falcon {many} nest"), (2, "falcon u1@big.example"), *[(n, f"plain words number {n}") for n in range(3, 40)]]
    rows += [(50, "falcon seen here"), (51, "a nest")]
    got = {row.doc_id: row for row in disclosure.report(make(rows)).collect()}
    assert got[1].n_email == 5000 and got[2].n_email == 1
    assert len(got) == len(rows) and got[3].spans == ""


def test_shuffled_terms_give_the_same(make, monkeypatch):
    rows = [(n, f"the zebra of a{n}@herd.example") for n in range(12)] + [(20 + n, f"the word {n}") for n in range(70)] + [(99, "zebra alone")]
    once = sorted(map(str, disclosure.report(make(rows)).collect()))
    monkeypatch.setattr(disclosure, "BROADCAST_BYTES", 0)
    assert sorted(map(str, disclosure.report(make(rows)).collect())) == once
    assert any("doc_id=99" in row and "term:0:5" in row for row in once)


def test_contract_columns(make):
    columns = disclosure.report(make([(1, "x")])).columns
    assert columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_term"]
