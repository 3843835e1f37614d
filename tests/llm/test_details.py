"""Cuts and repeats of chunks by plain loops, token slices, letters, language samples, shard folders."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from cohortmill.llm import chunks, fertility, langid, sharding


def brute_cuts(text):
    """Ends where the hash of the last REACH bytes is the least of its neighbours, one byte after the other."""
    near, most, size = chunks.NEAR, chunks.MOST, len(text)
    hashes = []
    for at in range(size):
        total = 0
        for age in range(min(chunks.REACH, at + 1)):
            total += int(chunks.GEAR[text[at - age]]) << age
        hashes.append(total % 2**32)
    ends = []
    if size > 2 * near:
        for at in range(near, size - near):
            if hashes[at] < min(hashes[at - near : at]) and hashes[at] <= min(hashes[at + 1 : at + near + 1]):
                ends.append(at + 1)
    out, start = [], 0
    for end in [*ends, size]:
        while end - start > most:
            parts = -(-(end - start) // most)
            start += -(-(end - start) // parts)
            while text[start] & 0xC0 == 0x80:
                start -= 1
            out.append(start)
        if end < size:
            while text[end] & 0xC0 == 0x80:
                end -= 1
            start = end
        out.append(end)
    return sorted(set(out)) if size else []


@pytest.mark.parametrize("seed", range(12))
def test_cuts_equal_a_plain_loop(seed):
    rng = random.Random(seed)
    alphabet = ["ab", "abcdefgh ", "aé漢 ", "x"][seed % 4]
    text = "".join(rng.choices(alphabet, k=rng.choice([0, 1, 31, 64, 65, 300, 1500]))).encode()
    assert sorted(set(chunks.cuts(text))) == brute_cuts(text)
    sizes = np.diff([0, *chunks.cuts(text)])
    assert len(text) <= 64 or (sizes.min() >= chunks.NEAR - 3 and sizes.max() <= chunks.MOST)


def test_repeats_equal_brute_force(make):
    rng = random.Random(3)
    shared = ["".join(rng.choices("abcdef gh", k=400)) for _ in range(3)]
    texts = ["".join(rng.choices("ijkl mnop", k=rng.randint(0, 300))) + rng.choice([*shared, ""]) for _ in range(40)]
    texts += ["short copy"] * 5 + ["another short one", "x" * 31, "x" * 31, None, ""]
    rows = list(enumerate(texts))
    places = defaultdict(list)
    for doc_id, text in rows:
        raw = (text or "").encode()
        ends = brute_cuts(raw)
        for start, end in zip([0, *ends[:-1]], ends):
            places[raw[start:end]].append((doc_id, start, end))
    wanted = {(*place, len(own), place == min(own)) for own in places.values() if len(own) > 1 for place in own}
    found = chunks.repeated(make(rows)).collect()
    assert {(r.doc_id, r.start, r.end, r.places, r.kept) for r in found} == wanted
    assert sum(r.doc_id in range(40, 45) for r in found) == 5
    clean = {r.doc_id: r.text for r in chunks.deduplicated(make(rows)).collect()}
    assert clean[40] == "short copy" and clean[41] == "" and clean[45] == "another short one"


def test_only_long_runs_are_sliced():
    with open(fertility.VOCABULARY, "rb") as file:
        tokens = fertility.Tokens(file.read())
    whole = tokens.encoding.encode_ordinary
    before, behind = "Some ordinary words, and more of them " * 90, " ordinary words behind it, again " * 70
    for run in ("x" * 2500, "ab1" * 1000, "=" * 1000):
        found = tokens.of(before + run + behind).tolist()
        inside = [t for at in range(0, len(run) + 1, 1000) for t in whole((" " + run)[at : at + 1000])]
        assert found == whole(before.rstrip()) + inside + whole(behind)
    assert tokens.of("word" + " " * 3000 + "word").tolist()[0] == whole("word")[0]
    assert tokens.of("word" + " " * 3000 + "word").tolist()[-1] == whole(" word")[-1]
    for text in ("", "a", before, behind + "x" * 999 + before, " " * 999):
        assert tokens.of(text).tolist() == whole(text)


def test_contract_columns_of_quality(make):
    columns = fertility.judge(make([(1, "x")]), ["doc_id"]).columns
    wanted = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    assert columns[: len(wanted)] == wanted


def test_base_counts_equal_brute_force(spark):
    with open(fertility.VOCABULARY, "rb") as file:
        tokens = fertility.Tokens(file.read())
    rng = random.Random(1)
    pool = ["a", "b", "cc", "#x", "$%", "é", " ", "<p>", "&|"]
    for _ in range(200):
        text = "".join(rng.choice(pool) + rng.choice([" ", "\n", "\t", "  ", "\x0b"]) for _ in range(rng.randint(0, 60)))
        words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", text) if w]
        lines = [line for line in text.split("\n") if line.strip(" \t\n\v\f\r")]
        windows = defaultdict(list)
        for i in range(len(words) - 7):
            windows[tuple(words[i : i + 8])].append(i)
        repeats = {at for own in windows.values() if len(own) > 1 for i in own for at in range(i, i + 8)}
        wanted = (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeats))
        assert fertility.measured(text, tokens)[:5] == wanted


def test_letters_are_letters(make):
    assert langid.letters("a² ½b Ⅷ ٣ x_y 漢 é") == "a b x y 漢 é"
    rows = [(n, f"some words of text number {n}", "en", "s", None) for n in range(40)] + [(99, "² ½ Ⅷ", None, "s", None)]
    found = {row.doc_id: row for row in langid.predict(make(rows)).collect()}
    assert found[99].lang_pred == "und" and found[99].score == 0.0 and found[1].lang_pred == "en"


def test_neither_copies_nor_long_texts_fill_the_sample(make):
    copies = [(n, "copied words " * 20, "en", "s", None) for n in range(300)]
    long = [(1000, "long " * 20_000, "en", "s", None)]
    others = [(2000 + n, f"text {chr(97 + n % 26)}{chr(97 + n // 26)}q unlike", "en", "s", None) for n in range(200)]
    sample = langid.learn(make([*copies, *long, *others]), sample_chars=4000)["en"]
    assert sample.count("copied words") <= 20 and sample.count("long ") <= 401
    assert sample.count("unlike") > 80


def test_keys_alone_decide_and_shards_are_written(make, tmp_path):
    rows = sharding.assign(make([(None, f"text {n}") for n in range(30)]), 8).collect()
    assert len({row.shard for row in rows}) == 1 and sorted(row.slot for row in rows) == list(range(30))
    docs = make([(n, f"text {n}") for n in range(100)] + [(None, "x"), (5, "text 5")])
    sharding.write_shards(docs, str(tmp_path / "shards"), 8)
    spark = docs.sparkSession
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter((r.doc_id, r.text) for r in docs.collect())
    placed = {r.doc_id: r.shard for r in sharding.assign(docs, 8).collect()}
    assert {r.doc_id: r.shard for r in back.collect()} == placed
    with pytest.raises(ValueError, match="name the shards"):
        sharding.write_shards(back, str(tmp_path / "again"), 8)
    sharding.write_shards(back, str(tmp_path / "again"), 8, name="part")
    assert {r.doc_id: (r.shard, r.part) for r in spark.read.parquet(str(tmp_path / "again")).collect()} == {k: (v, v) for k, v in placed.items()}


def test_parses_that_end_early_change_nothing():
    rng = random.Random(4)
    sample = {name: " ".join("".join(rng.choices(chars, k=rng.randint(2, 6))) for _ in range(400)) for name, chars in (("aa", "abcd"), ("bb", "abce"), ("cc", "xyza"))}
    languages = langid.Languages(sample)
    for _ in range(60):
        text = " ".join("".join(rng.choices(rng.choice(["abcd", "abce", "xyza", "abxy"]), k=rng.randint(1, 7))) for _ in range(rng.choice([1, 5, 60, 900])))
        costs = [langid.phrases(langid.letters(text), root) * bits for root, bits in zip(languages.roots, languages.bits)]
        best = min(range(3), key=costs.__getitem__)
        name, score, _ = languages.judge(text)
        assert name == languages.names[best]
        assert score == 1.0 / sum(2.0 ** max(-1000.0, costs[best] - cost) for cost in costs)


def test_language_workers_get_texts_row_by_row(make, plan_of):
    rows = [(n, "the cat sat on the mat and the dog sat by the door " * 3, "en", "s", n) for n in range(30)]
    rows += [(n, "der hund und die katze sitzen vor der alten tür im haus " * 3, "de", None, n) for n in range(30, 60)]
    rows += [(n, text, None, "s", None) for n, text in enumerate([None, "", "12 34", "漢字仮名", "the dog sat"], 60)]
    docs = make([*rows, rows[0]])
    known, found = langid.known_language(docs), langid.predict(docs)
    # No batch of a partition's texts, which would grow with their length, and each text parsed once.
    for df in (known.filter("n_chars > 3"), found.filter("lang_pred = 'en'").select("score", "lang_pred")):
        plan = plan_of(df)
        assert plan.count("BatchEvalPython") == 1 and "Arrow" not in plan
    assert sorted(map(str, known.collect())) == sorted(str(row) for row in docs.collect() if row.doc_id < 60 or row.doc_id == 64)
    languages = langid.Languages(langid.learn(docs.filter(~langid.held_out(docs.doc_id))))
    texts = {row.doc_id: row.text for row in docs.collect()}
    rows = found.collect()
    assert len(rows) == 66
    for row in rows:
        assert (row.lang_pred, row.score, row.chars_per_phrase) == languages.judge(texts[row.doc_id])
