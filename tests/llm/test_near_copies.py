"""Near copies whose shingles repeat unlike often."""

import random

from cohortmill.llm import probminhash


def test_copies_with_a_repeated_passage_are_found(make):
    rng = random.Random(10)
    rows = []
    for pair in range(30):
        words = [f"p{pair}w{n}" for n in range(100)]
        passage = words[:30] * 64 + words[30:]  # 96 common shingles, 4 and 5 of their own
        rows += [(2 * pair, " ".join(passage)), (2 * pair + 1, " ".join([*words, *(f"x{rng.random()}" for _ in range(5))]))]
    classes = {row.doc_id: row.class_id for row in probminhash.classify(make(rows)).collect()}
    assert classes == {n: n - n % 2 for n in range(60)}
