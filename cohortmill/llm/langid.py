"""Language identification by cross-parsing.

For each language, labelled text builds a suffix automaton. A document is parsed greedily against it: each
phrase is the longest run from here on that occurs in the labelled text (or one unknown character). The
number of phrases times the bits that point into the labelled text is the length of a description of the
document by that language; the language with the shortest description wins.

The labelled text is a bounded sample: ``sample_chars`` characters a language, from whole documents in the
order of a hash of their text, each text once, with its first ``slice_chars`` at most, so that neither copies nor a long text
fill it; the last one cut. Letters count in lower case; digits, signs and white space
count as one space, so that neither layout nor repeated signs speak for a language. Only the sample is bounded; every document is parsed to its
end. A worker holds one automaton per language, so its memory grows with languages, not with documents.

Defined results: text without a letter, empty or null is ``und`` with score 0. Equal description lengths go
to the language first by name. With no labelled text at all, everything is ``und``. Rows without a language,
or with text without a letter, teach nothing. Repeated rows get the same answer, and an empty table an empty result. Very long texts
are parsed whole; columns of other names are left alone.
"""

from __future__ import annotations

import math

import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortmill.llm.common import documents_only

SAMPLE_CHARS = 30_000
SLICE_CHARS = 2_000
UNKNOWN = "und"
OTHER = regex.compile(r"\P{L}+")


def letters(text: str) -> str:
    """Lower-case letters, and one space for each run of anything else."""
    return OTHER.sub(" ", text.lower())


def transitions(text: str) -> dict:
    """The root of the suffix automaton of a text, each state a dict from character to state."""
    states: list[dict] = [{}]
    links, lengths = [-1], [0]
    last = 0
    for character in text:
        new = len(states)
        states.append({})
        lengths.append(lengths[last] + 1)
        links.append(0)
        at = last
        while at >= 0 and character not in states[at]:
            states[at][character] = new
            at = links[at]
        if at >= 0:
            target = states[at][character]
            if lengths[target] == lengths[at] + 1:
                links[new] = target
            else:
                copy = len(states)
                states.append(dict(states[target]))
                lengths.append(lengths[at] + 1)
                links.append(links[target])
                links[target] = links[new] = copy
                while at >= 0 and states[at].get(character) == target:
                    states[at][character] = copy
                    at = links[at]
        last = new
    for state in states:
        for character, target in state.items():
            state[character] = states[target]
    return states[0]


#: Characters by which languages are put in the order that they parse a text in, and bits behind the best one that make
#: a language's share of the likelihood nothing.
FIRST_LOOK = 200
FAR_BEHIND = 1000.0


def phrases(text: str, root: dict, most: float = math.inf) -> int:
    """Number of phrases of the greedy parse: longest runs known to the automaton, or single unknown characters. The parse ends early
    with any number above ``most`` once there are more."""
    count = 1 if text else 0
    state = root
    first = root.get
    for character in text:
        following = state.get(character)
        if following is None:
            # The phrase ended before this character (if it had begun); the next one starts with it.
            if state is not root:
                count += 1
                if count > most:
                    return count
                following = first(character)
            if following is None:
                count += 1
                following = root
        state = following
    return count - (state is root) if text else 0


class Languages:
    """Automata of all languages; made anew in each worker from the sample, which is small."""

    def __init__(self, sample: dict[str, str]):
        self.names = sorted(sample)
        self.roots = [transitions(sample[name]) for name in self.names]
        self.bits = [math.log2(len(sample[name]) + 1) for name in self.names]

    def judge(self, text: str | None) -> tuple[str, float, float]:
        """Language, score (its share of the likelihood, 0 to 1) and characters per phrase."""
        text = letters(text or "")
        if not self.names or not text.strip():
            return UNKNOWN, 0.0, 0.0
        # The likely language first: a parse that falls far behind the best one so far needs no end, as all such get one share.
        start = [phrases(text[:FIRST_LOOK], root) * bits for root, bits in zip(self.roots, self.bits, strict=True)]
        counts, costs, least = [0] * len(start), [0.0] * len(start), math.inf
        for at in sorted(range(len(start)), key=start.__getitem__):
            most = (least + FAR_BEHIND) / self.bits[at] + 2
            counts[at] = phrases(text, self.roots[at], most)
            costs[at] = counts[at] * self.bits[at]
            least = min(least, costs[at])
        best = min(range(len(costs)), key=costs.__getitem__)
        score = 1.0 / sum(2.0 ** max(-FAR_BEHIND, costs[best] - cost) for cost in costs)
        return self.names[best], score, len(text) / max(1, counts[best])


_made: dict[tuple, Languages] = {}


def _languages(sample: dict[str, str]) -> Languages:
    """This worker's automata for a sample; kept from task to task."""
    key = tuple(sorted((name, hash(text)) for name, text in sample.items()))
    if key not in _made:
        _made.clear()
        _made[key] = Languages(sample)
    return _made[key]


def held_out(doc_id: Column) -> Column:
    """True for the quarter of ids that nothing is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def learn(labelled: DataFrame, sample_chars: int = SAMPLE_CHARS, slice_chars: int = SLICE_CHARS) -> dict[str, str]:
    """Letters of the sample text per language, from at most ``sample_chars`` characters each.

    Each text of a language counts once, with its first ``slice_chars``; copies are brought together with partial groups first.
    Sizes per language fix the share of hash values that is enough, so that only about twice the sample is
    sorted and brought here.
    """
    known = labelled.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    known = known.select("lang", F.substring("text", 1, slice_chars).alias("text"), F.xxhash64("text").alias("own"))
    texts = known.groupBy("lang", "own").agg(F.max(F.length("text")).alias("chars"))
    sizes = texts.groupBy("lang").agg(F.sum("chars").alias("chars"))
    space = 1 << 30
    enough = (F.lit(float(space)) * (2 * sample_chars + slice_chars) / F.col("chars")).alias("enough")
    place = F.pmod("own", F.lit(space))
    chosen = known.join(F.broadcast(sizes.select("lang", enough)), "lang").filter(place <= F.col("enough"))
    chosen = chosen.groupBy("lang", "own").agg(F.min("text").alias("text"))
    order = Window.partitionBy("lang").orderBy(F.pmod("own", F.lit(space)), "own")
    chosen = chosen.withColumn("before", F.sum(F.length("text")).over(order.rowsBetween(Window.unboundedPreceding, -1)))
    chosen = chosen.withColumn("before", F.coalesce("before", F.lit(0))).filter(F.col("before") < sample_chars)
    left = (F.lit(sample_chars) - F.col("before")).cast("int")
    parts: dict[str, list] = {}
    for row in chosen.select("lang", "before", F.substring("text", F.lit(1), left).alias("text")).collect():
        parts.setdefault(row.lang, []).append((row.before, row.text))
    return {lang: letters("\n".join(text for _, text in sorted(found))) for lang, found in parts.items()}


def identify(docs: DataFrame, sample: dict[str, str], keep: list[str]) -> DataFrame:
    """The named columns, lang_pred, score, and chars_per_phrase of the language that won.

    Workers get the text alone, a hundred rows at a time, so that neither their memory nor Spark's beside the heap
    grows with the texts of a partition; the other columns stay where they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(sample)
    found = "lang_pred string, score double, chars_per_phrase double"

    @F.udf(returnType=found, useArrow=False)
    def judge(text: str | None) -> tuple[str, float, float]:
        return _languages(shared.value).judge(text)

    # Not deterministic for Spark alone: so no later filter or column has texts parsed a second time.
    judged = docs.select(*keep, judge.asNondeterministic()(F.col("text")).alias("_found"))
    return judged.select(*keep, "_found.lang_pred", "_found.score", "_found.chars_per_phrase")


def predict(docs: DataFrame, sample_chars: int = SAMPLE_CHARS) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, chars_per_phrase; learned from the other three quarters."""
    marked = docs.select("doc_id", "text", "lang", held_out(F.col("doc_id")).alias("held_out"))
    sample = learn(marked.filter(~F.col("held_out")), sample_chars)
    return identify(marked, sample, ["doc_id", "held_out"])


def known_language(docs: DataFrame, sample_chars: int = SAMPLE_CHARS, least_chars_per_phrase: float = 1.5) -> DataFrame:
    """Documents in one of the labelled languages: those that are ``und``, or whose phrases are hardly longer
    than a character in every language, go."""
    docs = documents_only(docs)
    sample = learn(docs.filter(~held_out(F.col("doc_id"))), sample_chars)
    judged = identify(docs, sample, docs.columns)
    kept = (F.col("lang_pred") != UNKNOWN) & (F.col("chars_per_phrase") >= least_chars_per_phrase)
    return judged.filter(kept).select(*docs.columns)
