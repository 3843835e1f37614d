"""Phrase collocations, counted by weighted acyclic automata.

Every word of a text begins a run: itself and the words behind it, up to ``LONGEST`` words or the end of its piece.
How often a phrase occurs is then the number of runs that begin with it. Runs are the words of a weighted
acyclic automaton: a state is a phrase, an arc a word, and a state's weight counts the runs through it.

1. Each shard (input partition) gives its runs, a bounded number of words at a time; equal ones are counted before
   they are shuffled.
2. The shards' counts are united by prefix range: a range partition over the whole runs, so that a frequent first
   word is cut into several ranges. In a task the sorted runs build the automaton incrementally: a state is
   closed once the runs leave its prefix, and then its weight is final. A task holds one path only. States on the first or
   last path of a range may go on in another range, so their weights are summed over ranges.
3. Frequent phrases are sorted once more, read forwards and backwards. A walk over the forward automaton meets every
   first part of a phrase on its path, one over the backward automaton every last part: the composition gives
   the counts of both parts of all cuts. Parts on the border of a range are looked up by a join.

A frequent phrase has frequent words, pairs of neighbours and longer parts only. So two passes count words and pairs, and
then the longer runs of such pairs, in ``2 ** bits`` buckets each, up to the threshold; runs end where a bucket shows that they
can't be frequent. The sketches have a fixed size (a bit a bucket is broadcast); they never hide a frequent phrase, and
where the corpus fills all buckets they only save nothing.

Defined results: null, empty or blank text, and pieces without a word, hold no words. Null lang is ``und``. Repeated rows
count as often as they occur. Phrases that tie in score and count stand in the order of their bytes. Very long texts are counted whole.
An empty table gives an empty result. Other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortmill.sources.checkpoints import written

LONGEST = 5
LEAST = 100
TOP = 2000
BITS = 23
SHARD_WORDS = 2_000_000
#: Parts that a sketch is cut into, so that its sums are dealt to many tasks.
SLICES = 1024
#: Rows of a batch given back to Spark.
ROWS = 50_000
UNKNOWN = "und"
#: Parts the words of a run. It sorts below every byte of a word, as words have their own two lowest bytes escaped.
GAP = b"\x00"
END = b"."


def _translation() -> bytes:
    """Lower-cases A to Z, makes the ends of pieces one sign and tabs spaces."""
    table = bytearray(range(256))
    table[ord("A") : ord("Z") + 1] = range(ord("a"), ord("z") + 1)
    for sign in b".,;:!?\n\x0b\x0c\r":
        table[sign] = END[0]
    table[ord("\t")] = ord(" ")
    return bytes(table)


TRANSLATION = _translation()


def words_of(text: bytes) -> list[bytes]:
    """Words of a text and an END after each piece."""
    plain = text.translate(TRANSLATION)
    if b"\x00" in plain or b"\x01" in plain:
        plain = plain.replace(b"\x01", b"\x01\x02").replace(b"\x00", b"\x01\x01")
    return plain.replace(END, b" . ").split() + [END]


def _mixed(numbers: np.ndarray) -> np.ndarray:
    # An odd multiplier of 64 bits (from the golden ratio), a fixed value of multiplicative hashing.
    return (numbers ^ (numbers >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)


def _possible(flags: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    return ((flags[buckets >> 3] >> (7 - (buckets & 7)).astype(np.uint8)) & 1).astype(bool)


class Shard:
    """Words of a language in one array of numbers; END is where a piece ends."""

    def __init__(self, lang: str, words: list[bytes], bits: int):
        coded = pa.array(words, pa.binary()).dictionary_encode()
        self.lang, self.bits = lang, bits
        self.words = coded.dictionary.to_pylist()
        self.at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.is_word = np.array([word != END for word in self.words], bool)[self.at]
        # A number for each word; checksums that start from different values are different numbers.
        salts = [zlib.crc32(lang.encode(), seed) for seed in (1, 2)]
        self.numbers = np.array([zlib.crc32(x, salts[0]) << 32 | zlib.crc32(x, salts[1]) for x in self.words], np.uint64)
        self._following = _mixed(self.numbers)

    def _bucket(self, numbers: np.ndarray) -> np.ndarray:
        return (_mixed(numbers) >> np.uint64(64 - self.bits)).astype(np.int64)

    def word_buckets(self) -> np.ndarray:
        """Bucket of each different word."""
        return self._bucket(self.numbers)

    def pairs(self) -> np.ndarray:
        """Where two words of one piece stand side by side."""
        return np.flatnonzero(self.is_word[:-1] & self.is_word[1:])

    def pair_buckets(self, begins: np.ndarray) -> np.ndarray:
        return self._bucket(self._chain(self.numbers[self.at[begins]], begins + 1))

    def _chain(self, numbers: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Numbers of runs that one more word joins."""
        return _mixed(numbers) + self._following[self.at[places]]

    def reach(self, flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where possible pairs begin, and how many words they chain up to from there, LONGEST at most."""
        goes_on = np.zeros(len(self.at) + LONGEST, bool)
        pairs = self.pairs()
        begins = pairs[_possible(flags, self.pair_buckets(pairs))]
        goes_on[begins] = True
        length = np.full(len(begins), 2)
        for depth in range(2, LONGEST):
            length += (length == depth) & goes_on[begins + depth - 1]
        return begins, length

    def longer(self, begins: np.ndarray, length: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For 3 words and more: depth, the runs that reach it by ``length`` (read anew each time), and their buckets."""
        numbers = self._chain(self.numbers[self.at[begins]], begins + 1)
        for depth in range(3, LONGEST + 1):
            rows = np.flatnonzero(length >= depth)
            numbers[rows] = self._chain(numbers[rows], begins[rows] + depth - 1)
            yield depth, rows, self._bucket(numbers[rows])


def shards(batches: Iterator[pa.RecordBatch], shard_words: int, bits: int) -> Iterator[Shard]:
    """Words by language, some ``shard_words`` at a time."""
    held: dict[str, list[bytes]] = {}
    total = 0
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for lang, text in zip(batch.column("lang").to_pylist(), texts, strict=True):
            words = words_of(text.as_py() or b"")
            held.setdefault(lang, []).extend(words)
            total += len(words)
            if total >= shard_words:
                for name in sorted(held):
                    yield Shard(name, held.pop(name), bits)
                total = 0
    for name in sorted(held):
        yield Shard(name, held[name], bits)


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.col("text")).filter(F.col("text").isNotNull())


def sketch(docs: DataFrame, least: int, bits: int, shard_words: int, pairs: bytes | None = None) -> bytes:
    """One bit a bucket: whether its words and pairs together occur ``least`` times; with ``pairs``, the flags of a first
    sketch, whether its longer runs do. Counts stop at ``least``, which keeps sums true."""
    size = 1 << bits
    if size < 64:
        raise ValueError("a sketch has six bits or more")
    slices = min(SLICES, size // 64)
    if not 0 < least < 1 << 15:
        return bytes([255]) * (size // 8)
    kind = np.uint8 if least < 1 << 8 else np.uint16
    shared = docs.sparkSession.sparkContext.broadcast(pairs)
    names = ["slice", "counts"]

    def packed(parts: dict[int, np.ndarray]) -> pa.RecordBatch:
        found = [pa.array(list(parts), pa.int32()), pa.array([part.tobytes() for part in parts.values()], pa.binary())]
        return pa.RecordBatch.from_arrays(found, names)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(size, np.int32)
        for shard in shards(batches, shard_words, bits):
            if shared.value is None:
                np.add.at(counts, shard.word_buckets(), np.bincount(shard.at, minlength=len(shard.words)))
                counts += np.bincount(shard.pair_buckets(shard.pairs()), minlength=size).astype(np.int32)
            else:
                begins, length = shard.reach(np.frombuffer(shared.value, np.uint8))
                buckets = [found for _, _, found in shard.longer(begins, length)]
                counts += np.bincount(np.concatenate(buckets), minlength=size).astype(np.int32)
            np.minimum(counts, least, out=counts)
        if counts.any():
            yield packed(dict(enumerate(counts.astype(kind).reshape(slices, -1))))

    def flag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column("slice").to_pylist(), batch.column("counts"), strict=True):
                more = np.frombuffer(counts.as_py(), kind).astype(np.uint16)
                sums[part] = np.minimum(sums[part] + more, least) if part in sums else more
        if sums:
            yield packed({part: np.packbits(counts >= least) for part, counts in sorted(sums.items())})

    schema = "slice int, counts binary"
    flagged = _texts(docs).mapInArrow(count, schema).repartition("slice").mapInArrow(flag, schema).collect()
    found = {row.slice: bytes(row.counts) for row in flagged}
    return b"".join(found.get(part, bytes(size // 8 // slices)) for part in range(slices))


def runs_of(shard: Shard, pairs: np.ndarray, longer: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Runs of a shard, each as long as it can be frequent, and how often each entry counts. A word in no possible pair
    begins a run of itself, or the empty run if it can't be frequent either; both are counted here."""
    begins, length = shard.reach(pairs)
    for depth, rows, buckets in shard.longer(begins, length):
        length[rows[~_possible(longer, buckets)]] = depth - 1
    alone = shard.is_word.copy()
    alone[begins] = False
    alone = np.bincount(shard.at[alone], minlength=len(shard.words))
    named = np.flatnonzero(_possible(pairs, shard.word_buckets()) & (alone > 0))
    rest = int(alone.sum() - alone[named].sum())
    words = shard.words
    runs = [b"", *[words[word] for word in named.tolist()]]
    numbers = shard.at.tolist()
    ends = (begins + length).tolist()
    runs.extend(GAP.join([words[x] for x in numbers[begin:end]]) for begin, end in zip(begins.tolist(), ends, strict=True))
    return runs, np.concatenate([[rest], alone[named], np.ones(len(begins), np.int64)])


def shard_counts(docs: DataFrame, pairs: bytes, longer: bytes, bits: int, shard_words: int) -> DataFrame:
    """(lang, run, weight) over all shards."""
    shared = docs.sparkSession.sparkContext.broadcast((pairs, longer))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = [np.frombuffer(x, np.uint8) for x in shared.value]
        for shard in shards(batches, shard_words, bits):
            runs, weights = runs_of(shard, *flags)
            for at in range(0, len(runs), ROWS):
                some = pa.array(runs[at : at + ROWS], pa.binary()).view(pa.string())
                columns = [pa.array([shard.lang] * len(some)), some, pa.array(weights[at : at + ROWS], pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "run", "weight"])

    found = _texts(docs).mapInArrow(count, "lang string, run string, weight long")
    return found.groupBy("lang", "run").agg(F.sum("weight").alias("weight"))


class Path:
    """The open states of an automaton built from sorted runs: a word and a weight for each."""

    def __init__(self):
        self.words: list[str] = []
        self.weights: list[int] = []

    def move(self, words: list[str], weight: int) -> Iterator[tuple[list[str], int]]:
        """Goes to a run that sorts no lower than the last; gives the states this closes, deepest first."""
        same = 0
        for old, new in zip(self.words, words):  # noqa: B905 (one may be longer)
            if old != new:
                break
            same += 1
        yield from self.close(same)
        self.words.extend(words[same:])
        self.weights.extend([0] * (len(words) - same))
        if words:
            self.weights[-1] += weight

    def close(self, depth: int = 0) -> Iterator[tuple[list[str], int]]:
        while len(self.words) > depth:
            weight = self.weights.pop()
            yield self.words[:], weight
            self.words.pop()
            if self.weights:
                self.weights[-1] += weight


def _rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(name).to_pylist() for name in names], strict=True)


def _batched(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], size: int = ROWS) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held, strict=True), types, strict=True)], names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*held, strict=True), types, strict=True)], names)


def _split(run: str) -> list[str]:
    return run.split("\x00") if run else []


def united(counts: DataFrame, least: int) -> DataFrame:
    """(lang, run, weight): all phrases that occur ``least`` times or more, from counts of sorted shards."""

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        path, at, first = Path(), None, None
        rows = _rows(batches, "lang", "run", "weight")
        edge: set[tuple] = set()

        def kept(closed: Iterator, last: bool) -> Iterator[tuple]:
            for words, weight in closed:
                if weight >= least or last or (at, *words) in edge:
                    yield at, "\x00".join(words), weight

        for lang, run, weight in rows:
            words = _split(run)
            if first is None:
                first = (lang, *words)
                edge = {first[:depth] for depth in range(2, len(first) + 1)}
            if lang != at:
                yield from kept(path.close(), False)
                at = lang
            yield from kept(path.move(words, weight), False)
        yield from kept(path.close(), True)

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batched(states(batches), ["lang", "run", "weight"], [pa.string(), pa.string(), pa.int64()])

    ranged = counts.filter("run <> ''").repartitionByRange("lang", "run").sortWithinPartitions("lang", "run")
    closed = ranged.mapInArrow(close, "lang string, run string, weight long")
    return closed.groupBy("lang", "run").agg(F.sum("weight").alias("weight")).filter(F.col("weight") >= least)


def _words(run: Column, count: Column) -> Column:
    """The first words of a run, or the last ones if ``count`` is negative."""
    return F.call_function("substring_index", run, F.lit("\x00"), count)


def parts(frequent: DataFrame, backwards: bool) -> DataFrame:
    """(lang, run, found): for each frequent phrase the counts of its first 1, 2, ... words (backwards: its last ones).

    ``frequent`` has ``lang``, ``run`` (backwards: with its words in reverse order) and ``weight``.
    """

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        words: list[str] = []
        weights: list[int | None] = []
        at = None
        for lang, run, weight in _rows(batches, "lang", "run", "weight"):
            here = _split(run)
            same = 0
            if lang == at:
                for old, new in zip(words, here):  # noqa: B905 (one may be longer)
                    if old != new:
                        break
                    same += 1
            # States between the common path and this one are phrases of their own, so only a range's border lacks them.
            weights = weights[:same] + [None] * (len(here) - same)
            weights[-1] = weight
            words, at = here, lang
            yield lang, run, weights[:-1]

    def close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batched(walk(batches), ["lang", "run", "found"], [pa.string(), pa.string(), pa.list_(pa.int64())])

    ranged = frequent.repartitionByRange("lang", "run").sortWithinPartitions("lang", "run")
    walked = written(ranged.mapInArrow(close, "lang string, run string, found array<long>"))
    # Parts that a range lacks: at most one path for each range.
    lacking = F.filter(
        F.transform("found", lambda count, at: F.struct((at + 1).alias("depth"), count.alias("count"))),
        lambda part: part["count"].isNull(),
    )
    lacking = walked.select("lang", "run", F.explode(lacking).alias("part"))
    prefix = _words(F.col("run"), F.col("part.depth"))
    lacking = lacking.select("lang", "run", prefix.alias("prefix"), F.col("part.depth").alias("depth"))
    counts = frequent.select("lang", F.col("run").alias("prefix"), F.col("weight").alias("count"))
    wanted = lacking.select("lang", "prefix").distinct().join(counts, ["lang", "prefix"])
    got = lacking.join(wanted, ["lang", "prefix"]).groupBy("lang", "run")
    got = got.agg(F.map_from_entries(F.collect_list(F.struct("depth", "count"))).alias("others"))
    filled = walked.join(got, ["lang", "run"], "left")
    found = F.transform("found", lambda count, at: F.coalesce(count, F.try_element_at("others", at + 1)))
    return filled.select("lang", "run", found.alias("found"))


def _reversed(run: Column) -> Column:
    return F.array_join(F.reverse(F.split(run, "\x00")), "\x00")


def _phrase(run: Column) -> Column:
    """Words with one space between, and with their lowest bytes as they were."""
    spaced = F.translate(run, "\x00", " ")
    return F.replace(F.replace(spaced, F.lit("\x01\x01"), F.lit("\x00")), F.lit("\x01\x02"), F.lit("\x01"))


def _wide(count: Column) -> Column:
    return count.cast("decimal(19,0)")


def collocations(docs: DataFrame, least: int = LEAST, bits: int = BITS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """All candidates that no longer one replaces: lang, phrase, a, l, r, n, score."""
    docs = docs.select("lang", "text")
    pairs = sketch(docs, least, bits, shard_words)
    longer = sketch(docs, least, bits, shard_words, pairs)
    counts = written(shard_counts(docs, pairs, longer, bits, shard_words))
    # Every word of the corpus begins one run, so a language's words are the sum of all weights.
    totals = written(counts.groupBy("lang").agg(F.sum("weight").alias("n")))
    frequent = written(united(counts, least))
    backwards = written(frequent.select("lang", _reversed(F.col("run")).alias("run"), "weight"))
    firsts = parts(frequent, False).withColumnRenamed("found", "firsts").filter("size(firsts) > 0")
    lasts = parts(backwards, True).select("lang", _reversed(F.col("run")).alias("run"), F.col("found").alias("lasts"))
    whole = frequent.withColumnRenamed("weight", "a")
    candidates = written(firsts.join(lasts, ["lang", "run"]).join(whole, ["lang", "run"]))
    # A phrase that occurs only as part of a longer one has a longer one by one word that is as frequent.
    left = candidates.filter("size(firsts) > 1 and firsts[size(firsts) - 1] = a")
    left = left.select("lang", _words(F.col("run"), F.size("firsts")).alias("run"))
    right = candidates.filter("size(lasts) > 1 and lasts[size(lasts) - 1] = a")
    right = right.select("lang", _words(F.col("run"), -F.size("lasts")).alias("run"))
    own = candidates.join(left.union(right).distinct(), ["lang", "run"], "left_anti")
    own = own.join(F.broadcast(totals) if _few(totals) else totals, "lang")
    size = F.size("firsts")

    def cut(first: Column, at: Column) -> Column:
        rest = F.element_at("lasts", size - at)
        exact = F.lit(1000).cast("decimal(19,0)") * _wide(F.col("a")).cast("decimal(38,0)") * _wide(F.col("n")).cast("decimal(38,0)")
        score = F.call_function("div", exact, _wide(first).cast("decimal(38,0)") * _wide(rest).cast("decimal(38,0)"))
        return F.struct(score.alias("score"), (at + 1).alias("k"), first.alias("l"), rest.alias("r"))

    cuts = F.transform("firsts", cut)
    scored = own.select("lang", "run", "a", "n", F.array_min(cuts).alias("cut"))
    return scored.select("lang", _phrase(F.col("run")).alias("phrase"), "a", "cut.l", "cut.r", "n", "cut.score")


def _few(totals: DataFrame, bound: int = 10_000) -> bool:
    """Whether there are few enough languages to send their totals to every task."""
    return totals.limit(bound + 1).count() <= bound


def top(found: DataFrame, rows: int = TOP) -> DataFrame:
    """The first rows of each language, by score, count and phrase; the best of every part first, so that no task
    orders a whole language."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    part = F.pmod(F.xxhash64("phrase"), F.lit(64))
    best = found.withColumn("_part", part)
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order)))
    best = best.filter(F.col("rank") <= rows).drop("rank", "_part")
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    return best.filter(F.col("rank") <= rows).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
