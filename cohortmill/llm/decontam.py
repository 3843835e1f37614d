"""Benchmark decontamination with a generalised suffix automaton.

The words of the test items build one automaton. A document's words are streamed through it; after each
word the state and the length tell the longest run of words ending there that occurs in an item. Where
that length reaches the window, the last words up to the window are hit, and the state tells the items.
An item shorter than the window counts as one window: it is hit where the stream ends in all of it.

The test items are read in blocks of ``block_words`` words, each a whole automaton sent to every task, used and
taken back before the next one is built, so memory does not grow with the benchmark. Items longer
than a block are cut into pieces that overlap by the window less one, which keeps every window whole. With several blocks, one
pass marks the documents that hold the hash of any window (in a bitmap of fixed size, which may mark more, never fewer), and
only these go through the blocks. The spans of all blocks are joined before a text is cut, and cut texts go
through all blocks again until none is hit: the result doesn't depend on the blocks.

Words: A-Z in lower case, runs of letters, digits and code points from U+0080 on.

Defined results: null and empty texts have no words, and an item without words hits nothing. Items with a
null id are listed as ``null``; items with one id are one item. Repeated documents are each reported.
An empty benchmark hits nothing, and an empty document table gives an empty result. Very long texts are streamed
whole. Reports read doc_id and text alone; ``decontaminate`` keeps the columns of documents and leaves others out.
"""

from __future__ import annotations

import math
import re
import string
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortmill.llm.common import documents_only
from cohortmill.sources.checkpoints import written

WINDOW = 10
BLOCK_WORDS = 50_000
#: The bitmap of window hashes has 2 ** BITS bits (4 MB).
BITS = 25
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_BYTES = re.compile(WORD.encode())


class SuffixAutomaton:
    """All runs of words of some items; states hold the items they prove."""

    def __init__(self, items: Iterable[tuple[str, list[bytes]]], window: int):
        self.window = window
        self.next: list[dict[bytes, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        items = [(name, words) for name, words in items if words]
        for _, words in items:
            last = 0
            for word in words:
                last = self._extended(last, word)
        self._label(items)

    def _state(self, length: int, link: int, following: dict[bytes, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(following)
        return len(self.length) - 1

    def _split(self, state: int, target: int, word: bytes) -> int:
        """The state for the run of ``state`` and ``word``, which is part of a longer one so far."""
        if self.length[target] == self.length[state] + 1:
            return target
        copy = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extended(self, last: int, word: bytes) -> int:
        known = self.next[last].get(word)
        if known is not None:
            return self._split(last, known, word)
        new = self._state(self.length[last] + 1, 0, {})
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = new
            state = self.link[state]
        if state >= 0:
            self.link[new] = self._split(state, self.next[state][word], word)
        return new

    def _label(self, items: list[tuple[str, list[bytes]]]) -> None:
        states = len(self.length)
        # The state of the last ``window`` words, for states that are longer.
        self.window_state = [-1] * states
        for state in sorted(range(1, states), key=self.length.__getitem__):
            if self.length[state] >= self.window:
                above = self.window_state[self.link[state]]
                self.window_state[state] = above if above >= 0 else state
        self.window_items: dict[int, set[str]] = {}
        whole: dict[int, set[str]] = {}
        for name, words in items:
            state = 0
            for word in words:
                state = self.next[state][word]
                if self.window_state[state] >= 0:
                    self.window_items.setdefault(self.window_state[state], set()).add(name)
            if len(words) < self.window:
                whole.setdefault(state, set()).add(name)
        # Whole short items that end wherever a state's run ends: (words, items), the state's own first.
        self.short: list[tuple] = [()] * states
        if whole:
            for state in sorted(range(1, states), key=self.length.__getitem__):
                above = self.short[self.link[state]]
                own = ((self.length[state], whole[state]),) if state in whole else ()
                self.short[state] = own + above

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans of hit words, first and behind the last, joined where they touch; items with an occurring window."""
        following, link, length, window = self.next, self.link, self.length, self.window
        window_state, short = self.window_state, self.short
        root = following[0]
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        state = matched = 0
        for at, word in enumerate(words):
            if state == 0:
                state = root.get(word, 0)
                matched = 1 if state else 0
            else:
                target = following[state].get(word)
                while target is None and state:
                    state = link[state]
                    matched = length[state]
                    target = following[state].get(word)
                if target is None:
                    matched = 0
                else:
                    state = target
                    matched += 1
            if matched >= window:
                items |= self.window_items[window_state[state]]
                _add(spans, at + 1 - window, at + 1)
            elif not matched:
                continue
            for size, names in short[state]:
                if size <= matched:
                    items |= names
                    _add(spans, at + 1 - size, at + 1)
        return spans, items


def _add(spans: list[tuple[int, int]], first: int, behind: int) -> None:
    """Adds a span whose end is not before the last one's."""
    while spans and first <= spans[-1][1]:
        first = min(first, spans.pop()[0])
    spans.append((first, behind))


def words_of(text: bytes | None) -> list[bytes]:
    return WORD_BYTES.findall(text.lower()) if text else []


def item_blocks(benchmark: DataFrame, window: int, block_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """Items as (id, words), one block at a time; a block holds about ``block_words`` words."""
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    items = benchmark.select(
        F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("name"),
        F.regexp_extract_all(lower, F.lit(WORD), F.lit(0)).alias("words"),
    ).filter(F.size("words") > 0)
    starts = F.sequence(F.lit(0), F.size("words") - 1, F.lit(block_words))
    pieces = items.select("name", "words", F.explode(starts).alias("start"))
    # A last piece of fewer words than the overlap holds no window of its own.
    pieces = pieces.filter((F.col("start") == 0) | (F.size("words") - F.col("start") >= window))
    pieces = pieces.select("name", "start", F.slice("words", F.col("start") + 1, block_words + window - 1).alias("words"))
    total = pieces.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_words))
    if blocks > 1:
        pieces = written(pieces.withColumn("block", F.pmod(F.xxhash64("name", "start"), F.lit(blocks))))
    for block in range(blocks):
        rows = (pieces.filter(F.col("block") == block) if blocks > 1 else pieces).select("name", "words").collect()
        yield [(row.name, [word.encode() for word in row.words]) for row in rows]


def _window_buckets(words: list[bytes], size: int, bits: int) -> np.ndarray:
    """Bucket of each run of ``size`` words."""
    if len(words) < size:
        return np.empty(0, np.int64)
    numbers = np.array([zlib.crc32(word) for word in words], np.uint64)
    total = np.zeros(len(words) - size + 1, np.uint64)
    for at in range(size):
        # A fixed odd multiplier (from the golden ratio) for each place of the run.
        total = (total ^ (total >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + numbers[at : at + len(total)]
    total = (total ^ (total >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return (total >> np.uint64(64 - bits)).astype(np.int64)


def window_bitmap(benchmark: DataFrame, window: int, bits: int = BITS) -> tuple[list[int], bytes]:
    """Sizes of windows that occur, and one bit for each bucket that holds a window."""
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    items = benchmark.select(F.regexp_extract_all(lower, F.lit(WORD), F.lit(0)).alias("words")).filter(F.size("words") > 0)

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[int, np.ndarray] = {}
            for words in batch.column("words").to_pylist():
                size = min(window, len(words))
                own = _window_buckets([word.encode() for word in words], size, bits)
                found[size] = np.union1d(found[size], own) if size in found else np.unique(own)
            for size, own in found.items():
                yield pa.RecordBatch.from_arrays([pa.array([size] * len(own), pa.int32()), pa.array(own, pa.int64())], ["size", "bucket"])

    # At most one row a bucket comes here.
    held = items.mapInArrow(buckets, "size int, bucket long").groupBy("bucket").agg(F.collect_set("size").alias("sizes"))
    sizes: set[int] = set()
    bitmap = np.zeros(1 << bits, bool)
    for row in held.toLocalIterator():
        bitmap[row.bucket] = True
        sizes.update(row.sizes)
    return sorted(sizes), np.packbits(bitmap).tobytes()


def _marked(docs: DataFrame, benchmark: DataFrame, window: int) -> DataFrame:
    """The documents with _row, _words (their number) and _may, whether a window may occur; written, as rows are numbered."""
    sizes, bitmap = window_bitmap(benchmark, window)
    shared = docs.sparkSession.sparkContext.broadcast(bitmap)
    numbered = docs.withColumn("_row", F.monotonically_increasing_id())
    schema = T.StructType([*numbered.schema, T.StructField("_words", T.LongType()), T.StructField("_may", T.BooleanType())])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            counts, may = [], []
            for text in batch.column("text").cast(pa.binary()):
                words = words_of(text.as_py())
                buckets = [_window_buckets(words, size, BITS) for size in sizes]
                may.append(any(((flags[x >> 3] >> (7 - (x & 7)).astype(np.uint8)) & 1).any() for x in buckets))
                counts.append(len(words))
            arrays = [*batch.columns, pa.array(counts, pa.int64()), pa.array(may, pa.bool_())]
            yield pa.RecordBatch.from_arrays(arrays, names=schema.fieldNames())

    return written(numbered.mapInArrow(mark, schema))


def _through_blocks(docs: DataFrame, benchmark: DataFrame, window: int, block_words: int) -> DataFrame | None:
    """_row, spans and items of rows that any block hits; None if there is one block only."""
    found = None
    for items in item_blocks(benchmark, window, block_words):
        automaton = docs.sparkSession.sparkContext.broadcast(SuffixAutomaton(items, window))
        hit = written(_scanned(docs, automaton, "_row").filter(F.size("items") > 0))
        automaton.destroy()
        found = hit if found is None else found.unionByName(hit)
    return found.groupBy("_row").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )


HITS = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("spans", T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("behind", T.LongType())]))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def _scanned(docs: DataFrame, automaton, key: str) -> DataFrame:
    """The key column and HITS against one block."""
    schema = T.StructType([docs.schema[key], *HITS.fields])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = automaton.value.hits
        for batch in batches:
            counts, spans, items = [], [], []
            for text in batch.column("text"):
                words = words_of(text.as_py())
                found, names = search(words)
                counts.append(len(words))
                spans.append([{"first": first, "behind": behind} for first, behind in found])
                items.append(sorted(names))
            span_type = pa.list_(pa.struct([("first", pa.int64()), ("behind", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(key),
                    pa.array(counts, pa.int64()),
                    pa.array(spans, span_type),
                    pa.array(items, pa.list_(pa.string())),
                ],
                names=schema.fieldNames(),
            )

    return docs.select(key, F.col("text").cast("binary").alias("text")).mapInArrow(scan, schema)


def _one_block(docs: DataFrame, benchmark: DataFrame, window: int, block_words: int):
    """The automaton of all items where they fit one block, else None."""
    blocks = item_blocks(benchmark, window, block_words)
    first = next(blocks)
    if next(blocks, None) is not None:
        return None
    return docs.sparkSession.sparkContext.broadcast(SuffixAutomaton(first, window))


def scan(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Per document: doc_id, n_words, spans of hit words (numbers from 0, end behind), items with occurring windows."""
    automaton = _one_block(docs, benchmark, window, block_words)
    if automaton is not None:
        return _scanned(docs, automaton, "doc_id")
    rows = _marked(docs.select("doc_id", "text"), benchmark, window)
    hit = _through_blocks(rows.filter("_may"), benchmark, window, block_words)
    joined = rows.select("doc_id", "_row", F.col("_words").alias("n_words")).join(hit, "_row", "left")
    none = T.StructType(HITS.fields)
    spans = F.coalesce("spans", F.array().cast(none["spans"].dataType))
    items = F.coalesce("items", F.array().cast(none["items"].dataType))
    return joined.select("doc_id", "n_words", _joined(spans).alias("spans"), items.alias("items"))


def _joined(spans):
    """Sorted spans, joined where they touch."""

    def step(done, span):
        last = F.element_at(done, -1)
        longer = F.struct(last["first"].alias("first"), F.greatest(last["behind"], span["behind"]).alias("behind"))
        touches = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["behind"] >= span["first"])
        return F.when(touches, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(
            F.concat(done, F.array(span))
        )

    return F.aggregate(spans, F.slice(spans, 1, 0), step)


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """Counts and digests of ``scan``, and the share of words hit."""
    found = scan(docs, benchmark, window, block_words)
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda sum_, span: sum_ + span["behind"] - span["first"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
        F.when(F.col("n_words") > 0, n_hit / F.col("n_words")).otherwise(F.lit(0.0)).alias("coverage"),
    )


def _without(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of some spans, which are in order and don't touch."""
    places = [match.span() for match in WORD_BYTES.finditer(text.lower())]
    kept, at = [], 0
    for first, behind in spans:
        kept.append(text[at : places[first][0]].rstrip())
        at = places[behind - 1][1]
    kept.append(text[at:])
    return b"\n".join(part for part in kept if part.strip())


def _cut(text: bytes, automaton: SuffixAutomaton) -> tuple[bytes, int, int]:
    """The text without its hit words, and its number of words before and after; again, until none is hit."""
    words = words_of(text)
    before = len(words)
    while spans := automaton.hits(words)[0]:
        text = _without(text, spans)
        words = words_of(text)
    return text, before, len(words)


def _cut_by_one(docs: DataFrame, automaton) -> DataFrame:
    """The documents with cut texts, and _words and _cut: their words and how many of them are gone."""
    schema = T.StructType([*docs.schema, T.StructField("_words", T.LongType()), T.StructField("_cut", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, words, cut = [], [], []
            for text in batch.column("text"):
                text = text.as_py()
                kept, before, after = _cut(text.encode(), automaton.value) if text else (None, 0, 0)
                texts.append(text if before == after else kept.decode())
                words.append(before)
                cut.append(before - after)
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns |= {"text": pa.array(texts, batch.schema.field("text").type)}
            columns |= {"_words": pa.array(words, pa.int64()), "_cut": pa.array(cut, pa.int64())}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=schema.fieldNames())

    return docs.mapInArrow(run, schema)


def _cut_by_blocks(docs: DataFrame, benchmark: DataFrame, window: int, block_words: int) -> DataFrame:
    """The same against several blocks. Each round cuts the spans of all blocks; rows that were cut go into the next one."""
    rows = _marked(docs, benchmark, window).withColumn("_cut", F.lit(0).cast("long"))
    schema = rows.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, cut = [], []
            for row in batch.select(["text", "_cut", "spans"]).to_pylist():
                spans: list[tuple[int, int]] = []
                for span in sorted(row["spans"], key=lambda span: (span["behind"], span["first"])):
                    _add(spans, span["first"], span["behind"])
                texts.append(_without(row["text"].encode(), spans).decode())
                cut.append(row["_cut"] + sum(behind - first for first, behind in spans))
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns |= {"text": pa.array(texts, batch.schema.field("text").type), "_cut": pa.array(cut, pa.int64())}
            yield pa.RecordBatch.from_arrays([columns[name] for name in schema.fieldNames()], names=schema.fieldNames())

    done = rows.filter(~F.col("_may"))
    pending = rows.filter("_may")
    while True:
        hit = written(_through_blocks(pending, benchmark, window, block_words).drop("items"))
        done = done.unionByName(pending.join(hit, "_row", "left_anti").select(*schema.fieldNames()))
        if hit.isEmpty():
            return done.drop("_row", "_may")
        pending = written(pending.join(hit, "_row").mapInArrow(run, schema))


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    max_coverage: float = 0.5,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Documents without the spans that repeat test items; those with more than ``max_coverage`` of their words
    in such spans go. The other columns of documents stay as they are; ``n_chars`` follows the text where there is one."""
    docs = documents_only(docs)
    names = docs.columns
    automaton = _one_block(docs, benchmark, window, block_words)
    if automaton is not None:
        current = _cut_by_one(docs, automaton)
    else:
        current = _cut_by_blocks(docs, benchmark, window, block_words)
    kept = current.filter(F.col("_cut") <= F.col("_words") * F.lit(max_coverage))
    if "n_chars" in names:
        length = F.when(F.col("_cut") > 0, F.length("text")).otherwise(F.col("n_chars"))
        kept = kept.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return kept.select(*names)
