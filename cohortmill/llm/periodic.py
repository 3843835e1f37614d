"""Periodic runs of words, found by multi-scale minimizers.

A run is a stretch of words with smallest period q (words q apart are the same) that is at least ``LEAST`` words
and ``TIMES`` periods long and that no neighbouring word extends.

Periods are taken scale by scale: a scale holds the periods from P to P' - 1, with P' about 1.5 P. At a scale
every word place has a rolling hash of the k = P' - 1 words from there on, and a window of 2 P - k + 1 places
selects those with its least hash. Inside a run the windows repeat at the distance of the period, so what they
select does too; and since k is no less than the period, equal hashes inside a run stand whole periods apart.
So the nearest equal selected hash of a place in a run is exactly one period further on, for every run of the scale.
Such pairs seed an extension, word by word, to both sides; the words themselves decide. Periods below
``SHORT`` are too short for windows: for each of them, one scan compares all words with those that far on.

Documents are searched in groups of at most about ``GROUP_WORDS`` words (one longer document is a group of its own), so
memory grows with the longest document only. Nothing is shuffled; a lost task is repeated from its input.

Defined results: null, empty or blank text has no words, no run, and collapses to the empty string. Very long
texts are searched whole. Repeated rows get the same answer, and an empty table an empty result. With a null id
nothing is planted by ``planted``. Other columns of the input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

LEAST = 24
TIMES = 3
SHORT = 9
GROUP_WORDS = 1_000_000
# Multipliers of a published 64-bit mixing function (splitmix64), fixed values; any odd base serves the rolling hash.
MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


@dataclass(frozen=True, order=True)
class Run:
    start: int
    length: int
    period: int


def scales(longest: int) -> list[tuple[int, int]]:
    """(P, P') of the scales for periods from SHORT to ``longest``."""
    found, low = [], SHORT
    while low <= longest:
        found.append((low, low + (low + 1) // 2))
        low = found[-1][1]
    return found


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(MIX[1])
    x = (x ^ (x >> np.uint64(27))) * np.uint64(MIX[2])
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _sliding(values: np.ndarray, width: int, pick: np.ufunc) -> np.ndarray:
    """``pick`` (least or greatest) over every window of ``width`` neighbours, by doubling."""
    done = 1
    while done < width:
        step = min(done, width - done)
        values = pick(values[:-step], values[step:])
        done += step
    return values


def _selected(hashes: np.ndarray, width: int) -> np.ndarray:
    """Places that are least in some window: the greatest of the window minima over a place is its own value."""
    if len(hashes) < width:
        return np.empty(0, np.int64)
    least = _sliding(hashes, width, np.minimum)
    padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
    return np.flatnonzero(_sliding(padded, width, np.maximum) == hashes)


def _reach(words: np.ndarray, place: int, period: int, step: int) -> int:
    """How many words from ``place`` on, in direction ``step``, equal the word one period further on."""
    total, block = 0, 64
    while True:
        if step > 0:
            first = place + total
            last = min(first + block, len(words) - period)
            if first >= last:
                return total
            differ = np.flatnonzero(words[first:last] != words[first + period : last + period])
            if len(differ):
                return total + int(differ[0])
            total += last - first
        else:
            last = place - total + 1
            first = max(0, last - block)
            if first >= last:
                return total
            differ = np.flatnonzero(words[first:last] != words[first + period : last + period])
            if len(differ):
                return total + (last - 1 - first) - int(differ[-1])
            total += last - first
        block *= 4


def _divisors(period: int) -> list[int]:
    """The period divided by each of its prime factors."""
    found, rest, factor = [], period, 2
    while factor * factor <= rest:
        if rest % factor == 0:
            found.append(period // factor)
            while rest % factor == 0:
                rest //= factor
        factor += 1
    return found + ([period // rest] if rest > 1 else [])


def _is_least(words: np.ndarray, start: int, period: int) -> bool:
    """Whether a stretch of three periods or more has no smaller one: one would divide it."""
    return not any(
        np.array_equal(words[start : start + period], words[start + d : start + d + period]) for d in _divisors(period)
    )


def runs(words: np.ndarray) -> list[Run]:
    """All runs in an array of word numbers, by start and period."""
    n = len(words)
    found = set()
    for period in range(1, min(SHORT - 1, n // TIMES) + 1):
        differ = np.flatnonzero(words[period:] != words[:-period])
        bounds = np.concatenate([[-1], differ, [n - period]])
        same = np.diff(bounds) - 1
        for at in np.flatnonzero(same >= max(LEAST, TIMES * period) - period):
            start = int(bounds[at]) + 1
            if _is_least(words, start, period):
                found.add(Run(start, int(same[at]) + period, period))
    if n < TIMES * SHORT:
        return sorted(found, key=lambda run: (run.start, run.period))
    numbers = _mixed((words.astype(np.uint64) + np.uint64(1)) * np.uint64(MIX[0]))
    base = MIX[1]
    powers, inverse = _powers(base, n), _powers(pow(base, -1, 1 << 64), n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(numbers * powers, dtype=np.uint64)])
    for low, high in scales(n // TIMES):
        width = high - 1
        hashes = _mixed((sums[width:] - sums[:-width]) * inverse[: n - width + 1])
        places = _selected(hashes, 2 * low - width + 1)
        order = np.argsort(hashes[places], kind="stable")
        places = places[order]
        distance = np.diff(places)
        alike = (hashes[places[1:]] == hashes[places[:-1]]) & (distance >= low) & (distance < high)
        pairs = sorted(zip(distance[alike].tolist(), places[:-1][alike].tolist(), strict=True))
        done = (0, 0)
        for period, place in pairs:
            if done[0] == period and place < done[1]:
                continue
            ahead = _reach(words, place, period, 1)
            if not ahead:
                continue
            start = place - _reach(words, place - 1, period, -1)
            length = place + ahead + period - start
            done = (period, place + ahead)
            if length >= max(LEAST, TIMES * period) and _is_least(words, start, period):
                found.add(Run(start, length, period))
    return sorted(found, key=lambda run: (run.start, run.period))


def longest_exponent(found: list[Run]) -> Run | None:
    """The run with the greatest length / period; of equal ones the first by start, then period."""
    best = None
    for run in found:
        if best is None or run.length * best.period > best.length * run.period:
            best = run
    return best


def collapsed(words: list[bytes], found: list[Run]) -> list[bytes]:
    """Words without those that any run holds after its first period."""
    if not found:
        return words
    kept = np.ones(len(words), bool)
    for run in found:
        kept[run.start + run.period : run.start + run.length] = False
    return [word for word, stays in zip(words, kept.tolist(), strict=True) if stays]


def split(text: bytes | None) -> list[bytes]:
    """Words of a text: bytes between white space (space, and \\t to \\r)."""
    return (text or b"").split()


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with a periodic tail in one of ten documents, by a checksum of the id: known runs to be found."""
    if doc_id is None or not words:
        return words
    number = zlib.crc32(str(doc_id).encode())
    if number % 10:
        return words
    n, g = len(words), number // 10
    first = g % n
    period = 1 + (n - first) // (3 + g % 8)
    tail = words[first : first + period]
    return words[:first] + (tail * ((n - first) // period + 1))[: n - first]


def found_in(documents: list[list[bytes]]) -> list[list[Run]]:
    """Runs of each document. All are searched as one array, parted by numbers that occur once."""
    flat = [word for words in documents for word in words]
    numbers = pa.array(flat, pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = np.array([len(words) for words in documents], np.int64)
    starts = np.concatenate([[0], np.cumsum(lengths + 1)])
    whole = np.empty(int(starts[-1]), np.int64)
    parted = np.zeros(len(whole), bool)
    parted[starts[1:] - 1] = True
    whole[~parted] = numbers
    whole[parted] = len(flat) + np.arange(len(documents))
    out: list[list[Run]] = [[] for _ in documents]
    for run in runs(whole):
        at = int(np.searchsorted(starts, run.start, side="right")) - 1
        out[at].append(Run(run.start - int(starts[at]), run.length, run.period))
    return out


def _size_class(words: list[bytes]) -> int:
    return len(words).bit_length()


def searched(rows: Iterator[tuple[int, list[bytes]]]) -> Iterator[tuple[int, list[bytes], list[Run]]]:
    """Rows (number, words) with their runs; documents of like length share a search, as its scales depend on the longest."""
    groups: dict[int, list[tuple[int, list[bytes]]]] = {}
    held: dict[int, int] = {}

    def done(size: int) -> Iterator[tuple[int, list[bytes], list[Run]]]:
        group = groups.pop(size)
        held.pop(size)
        for (number, words), found in zip(group, found_in([words for _, words in group]), strict=True):
            yield number, words, found

    for number, words in rows:
        size = _size_class(words)
        groups.setdefault(size, []).append((number, words))
        held[size] = held.get(size, 0) + len(words) + 1
        if sum(held.values()) >= GROUP_WORDS:
            yield from done(max(held, key=held.__getitem__))
    for size in sorted(groups):
        yield from done(size)


FOUND = T.StructType(
    [T.StructField(name, T.LongType()) for name in ("n_words", "n_runs", "start", "length", "period", "exponent_milli")]
    + [T.StructField("runs", T.StringType()), T.StructField("collapsed", T.StringType())]
)
DIGESTS = T.StructType(
    [
        *[T.StructField(name, T.LongType()) for name in ("doc_id", "n_runs", "start", "length", "period", "exponent_milli")],
        T.StructField("runs_sha256", T.StringType()),
        T.StructField("collapsed_sha256", T.StringType()),
    ]
)


def _listed(found: list[Run]) -> str:
    return "".join(f"{run.start},{run.length},{run.period}\n" for run in found)


def _measures(found: list[Run]) -> list[int | None]:
    best = longest_exponent(found)
    if best is None:
        return [0, None, None, None, None]
    return [len(found), best.start, best.length, best.period, 1000 * best.length // best.period]


def _each(
    batches: Iterator[pa.RecordBatch], words_of: Callable, row_of: Callable, schema: T.StructType, keep: list[str]
) -> Iterator[pa.RecordBatch]:
    """One row per document: its kept columns, then what ``row_of`` makes of words and runs."""
    for batch in batches:
        ids = batch.column("_id") if "_id" in batch.schema.names else [None] * batch.num_rows
        texts = batch.column("_text").cast(pa.binary())
        rows = ((at, words_of(ids[at], texts[at].as_py())) for at in range(batch.num_rows))
        made = {}
        for at, words, found in searched(rows):
            made[at] = row_of(words, found)
        columns = list(zip(*[made[at] for at in range(batch.num_rows)], strict=True))
        fields = schema.fields[len(keep) :]
        types = [pa.int64() if isinstance(field.dataType, T.LongType) else pa.string() for field in fields]
        arrays = [batch.column(name) for name in keep]
        arrays += [pa.array(column, kind) for column, kind in zip(columns, types, strict=True)]
        if batch.num_rows:
            yield pa.RecordBatch.from_arrays(arrays, names=schema.fieldNames())


def detect(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The kept columns (doc_id by default), n_words, n_runs, the run of greatest exponent (start, length, period,
    exponent_milli), ``runs`` (a line ``start,length,period`` each) and ``collapsed``, the text without repeats."""
    keep = ["doc_id"] if keep is None else keep
    schema = T.StructType([*[docs.schema[name] for name in keep], *FOUND.fields])

    def row(words: list[bytes], found: list[Run]) -> list:
        text = b" ".join(collapsed(words, found)).decode("utf-8", "replace")
        return [len(words), *_measures(found), _listed(found), text]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _each(batches, lambda _, text: split(text), row, schema, keep)

    return docs.select(*keep, docs["text"].alias("_text")).mapInArrow(judge, schema)


def report(docs: DataFrame) -> DataFrame:
    """Digests of runs and collapsed words per document, after planting tails in one of ten documents."""

    def row(words: list[bytes], found: list[Run]) -> list:
        text = b" ".join(collapsed(words, found))
        return [*_measures(found), sha256(_listed(found).encode()).hexdigest(), sha256(text).hexdigest()]

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def words_of(doc_id: pa.Scalar, text: bytes | None) -> list[bytes]:
            return planted(doc_id.as_py(), split(text))

        return _each(batches, words_of, row, DIGESTS, ["doc_id"])

    columns = [docs["doc_id"], docs["doc_id"].alias("_id"), docs["text"].alias("_text")]
    return docs.select(*columns).mapInArrow(judge, DIGESTS)
