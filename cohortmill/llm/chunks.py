"""Substring deduplication with content-defined chunks.

A gear hash rolls over the bytes of a text: each byte shifts the hash by one bit and adds its own fixed
random number, so the hash depends on the last bytes alone. A chunk ends where the hash is the least among
its ``near`` neighbours on either side, so an end depends on the bytes around it and on nothing before: an
insertion changes the chunks that touch it and no others. Chunks are identified by a 128-bit digest of their
bytes. Of the places of a digest that occurs again, the first by document id, then text hash, then position
stays; the others are duplicates.

Sizes in bytes: ``near`` and more, about twice that on average, none above ``most``: longer stretches without a least are cut
into parts of equal length. A text of up to twice ``near`` is one chunk, however short. A chunk ends at a whole code
point. All chunks are compared.

Defined results: null and empty texts have no chunks. Repeated rows hold the same chunks, of which one stays.
Null ids come last. Very long texts are cut whole; other columns are not read. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortmill.llm.common import documents_only
from cohortmill.sources.checkpoints import written

NEAR, MOST = 32, 256
#: Bytes the hash depends on.
REACH = 16
SEED = 20240229


def gear_numbers() -> np.ndarray:
    """A random 32-bit number per byte value, the same everywhere."""
    return np.random.Generator(np.random.PCG64(SEED)).integers(0, 1 << 32, 256, dtype=np.uint32)


GEAR = gear_numbers()


def gear_hash(raw: np.ndarray) -> np.ndarray:
    """The hash after each byte, over the last REACH bytes: sum of the bytes' numbers, each shifted by its age."""
    total = GEAR[raw]
    size = 1
    while size < REACH:  # sums over 2, 4, ... bytes from sums of half as many
        older = np.zeros_like(total)
        older[size:] = total[:-size] << np.uint32(size)
        total += older
        size *= 2
    return total


def least_of(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each value and the ``width`` - 1 after it; the end is padded with the largest number."""
    low, size = values, 1
    while size < width:
        step = min(size, width - size)
        following = np.full_like(low, np.iinfo(low.dtype).max)
        following[:-step] = low[step:]
        low = np.minimum(low, following)
        size += step
    return low


def cuts(text: bytes, near: int = NEAR, most: int = MOST) -> list[int]:
    """Ends of the chunks of a text, in bytes; the last one is its length."""
    size = len(text)
    ends: list[int] = []
    if size > 2 * near:
        raw = np.frombuffer(text, np.uint8)
        hashes = gear_hash(raw)
        after = least_of(hashes, near + 1)
        before = np.full(size, np.iinfo(np.uint32).max, np.uint32)
        before[near:] = least_of(hashes, near)[: size - near]
        # Below all before, not above any after; not so near an end that a side is missing.
        found = np.flatnonzero((hashes[near : size - near] == after[near : size - near]) & (hashes < before)[near : size - near])
        start = 0
        for end in [*(found + near + 1).tolist(), size]:
            while end - start > most:
                parts = -(-(end - start) // most)
                start = _whole(raw, start + -(-(end - start) // parts))
                ends.append(start)
            if end < size:
                start = _whole(raw, end)
                ends.append(start)
    if size:
        ends.append(size)
    return ends


def _whole(raw: np.ndarray, end: int) -> int:
    """The end, moved back to where a code point begins."""
    while raw[end] & 0xC0 == 0x80:
        end -= 1
    return end


def chunked(docs: DataFrame, near: int = NEAR, most: int = MOST) -> DataFrame:
    """Per chunk: doc_id, text_hash, both halves of its digest, start and end (``behind``) in code points."""
    types = [("text_hash", T.LongType()), ("high", T.LongType()), ("low", T.LongType())]
    types += [("start", T.IntegerType()), ("behind", T.IntegerType())]
    schema = T.StructType([docs.schema["doc_id"], *[T.StructField(name, kind) for name, kind in types]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, whole, digests, starts, ends = [], [], [], [], []
            for row, text in enumerate(batch.column("_text")):
                text = text.as_py()
                if not text:
                    continue
                found = cuts(text, near, most)
                spans = list(zip([0, *found[:-1]], found, strict=True))
                digests += [xxhash.xxh3_128_digest(text[start:end]) for start, end in spans]
                rows += [row] * len(spans)
                whole += [xxhash.xxh3_64_intdigest(text)] * len(spans)
                at = np.array(spans, np.int64).reshape(-1, 2)
                if not text.isascii():
                    points = (np.frombuffer(text, np.uint8) & 0xC0) != 0x80
                    at = np.concatenate([[0], np.cumsum(points)])[at]
                starts.append(at[:, 0])
                ends.append(at[:, 1])
            halves = np.frombuffer(b"".join(digests), ">i8").astype(np.int64).reshape(-1, 2)
            columns = [np.array(whole, np.uint64).view(np.int64), halves[:, 0], halves[:, 1]]
            columns += [np.concatenate([[], *part]).astype(np.int32) for part in (starts, ends)]
            ids = batch.column("doc_id").take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, *map(pa.array, columns)], names=schema.fieldNames())

    return docs.select("doc_id", F.col("text").cast("binary").alias("_text")).mapInArrow(run, schema)


def repeated(docs: DataFrame, near: int = NEAR, most: int = MOST) -> DataFrame:
    """Every place of every chunk that occurs twice or more: doc_id, text_hash, digest, start, end, places
    (how many there are), and kept (the one that stays).

    Digests are counted with partial counts first; the places then join the repeated digests, a join that
    splits where one chunk is in very many documents.
    """
    found = written(chunked(docs, near, most))
    again = found.groupBy(F.col("high").alias("_high"), F.col("low").alias("_low"))
    again = again.agg(F.count(F.lit(1)).alias("places")).filter(F.col("places") > 1)
    same = (F.col("high") == F.col("_high")) & (F.col("low") == F.col("_low"))
    places = written(found.join(again, same).drop("_high", "_low"))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "start")
    keepers = places.groupBy(F.col("high").alias("_high"), F.col("low").alias("_low")).agg(F.min(place).alias("keeper"))
    digest = F.concat(*[F.lpad(F.lower(F.hex(half)), 16, "0") for half in ("high", "low")])
    return places.join(keepers, same).select(
        "doc_id",
        "text_hash",
        digest.alias("digest"),
        "start",
        F.col("behind").alias("end"),
        "places",
        (place == F.col("keeper")).alias("kept"),
    )


def deduplicated(docs: DataFrame, near: int = NEAR, most: int = MOST) -> DataFrame:
    """The documents without the chunks that another place keeps. Texts that are nothing else become empty."""
    docs = documents_only(docs)
    places = repeated(docs, near, most).filter(~F.col("kept"))
    span = F.struct("start", "end")
    # A row's chunks, so no list is longer than its text.
    gone = places.groupBy(F.col("doc_id").alias("_doc_id"), F.col("text_hash").alias("_hash"))
    gone = gone.agg(F.array_sort(F.array_distinct(F.collect_list(span))).alias("_gone"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text.as_py() for text in batch.column("text")]
            own = [None if text is None else xxhash.xxh3_64_intdigest(text.encode()) for text in texts]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([value and int(np.uint64(value).view(np.int64)) for value in own], pa.int64())], names=[*batch.schema.names, "_own"]
            )

    schema = T.StructType([*docs.schema.fields, T.StructField("_own", T.LongType())])
    match = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("_own") == F.col("_hash"))
    joined = docs.mapInArrow(digest, schema).join(gone, match, "left")
    ends = F.concat(F.transform("_gone", lambda span: span["start"]), F.array(F.length("text")))
    begins = F.concat(F.array(F.lit(0)), F.transform("_gone", lambda span: span["end"]))
    pieces = F.zip_with(begins, ends, lambda begin, end: F.substring("text", begin + 1, end - begin))
    text = F.when(F.col("_gone").isNull(), F.col("text")).otherwise(F.array_join(pieces, ""))
    kept = joined.withColumn("text", text)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)
