"""Line deduplication with content-defined chunks of lines.

A hash of two neighbouring lines with a word (and what stands between them) rolls over every text. Where its
value occurs at no second place of the corpus, a chunk ends: so chunks are the longest stretches of lines whose
every pair of neighbours occurs elsewhere too. Boundaries depend on the lines beside them alone, a line
that is put in or left out changes nothing further on, and a chunk has two lines with words or more. (A boundary wherever the hash divides by some
number would cut short blocks at random: of blocks of two lines it finds hardly any.)

Of the places of a pair the first stays, by document id, text digest and line; the lines of all others go, so each line
that goes still stands at an earlier place. Digests bring places together, and their bytes decide: texts
of pairs are grouped as they are, with partial groups first, and where texts with one digest differ, none of them
is removed. Only pairs that occur twice are compared. Built-in functions only.

Defined results: null text has no lines and stays null; empty text is one empty line. Lines without a word
(anything but white space) go with the pair that they stand in; alone they stay. Rows that are equal in id and text lose the same
lines. Null ids come last. Very long texts are read whole. Columns that documents don't have are left out. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmill.llm.common import documents_only
from cohortmill.sources.checkpoints import written

WORD = r"[^\x20\x09-\x0D]"


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def _body(lines: Column, first: Column, last: Column) -> Column:
    """Lines from one to another with a word, as text. A slice reads all lines of the document, so neighbours and those with
    one line between are picked one by one."""

    def picked(count: int) -> Column:
        return F.concat_ws("\n", *[F.element_at(lines, first + at) for at in range(count)])

    gap = last - first
    return F.when(gap == 1, picked(2)).when(gap == 2, picked(3)).otherwise(F.array_join(F.slice(lines, first, gap + 1), "\n"))


def pairs(docs: DataFrame) -> DataFrame:
    """Every pair of neighbouring lines with a word: doc_id, digest (of the document), first, last (lines from 1), chunk (the
    pair's digest)."""
    lines = docs.filter(F.col("text").isNotNull())
    lines = lines.select("doc_id", _digest(F.col("text")).alias("digest"), F.split("text", "\n", -1).alias("lines"))
    worded = F.filter(F.sequence(F.lit(1), F.size("lines")), lambda at: F.element_at("lines", at).rlike(WORD))
    lines = lines.withColumn("worded", worded)

    def pair(first: Column, last: Column) -> Column:
        return F.struct(first.alias("first"), last.alias("last"), _digest(_body(F.col("lines"), first, last)).alias("chunk"))

    # Texts of pairs are not carried along, as together they are twice the document.
    count = F.greatest(F.size("worded") - 1, F.lit(0))
    pairs_of = F.zip_with(F.slice("worded", F.lit(1), count), F.slice("worded", F.lit(2), count), pair)
    found = lines.select("doc_id", "digest", pairs_of.alias("pairs"))
    # With the outer form no filter on the array's size is moved below, which would cut the text anew for every line.
    return found.select("doc_id", "digest", F.explode_outer("pairs").alias("p")).filter("p is not null").select("doc_id", "digest", "p.*")


def repeated(docs: DataFrame) -> DataFrame:
    """Every place of a pair with several places: doc_id, digest, first, last, chunk, kept (whether it is the one that stays)."""
    every = written(pairs(docs))
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest", "first")
    keepers = every.groupBy(F.col("chunk").alias("_chunk")).agg(F.count(F.lit(1)).alias("places"), F.min(place).alias("keeper"))
    keepers = keepers.filter("places > 1").drop("places")
    places = every.join(keepers, F.col("chunk") == F.col("_chunk"))
    places = written(places.withColumn("kept", place == F.col("keeper")).drop("_chunk", "keeper"))
    texts = _with_places(docs.select("doc_id", "text"), places, "inner")
    texts = texts.withColumn("_lines", F.split("text", "\n", -1))
    bodies = F.transform("_places", lambda p: F.struct(p["chunk"].alias("chunk"), _body(F.col("_lines"), p["first"], p["last"]).alias("body")))
    bodies = texts.select(F.explode_outer(F.array_distinct(bodies)).alias("b")).select("b.chunk", "b.body").distinct()
    differing = bodies.groupBy(F.col("chunk").alias("_chunk")).agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1")
    return places.join(differing, F.col("chunk") == F.col("_chunk"), "left_anti")


def _with_places(docs: DataFrame, places: DataFrame, how: str) -> DataFrame:
    """Documents with ``_places``, an array of their places (first, last, chunk), no longer than their lines."""
    own = places.groupBy(F.col("doc_id").alias("_doc_id"), F.col("digest").alias("_digest"))
    own = own.agg(F.array_sort(F.collect_set(F.struct("first", "last", "chunk"))).alias("_places"))
    keyed = docs.withColumn("_own", _digest(F.col("text")))
    match = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("_own") == F.col("_digest"))
    return keyed.join(own.hint("shuffle_hash"), match, how).drop("_doc_id", "_digest", "_own")


def deduplicated(docs: DataFrame) -> DataFrame:
    """Per document: its columns with the text that stays, n_lines, n_removed_chunks and n_removed_lines."""
    docs = documents_only(docs)
    gone = repeated(docs).filter(~F.col("kept"))
    joined = _with_places(docs, gone, "left").withColumn("_lines", F.split("text", "\n", -1))
    span = "array<struct<first:int,last:int>>"

    def step(done: Column, place: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        one = F.array(F.struct(place["first"].alias("first"), place["last"].alias("last"))).cast(span)
        longer = F.array(F.struct(last["first"].alias("first"), F.greatest(last["last"], place["last"]).alias("last"))).cast(span)
        # Pairs that share a line, or stand side by side, are one chunk.
        touches = F.coalesce(last["last"] >= place["first"] - 1, F.lit(False))
        return F.when(touches, F.concat(F.slice(done, 1, F.size(done) - 1), longer)).otherwise(F.concat(done, one))

    places = F.coalesce("_places", F.array().cast("array<struct<first:int,last:int,chunk:binary>>"))
    joined = joined.withColumn("_gone", F.aggregate(places, F.array().cast(span), step))
    # Lines between the removed chunks, in order.
    begins = F.concat(F.array(F.lit(1)), F.transform("_gone", lambda c: c["last"] + 1))
    ends = F.concat(F.transform("_gone", lambda c: c["first"] - 1), F.array(F.size("_lines")))
    runs = F.zip_with(begins, ends, lambda begin, end: F.slice(F.col("_lines"), begin, end - begin + 1))
    text = F.when(F.size("_gone") > 0, F.array_join(F.flatten(runs), "\n")).otherwise(F.col("text"))
    removed = F.aggregate("_gone", F.lit(0).cast("bigint"), lambda n, c: n + c["last"] - c["first"] + 1)
    n_lines = F.coalesce(F.size("_lines"), F.lit(0))
    counted = joined.select(
        *[text.alias("text") if name == "text" else F.col(name) for name in docs.columns],
        F.greatest(n_lines, F.lit(0)).cast("bigint").alias("n_lines"),
        F.size("_gone").cast("bigint").alias("n_removed_chunks"),
        removed.alias("n_removed_lines"),
    )
    return counted
