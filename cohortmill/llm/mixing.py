"""Mixing sources to target weights by weighted fair queueing.

Each document enters its source's queue in a shuffled order and gets a virtual finish time: the tokens of
its source up to and including it, divided by the source's weight. All queues are merged by finish time in
one global order, which is cut at the token budget. A source that has given all it may give leaves the
others to share what remains by weight, as its queue is empty.

A source may be queued several times (``epochs``), so none gives more than that many times its size.

Defined results: null text has no tokens and null sources are one source, ordered last. Documents without
tokens are taken as often as they come before the cut, which adds nothing. The shuffle follows from key,
text and seed, so that reruns agree; rows equal in all of these are interchangeable. Empty tables give
empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortmill.llm.common import documents_only, n_words, running_total
from cohortmill.sources.checkpoints import written

WEIGHTS = (1, 2, 3)
EPOCHS = 3


def cycled_weights(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Sources by code point, null last, with the weights in turn."""
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    turn = F.element_at(F.array(*map(F.lit, weights)), (rank % len(weights) + 1).cast("int"))
    return sources.withColumn("weight", turn.cast("long"))


def targets(sources: DataFrame, share: float = 1.0, epochs: int = EPOCHS) -> DataFrame:
    """Adds ``target``: ``share`` of all sizes by weight, none above ``epochs`` times its source's size.

    Sources in the order in which they fill up; the level at which the rest shares is the largest one that
    leaves no earlier source unfilled. One row per source.
    """
    limit = F.col("source_size") * epochs
    filling = Window.orderBy((limit / F.col("weight")), F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    budget = F.sum("source_size").over(everything) * F.lit(share)
    full = F.coalesce(F.sum(limit).over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(
        F.sum("weight").over(filling.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    at = sources.withColumn("_level", (budget - full) / open_weight).withColumn("_full_at", limit / F.col("weight"))
    # The first source that isn't full at the level it would share sets the level for all after it.
    first = F.min(F.when(F.col("_full_at") >= F.col("_level"), F.col("_full_at"))).over(everything)
    sets = (F.col("_full_at") == first) & (F.col("_full_at") >= F.col("_level"))
    level = F.max(F.when(sets, F.col("_level"))).over(everything)
    level = F.coalesce(level, F.max("_full_at").over(everything))
    target = F.least(limit.cast("double"), level * F.col("weight"))
    return at.withColumn("target", target).drop("_level", "_full_at")


def shuffle_key(key: Column, text: Column, seed: int) -> Column:
    """A digest that orders the queue."""
    parts = [F.coalesce(key.cast("string"), F.lit("")), F.coalesce(F.md5(text.cast("binary")), F.lit("")), F.lit(str(seed))]
    return F.md5(F.concat_ws(":", *parts).cast("binary"))


def schedule(
    docs: DataFrame, weights: DataFrame | None = None, share: float = 1.0, epochs: int = EPOCHS, seed: int = 1
) -> tuple[DataFrame, DataFrame]:
    """The queue entries of all documents and what each source is due.

    Entries: doc_id, source, size, source_size, target, shuffle, epoch, finish, position (tokens of the mix up
    to and including the entry) and in_mix. ``weights``: rows of (source, weight); by default 1, 2, 3 in turn.
    """
    sized = written(
        docs.select(
            "doc_id",
            "source",
            n_words(F.col("text")).alias("size"),
            shuffle_key(F.col("doc_id"), F.col("text"), seed).alias("shuffle"),
        )
    )
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    if weights is None:
        weighed = cycled_weights(sources)
    else:
        named = weights.select(F.col("source").alias("_source"), "weight")
        weighed = sources.join(named, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    due = written(targets(weighed, share, epochs))
    queued = running_total(sized, ["source"], ["shuffle", "doc_id"], "size", "_upto")
    due_for = due.withColumnRenamed("source", "_source")
    entries = queued.join(due_for, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    entries = entries.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(epochs - 1))))
    finish = (F.col("epoch") * F.col("source_size") + F.col("_upto")) / F.col("weight")
    merged = running_total(
        entries.withColumn("finish", finish).drop("_upto"),
        [],
        ["finish", "source", "epoch", "shuffle", "doc_id"],
        "size",
        "position",
    )
    budget = (due.agg(F.sum("source_size")).first()[0] or 0) * share
    return merged.withColumn("in_mix", F.col("position") <= F.lit(budget)), due


def mix(docs: DataFrame, share: float = 1.0, epochs: int = EPOCHS, seed: int = 1) -> DataFrame:
    """Per document: doc_id, source, shuffle, size, source_size, target, times (how often the mix takes it) and taken."""
    entries, _ = schedule(docs, None, share, epochs, seed)
    # The epochs of one row are told from those of an equal row by nothing, and need not be: they are counted together
    # and dealt out evenly.
    names = ["doc_id", "source", "shuffle", "size", "source_size", "target"]
    counted = entries.groupBy(*names).agg(
        F.sum(F.col("in_mix").cast("long")).alias("_taken"), (F.count(F.lit(1)) / epochs).cast("long").alias("_rows")
    )
    rows = counted.withColumn("_row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_rows"))))
    times = F.floor(F.col("_taken") / F.col("_rows")) + (F.col("_row") <= F.col("_taken") % F.col("_rows")).cast("long")
    return rows.withColumn("times", times).withColumn("taken", F.col("times") * F.col("size")).drop(
        "_taken", "_rows", "_row"
    )


def mixed_documents(docs: DataFrame, share: float = 1.0, epochs: int = EPOCHS, seed: int = 1) -> DataFrame:
    """The documents themselves, each as often as the mix takes it; rows equal in key, source and text are one."""
    docs = documents_only(docs)
    chosen = mix(docs, share, epochs, seed).groupBy("doc_id", "source", "shuffle")
    chosen = chosen.agg(F.sum("times").cast("int").alias("_times"), F.count(F.lit(1)).alias("_rows"))
    chosen = chosen.filter(F.col("_times") > 0).withColumnsRenamed(
        {"doc_id": "_doc_id", "source": "_source", "shuffle": "_key"}
    )
    keyed = docs.withColumn("_shuffle", shuffle_key(F.col("doc_id"), F.col("text"), seed))
    match = (
        F.col("doc_id").eqNullSafe(F.col("_doc_id"))
        & F.col("source").eqNullSafe(F.col("_source"))
        & (F.col("_shuffle") == F.col("_key"))
    )
    joined = keyed.join(chosen, match)
    alone = joined.filter(F.col("_rows") == 1)
    repeated = joined.filter(F.col("_rows") > 1).dropDuplicates(["_doc_id", "_source", "_key"])
    copies = F.explode(F.sequence(F.lit(1), F.col("_times")))
    return alone.unionByName(repeated).withColumn("_copy", copies).select(*docs.columns)
