"""Near-duplicates by ProbMinHash signatures of weighted shingles.

Shingles are five words in a row; a shingle weighs 1 + log2 of its count in the text. Each shingle is a
Poisson process whose rate is its weight: its arrivals, drawn from its own hash, fall on random components of
the signature, and a component keeps the shingle that arrives first. A shingle stops as soon as its next
arrival is later than every component's first. Two signatures agree in a component with a probability equal
to the probability Jaccard similarity of the weighted shingles, which is the Jaccard similarity where no
shingle repeats.

Documents with one text are one node. Signatures are cut into bands; nodes with an equal band share a bucket.
Pairs in buckets are verified on their whole texts: a pair is linked where the probability Jaccard or the
Jaccard similarity of the shingles reaches the threshold. Classes are the connected components of the links.

Buckets may be large, so not every pair in them is made. First the members of a bucket meet its leader, the
node that shares buckets with most others: one pair a member. Nodes that are tied by such pairs, similar or
not, are one cluster. Where a cluster of three nodes or more is not one class by then, its texts outside of its
largest class are compared with all its texts, in blocks: a node goes once to each pair of blocks that its own is part
of, as shingles that are made once, a task compares two blocks at a time, and gives back no more links than tie its
classes. Blocks of the largest class never meet each other, so the work grows with what is undecided. No two nodes that share
a bucket and may be of different classes are left uncompared, no pairs are written out, and no task holds more than two blocks.

A text that repeats a shingle has a second signature with all weights 1, with bands of its own, so that pairs
are found by either similarity. With the default 24 bands of 5, a pair at the threshold of 0.8 in one of them
shares no bucket with a chance of 7 in 100,000.

Words: Unicode lower case, cut at white space. A text of fewer than five words is one shingle.

Defined results: a null text is a class of its own, and so is a text without words, but for its exact copies.
Classes are named after their least doc_id, null ids last; repeated rows are copies. Very long texts are shingled whole, a
block of their own if need be. Only doc_id and text are read; ``deduplicated`` keeps the columns of documents and leaves others out. An empty table gives an
empty result.
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
from cohortmill.llm.components import components
from cohortmill.sources.checkpoints import written

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 5
#: Shingles that are worked on at a time.
SLICE = 300_000
#: Characters of the texts of a block; one longer text is a block of its own, more or less.
BLOCK_CHARS = 500_000
#: Shingles of two blocks that are compared at a time.
COLUMNS = 4096


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hash_of = _WordHashes()


# The multipliers of a published 64-bit mixing function (splitmix64).
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def mixed(values: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit numbers."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(MIX[0])
    values = (values ^ (values >> np.uint64(27))) * np.uint64(MIX[1])
    return values ^ (values >> np.uint64(31))


_ORDER = mixed(np.arange(1, SHINGLE + 1, dtype=np.uint64)) | np.uint64(1)


def shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the different shingles of a text, in order, and their weights."""
    words = text.lower().split()
    if len(_hash_of) > 500_000:
        _hash_of.clear()
    hashes = np.fromiter(map(_hash_of.__getitem__, words), np.uint64, len(words))
    if not len(words):
        return hashes, np.zeros(0)
    size = min(SHINGLE, len(words))
    runs = np.zeros(len(words) - size + 1, np.uint64)
    for place in range(size):
        runs += hashes[place : len(words) - size + 1 + place] * _ORDER[place]
    found, counts = np.unique(mixed(runs), return_counts=True)
    return found, 1.0 + np.log2(counts)


def signatures(parts: list[tuple[np.ndarray, np.ndarray]], size: int) -> np.ndarray:
    """One row of ``size`` 32-bit numbers per list of weighted shingles; zeros where there is none."""
    lengths = np.array([len(hashes) for hashes, _ in parts])
    owner = np.repeat(np.arange(len(parts)), lengths)
    hashes = np.concatenate([np.zeros(0, np.uint64), *[hashes for hashes, _ in parts]])
    pace = 1.0 / np.concatenate([np.zeros(0), *[weights for _, weights in parts]])
    first = np.full(len(parts) * size, np.inf)
    kept = np.zeros(len(parts) * size, np.uint32)
    time = np.zeros(len(hashes))
    arrival = 0
    while len(hashes):
        arrival += 1
        step = np.uint64((arrival * 0x9E3779B97F4A7C15) & (2**64 - 1))
        drawn = mixed(hashes + step)
        time = time - np.log(((drawn >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) * pace
        component = (mixed(drawn + np.uint64(0x632BE59BD9B4E019)) >> np.uint64(32)) * np.uint64(size) >> np.uint64(32)
        place = owner * size + component.astype(np.int64)
        np.minimum.at(first, place, time)
        won = time == first[place]
        kept[place[won]] = (hashes[won] >> np.uint64(32)).astype(np.uint32)
        latest = first.reshape(len(parts), size).max(axis=1)
        left = time < latest[owner]
        owner, hashes, pace, time = owner[left], hashes[left], pace[left], time[left]
    return kept.reshape(len(parts), size)


def estimated(left: np.ndarray, right: np.ndarray) -> float:
    """Probability Jaccard similarity as two signatures estimate it."""
    return float(np.mean(left == right))


def similarity(left: tuple[np.ndarray, np.ndarray], right: tuple[np.ndarray, np.ndarray]) -> float:
    """The larger of the Jaccard and the probability Jaccard similarity of two lists of weighted shingles."""
    (a, a_weights), (b, b_weights) = left, right
    if not len(a) or not len(b):
        return 0.0
    common, in_a, in_b = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    plain = len(common) / (len(a) + len(b) - len(common))
    if not len(common) or (a_weights.max() == 1.0 and b_weights.max() == 1.0):
        return plain
    # Over the union, x = weights in a and y = weights in b. For a common shingle the larger of x / x_d and y / y_d
    # is the former where x / y is at least x_d / y_d, so sums over the union in the order of x / y are enough.
    only_a = np.delete(a_weights, in_a)
    only_b = np.delete(b_weights, in_b)
    x, y = a_weights[in_a], b_weights[in_b]
    ratio = x / y
    order = np.argsort(ratio)
    sorted_ratio = ratio[order]
    y_below = np.concatenate([[0.0], np.cumsum(y[order])])
    x_from = x.sum() - np.concatenate([[0.0], np.cumsum(x[order])])
    at = np.searchsorted(sorted_ratio, ratio, side="left")
    total = (x_from[at] + only_a.sum()) / x + (y_below[at] + only_b.sum()) / y
    return max(plain, float((1.0 / total).sum()))


def signed(docs: DataFrame, size: int = BANDS * ROWS) -> DataFrame:
    """Per document with a text: doc_id, digest of the text, n_shingles, signature; where a shingle repeats, the
    signature with all weights 1 comes behind it."""
    schema = T.StructType(
        [
            docs.schema["doc_id"],
            T.StructField("digest", T.BinaryType()),
            T.StructField("n_shingles", T.IntegerType()),
            T.StructField("signature", T.ArrayType(T.IntegerType())),
        ]
    )

    def both(parts: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray]:
        repeating = [n for n, (_, weights) in enumerate(parts) if len(weights) and weights.max() > 1.0]
        rows = list(signatures(parts, size)) if parts else []
        if repeating:
            plain = signatures([(parts[n][0], np.ones(len(parts[n][0]))) for n in repeating], size)
            for n, row in zip(repeating, plain, strict=True):
                rows[n] = np.concatenate([rows[n], row])
        return rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks, lengths, waiting = [], [], []
            for text in batch.column("_text"):
                waiting.append(shingles(text.as_py()))
                lengths.append(len(waiting[-1][0]))
                if sum(len(hashes) for hashes, _ in waiting[-1:]) and sum(lengths[-len(waiting) :]) > SLICE:
                    blocks += both(waiting)
                    waiting = []
            blocks += both(waiting)
            values = pa.array(np.concatenate([np.zeros(0, np.uint32), *blocks]).view(np.int32))
            offsets = pa.array(np.cumsum([0, *map(len, blocks)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    batch.column("digest"),
                    pa.array(lengths, pa.int32()),
                    pa.ListArray.from_arrays(offsets, values),
                ],
                names=schema.fieldNames(),
            )

    texts = docs.filter(F.col("text").isNotNull())
    texts = texts.select("doc_id", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"), F.col("text").alias("_text"))
    return texts.mapInArrow(run, schema)


def _buckets(nodes: DataFrame, bands: int, rows: int) -> DataFrame:
    """(bucket, node, degree) of buckets with two nodes or more; degree: nodes that a node shares buckets with."""
    # Bands of either signature meet those of either.
    numbers = F.sequence(F.lit(0), (F.size("signature") / rows).cast("int") - 1)
    keys = F.transform(numbers, lambda band: F.xxhash64(band % bands, F.slice("signature", band * rows + 1, rows)))
    keys = F.array_distinct(keys)
    banded = nodes.filter("n_shingles > 0").select(F.explode(keys).alias("bucket"), "node")
    sizes = banded.groupBy(F.col("bucket").alias("_bucket")).agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    shared = written(banded.join(sizes, F.col("bucket") == F.col("_bucket")).drop("_bucket"))
    degrees = shared.groupBy(F.col("node").alias("_node")).agg(F.sum("size").alias("degree"))
    return written(shared.join(degrees, F.col("node") == F.col("_node")).select("bucket", "node", "degree"))


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose texts are similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[int, tuple] = {}
        size = 0
        for batch in batches:
            rows = zip(*[batch.column(name) for name in ("a", "b", "text_a", "text_b")], strict=True)
            similar = []
            for a, b, text_a, text_b in rows:
                sides = []
                for node, text in ((a.as_py(), text_a), (b.as_py(), text_b)):
                    if node not in known:
                        if size > 2_000_000:
                            known.clear()
                            size = 0
                        known[node] = shingles(text.as_py())
                        size += len(known[node][0])
                    sides.append(known[node])
                similar.append(similarity(*sides) >= threshold - 1e-12)
            yield batch.select(["a", "b"]).filter(pa.array(similar, pa.bool_()))

    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def _overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Number of common shingles of each text on the left with each on the right.

    Products of 0/1 matrices over slices of the shingles that occur on both sides.
    """
    result = np.zeros((len(left), len(right)), np.float32)
    own, other = (np.concatenate([np.zeros(0, np.uint64), *side]) for side in (left, right))
    shared = np.intersect1d(own, other)
    for start in range(0, len(shared), COLUMNS):
        part = shared[start : start + COLUMNS]
        sides = []
        for texts, every in ((left, own), (right, other)):
            rows = np.repeat(np.arange(len(texts)), [len(text) for text in texts])
            at = np.minimum(np.searchsorted(part, every), len(part) - 1)
            hit = part[at] == every
            matrix = np.zeros((len(texts), len(part)), np.float32)
            matrix[rows[hit], at[hit]] = 1.0
            sides.append(matrix)
        result += sides[0] @ sides[1].T
    return result


def _links_between(left: list[tuple], right: list[tuple], threshold: float, inside: bool) -> list[tuple[int, int]]:
    """Links (class, class) that tie the classes of similar texts of two blocks, given as (class, shingles, weights)."""
    common = _overlaps([hashes for _, hashes, _ in left], [hashes for _, hashes, _ in right])
    sizes = [np.array([len(hashes) for _, hashes, _ in side], np.float32) for side in (left, right)]
    union = np.maximum(sizes[0][:, None] + sizes[1][None, :] - common, 1.0)
    weighted = [np.array([len(w) > 0 and w.max() > 1.0 for _, _, w in side], bool) for side in (left, right)]
    similar = common >= (threshold - 1e-6) * union
    unsure = (common > 0) & (weighted[0][:, None] | weighted[1][None, :]) & ~similar
    roots: dict[int, int] = {}

    def root(name: int) -> int:
        while roots.setdefault(name, name) != name:
            name = roots[name]
        return name

    links = []
    for rows, sure in ((np.argwhere(similar), True), (np.argwhere(unsure), False)):
        for i, j in rows:
            if inside and i >= j:
                continue
            a, b = root(left[i][0]), root(right[j][0])
            if a != b and (sure or similarity(left[i][1:], right[j][1:]) >= threshold - 1e-12):
                roots[max(a, b)] = min(a, b)
                links.append((min(a, b), max(a, b)))
    return links


def _shingled(texts: DataFrame) -> DataFrame:
    """Texts as bytes of their shingles' hashes and weights (no weights where all are 1)."""
    schema = T.StructType([*[f for f in texts.schema if f.name != "text"], T.StructField("hashes", T.BinaryType()), T.StructField("weights", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shingles(text.as_py()) for text in batch.column("text")]
            arrays = [batch.column(name) for name in schema.fieldNames()[:-2]]
            arrays.append(pa.array([hashes.tobytes() for hashes, _ in made], pa.binary()))
            arrays.append(pa.array([w.tobytes() if len(w) and w.max() > 1.0 else b"" for _, w in made], pa.binary()))
            yield pa.RecordBatch.from_arrays(arrays, names=schema.fieldNames())

    return texts.mapInArrow(run, schema)


def _compared(nodes: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between the classes of similar texts of a cluster; nodes: (node, cluster, class)."""
    sized = nodes.join(texts.withColumnRenamed("node", "_node"), F.col("node") == F.col("_node")).drop("_node")
    sized = written(_shingled(sized.withColumn("chars", F.length("text"))))
    classes = sized.groupBy("cluster", "class").agg(F.sum("chars").alias("chars"))
    # The largest class of a cluster is one already: its texts only meet the others.
    largest = F.max(F.struct("chars", "class"))["class"].alias("largest")
    needed = lambda chars: F.greatest(F.ceil(chars / BLOCK_CHARS), F.lit(1))
    blocks = classes.groupBy(F.col("cluster").alias("_cluster")).agg(
        largest, F.sum("chars").alias("_all"), F.max("chars").alias("_most")
    )
    blocks = blocks.select("_cluster", "largest", needed(F.col("_all") - F.col("_most")).alias("others"), needed(F.col("_most")).alias("large"))
    dealt = sized.join(blocks, F.col("cluster") == F.col("_cluster"))
    place, is_large = F.xxhash64("node"), F.col("class") == F.col("largest")
    dealt = dealt.withColumn(
        "block", F.when(is_large, F.col("others") + F.pmod(place, F.col("large"))).otherwise(F.pmod(place, F.col("others")))
    )
    last = F.when(is_large, F.col("others")).otherwise(F.col("others") + F.col("large")) - 1
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
    keys = ["cluster", "low", "high"]
    met = dealt.select(
        "cluster",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        "block",
        "class",
        "hashes",
        "weights",
    )
    met = met.repartition(*keys).sortWithinPartitions(*keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def answer(key: tuple, sides: tuple[list, list]) -> pa.RecordBatch:
            inside = key[1] == key[2]
            links = _links_between(sides[0], sides[0] if inside else sides[1], threshold, inside)
            ends = [pa.array([link[end] for link in links], pa.int64()) for end in (0, 1)]
            return pa.RecordBatch.from_arrays(ends, names=["a", "b"])

        current, sides = None, ([], [])
        for batch in batches:
            for row in zip(*[batch.column(name) for name in (*keys, "block", "class", "hashes", "weights")], strict=True):
                key = tuple(value.as_py() for value in row[:3])
                if key != current:
                    if current is not None:
                        yield answer(current, sides)
                    current, sides = key, ([], [])
                hashes = np.frombuffer(row[5].as_py(), np.uint64)
                weights = np.frombuffer(row[6].as_py(), np.float64) if len(row[6].as_py()) else np.ones(len(hashes))
                sides[row[3].as_py() != key[1]].append((row[4].as_py(), hashes, weights))
        if current is not None:
            yield answer(current, sides)

    return met.mapInArrow(run, "a long, b long")


def _classes(members: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(node, class) of all nodes in buckets."""
    leaders = members.groupBy(F.col("bucket").alias("_bucket")).agg(F.max(F.struct("degree", "node")).alias("best"))
    leaders = leaders.select("_bucket", F.col("best.node").alias("leader"))
    meeting = members.join(leaders, F.col("bucket") == F.col("_bucket")).filter("node <> leader")
    pairs = written(
        meeting.select(F.least("node", "leader").alias("a"), F.greatest("node", "leader").alias("b")).distinct()
    )
    clusters = components(pairs).withColumnRenamed("root", "cluster")
    similar = components(_verified(pairs, texts, threshold)).withColumnRenamed("node", "_node")
    nodes = clusters.join(similar, F.col("node") == F.col("_node"), "left")
    nodes = written(nodes.select("node", "cluster", F.coalesce("root", "node").alias("class")))
    several = nodes.groupBy(F.col("cluster").alias("_cluster"))
    several = several.agg(F.count(F.lit(1)).alias("n"), F.min("class").alias("least"), F.max("class").alias("most"))
    several = several.filter("n > 2 and least <> most").select("_cluster")
    open_nodes = nodes.join(several, F.col("cluster") == F.col("_cluster")).select("node", "cluster", "class")
    ties = components(_compared(open_nodes, texts, threshold)).withColumnRenamed("node", "_class")
    tied = nodes.join(ties, F.col("class") == F.col("_class"), "left")
    return written(tied.select("node", F.coalesce("root", "class").alias("class")))


def classify(
    docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """Per document: doc_id, digest of its text, same_text_id (least id with this text), class_id (least id of
    the class), and kept (the document the class is named after)."""
    signatures_of = written(signed(docs, bands * rows))
    nodes = signatures_of.groupBy("digest").agg(
        F.min("doc_id").alias("same_text_id"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("signature").alias("signature"),
    )
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()))
    members = _buckets(nodes, bands, rows)
    suspects = members.select("node").distinct().join(nodes.select("node", "digest", "same_text_id"), "node")
    suspects = suspects.withColumnsRenamed({"digest": "_digest", "same_text_id": "_first"})
    keyed = docs.select("doc_id", "text", F.unhex(F.md5(F.col("text").cast("binary"))).alias("digest"))
    # One row per text: copies with another id don't match, repeated rows may, and are told by nothing.
    match = (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_first"))
    texts = written(keyed.join(suspects.hint("shuffle_hash"), match).select("node", "text"))
    repeated = texts.groupBy("node").count().filter("count > 1").select("node")
    if not repeated.isEmpty():
        single = texts.join(repeated, "node", "left_anti")
        texts = written(single.unionByName(texts.join(repeated, "node", "left_semi").dropDuplicates(["node"])))
    classes = _classes(members, texts, threshold).withColumnRenamed("node", "_node")
    joined = nodes.select("node", "digest", "same_text_id").join(classes, F.col("node") == F.col("_node"), "left")
    joined = written(joined.select("digest", "same_text_id", F.coalesce("class", "node").alias("class")))
    names = joined.groupBy(F.col("class").alias("_class")).agg(F.min("same_text_id").alias("class_id"))
    named = joined.join(names, F.col("class") == F.col("_class"))
    # Where ids repeat with other texts, the class's name may be several texts' id: the least digest is kept.
    keeper = named.filter(F.col("same_text_id").eqNullSafe(F.col("class_id")))
    keeper = keeper.groupBy(F.col("class").alias("_kept_class")).agg(F.min("digest").alias("_kept_digest"))
    named = named.join(keeper, F.col("class") == F.col("_kept_class"))
    named = named.select(
        F.col("digest").alias("_digest"),
        "same_text_id",
        "class_id",
        (F.col("digest") == F.col("_kept_digest")).alias("_keeps"),
    )
    found = signatures_of.select("doc_id", "digest").join(named, F.col("digest") == F.col("_digest"))
    found = found.select(
        "doc_id",
        "digest",
        "same_text_id",
        "class_id",
        (F.col("_keeps") & F.col("doc_id").eqNullSafe(F.col("same_text_id"))).alias("kept"),
    )
    own = docs.filter(F.col("text").isNull()).select(
        "doc_id",
        F.lit(None).cast("binary").alias("digest"),
        F.col("doc_id").alias("same_text_id"),
        F.col("doc_id").alias("class_id"),
        F.lit(True).alias("kept"),
    )
    return found.unionByName(own)


def deduplicated(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """The documents that their classes are named after, one row each."""
    docs = documents_only(docs)
    kept = classify(docs, threshold, bands, rows).filter(F.col("kept") & F.col("digest").isNotNull())
    kept = kept.groupBy(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest")).agg(F.count(F.lit(1)).alias("_rows"))
    keyed = docs.withColumn("_own", F.unhex(F.md5(F.col("text").cast("binary"))))
    match = (F.col("_own") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    joined = keyed.join(kept, match)
    repeated = joined.filter("_rows > 1").dropDuplicates(["_id", "_digest"])
    one_each = joined.filter("_rows = 1").unionByName(repeated).select(*docs.columns)
    return one_each.unionByName(docs.filter(F.col("text").isNull()))
