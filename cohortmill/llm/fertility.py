"""Quality rules from tokeniser fertility.

A public byte-level vocabulary, which is only read, splits every document into tokens. Measured per
document: characters per token, share of tokens that are no whole characters (byte fallback), and entropy of
the tokens, of which the bands use what it lacks to that of as many different tokens. Bands around the usual values are learned for each language and size of document, and a document
outside a band is rejected. Plain rules on words, repeats and signs stand beside the bands.

The language is the ``lang`` column; where it is null, the script of most letters. Bands come from counts
of all documents over a fixed grid: medians and median distances, so that neither a hot source nor junk
moves them far. A language and size with fewer than ``least_docs`` documents uses the bands of its language
and none for entropy, which depends on size; a language with fewer than that rejects nothing.

Defined results: null text has no words and tokens, fails the plain rules and is left out of the bands, as is
text without tokens. Runs of 1,000 and more characters without a space, or of white space, are tokenised in slices of that
length, as merging takes time by the square of a run; the text between them, with the space before a run and the one behind, is
tokenised whole. Ties keep a document: the bands' ends are inside. Very long texts are measured whole.
Repeated rows are measured each, and an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortmill.sources.checkpoints import written

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how this vocabulary's library cuts text before merging.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
SPACE = b" \t\n\v\f\r"
SYMBOLS = b"#*$%&|<>"
LONG = 1000
LONG_RUN = re.compile(rf" ?\S{{{LONG},}}|\s{{{LONG},}}")
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED = 30
SCRIPTS = {"latin": r"\p{IsLatin}", "cyrillic": r"\p{IsCyrillic}", "arabic": r"\p{IsArabic}", "han": r"\p{IsHan}"}
GRID = {"chars_per_token": 0.02, "byte_share": 0.005, "entropy_lack": 0.05}
# Least half width of a band, in the metric's own unit.
LEAST_WIDTH = {"chars_per_token": 0.6, "byte_share": 0.1, "entropy_lack": 1.0}
METRICS = [
    ("n_words", T.LongType()),
    ("word_chars", T.LongType()),
    ("n_symbols", T.LongType()),
    ("n_dup_lines", T.LongType()),
    ("n_repeat_words", T.LongType()),
    ("n_tokens", T.LongType()),
    ("chars_per_token", T.DoubleType()),
    ("byte_share", T.DoubleType()),
    ("entropy", T.DoubleType()),
]


class Tokens:
    """The vocabulary, and which of its entries are no whole characters."""

    def __init__(self, ranks_file: bytes):
        import tiktoken

        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks_file.splitlines())}
        self.encoding = tiktoken.Encoding("read", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.partial = np.zeros(max(ranks.values()) + 1, bool)
        for token, rank in ranks.items():
            try:
                token.decode()
            except UnicodeDecodeError:
                self.partial[rank] = True

    def of(self, text: str) -> np.ndarray:
        encode = self.encoding.encode_ordinary
        found: list[int] = []
        done = 0
        for run in LONG_RUN.finditer(text):
            # The last white space before a word is part of the word's token, as is the one before a long run.
            end = run.end() - 1 if run[0].isspace() and run.end() < len(text) else run.end()
            found += encode(text[done : run.start()])
            for at in range(run.start(), end, LONG):
                found += encode(text[at : min(at + LONG, end)])
            done = end
        return np.array(found + encode(text[done:]), np.int64)


_made: dict[bytes, Tokens] = {}


def _tokens(ranks_file: bytes) -> Tokens:
    """This worker's vocabulary; kept from task to task."""
    key = hashlib.md5(ranks_file).digest()
    if key not in _made:
        _made[key] = Tokens(ranks_file)
    return _made[key]


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside windows that occur twice or more, the first occurrence included."""
    n = len(words)
    if n <= window or len(set(words)) == n:
        return 0
    numbers: dict[bytes, int] = {}
    run = np.fromiter((numbers.setdefault(word, len(numbers)) for word in words), np.int64, n)
    # Runs of 2, 4, 8 words get numbers from pairs of runs of half the length, so equal numbers are equal words.
    size = 1
    while size < window:
        step = min(size, window - size)
        pairs = run[: n - size - step + 1] * (run.max() + 1) + run[step : n - size + 1]
        run = np.unique(pairs, return_inverse=True)[1]
        size += step
    starts = np.flatnonzero(np.bincount(run)[run] > 1)
    cover = np.zeros(n + 1, np.int64)
    np.add.at(cover, starts, 1)
    np.add.at(cover, starts + window, -1)
    return int(np.count_nonzero(np.cumsum(cover[:n])))


def measured(text: str | None, tokens: Tokens) -> tuple:
    """METRICS of one text."""
    if not text:
        return 0, 0, 0, 0, 0, 0, None, None, None
    raw = text.encode()
    words = raw.split()
    n_space = len(raw) - len(raw.translate(None, SPACE))
    n_symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    lines = [line for line in raw.split(b"\n") if line.strip()]
    found = tokens.of(text)
    counts = np.unique(found, return_counts=True)[1]
    shares = counts / max(1, len(found))
    return (
        len(words),
        len(text) - n_space,
        n_symbols,
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(found),
        len(text) / len(found),
        float(np.count_nonzero(tokens.partial[found]) / len(found)),
        float(-(shares * np.log2(shares)).sum()),
    )


def measure(docs: DataFrame, keep: list[str], vocabulary: str = VOCABULARY) -> DataFrame:
    """The named columns, METRICS, ``kind`` (language or script), ``octave`` (log2 of the token count) and ``entropy_lack``."""
    with open(vocabulary, "rb") as file:  # about 1 MB, sent along so that executors need no file
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    fields = [T.StructField(name, kind) for name, kind in METRICS]
    kind = F.col("lang").cast("string")
    if "lang" not in docs.columns:
        kind = F.lit(None).cast("string")
    letters = {name: F.regexp_count("text", F.lit(pattern)) for name, pattern in SCRIPTS.items()}
    most = F.greatest(*letters.values())
    script = F.coalesce(*[F.when((n == most) & (n > 0), F.lit(name)) for name, n in letters.items()], F.lit("other"))
    kind = F.when(kind.isNotNull(), kind).otherwise(script)
    schema = T.StructType([*[docs.schema[name] for name in keep], T.StructField("kind", T.StringType()), *fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _tokens(shared.value)
        types = [pa.int64() if isinstance(kind, T.LongType) else pa.float64() for _, kind in METRICS]
        for batch in batches:
            rows = [measured(text.as_py(), tokens) for text in batch.column("_text")]
            columns = zip(*rows, strict=True) if rows else [()] * len(METRICS)
            arrays = [pa.array(values, kind) for values, kind in zip(columns, types, strict=True)]
            kept = [batch.column(name) for name in [*keep, "kind"]]
            yield pa.RecordBatch.from_arrays([*kept, *arrays], names=schema.fieldNames())

    source = docs.select(*keep, kind.alias("kind"), F.col("text").alias("_text"))
    found = source.mapInArrow(run, schema)
    size = F.when(F.col("n_tokens") > 0, F.log2("n_tokens"))
    return found.withColumns(
        {"octave": F.coalesce(F.floor(size), F.lit(-1)), "entropy_lack": F.greatest(size - F.col("entropy"), F.lit(0.0))}
    )


def bands(measures: DataFrame, spread: float = 6.0, least_docs: int = 50) -> DataFrame:
    """Per kind and octave: low and high of each metric. One row for each pair that occurs.

    Counts over the grid, one row per cell, are all that meets in one place.
    """
    cells = F.explode(
        F.array(
            *[
                F.struct(F.lit(name).alias("metric"), F.round(F.col(name) / step).cast("long").alias("cell"))
                for name, step in GRID.items()
            ]
        )
    )
    each = measures.filter("n_tokens > 0").select("kind", "octave", cells.alias("c"))
    counts = each.groupBy("kind", "octave", "c.metric", "c.cell").agg(F.count(F.lit(1)).alias("n"))
    counts = written(counts)

    def centre(of: DataFrame, keys: list[str], value: str) -> DataFrame:
        """The lower median of a counted value."""
        at = Window.partitionBy(*keys).orderBy(value)
        upto = of.withColumn("upto", F.sum("n").over(at)).withColumn("all", F.sum("n").over(Window.partitionBy(*keys)))
        upto = upto.filter(F.col("upto") * 2 >= F.col("all"))
        return upto.groupBy(*keys).agg(F.min(value).alias("centre"), F.first("all").alias("docs"))

    def widths(keys: list[str]) -> DataFrame:
        counted = counts.groupBy(*keys, "metric", "cell").agg(F.sum("n").alias("n"))
        middle = centre(counted, [*keys, "metric"], "cell")
        away = counted.join(middle, [*keys, "metric"])
        away = away.withColumn("away", F.abs(F.col("cell") - F.col("centre")))
        away = away.groupBy(*keys, "metric", "away").agg(F.sum("n").alias("n"))
        near = centre(away, [*keys, "metric"], "away").withColumnRenamed("centre", "away").drop("docs")
        return middle.join(near, [*keys, "metric"])

    fine, coarse = widths(["kind", "octave"]), widths(["kind"])
    coarse = coarse.withColumnsRenamed({"centre": "all_centre", "away": "all_away", "docs": "all_docs"})
    both = fine.join(coarse, ["kind", "metric"])
    enough = F.col("docs") >= least_docs
    step = F.element_at(F.create_map(*[F.lit(x) for pair in GRID.items() for x in pair]), F.col("metric"))
    least = F.element_at(F.create_map(*[F.lit(x) for pair in LEAST_WIDTH.items() for x in pair]), F.col("metric"))
    middle = F.when(enough, F.col("centre")).otherwise(F.col("all_centre")) * step
    width = F.greatest(F.when(enough, F.col("away")).otherwise(F.col("all_away")) * step * spread, least)
    usable = (F.col("all_docs") >= least_docs) & (enough | (F.col("metric") != "entropy_lack"))
    width = F.when(usable, width).otherwise(F.lit(float("inf")))
    ends = both.select("kind", "octave", "metric", (middle - width).alias("low"), (middle + width).alias("high"))
    picked = [
        F.max(F.when(F.col("metric") == name, F.col(end))).alias(f"{name}_{end}") for name in GRID for end in ("low", "high")
    ]
    return ends.groupBy("kind", "octave").agg(*picked)


def judge(docs: DataFrame, keep: list[str], vocabulary: str = VOCABULARY) -> DataFrame:
    """The named columns, METRICS, base_failed, one verdict per band (``odd_...``) and kept."""
    measures = written(measure(docs, keep, vocabulary))
    ends = written(bands(measures)).withColumnsRenamed({"kind": "_kind", "octave": "_octave"})
    match = F.col("kind").eqNullSafe(F.col("_kind")) & F.col("octave").eqNullSafe(F.col("_octave"))
    judged = measures.join(ends, match, "left")
    odd = {}
    for name in GRID:
        outside = (F.col(name) < F.col(f"{name}_low")) | (F.col(name) > F.col(f"{name}_high"))
        odd[f"odd_{name}"] = F.coalesce(outside, F.lit(False))
    failed = (F.col("n_words") < LEAST_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MOST_REPEATED)
    judged = judged.withColumns({**odd, "base_failed": failed})
    fine = ~F.col("base_failed")
    for name in odd:
        fine = fine & ~F.col(name)
    plain, others = [name for name, _ in METRICS[:5]], [name for name, _ in METRICS[5:]]
    return judged.withColumn("kept", fine).select(*keep, *plain, "base_failed", "kept", *others, "entropy_lack", "kind", *odd)
