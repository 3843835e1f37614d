"""Least squares per group on a seeded train split, as one aggregation."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortmill.sources.checkpoints import written

# Fixed values of the split: seed, and the share of rows set aside.
SPLIT_SEED = 1
TEST_SHARE = 0.25


def train_mask(n: int) -> np.ndarray:
    """Train membership of rows 0..n-1: all but the first ``ceil(n / 4)`` of a seeded permutation."""
    mask = np.ones(n, dtype=bool)
    mask[np.random.RandomState(SPLIT_SEED).permutation(n)[: int(np.ceil(n * TEST_SHARE))]] = False
    return mask


def split_lookup(spark: SparkSession, max_rows: int) -> DataFrame:
    """``(n, mask)`` for group sizes up to ``max_rows``; ``mask[position] = '1'`` marks a train row."""
    masks = [(n, "".join("1" if train else "0" for train in train_mask(n))) for n in range(1, max_rows + 1)]
    return spark.createDataFrame(masks, "n bigint, mask string")


def _train_rows(sizes: DataFrame) -> DataFrame:
    """``(n, position)`` of the train rows for each group size ``n``, drawn once per size.

    The function is self-contained, so executors need not have this package installed.
    """
    seed, share = SPLIT_SEED, TEST_SHARE

    def drawn(batches):
        for batch in batches:
            for n in batch["n"]:
                order = np.random.RandomState(seed).permutation(n)
                yield pd.DataFrame({"n": n, "position": order[int(np.ceil(n * share)) :]})

    return sizes.mapInPandas(drawn, "n bigint, position bigint")


def with_split(
    df: DataFrame, keys: list[str], order: list[str], sample: Column, max_rows: int | None, split: str = "seeded"
) -> DataFrame:
    """Add ``n``, ``position`` and ``is_train`` for the sample rows of each group.

    ``position`` counts the sample rows in the given order. With ``max_rows``, a proven bound of the
    sample size per group, membership comes from a broadcast lookup of ``max_rows`` short strings, and a
    larger group is an error; without a bound it is drawn once for each size that occurs and joined by size
    and position. Rows outside the sample are never train rows.
    """
    group = Window.partitionBy(*keys)
    before = group.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = F.when(sample, 1).otherwise(0)
    rows = df.withColumns(
        {"n": F.sum(counted).over(group), "position": F.sum(counted).over(before) - 1, "_sampled": F.coalesce(sample, F.lit(False))}
    )
    if split == "none":
        return rows.withColumn("is_train", F.col("_sampled") & (F.col("n") > 1)).drop("_sampled")
    if split != "seeded":
        raise ValueError(f"unknown split {split!r}")
    if max_rows is None:
        sizes = df.where(sample).groupBy(*keys).agg(F.count("*").alias("n")).select("n").distinct()
        train = written(_train_rows(sizes)).withColumn("_train", F.lit(True))
        chosen = F.col("_sampled") & F.coalesce(F.col("_train"), F.lit(False))
        return rows.join(train, ["n", "position"], "left").withColumn("is_train", chosen).drop("_sampled", "_train")
    lookup = F.broadcast(split_lookup(df.sparkSession, max_rows))
    drawn = F.substring("mask", F.col("position").cast("int") + 1, F.lit(1)) == "1"
    beyond = F.raise_error(F.lit(f"a group has more than {max_rows} sample rows"))
    drawn = F.when(F.col("n") > max_rows, beyond.cast("boolean")).otherwise(drawn)
    train = F.when(F.col("_sampled"), drawn).otherwise(F.lit(False))
    return rows.join(lookup, "n", "left").withColumn("is_train", train).drop("mask", "_sampled")


def train_fit(y: str, x: str) -> tuple[Column, Column]:
    """Aggregates: slope and intercept of ``y ~ x`` over the train rows.

    A constant ``x`` gives slope 0 and the mean; no train row gives (0, 0).
    """
    train = F.col("is_train")
    xs, ys = F.when(train, F.col(x)), F.when(train, F.col(y))
    flat = F.min(xs) == F.max(xs)
    empty = F.count(xs) == 0
    slope = F.when(empty | flat, F.lit(0.0)).otherwise(F.regr_slope(ys, xs))
    intercept = F.when(empty, F.lit(0.0)).when(flat, F.avg(ys)).otherwise(F.regr_intercept(ys, xs))
    return slope, intercept
