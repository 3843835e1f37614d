"""Coefficients for a channel, or for the nearest coarser channel that has them.

Each channel offers one candidate key per level; candidates meet the coefficient table in one equi-join
and the finest match wins. Channels are made distinct first, so the join sees each key once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmill.functions.levels import fallback_levels
from cohortmill.functions.ratios import key_text
from cohortmill.operators.coefficients import CHANNEL_KEYS, COEF_VALUES
from cohortmill.schema import DIMENSIONS, REFER_COLS, ROLLED_UP


def _finest(candidates: DataFrame, table: DataFrame, on: list[str], keys: list[str], level: str) -> DataFrame:
    """For each key, the table row of its first matching candidate: ``level`` and the coefficients."""
    match = F.struct(F.col("_priority").alias(level), *COEF_VALUES)
    return (
        candidates.join(table, on)
        .groupBy(*keys)
        .agg(F.min_by(match, F.struct("_priority", F.struct(*COEF_VALUES))).alias("_match"))
        .select(*keys, "_match.*")
    )


def channel_fallback(refers: DataFrame, coefs: DataFrame) -> DataFrame:
    """Coefficients per (type, refer tuple): of the class, category, department or all, by existence.

    ``coef_level`` is 1 for the class and 4 for all; tuples without any match are left out.
    """
    keys = ["type", *REFER_COLS]
    klass, category, department, everything = (F.col(name) for name in REFER_COLS)
    labels = [
        (klass, category, department),
        (category, category, department),
        (department, department, department),
        (everything, everything, everything),
    ]
    candidates = F.array(
        *[
            F.struct(
                F.lit(priority).alias("_priority"),
                *[label.alias(name) for name, label in zip(CHANNEL_KEYS, key)],
            )
            for priority, key in enumerate(labels, start=1)
        ]
    )
    offered = refers.select(*keys).distinct().select(*keys, F.inline(candidates))
    table = coefs.select(F.col("type_name").alias("type"), *CHANNEL_KEYS, *COEF_VALUES)
    return _finest(offered, table, ["type", *CHANNEL_KEYS], keys, "coef_level")


def _suffix_label(name: str, level: list[str]) -> Column:
    return F.col(name) if name in level else F.lit(ROLLED_UP)


def suffix_fallback(rows: DataFrame, coefs: DataFrame, dims: list[str] = DIMENSIONS) -> DataFrame:
    """Valid coefficients per (type, dimensions but the finest), from the longest suffix that has them.

    ``coef_level`` is the number of dimensions of the suffix used; keys without any match are left out.
    """
    own = ["type", *dims[1:]]
    candidates = F.array(
        *[
            F.struct(
                F.lit(-len(level)).alias("_priority"),
                F.lit(len(level)).alias("level"),
                *[_suffix_label(name, level).alias(f"_{name}") for name in dims[1:]],
            )
            for level in fallback_levels(dims)
        ]
    )
    offered = rows.select(*own).distinct().select(*own, F.inline(candidates))
    table = coefs.where(F.col("valid") == 1).select(
        "type", "level", *[F.col(name).alias(f"_{name}") for name in dims[1:]], *COEF_VALUES
    )
    on = ["type", "level", *[f"_{name}" for name in dims[1:]]]
    found = _finest(offered, table, on, own, "coef_level")
    return found.withColumn("coef_level", -F.col("coef_level"))


def suffix_ref_col(level: Column, dims: list[str] = DIMENSIONS) -> Column:
    """Key text of the suffix used, or of the coarsest suffix tried when none matched."""
    text = F.lit(None).cast("string")
    for suffix in fallback_levels(dims):
        own = key_text({name: _suffix_label(name, suffix) for name in dims})
        text = F.when(level == len(suffix), own).otherwise(text)
    coarsest = key_text({name: _suffix_label(name, dims[-1:]) for name in dims})
    return F.coalesce(text, coarsest)
