"""Outlier rule on the first-month margin per registrant.

A row stays when ``abs(r - std(r)) <= 3 * mean(r)`` and it has registrants. Centre and bound are meant as
written. Rows without registrants have no ``r`` and do not enter the statistics. A group with one ``r``
has no sample deviation, so it is dropped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortmill.functions.ratios import per_head
from cohortmill.operators.measures import keyed


def _margin() -> Column:
    return per_head(F.col("profit_m01"), F.col("reg_user_cnt"))


def _is_kept(mean: Column, deviation: Column, min_reg: int) -> Column:
    near = F.abs(_margin() - deviation) <= 3 * mean
    return near & (F.col("reg_user_cnt") > 0) & (F.col("reg_user_cnt") >= min_reg)


def drop_outliers(df: DataFrame, keys: list[str], min_reg: int = 0) -> DataFrame:
    """Rule over groups of any size: pre-aggregated statistics joined back to the rows."""
    rows = keyed(df, keys)
    statistics = rows.groupBy(*keys).agg(
        F.avg(_margin()).alias("_mean"), F.stddev_samp(_margin()).alias("_deviation")
    )
    kept = rows.join(statistics, keys).where(_is_kept(F.col("_mean"), F.col("_deviation"), min_reg))
    return kept.select(*df.columns)


def drop_daily_outliers(df: DataFrame, keys: list[str], min_reg: int = 0) -> DataFrame:
    """Rule over rows already summed to ``(keys, ds)``.

    A group then holds one row per day at most, so one window over the keys is small, and later steps by
    the same keys need no further shuffle.
    """
    group = Window.partitionBy(*keys)
    statistics = {
        "_mean": F.avg(_margin()).over(group),
        "_deviation": F.stddev_samp(_margin()).over(group),
    }
    kept = df.withColumns(statistics).where(_is_kept(F.col("_mean"), F.col("_deviation"), min_reg))
    return kept.select(*df.columns)
