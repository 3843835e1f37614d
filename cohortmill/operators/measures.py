"""Sums and per-head measures."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmill.functions.dates import DateWindow, ReferenceWindows, month_key
from cohortmill.functions.ratios import per_head
from cohortmill.schema import MEASURES, MONTH_PROFITS, MONTHS


def keyed(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys are all present; group-sums leave the others out."""
    return df.where(" AND ".join(f"{key} IS NOT NULL" for key in keys))


def totals(measures: list[str]) -> list[Column]:
    """Sum of each measure under its own name; a sum over nothing but nulls is 0."""
    return [F.expr(f"coalesce(sum({name}), 0) AS {name}") for name in measures]


def sums(df: DataFrame, keys: list[str], measures: list[str] = MEASURES) -> DataFrame:
    """Sums of the measures per key."""
    return keyed(df, keys).groupBy(*keys).agg(*totals(measures))


def with_per_head(df: DataFrame) -> DataFrame:
    """Seven-day purchase rate and margins per registrant."""
    heads = F.col("reg_user_cnt")
    return df.withColumns(
        {
            "rate_d07": per_head(F.col("isprofit_d07_cnt"), heads),
            "profit_m01_avg": per_head(F.col("profit_m01"), heads),
            "profit_y01_avg": per_head(F.col("profit_y01"), heads),
        }
    )


def sum_in(window: DateWindow, name: str) -> Column:
    """Sum of a measure over the days of a window; 0 without such days."""
    inside = f"ds BETWEEN DATE '{window.lo}' AND DATE '{window.hi}'"
    return F.expr(f"coalesce(sum(CASE WHEN {inside} THEN {name} END), 0)")


def window_totals(df: DataFrame, keys: list[str], windows: ReferenceWindows) -> DataFrame:
    """All measures over all four windows in one pass, reading only the days some window holds."""
    named = {"ds": windows.cohort, "1m": windows.month, "3m": windows.quarter, "1y": windows.year}
    wanted = F.lit(False)
    for window in named.values():
        wanted = wanted | window.holds(F.col("ds"))
    return (
        keyed(df, keys)
        .where(F.col("ds").between(F.lit(windows.year.lo), F.lit(windows.cohort.hi)) & wanted)
        .groupBy(*keys)
        .agg(*[sum_in(w, m).alias(f"{m}_{label}") for label, w in named.items() for m in MEASURES])
    )


def monthly_per_head(df: DataFrame, key: str, days: Column) -> DataFrame:
    """``m01..m36``: margin of each month of life per registrant, by registration month."""
    monthly = sums(
        df.where(days).withColumn("month", month_key(F.col("ds"))),
        [key, "month"],
        ["reg_user_cnt", *MONTH_PROFITS],
    )
    ratios = [f"try_divide(profit_m{n}, cast(reg_user_cnt as double)) AS m{n}" for n in MONTHS]
    return monthly.selectExpr(key, "month", *ratios)
