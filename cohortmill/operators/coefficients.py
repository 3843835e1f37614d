"""Reference coefficients per channel: month-over-week and year-over-month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmill.functions.dates import DateWindow, ReferenceWindows
from cohortmill.functions.ratios import (
    guarded_ratio,
    is_linear,
    is_multiple,
    linear_value,
    multiple_value,
)
from cohortmill.operators.hierarchy import seen_in, suffix_daily
from cohortmill.operators.measures import keyed, sum_in, sums, with_per_head
from cohortmill.operators.outliers import drop_daily_outliers, drop_outliers
from cohortmill.operators.regression import train_fit, with_split
from cohortmill.schema import COMPUTE_COLS, DIMENSIONS, HIERARCHY, REFER_COLS

# Fixed value: registrants a day needs to count in the six-dimension job.
MIN_REG = 50


def refer_input(rolled: DataFrame, windows: ReferenceWindows) -> DataFrame:
    """Rows that define the coefficients of each refer tuple seen in the cohort, outliers dropped.

    A tuple takes the rows whose compute labels equal it and whose class refers to itself.
    """
    keys = ["type", *COMPUTE_COLS]
    seen = rolled.where(windows.cohort.holds(F.col("ds"))).select(
        "type", *[F.col(refer).alias(compute) for compute, refer in HIERARCHY]
    )
    own = rolled.where(F.col("channel_class_value_refer") == F.col("channel_class"))
    # The tuples are the groups of the statistics too, so others need none.
    return drop_outliers(own.join(seen.distinct(), keys, "left_semi"), keys)


def refer_daily(rolled: DataFrame, windows: ReferenceWindows) -> DataFrame:
    """Daily sums of :func:`refer_input` per refer tuple, with per-head measures."""
    keys = ["type", *COMPUTE_COLS, *REFER_COLS[1:], "ds"]
    return with_per_head(sums(refer_input(rolled, windows), keys))


def suffix_input(rows: DataFrame, windows: ReferenceWindows, min_reg: int = MIN_REG) -> DataFrame:
    """Daily sums of every suffix level seen in the cohort, outliers dropped, with per-head measures."""
    keys = ["type", "level", *DIMENSIONS]
    daily = seen_in(suffix_daily(rows), keys, windows.cohort)
    return with_per_head(drop_daily_outliers(daily, keys, min_reg))


def coefficients(
    daily: DataFrame,
    keys: list[str],
    windows: ReferenceWindows,
    *,
    order: list[str],
    max_rows: int | None,
    floor: DateWindow | None = None,
    split: str = "seeded",
) -> DataFrame:
    """One row of coefficients per key (which includes ``type``) from daily sums.

    Linear types: slope and intercept of first-month margin on the seven-day purchase rate over the
    quarter window, and the year multiple of the year window. Other types: month multiple over the month
    window and year multiple over the year window, the latter not before ``floor``. ``valid`` marks
    coefficients fit to be used by the six-dimension job.
    """
    kind = F.col("type")
    linear = is_linear(kind)
    floored = windows.year.not_before(floor)
    sample = linear & windows.quarter.holds(F.col("ds"))
    slope, intercept = train_fit("profit_m01_avg", "rate_d07")
    totals = (
        with_split(daily, keys, order, sample, max_rows, split)
        .groupBy(*keys)
        .agg(
            slope.alias("_slope"),
            intercept.alias("_intercept"),
            sum_in(windows.cohort, "reg_user_cnt").alias("reg_user_cnt"),
            sum_in(windows.cohort, "isprofit_d07_cnt").alias("_isprofit"),
            sum_in(windows.cohort, "profit_d07").alias("_profit_d07"),
            sum_in(windows.month, "profit_m01").alias("_month_m01"),
            sum_in(windows.month, "profit_d07").alias("_month_d07"),
            sum_in(windows.year, "profit_pm08").alias("_year_pm08"),
            sum_in(windows.year, "profit_mm03").alias("_year_mm03"),
            sum_in(windows.year, "profit_m01").alias("_year_m01"),
            sum_in(floored, "profit_y01").alias("_floored_y01"),
            sum_in(floored, "profit_m01").alias("_floored_m01"),
        )
        .where(linear | is_multiple(kind))
    )
    # Months 6 to 8 stand for the four months up to the year's end.
    first_year = F.col("_year_pm08") + F.col("_year_mm03") * 4 / 3

    def only(condition: Column, value: Column) -> Column:
        return F.when(condition, value)

    fitted = totals.select(
        *keys,
        F.lit(windows.cohort.label).alias("ds"),
        "reg_user_cnt",
        only(linear, guarded_ratio(F.col("_isprofit"), F.col("reg_user_cnt"))).alias("rate_d07"),
        only(~linear, F.col("_profit_d07")).alias("profit_d07"),
        F.when(linear, windows.quarter.label).otherwise(windows.month.label).alias("m_w_ds"),
        only(linear, F.col("_slope")).alias("m_w_coef"),
        only(linear, F.col("_intercept")).alias("m_w_intercept"),
        only(~linear, guarded_ratio(F.col("_month_m01"), F.col("_month_d07"))).alias("m_w_multiple"),
        F.when(linear, windows.year.label).otherwise(floored.label).alias("y_m_ds"),
        F.when(linear, guarded_ratio(first_year, F.col("_year_m01")))
        .otherwise(guarded_ratio(F.col("_floored_y01"), F.col("_floored_m01")))
        .alias("y_m_multiple"),
    )
    has_fit = (F.col("m_w_coef") != 0) | (F.col("m_w_intercept") != 0)
    usable = F.when(linear, has_fit).otherwise(F.col("m_w_multiple") >= 1) & (F.col("y_m_multiple") >= 1)
    return fitted.withColumns({"user_value": model_value(), "valid": usable.cast("int")})


def model_value() -> Column:
    """Value per registrant from the coefficient and cohort columns of a row, by profit type."""
    heads = F.col("reg_user_cnt")
    by_rate = linear_value(
        F.col("rate_d07"), F.col("m_w_coef"), F.col("m_w_intercept"), F.col("y_m_multiple"), heads
    )
    by_profit = multiple_value(F.col("profit_d07"), F.col("m_w_multiple"), F.col("y_m_multiple"), heads)
    return F.when(is_linear(F.col("type")), by_rate).otherwise(by_profit)


# Columns of a four-level coefficient table.
CHANNEL_KEYS = ["channel", "channel_category", "channel_department"]
COEF_VALUES = ["m_w_ds", "m_w_coef", "m_w_intercept", "m_w_multiple", "y_m_ds", "y_m_multiple"]
COEF_COLUMNS = [
    "type_name",
    "column_name",
    *CHANNEL_KEYS,
    "ds",
    "reg_user_cnt",
    "rate_d07",
    "profit_d07",
    "user_value",
    *COEF_VALUES,
]


def channel_coefficients(
    rolled: DataFrame,
    windows: ReferenceWindows,
    floor: DateWindow | None = None,
    split: str = "seeded",
) -> DataFrame:
    """Coefficient table of the four-level job, all profit types together.

    A tuple may hold several refer tuples per day, so the size of its train sample has no fixed bound.
    """
    keys = ["type", *COMPUTE_COLS]
    table = coefficients(
        refer_daily(rolled, windows),
        keys,
        windows,
        order=[*REFER_COLS[1:], "ds"],
        max_rows=None,
        floor=floor,
        split=split,
    )
    named = table.withColumnsRenamed({"type": "type_name", "channel_class": "channel"})
    return named.withColumn("column_name", F.lit("")).select(*COEF_COLUMNS).distinct()


def suffix_coefficients(
    rows: DataFrame,
    windows: ReferenceWindows,
    min_reg: int = MIN_REG,
    floor: DateWindow | None = None,
    split: str = "seeded",
) -> DataFrame:
    """Coefficient table of the six-dimension job: one row per (type, suffix level, labels)."""
    keys = ["type", "level", *DIMENSIONS]
    window_days = (windows.quarter.hi - windows.quarter.lo).days + 1
    return coefficients(
        suffix_input(rows, windows, min_reg),
        keys,
        windows,
        order=["ds"],
        max_rows=window_days,
        floor=floor,
        split=split,
    )


def repaired(coefs: DataFrame) -> DataFrame:
    """Coefficients not above 1 replaced by those of the parent channel, as they were before repair.

    The parent is the row of the same type, department and run whose channel and category both equal the
    child's category. A linear row takes the parent's slope together with its intercept.
    """
    keys = ["type_name", "channel_category", "channel_department", "ds"]
    parent = (
        keyed(coefs.where(F.col("channel") == F.col("channel_category")), keys)
        .groupBy(*keys)
        .agg(F.max(F.struct("y_m_multiple", "m_w_coef", "m_w_intercept", "m_w_multiple")).alias("_parent"))
    )
    linear = is_linear(F.col("type_name"))
    found = F.col("_parent").isNotNull()

    def fixed(name: str, when: Column) -> Column:
        return F.when(found & when, F.col(f"_parent.{name}")).otherwise(F.col(name))

    flat_slope = linear & (F.col("m_w_coef") <= 1)
    fixes = {
        "y_m_multiple": fixed("y_m_multiple", F.col("y_m_multiple") <= 1),
        "m_w_coef": fixed("m_w_coef", flat_slope),
        "m_w_intercept": fixed("m_w_intercept", flat_slope),
        "m_w_multiple": fixed("m_w_multiple", ~linear & (F.col("m_w_multiple") <= 1)),
    }
    return coefs.join(parent, keys, "left").withColumns(fixes).select(*coefs.columns).distinct()
