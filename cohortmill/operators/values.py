"""Value per registrant and channel, and the report over three profit types."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmill.functions.dates import ReferenceWindows
from cohortmill.functions.ratios import guarded_ratio, is_linear, is_multiple
from cohortmill.operators.coefficients import CHANNEL_KEYS, COEF_VALUES, model_value
from cohortmill.operators.fallback import channel_fallback, suffix_fallback, suffix_ref_col
from cohortmill.operators.hierarchy import LEVEL
from cohortmill.operators.measures import sums
from cohortmill.schema import COMPUTE_COLS, DIMENSIONS, REFER_COLS

COHORT_MEASURES = ["reg_user_cnt", "isprofit_d07_cnt", "profit_d07"]


def _with_cohort_columns(rows: DataFrame, windows: ReferenceWindows) -> DataFrame:
    linear = is_linear(F.col("type"))
    rate = guarded_ratio(F.col("isprofit_d07_cnt"), F.col("reg_user_cnt"))
    return rows.withColumns(
        {
            "ds": F.lit(windows.cohort.label),
            "rate_d07": F.when(linear, rate),
            "profit_d07": F.when(~linear, F.col("profit_d07")),
        }
    )


def channel_cohort(rolled: DataFrame, windows: ReferenceWindows) -> DataFrame:
    """Cohort sums per (type, compute tuple) with the tuple's refer labels.

    The refer labels are those of the finest rows; among several, the smallest.
    """
    keys = ["type", *COMPUTE_COLS]
    present = F.lit(True)
    for key in keys:
        present = present & F.col(key).isNotNull()
    refer = F.min(F.struct(LEVEL, *REFER_COLS)).alias("_refer")
    totals = [F.coalesce(F.sum(name), F.lit(0)).alias(name) for name in COHORT_MEASURES]
    modelled = is_linear(F.col("type")) | is_multiple(F.col("type"))
    return (
        rolled.where(windows.cohort.holds(F.col("ds")) & present & modelled)
        .groupBy(*keys)
        .agg(*totals, refer)
        .select(*keys, *COHORT_MEASURES, *[F.col(f"_refer.{name}").alias(name) for name in REFER_COLS])
    )


def channel_values(rolled: DataFrame, coefs: DataFrame, windows: ReferenceWindows) -> DataFrame:
    """Value of every compute tuple in the cohort, per profit type (four-level job).

    A tuple whose refer labels find no coefficients has a null value and a null ``coef_level``.
    """
    cohort = channel_cohort(rolled, windows)
    # A missing refer label only rules out its own level, so labels meet null-safely.
    found = channel_fallback(cohort, coefs).withColumnsRenamed({n: f"_{n}" for n in ["type", *REFER_COLS]})
    same = F.col("type") == F.col("_type")
    for name in REFER_COLS:
        same = same & F.col(name).eqNullSafe(F.col(f"_{name}"))
    rows = _with_cohort_columns(cohort.join(found, same, "left"), windows)
    return rows.withColumn("user_value", model_value()).select(
        F.col("type").alias("type_name"),
        F.lit("").alias("column_name"),
        F.col("channel_class").alias("channel"),
        "channel_category",
        "channel_department",
        "all_compute",
        "ds",
        "reg_user_cnt",
        "rate_d07",
        "profit_d07",
        "user_value",
        *COEF_VALUES,
        "coef_level",
    )


def suffix_values(rows: DataFrame, coefs: DataFrame, windows: ReferenceWindows) -> DataFrame:
    """Value of every full six-dimension key in the cohort, per profit type.

    Without valid coefficients at any level the coefficients and the value are 0 and the range labels
    null. Values of linear types are never negative.
    """
    own = ["type", *DIMENSIONS[1:]]
    modelled = is_linear(F.col("type")) | is_multiple(F.col("type"))
    cohort = sums(
        rows.where(windows.cohort.holds(F.col("ds")) & modelled), ["type", *DIMENSIONS], COHORT_MEASURES
    )
    found = suffix_fallback(cohort, coefs)
    joined = _with_cohort_columns(cohort.join(found, own, "left"), windows)
    linear = is_linear(F.col("type"))
    lacking = F.col("coef_level").isNull()

    def or_zero(name: str, used: Column) -> Column:
        return F.when(lacking & used, F.lit(0.0)).otherwise(F.col(name))

    filled = joined.withColumns(
        {
            "m_w_coef": or_zero("m_w_coef", linear),
            "m_w_intercept": or_zero("m_w_intercept", linear),
            "m_w_multiple": or_zero("m_w_multiple", ~linear),
            "y_m_multiple": or_zero("y_m_multiple", F.lit(True)),
            "ref_col": suffix_ref_col(F.col("coef_level")),
        }
    )
    value = F.when(linear, F.greatest(model_value(), F.lit(0.0))).otherwise(model_value())
    return filled.withColumn("user_value", value).select(
        F.col("type").alias("type_name"),
        *DIMENSIONS,
        "ds",
        "reg_user_cnt",
        "rate_d07",
        "profit_d07",
        "user_value",
        *COEF_VALUES,
        "ref_col",
        "coef_level",
    )


# Columns of one profit type in a report, in order; types in report order with their suffixes.
LINEAR_PART = ["type_name", "rate_d07", "user_value", "m_w_ds", "m_w_coef", "m_w_intercept"]
MULTIPLE_PART = ["type_name", "profit_d07", "user_value", "m_w_ds", "m_w_multiple"]
YEAR_PART = ["y_m_ds", "y_m_multiple"]
REPORT_TYPES = [
    ("supplier", "e_supplier_profit", LINEAR_PART + YEAR_PART),
    ("licai", "licai_order_profit", MULTIPLE_PART + YEAR_PART),
    ("ad", "ad_profit", MULTIPLE_PART + YEAR_PART),
]


def _three_types(values: DataFrame, keys: list[str], shown: list[str], extra: list[str]) -> DataFrame:
    """One row per key of the supplier type, with the columns of the other types beside it.

    Says the same as left joins of the three types on the key, in one shuffle.
    """
    parts = {suffix: [*columns, *extra] for suffix, _, columns in REPORT_TYPES}
    parts["supplier"] = ["reg_user_cnt", *parts["supplier"]]
    picked = [
        F.max(F.when(F.col("type_name") == kind, F.struct(*parts[suffix]))).alias(f"_{suffix}")
        for suffix, kind, _ in REPORT_TYPES
    ]
    wide = (
        values.where(F.col("type_name").isin([kind for _, kind, _ in REPORT_TYPES]))
        .groupBy(*keys, "ds")
        .agg(*picked)
        .where(F.col("_supplier").isNotNull())
    )
    total = F.col("_supplier.user_value") + F.col("_licai.user_value") + F.col("_ad.user_value")
    columns = [F.col("_supplier.reg_user_cnt").alias("reg_user_cnt_supplier"), total.alias("user_value_all")]
    for suffix, _, _ in REPORT_TYPES:
        names = [name for name in parts[suffix] if name != "reg_user_cnt"]
        columns += [F.col(f"_{suffix}.{name}").alias(f"{name}_{suffix}") for name in names]
    return wide.select(*shown, *columns, "ds")


def channel_report(values: DataFrame) -> DataFrame:
    """28-column report of the four-level job."""
    keys = ["column_name", *CHANNEL_KEYS, "all_compute"]
    return _three_types(values, keys, CHANNEL_KEYS, [])


def suffix_report(values: DataFrame) -> DataFrame:
    """34-column report of the six-dimension job."""
    return _three_types(values, DIMENSIONS, DIMENSIONS, ["ref_col"])
