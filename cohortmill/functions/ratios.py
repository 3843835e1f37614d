"""Ratios and scalar formulas of the value models, all JVM-side."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortmill.schema import LINEAR_TYPES, MULTIPLE_TYPES


def guarded_ratio(num: Column, den: Column) -> Column:
    """``num / den`` where the denominator is positive, else 0."""
    return F.when(den > 0, num / den).otherwise(F.lit(0.0))


def per_head(total: Column, heads: Column) -> Column:
    """``total / heads``; null without heads."""
    return F.try_divide(total.cast("double"), heads.cast("double"))


def exp_curve(x: Column, a: Column, b: Column, c: Column) -> Column:
    return a * F.exp(-b * x) + c


def is_linear(type_col: Column) -> Column:
    return type_col.isin(LINEAR_TYPES)


def is_multiple(type_col: Column) -> Column:
    return type_col.isin(MULTIPLE_TYPES)


def value_model(type_col: Column) -> Column:
    """Name of the model that values a profit type; null for other types."""
    return F.when(is_linear(type_col), "linear").when(is_multiple(type_col), "multiple")


def linear_value(rate: Column, slope: Column, intercept: Column, multiple: Column, heads: Column) -> Column:
    return F.when(heads == 0, F.lit(0.0)).otherwise((slope * rate + intercept) * multiple)


def multiple_value(profit: Column, month_multiple: Column, year_multiple: Column, heads: Column) -> Column:
    return F.when(heads == 0, F.lit(0.0)).otherwise(profit * month_multiple * year_multiple / heads)


def key_text(values: dict[str, Column]) -> Column:
    """``'name'='value' & 'name'='value'`` in the order of ``values``."""
    parts = [F.concat(F.lit(f"'{name}'='"), value, F.lit("'")) for name, value in values.items()]
    return F.concat_ws(" & ", *parts)
