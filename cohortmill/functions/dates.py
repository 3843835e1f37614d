"""Date functions as Column expressions, and the reference windows of a run.

A run values the cohort registered in ``[bdate, edate]``. Its windows are plain Python dates, so that
they reach the scan as literals and prune partitions; the same offsets are also offered as Columns for
tables that hold many run dates.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Window bounds in days relative to bdate, both ends inclusive.
MONTH_WINDOW = (-46, -16)
QUARTER_WINDOW = (-166, -76)
YEAR_WINDOW = (-376, -346)
# Days relative to bdate whose month begin bounds the margin curve.
CURVE_OFFSETS = (-436, -76)
# A daily run at t values the seven days that start 14 days earlier.
COHORT_LAG_DAYS = 14
COHORT_LENGTH_DAYS = 7
# Fixed value: first registration day used by the margin curve.
CURVE_START = dt.date(2015, 1, 1)
# Earliest year window of the multiplicative types.
YEAR_WINDOW_FLOOR = (dt.date(2016, 7, 14), dt.date(2016, 8, 13))


def add_days(day: Column, n: int) -> Column:
    return F.date_add(day, n)


def year_week(day: Column) -> Column:
    """Year and Monday-based week number; days before the first Monday are in week 00 (not ISO)."""
    week = F.floor((F.dayofyear(day) - 1 + 7 - F.weekday(day)) / 7).cast("int")
    return F.concat(F.date_format(day, "yyyy"), F.lpad(week.cast("string"), 2, "0"))


def week_start(day: Column) -> Column:
    return F.date_sub(day, F.weekday(day))


def week_end(day: Column) -> Column:
    return F.date_add(day, 6 - F.weekday(day))


def week_label(day: Column) -> Column:
    return F.concat_ws(
        "-",
        F.date_format(week_start(day), "yyyy-MM-dd"),
        F.date_format(week_end(day), "yyyy-MM-dd"),
    )


def two_weeks_back(day: Column) -> Column:
    return F.date_sub(day, 14)


def month_start(day: Column) -> Column:
    return F.trunc(day, "MM").cast("date")


def month_end(day: Column) -> Column:
    return F.last_day(day)


def previous_month_end(day: Column) -> Column:
    return F.date_sub(month_start(day), 1)


def month_key(day: Column) -> Column:
    return F.date_format(day, "yyyy-MM")


def range_label(lo: Column, hi: Column) -> Column:
    return F.concat_ws("-", F.date_format(lo, "yyyyMMdd"), F.date_format(hi, "yyyyMMdd"))


@dataclass(frozen=True)
class DateWindow:
    """Closed range of days."""

    lo: dt.date
    hi: dt.date

    @property
    def label(self) -> str:
        return f"{self.lo:%Y%m%d}-{self.hi:%Y%m%d}"

    def holds(self, day: Column) -> Column:
        return day.between(F.lit(self.lo), F.lit(self.hi))

    def not_before(self, floor: DateWindow | None) -> DateWindow:
        """This window, or ``floor`` when this one starts earlier."""
        return floor if floor is not None and self.lo < floor.lo else self


@dataclass(frozen=True)
class ReferenceWindows:
    """All windows of one run."""

    cohort: DateWindow
    month: DateWindow
    quarter: DateWindow
    year: DateWindow
    curve: DateWindow
    """Begin and (exclusive) end of the curve's last fifteen months; only the end is used."""

    @classmethod
    def of(cls, bdate: dt.date, edate: dt.date) -> ReferenceWindows:
        if bdate > edate:
            raise ValueError(f"bdate {bdate} is after edate {edate}")

        def shifted(bounds: tuple[int, int]) -> DateWindow:
            return DateWindow(*(bdate + dt.timedelta(days=n) for n in bounds))

        curve = shifted(CURVE_OFFSETS)
        return cls(
            cohort=DateWindow(bdate, edate),
            month=shifted(MONTH_WINDOW),
            quarter=shifted(QUARTER_WINDOW),
            year=shifted(YEAR_WINDOW),
            curve=DateWindow(curve.lo.replace(day=1), curve.hi.replace(day=1)),
        )

    @classmethod
    def for_run(cls, mode: str, t: dt.date) -> ReferenceWindows:
        return cls.of(*run_period(mode, t))


def run_period(mode: str, t: dt.date) -> tuple[dt.date, dt.date]:
    """Cohort of a ``daily``, ``weekly`` or ``monthly`` run at day ``t``."""
    if mode == "daily":
        begin = t - dt.timedelta(days=COHORT_LAG_DAYS)
        return begin, begin + dt.timedelta(days=COHORT_LENGTH_DAYS - 1)
    if mode == "weekly":
        monday = t - dt.timedelta(days=14 + t.weekday())
        return monday, monday + dt.timedelta(days=6)
    if mode == "monthly":
        end = t.replace(day=1) - dt.timedelta(days=1)
        return end.replace(day=1), end
    raise ValueError(f"unknown run mode {mode!r}")


def run_period_columns(mode: str, t: Column) -> tuple[Column, Column]:
    """Column form of :func:`run_period`."""
    if mode == "daily":
        begin = F.date_sub(t, COHORT_LAG_DAYS)
        return begin, F.date_add(begin, COHORT_LENGTH_DAYS - 1)
    if mode == "weekly":
        return week_start(two_weeks_back(t)), week_end(two_weeks_back(t))
    if mode == "monthly":
        end = previous_month_end(t)
        return month_start(end), end
    raise ValueError(f"unknown run mode {mode!r}")


def window_columns(bdate: Column, edate: Column) -> dict[str, Column]:
    """Column form of :class:`ReferenceWindows`: bounds and label of every window."""
    bounds = {
        "ds": (bdate, edate),
        "ds_1m": tuple(add_days(bdate, n) for n in MONTH_WINDOW),
        "ds_3m": tuple(add_days(bdate, n) for n in QUARTER_WINDOW),
        "ds_1y": tuple(add_days(bdate, n) for n in YEAR_WINDOW),
        "ds_1y3": tuple(month_start(add_days(bdate, n)) for n in CURVE_OFFSETS),
    }
    columns = {}
    for name, (lo, hi) in bounds.items():
        columns[name] = range_label(lo, hi)
        columns[f"{name}_0"] = lo
        columns[f"{name}_1"] = hi
    return columns
