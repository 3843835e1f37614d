"""The three jobs end to end: value by channel (two hierarchies), margin curve, ledger."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from cohortmill.functions.dates import CURVE_START, YEAR_WINDOW_FLOOR, DateWindow, ReferenceWindows
from cohortmill.operators import coefficients, curve, hierarchy, ledger, values
from cohortmill.schema import COMPUTE_COLS, MEASURES, REFER_COLS
from cohortmill.sources import sinks
from cohortmill.sources.checkpoints import written
from cohortmill.sources.tables import profit_rows

DEFAULT_FLOOR = DateWindow(*YEAR_WINDOW_FLOOR)


@dataclass
class ChannelValues:
    """Value by channel over the four-level hierarchy.

    The roll-up and the coefficients are used several times and written out in between.
    """

    base: DataFrame
    windows: ReferenceWindows
    floor: DateWindow | None = DEFAULT_FLOOR
    split: str = "seeded"
    dedupe: str = "rows"

    @cached_property
    def rolled(self) -> DataFrame:
        keep = ["type", "ds", *COMPUTE_COLS, *REFER_COLS, *MEASURES]
        return written(hierarchy.promoted_rollup(self.base, self.dedupe, keep))

    @cached_property
    def coefs(self) -> DataFrame:
        table = coefficients.channel_coefficients(self.rolled, self.windows, self.floor, self.split)
        return written(table)

    @cached_property
    def repaired(self) -> DataFrame:
        return coefficients.repaired(self.coefs)

    @cached_property
    def values(self) -> DataFrame:
        return values.channel_values(self.rolled, self.repaired, self.windows)

    @cached_property
    def report(self) -> DataFrame:
        return values.channel_report(self.values)


@dataclass
class SuffixValues:
    """Value by channel over the six-dimension hierarchy."""

    rows: DataFrame
    windows: ReferenceWindows
    min_reg: int = coefficients.MIN_REG
    floor: DateWindow | None = DEFAULT_FLOOR
    split: str = "seeded"

    @cached_property
    def coefs(self) -> DataFrame:
        return coefficients.suffix_coefficients(self.rows, self.windows, self.min_reg, self.floor, self.split)

    @cached_property
    def values(self) -> DataFrame:
        return values.suffix_values(self.rows, self.coefs, self.windows)

    @cached_property
    def report(self) -> DataFrame:
        return values.suffix_report(self.values)


Period = tuple[dt.date, dt.date]


def run_windows(mode: str, t: dt.date, period: Period | None = None) -> ReferenceWindows:
    """Windows of a run at day ``t``, or of an explicit first and last day, as re-runs and back-fills need."""
    return ReferenceWindows.for_run(mode, t) if period is None else ReferenceWindows.of(*period)


def _put(df: DataFrame, target: str, mode: str, windows: ReferenceWindows) -> None:
    """Replace the run's partition of a path (a name with a slash) or of a catalog table."""
    put = sinks.overwrite_partition if "/" in target else sinks.overwrite_table_partition
    put(df, target, mode, windows.cohort.label)


def run_channel_values(
    base: DataFrame,
    mode: str,
    t: dt.date,
    target: str,
    coef_path: str | None = None,
    period: Period | None = None,
):
    """Scan the base table, value the cohort of a run and replace its partition of the report."""
    job = ChannelValues(profit_rows(base), run_windows(mode, t, period))
    if coef_path is not None:
        sinks.dump_csv(job.repaired, coef_path)
    _put(job.report, target, mode, job.windows)


def run_suffix_values(rows: DataFrame, mode: str, t: dt.date, target: str, period: Period | None = None):
    """The same over the six-dimension hierarchy."""
    job = SuffixValues(profit_rows(rows), run_windows(mode, t, period))
    _put(job.report, target, mode, job.windows)


def run_margin_curve(
    base: DataFrame,
    mode: str,
    t: dt.date,
    target: str,
    curve_start: dt.date = CURVE_START,
    period: Period | None = None,
    flagged: bool = False,
):
    """Compute the margin share curve of a run and replace its partition; ``flagged`` adds a column for fits at a limit."""
    windows = run_windows(mode, t, period)
    shares = curve.margin_share(profit_rows(base), curve.curve_days(windows.curve.hi, curve_start), flagged=flagged)
    _put(shares, target, mode, windows)


def run_ledger(
    income: DataFrame,
    payout: DataFrame,
    table: str,
    rejects_table: str | None = None,
    order: str = "seq",
    scope: str = "incremental",
    overdraft_table: str | None = None,
):
    """Match payouts to incomes once and replace the result table; ``LedgerRuns`` goes on from run to run.

    Rows that take no part are written to ``rejects_table``; without one, a run that has such rows fails. Payouts
    beyond the open income are written to ``overdraft_table``, if one is named.
    """
    rejects = ledger.rejected(income, payout, order)
    if rejects_table is not None:
        sinks.overwrite_table(rejects, rejects_table)
    elif not rejects.isEmpty():
        raise ValueError("some rows take no part in matching; name a rejects_table for them")
    if overdraft_table is not None:
        sinks.overwrite_table(ledger.overdraft(income, payout, order), overdraft_table)
    # Written first, as the result may replace what it was made from.
    sinks.overwrite_table(written(ledger.match(income, payout, order, scope)), table)
