"""Every operator as a query over the given tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill.functions import dates
from cohortmill.functions.ratios import value_model
from cohortmill.operators import coefficients as coef
from cohortmill.operators import curve, fallback, hierarchy, ledger, measures, outliers, regression, values
from cohortmill.plans.jobs import ChannelValues, SuffixValues, run_windows
from cohortmill.plans.ledger_runs import LedgerRuns
from cohortmill.schema import COMPUTE_COLS, DIMENSIONS, MEASURES, REFER_COLS
from cohortmill.sources import fixtures as fx
from cohortmill.sources import sinks
from cohortmill.sources.checkpoints import new_path, written
from cohortmill.sources.sinks import rounded
from cohortmill.sources.tables import profit_rows

WINDOWS = fx.WINDOWS
SUPPLIER, AD, LICAI = "e_supplier_profit", "ad_profit", "licai_order_profit"
# Ledger runs before this day, and from it on, in the two-run query.
SECOND_RUN = dt.date(2024, 1, 16)
# First days of the second and third run in the three-run query.
THREE_RUNS = [dt.date(2024, 1, 11), dt.date(2024, 1, 21)]

COMMON = ["ds", "reg_user_cnt", "user_value", "m_w_ds", "y_m_ds", "y_m_multiple"]
LINEAR = ["rate_d07", "m_w_coef", "m_w_intercept"]
MULTIPLE = ["profit_d07", "m_w_multiple"]
CHANNEL = ["type_name", *coef.CHANNEL_KEYS]


def _base(spark: SparkSession, sf: str) -> DataFrame:
    return profit_rows(fx.base_info(spark, sf))


def _sum(spark: SparkSession, sf: str) -> DataFrame:
    return profit_rows(fx.channel_sum(spark, sf))


def _channel(spark: SparkSession, sf: str, floor=None, windows=WINDOWS) -> ChannelValues:
    """The input is derived here and used twice, so it is written first, as the table it stands for."""
    return ChannelValues(written(_base(spark, sf)), windows, floor)


def _suffix(spark: SparkSession, sf: str) -> SuffixValues:
    rows = _sum(spark, sf).select("type", "ds", *DIMENSIONS, *MEASURES)
    return SuffixValues(written(rows), WINDOWS, fx.MIN_REG, floor=None)


def _days():
    return curve.curve_days(WINDOWS.curve.hi, fx.CURVE_START)


# Dates


def date_calendar(spark, sf):
    d = F.col("d")
    return fx.order_days(spark, sf).select(
        "d",
        dates.add_days(d, 7).alias("plus_7"),
        dates.year_week(d).alias("year_week"),
        dates.week_start(d).alias("week_first"),
        dates.week_end(d).alias("week_last"),
        dates.week_label(d).alias("week_label"),
        dates.two_weeks_back(d).alias("two_weeks_back"),
        dates.month_start(d).alias("month_first"),
        dates.month_end(d).alias("month_last"),
        dates.previous_month_end(d).alias("previous_month_last"),
        dates.month_key(d).alias("month_key"),
    )


def reference_windows(spark, sf):
    columns = dates.window_columns(F.col("d"), dates.add_days(F.col("d"), 6))
    return fx.order_days(spark, sf).select(*[c.alias(n) for n, c in columns.items()])


def run_periods(spark, sf):
    columns = []
    for mode in ("daily", "weekly", "monthly"):
        begin, end = dates.run_period_columns(mode, F.col("d"))
        columns += [begin.alias(f"{mode}_begin"), end.alias(f"{mode}_end")]
    return fx.order_days(spark, sf).select("d", *columns)


# Sums


def scan_profit_types(spark, sf):
    return rounded(_base(spark, sf))


def cohort_daily_sums(spark, sf):
    return rounded(measures.sums(_base(spark, sf), ["type", "channel_category", "ds"]))


def derive_per_head(spark, sf):
    daily = measures.with_per_head(measures.sums(_base(spark, sf), ["type", "channel_category", "ds"]))
    return rounded(
        daily.select("type", "channel_category", "ds", "rate_d07", "profit_m01_avg", "profit_y01_avg")
    )


def window_totals(spark, sf):
    return rounded(measures.window_totals(_base(spark, sf), ["type", "channel_department"], WINDOWS))


def value_model_by_type(spark, sf):
    return (
        _base(spark, sf)
        .groupBy("type", value_model(F.col("type")).alias("model"))
        .agg(F.count("*").alias("row_cnt"), F.sum("reg_user_cnt").alias("reg_user_cnt"))
    )


def distinct_channels(spark, sf):
    return _base(spark, sf).where(WINDOWS.cohort.holds(F.col("ds"))).select(*COMPUTE_COLS).distinct()


# Outliers and roll-ups


def outlier_v1(spark, sf):
    own = _base(spark, sf).where(F.col("channel_class_value_refer") == F.col("channel_class"))
    kept = outliers.drop_outliers(own, ["type", *COMPUTE_COLS])
    return rounded(kept.select("type", *COMPUTE_COLS, "ds", "reg_user_cnt", "profit_m01"))


def outlier_v2(spark, sf):
    daily = hierarchy.suffix_daily(_sum(spark, sf))
    kept = outliers.drop_daily_outliers(daily, ["type", "level", *DIMENSIONS], fx.MIN_REG)
    return rounded(kept.select("type", "level", *DIMENSIONS, "ds", "reg_user_cnt", "profit_m01"))


def suffix_grouping_sets(spark, sf):
    daily = hierarchy.suffix_daily(_sum(spark, sf))
    return rounded(hierarchy.seen_in(daily, ["type", "level", *DIMENSIONS], WINDOWS.cohort))


def hierarchy_rollup(spark, sf):
    rolled = hierarchy.promoted_rollup(written(_base(spark, sf)))
    return rounded(rolled.drop(hierarchy.LEVEL))


# Coefficients


def split_membership(spark, sf):
    daily = coef.suffix_input(_sum(spark, sf).where(F.col("type") == SUPPLIER), WINDOWS, fx.MIN_REG)
    keys = ["type", "level", *DIMENSIONS]
    sample = WINDOWS.quarter.holds(F.col("ds"))
    split = regression.with_split(daily, keys, ["ds"], sample, max_rows=91)
    return split.where(sample).select(*keys, "ds", "n", "position", "is_train")


def ols_by_channel(spark, sf):
    keys = ["type", "channel_category"]
    rows = _base(spark, sf).where((F.col("type") == SUPPLIER) & WINDOWS.quarter.holds(F.col("ds")))
    daily = measures.with_per_head(measures.sums(rows, [*keys, "ds"]))
    split = regression.with_split(daily, keys, ["ds"], F.lit(True), max_rows=91)
    slope, intercept = regression.train_fit("profit_m01_avg", "rate_d07")
    return rounded(split.groupBy(*keys).agg(slope.alias("slope"), intercept.alias("intercept")))


def _coef_v1(spark, sf, floor=None):
    return coef.channel_coefficients(_channel(spark, sf).rolled, WINDOWS, floor)


def _coef_v2(spark, sf):
    """The rows are used once here, so nothing is written."""
    return coef.suffix_coefficients(_sum(spark, sf), WINDOWS, fx.MIN_REG)


def coef_v1_supplier(spark, sf):
    table = _coef_v1(spark, sf).where(F.col("type_name") == SUPPLIER)
    return rounded(table.select(*CHANNEL, "column_name", *COMMON, *LINEAR))


def coef_v1_ad(spark, sf):
    table = _coef_v1(spark, sf).where(F.col("type_name").isin(AD, LICAI))
    return rounded(table.select(*CHANNEL, "column_name", *COMMON, *MULTIPLE))


def coef_multiplier_floor(spark, sf):
    table = _coef_v1(spark, sf, fx.FLOOR).where(F.col("type_name").isin(AD, LICAI))
    return rounded(table.select(*CHANNEL, "column_name", *COMMON, *MULTIPLE))


def coef_v2_supplier(spark, sf):
    table = _coef_v2(spark, sf).where(F.col("type") == SUPPLIER)
    return rounded(table.select("type", *DIMENSIONS, *COMMON, *LINEAR, "valid"))


def coef_v2_ad(spark, sf):
    table = _coef_v2(spark, sf).where(F.col("type").isin(AD, LICAI))
    return rounded(table.select("type", *DIMENSIONS, *COMMON, *MULTIPLE, "valid"))


def coef_repair(spark, sf):
    return rounded(_channel(spark, sf).repaired)


def coef_fallback_v1(spark, sf):
    job = _channel(spark, sf)
    return rounded(fallback.channel_fallback(values.channel_cohort(job.rolled, WINDOWS), job.repaired))


def coef_fallback_v2(spark, sf):
    job = _suffix(spark, sf)
    cohort = job.rows.where(WINDOWS.cohort.holds(F.col("ds")))
    return rounded(fallback.suffix_fallback(cohort, job.coefs))


def fallback_every_level_v1(spark, sf):
    """Each refer tuple with none to all of its labels, from the finest on, replaced by labels that no channel has."""
    job = _channel(spark, sf)
    refers = values.channel_cohort(job.rolled, WINDOWS).select("type", *REFER_COLS).distinct()
    variants = refers.withColumn("_v", F.explode(F.sequence(F.lit(0), F.lit(4))))
    foreign = {
        name: F.when(F.col("_v") > place, F.concat(F.lit("foreign "), name)).otherwise(F.col(name))
        for place, name in enumerate(REFER_COLS)
    }
    variants = written(variants.withColumns(foreign).drop("_v").distinct())
    found = fallback.channel_fallback(variants, job.repaired)
    return rounded(variants.join(found, ["type", *REFER_COLS], "left"))


def fallback_every_level_v2(spark, sf):
    """Coefficients of days with few registrants too, some of the longest suffixes taken as valid, and each key once more with a
    business type that none has."""
    rows = _sum(spark, sf).select("type", "ds", *DIMENSIONS, *MEASURES)
    job = SuffixValues(written(rows), WINDOWS, 1, floor=None)
    keys = ["type", *DIMENSIONS[1:]]
    cohort = job.rows.where(WINDOWS.cohort.holds(F.col("ds"))).select(*keys).distinct()
    last = DIMENSIONS[-1]
    wanted = written(cohort.unionByName(cohort.withColumn(last, F.concat(F.lit("foreign "), last))))
    also = ((F.col("level") == 5) & (F.col("ora_channel") < "C")) | (
        (F.col("level") == 4) & F.col("ora_activity_type").startswith("1")
    )
    coefs = job.coefs.withColumn("valid", F.when(also, 1).otherwise(F.col("valid")))
    return rounded(wanted.join(fallback.suffix_fallback(wanted, coefs), keys, "left"))


# Values and reports


def report_missing_types(spark, sf):
    """The report where some channels have no rows of one or two profit types, so no total."""
    valued = _channel(spark, sf).values
    gone = ((F.col("type_name") == AD) & (F.col("channel_category") < "B")) | (
        (F.col("type_name") == LICAI) & (F.col("channel_category") > "M")
    )
    return rounded(values.channel_report(valued.where(~gone)))


def user_value_v1(spark, sf):
    return rounded(_channel(spark, sf).values)


def user_value_v2(spark, sf):
    return rounded(_suffix(spark, sf).values)


def report_three_types(spark, sf):
    return rounded(_channel(spark, sf).report)


def report_explicit_period(spark, sf):
    """A back-fill: the mode and day of the run are others, its period is given."""
    windows = run_windows("monthly", dt.date(2001, 7, 1), (WINDOWS.cohort.lo, WINDOWS.cohort.hi))
    return rounded(_channel(spark, sf, windows=windows).report)


def report_three_types_v2(spark, sf):
    return rounded(_suffix(spark, sf).report)


# Curve


def monthly_per_head(spark, sf):
    return rounded(curve.curve_months(_base(spark, sf), _days()))


def curve_mean(spark, sf):
    return rounded(curve.curve_mean(_base(spark, sf), _days()))


def curve_unpivot(spark, sf):
    return rounded(curve.curve_points(curve.curve_mean(_base(spark, sf), _days())))


def exp_curve_fit(spark, sf):
    fitted = curve.exp_fit(curve.curve_mean(_base(spark, sf), _days()))
    return rounded(fitted.select("channel_category", "a", "b", "c"))


def margin_share_36(spark, sf):
    return rounded(curve.margin_share(_base(spark, sf), _days()))


# Ledger


def scan_ledger(spark, sf):
    columns = ["id", "user_id", "ds", "show_amount"]
    incomes = fx.income(spark, sf).select(F.lit("income").alias("source"), *columns)
    return incomes.unionByName(fx.payout(spark, sf).select(F.lit("payout").alias("source"), *columns))


def _ledger(spark, sf):
    return fx.income(spark, sf), fx.payout(spark, sf)


def ledger_match(spark, sf):
    return ledger.match(*_ledger(spark, sf))


def ledger_match_by_date(spark, sf):
    return ledger.match(*_ledger(spark, sf), order="date")


def ledger_match_heavy(spark, sf):
    """Both orders with every user on the path for users of any size, in small chunks."""
    sizes = ledger.Sizes(heavy_rows=0, chunk_rows=8, block_segments=4)
    income, payout = _ledger(spark, sf)
    runs = [
        ledger.match(income, payout, order, sizes=sizes).withColumn("match_order", F.lit(order))
        for order in ("seq", "date")
    ]
    return runs[0].unionByName(runs[1])


def ledger_full_scope(spark, sf):
    return ledger.match(*_ledger(spark, sf), scope="full")


def ledger_splits(spark, sf):
    return ledger.splits(*_ledger(spark, sf))


def ledger_open_balance(spark, sf):
    return ledger.open_balance(ledger.match(*_ledger(spark, sf)))


def ledger_overdraft(spark, sf):
    return ledger.overdraft(*_ledger(spark, sf))


def ledger_untouched_users(spark, sf):
    return ledger.untouched_users(*_ledger(spark, sf))


def ledger_resume(spark, sf):
    income, payout = _ledger(spark, sf)
    early, late = F.col("ds") < F.lit(SECOND_RUN), F.col("ds") >= F.lit(SECOND_RUN)
    first = written(ledger.match(income.where(early), payout.where(early), scope="full"))
    return ledger.resume(first, income.where(late), payout.where(late))


def ledger_three_runs(spark, sf):
    """Three runs by day, each with what the earlier ones left open: all rows at the end, and every run's overdraft."""
    income, payout = _ledger(spark, sf)
    runs = LedgerRuns(spark, new_path(spark, "ledger"))
    edges = [F.lit(dt.date(1900, 1, 1)), *[F.lit(day) for day in THREE_RUNS], F.lit(dt.date(9999, 1, 1))]
    for number, (first, last) in enumerate(zip(edges, edges[1:]), start=1):
        own = (F.col("ds") >= first) & (F.col("ds") < last)
        runs.run(number, income.where(own), payout.where(own))
    rows = runs.result("full").select(F.lit("income").alias("source"), *income.columns)
    beyond = runs.overdraft().select(
        F.lit("overdraft").alias("source"),
        "user_id",
        F.col("dropped_amount").alias("show_amount"),
        "payout_id",
        "payout_type_id",
        "payout_date",
    )
    return rows.unionByName(beyond, allowMissingColumns=True)


# Sinks


def sink_round_trip(spark, sf):
    """Two partitions of a result written, the second twice, and read back with the partition's columns, by path and as
    a catalog table, where each overwrite replaces its own partition alone; and the same rows through CSV files."""
    body = measures.sums(_base(spark, sf), ["type", "channel_category", "ds"], ["reg_user_cnt", "profit_m01"])
    body = written(body.withColumnRenamed("ds", "day"))
    path, name = new_path(spark, "sink"), f"sink_{uuid.uuid4().hex}"
    spare = body.limit(3)
    for rows, mode, label in [(body, "daily", "a'b\\c"), (spare, "weekly", "20010101"), (body, "weekly", "20010101")]:
        sinks.overwrite_partition(rows, path, mode, label)
        sinks.overwrite_table_partition(rows, name, mode, label)
    by_path = spark.read.parquet(path).withColumn("kind", F.lit("path"))
    by_table = written(spark.table(name)).withColumn("kind", F.lit("table"))
    spark.sql(f"DROP TABLE {name}")
    found = by_path.withColumn("ds", F.col("ds").cast("string")).unionByName(by_table)
    sinks.dump_csv(body.select("type", "channel_category", "day", "reg_user_cnt"), f"{path}-csv")
    schema = "type string, channel_category string, day date, reg_user_cnt long"
    by_csv = spark.read.schema(schema).option("header", True).csv(f"{path}-csv").withColumn("kind", F.lit("csv"))
    return found.unionByName(by_csv, allowMissingColumns=True)


QUERIES = {
    function.__name__: function
    for function in (
        date_calendar,
        reference_windows,
        run_periods,
        scan_profit_types,
        derive_per_head,
        coef_multiplier_floor,
        window_totals,
        outlier_v1,
        outlier_v2,
        value_model_by_type,
        cohort_daily_sums,
        coef_v1_supplier,
        coef_v1_ad,
        suffix_grouping_sets,
        hierarchy_rollup,
        distinct_channels,
        split_membership,
        ols_by_channel,
        coef_v2_supplier,
        coef_v2_ad,
        coef_repair,
        coef_fallback_v1,
        coef_fallback_v2,
        user_value_v1,
        user_value_v2,
        report_three_types,
        report_explicit_period,
        report_three_types_v2,
        monthly_per_head,
        curve_mean,
        exp_curve_fit,
        curve_unpivot,
        margin_share_36,
        scan_ledger,
        ledger_untouched_users,
        ledger_match,
        ledger_splits,
        ledger_overdraft,
        ledger_open_balance,
        ledger_match_by_date,
        ledger_match_heavy,
        ledger_full_scope,
        ledger_resume,
        ledger_three_runs,
        fallback_every_level_v1,
        fallback_every_level_v2,
        report_missing_types,
        sink_round_trip,
    )
}
