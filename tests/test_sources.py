import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortmill.operators import ledger
from cohortmill.plans import jobs
from cohortmill.sources import fixtures as fx
from cohortmill.sources import sinks, tables

SF = "/root/testdata/sf0.001"


def test_partition_overwrite_leaves_the_others(spark, tmp_path):
    path = str(tmp_path / "report")
    first = spark.createDataFrame([("a", 1.23456)], "channel string, v double")
    sinks.overwrite_partition(first, path, "daily", "w1")
    sinks.overwrite_partition(first, path, "daily", "w2")
    sinks.overwrite_partition(first.withColumn("v", F.lit(2.0)), path, "daily", "w2")
    assert {(r.ds, r.v) for r in spark.read.parquet(path).collect()} == {("w1", 1.2346), ("w2", 2.0)}


def test_table_partition_and_table_overwrite(spark):
    df = spark.createDataFrame([("a", 1.0)], "channel string, v double")
    for freq, ds, v in [("daily", "w1", 1.0), ("weekly", "w1", 2.0), ("daily", "w1", 3.0)]:
        sinks.overwrite_table_partition(df.withColumn("v", F.lit(v)), "reports", freq, ds)
    assert {(r.freq_type, r.v) for r in spark.table("reports").collect()} == {("daily", 3.0), ("weekly", 2.0)}
    for v in (1.0, 2.0):
        sinks.overwrite_table(df.withColumn("v", F.lit(v)), "plain")
    assert [r.v for r in tables.read_table(spark, "plain").collect()] == [2.0]


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "csv")
    df = spark.createDataFrame([("渠道", 1.5, None)], "channel string, v double, n int")
    sinks.dump_csv(df, path)
    assert tables.read_csv(spark, path, df.schema).collect() == df.collect()
    assert tables.read_csv(spark, path).first().v == 1.5


def test_profit_rows_filters_and_casts(spark):
    rows = [("ad_profit", "2020-01-01", 1, "2.5", "a"), ("ad_profit", "", 1, "1", "a"), ("other", "2020-01-01", 1, "1", "a"),
            ("ad_profit", "2020-01-01", 1, "9", "b")]
    df = spark.createDataFrame(rows, "type string, ds string, reg_user_cnt int, profit_d07 string, channel_class string")
    kept = tables.profit_rows(df, channel="a").collect()
    assert [(r.ds, r.reg_user_cnt, r.profit_d07) for r in kept] == [(dt.date(2020, 1, 1), 1, 2.5)]
    assert tables.profit_rows(df, ["other"]).count() == 1


def test_jobs_write_their_results(spark, tmp_path):
    base = fx.base_info(spark, SF)
    report, shares = str(tmp_path / "v1"), str(tmp_path / "curve")
    jobs.run_channel_values(base, "daily", fx.RUN_DAY, report, str(tmp_path / "coefs"))
    jobs.run_margin_curve(base, "daily", fx.RUN_DAY, shares, fx.CURVE_START)
    rows = spark.read.parquet(report)
    assert len(rows.columns) == 29 and rows.count() > 5
    assert {(r.freq_type, r.ds) for r in rows.collect()} == {("daily", "20010331-20010406")}
    assert len(spark.read.parquet(shares).columns) == 39
    assert tables.read_csv(spark, str(tmp_path / "coefs")).count() > 5
    income, payout = fx.income(spark, SF), fx.payout(spark, SF)
    jobs.run_ledger(income, payout, "ledger_result", "ledger_rejects")
    assert spark.table("ledger_result").count() == ledger.match(income, payout).count()
    assert spark.table("ledger_rejects").count() == 0


def test_jobs_scan_take_a_period_and_write_tables(spark, tmp_path):
    foreign = {"type": F.lit("foreign_profit")}
    days = fx.channel_sum(spark, SF)
    days = days.unionByName(days.limit(20).withColumns(foreign))
    days = days.withColumn("ds", F.col("ds").cast("string"))
    days = days.unionByName(days.limit(1).withColumn("ds", F.lit("")))
    days.write.parquet(str(tmp_path / "sums"))
    rows = spark.read.parquet(str(tmp_path / "sums"))
    period = (fx.WINDOWS.cohort.lo, fx.WINDOWS.cohort.hi)
    jobs.run_suffix_values(rows, "monthly", dt.date(2001, 9, 1), "suffix_reports", period=period)
    report = spark.table("suffix_reports")
    assert {(r.freq_type, r.ds) for r in report.select("freq_type", "ds").distinct().collect()} == {
        ("monthly", fx.WINDOWS.cohort.label)
    }
    assert report.count() > 5


def test_ledger_job_writes_overdraft_and_fails_on_rejects(spark):
    income, payout = fx.income(spark, SF), fx.payout(spark, SF)
    jobs.run_ledger(income, payout, "ledger_all", scope="full", overdraft_table="ledger_beyond")
    assert spark.table("ledger_all").count() == ledger.match(income, payout, scope="full").count()
    wanted = sorted(map(str, ledger.overdraft(income, payout).collect()))
    assert sorted(map(str, spark.table("ledger_beyond").collect())) == wanted and wanted
    bad = income.limit(1).withColumn("show_amount", F.lit(-1).cast("decimal(18,2)"))
    with pytest.raises(ValueError, match="rejects_table"):
        jobs.run_ledger(bad, payout, "runs")
