import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortmill.functions import dates
from cohortmill.functions.levels import coarse_first_levels, fallback_levels, parent_level


def test_year_week_follows_monday_weeks(spark):
    days = [dt.date(2015, 1, 1) + dt.timedelta(days=n) for n in range(0, 2557)]
    rows = spark.createDataFrame([(d,) for d in days], "d date").select("d", dates.year_week(F.col("d")))
    for day, label in rows.collect():
        assert label == day.strftime("%Y%W")


def test_known_days(spark):
    row = (
        spark.createDataFrame([(dt.date(2017, 1, 1), dt.date(2016, 2, 10))], "a date, b date")
        .select(
            dates.year_week(F.col("a")).alias("week"),
            dates.week_label(F.col("a")).alias("scope"),
            dates.month_end(F.col("b")).alias("end"),
            dates.previous_month_end(F.col("b")).alias("before"),
            dates.range_label(F.col("b"), F.col("a")).alias("label"),
        )
        .first()
    )
    assert row.week == "201700"
    assert row.scope == "2016-12-26-2017-01-01"
    assert row.end == dt.date(2016, 2, 29)
    assert row.before == dt.date(2016, 1, 31)
    assert row.label == "20160210-20170101"


def test_windows_have_the_fixed_offsets():
    windows = dates.ReferenceWindows.of(dt.date(2001, 3, 31), dt.date(2001, 4, 6))
    assert windows.cohort.label == "20010331-20010406"
    assert windows.month.label == "20010213-20010315"
    assert windows.quarter.label == "20001016-20010114"
    assert windows.year.label == "20000320-20000419"
    assert windows.curve.hi == dt.date(2001, 1, 1)
    with pytest.raises(ValueError):
        dates.ReferenceWindows.of(dt.date(2001, 4, 7), dt.date(2001, 4, 6))


def test_window_ends_are_inclusive(spark):
    window = dates.DateWindow(dt.date(2020, 1, 2), dt.date(2020, 1, 4))
    days = spark.createDataFrame([(dt.date(2020, 1, n),) for n in range(1, 7)], "ds date")
    kept = [row.ds.day for row in days.where(window.holds(F.col("ds"))).collect()]
    assert sorted(kept) == [2, 3, 4]


def test_floor_replaces_an_earlier_window_without_changing_it():
    window = dates.DateWindow(dt.date(2016, 7, 1), dt.date(2016, 7, 31))
    floor = dates.DateWindow(*dates.YEAR_WINDOW_FLOOR)
    assert window.not_before(floor).label == "20160714-20160813"
    assert window.label == "20160701-20160731"
    assert floor.not_before(window) is floor
    assert window.not_before(None) is window


@pytest.mark.parametrize(
    "mode, begin, end",
    [
        ("daily", dt.date(2017, 7, 1), dt.date(2017, 7, 7)),
        ("weekly", dt.date(2017, 6, 26), dt.date(2017, 7, 2)),
        ("monthly", dt.date(2017, 6, 1), dt.date(2017, 6, 30)),
    ],
)
def test_run_periods(spark, mode, begin, end):
    t = dt.date(2017, 7, 15)
    assert dates.run_period(mode, t) == (begin, end)
    row = spark.createDataFrame([(t,)], "t date").select(*dates.run_period_columns(mode, F.col("t"))).first()
    assert tuple(row) == (begin, end)


def test_levels():
    assert fallback_levels(["a", "b", "c"]) == [["b", "c"], ["c"]]
    assert coarse_first_levels(["a", "b", "c"]) == [["c"], ["b", "c"]]
    assert parent_level(["a", "b", "c"]) == ["b", "c"]
