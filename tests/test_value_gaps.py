"""Fallback to every level, missing types, far decays, and the train rows by another generator."""

import math

import pytest

import __spark_entry__ as entry
from checks import duckdb_sql
from checks.compare import differences, duck
from cohortmill.operators import curve, regression
from cohortmill.schema import MONTHS
from cohortmill.sources import fixtures as fx

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize(
    ("name", "levels"),
    [("fallback_every_level_v1", {1, 2, 3, 4, None}), ("fallback_every_level_v2", {1, 2, 3, 4, 5, None})],
)
def test_every_level_and_a_miss_occur(spark, name, levels):
    rows = entry.queries()[name](spark, SF).cache()
    assert {row.coef_level for row in rows.select("coef_level").distinct().collect()} == levels
    assert rows.where("coef_level is null and y_m_ds is not null").count() == 0
    assert differences(rows, duck(SF), entry.oracle_sql()[name]) == []
    rows.unpersist()


def test_a_total_is_null_where_a_type_is_missing(spark):
    rows = entry.queries()["report_missing_types"](spark, SF).cache()
    assert rows.where("type_name_ad is null").count() > 0 and rows.where("type_name_licai is null").count() > 0
    lacking = "type_name_ad is null or type_name_licai is null"
    assert rows.where(f"({lacking}) and user_value_all is not null").count() == 0
    assert rows.where(f"not ({lacking}) and user_value_all is not null").count() > 0
    assert differences(rows, duck(SF), entry.oracle_sql()["report_missing_types"]) == []
    rows.unpersist()


@pytest.mark.parametrize("n", [1, 2, 7, 30, 91, 365])
def test_train_rows_equal_another_generator(n):
    assert regression.train_mask(n).tolist() == duckdb_sql.train_mask(n)


def test_size_of_train_rows():
    assert [int(sum(regression.train_mask(n))) for n in (1, 2, 7, 30, 91)] == [0, 1, 5, 22, 68]


@pytest.mark.parametrize(("a", "b", "c"), [(3.0, 40.0, 2.0), (1e-150, -10.0, 5.0), (2.0, 5.5, 1.0), (4.0, 0.25, 1.0), (1e-4, -0.4, 3.0), (1.0, 12.0, 0.0)])
def test_far_decays(spark, a, b, c):
    points = [a * math.exp(-b * x) + c for x in range(36)]
    means = spark.createDataFrame([("k", *points)], ["channel_category", *[f"m{n}" for n in MONTHS]])
    row = curve.exp_fit(means).first()
    assert not row.edge
    for x, y in enumerate(points):
        assert row.a * math.exp(-row.b * x) + row.c == pytest.approx(y, rel=1e-5, abs=1e-7 * max(points))
    if abs(b) < 6 or b < 0:
        assert row.b == pytest.approx(b, rel=1e-4)


def test_a_fit_at_a_limit_is_flagged(spark):
    """A jump in the last month alone grows faster than doubles can say; the job's result has the flag."""
    columns = ["channel_category", *[f"m{n}" for n in MONTHS]]
    jump = spark.createDataFrame([("jump", *[0.0] * 35, 1.0), ("flat", *[2.0 - n / 50 for n in range(36)])], columns)
    edges = {row.channel_category: row.edge for row in curve.exp_fit(jump).collect()}
    assert set(edges) == {"jump", "flat"} and not edges["flat"]
    limits = [curve._beyond(end)[-1] * curve.DECAY_UNIT for end in curve.FIRST_GRID[:2]]
    assert limits[0] <= -20 and limits[1] >= 745
    base = fx.base_info(spark, "/root/testdata/sf0.001")
    shares = curve.margin_share(base, curve.curve_days(fx.WINDOWS.curve.hi, fx.CURVE_START), flagged=True)
    assert shares.columns[-1] == "fit_edge" and {row.fit_edge for row in shares.collect()} == {False}
