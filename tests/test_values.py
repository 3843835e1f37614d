import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortmill.functions.dates import DateWindow, ReferenceWindows
from cohortmill.operators import coefficients, curve, fallback, hierarchy, measures, outliers, regression
from cohortmill.schema import COMPUTE_COLS, DIMENSIONS, MONTHS, REFER_COLS

DAY = dt.date(2020, 1, 1)


def test_a_single_row_is_an_outlier(spark):
    rows = [("a", DAY, 10, 5.0), ("b", DAY, 10, 5.0), ("b", DAY + dt.timedelta(1), 10, 6.0), ("b", DAY, 0, 1.0)]
    df = spark.createDataFrame(rows, "k string, ds date, reg_user_cnt bigint, profit_m01 double")
    for rule in (outliers.drop_outliers, outliers.drop_daily_outliers):
        assert sorted(r.profit_m01 for r in rule(df, ["k"]).collect()) == [5.0, 6.0]
        assert rule(df, ["k"], 11).count() == 0


@pytest.mark.parametrize("max_rows", [91, None], ids=["lookup", "in tasks"])
def test_regression_on_the_train_split(spark, max_rows):
    rng = np.random.default_rng(1)
    groups = {"many": (rng.random(40), rng.random(40)), "flat": (np.ones(8), rng.random(8)),
              "two": (np.array([1.0, 2.0]), np.array([3.0, 4.0])), "one": (np.array([1.0]), np.array([3.0]))}
    rows = [(k, n, float(x), float(y), True) for k, (xs, ys) in groups.items() for n, (x, y) in enumerate(zip(xs, ys))]
    rows += [("many", 99, 7.0, 7.0, False)]
    df = spark.createDataFrame(rows, "k string, o int, x double, y double, used boolean")
    split = regression.with_split(df, ["k"], ["o"], F.col("used"), max_rows)
    slope, intercept = regression.train_fit("y", "x")
    got = {r.k: (r.a, r.b) for r in split.groupBy("k").agg(slope.alias("a"), intercept.alias("b")).collect()}
    xs, ys = (values[regression.train_mask(40)] for values in groups["many"])
    assert got["many"] == pytest.approx(tuple(np.polyfit(xs, ys, 1)))
    assert got["flat"] == (0.0, pytest.approx(groups["flat"][1][regression.train_mask(8)].mean()))
    assert got["two"] == (0.0, groups["two"][1][regression.train_mask(2)][0])
    assert got["one"] == (0.0, 0.0)


COEF = "type_name string, channel string, channel_category string, channel_department string"


def coef_table(spark, rows):
    schema = COEF + ", m_w_multiple double, m_w_coef double, m_w_intercept double, y_m_multiple double"
    fixed = {"column_name": "''", "ds": "'w'", "reg_user_cnt": "1L", "rate_d07": "1D", "profit_d07": "1D",
             "user_value": "1D", "m_w_ds": "'m'", "y_m_ds": "'y'"}
    df = spark.createDataFrame(rows, schema).withColumns({n: F.expr(e) for n, e in fixed.items()})
    return df.select(*coefficients.COEF_COLUMNS)


def test_repair_takes_the_parent_as_it_was(spark):
    rows = [
        ("ad_profit", "a", "c", "d", 0.8, None, None, 2.0),
        ("ad_profit", "c", "c", "d", 1.5, None, None, 0.5),
        ("ad_profit", "b", "low", "d", 0.7, None, None, 3.0),
        ("ad_profit", "low", "low", "d", 0.9, None, None, 3.0),
        ("ad_profit", "d", "d", "d", 5.0, None, None, 5.0),
        ("e_supplier_profit", "a", "c", "d", None, 0.5, 9.0, 1.0),
        ("e_supplier_profit", "c", "c", "d", None, 4.0, 2.0, 7.0),
    ]
    fixed = coefficients.repaired(coef_table(spark, rows))
    got = {(r.type_name, r.channel): r for r in fixed.collect()}
    assert got["ad_profit", "a"].m_w_multiple == 1.5
    assert got["ad_profit", "b"].m_w_multiple == 0.9
    supplier = got["e_supplier_profit", "a"]
    assert (supplier.m_w_coef, supplier.m_w_intercept, supplier.y_m_multiple) == (4.0, 2.0, 7.0)


def test_channel_fallback_takes_the_first_existing_level(spark):
    rows = [("ad_profit", *key, 2.0, None, None, 2.0) for key in [("k", "c", "d"), ("c2", "c2", "d"), ("d3", "d3", "d3"), ("all",) * 3]]
    refers = [("ad_profit", *key) for key in [("k", "c", "d", "all"), ("x", "c2", "d", "all"), ("x", "y", "d3", "all"),
                                              ("x", "y", "z", "all"), ("x", "y", "z", "other")]]
    names = ", ".join(f"{n} string" for n in ["type", *REFER_COLS])
    found = fallback.channel_fallback(spark.createDataFrame(refers, names), coef_table(spark, rows))
    assert {(tuple(r[n] for n in REFER_COLS), r.coef_level) for r in found.collect()} == {
        (("k", "c", "d", "all"), 1), (("x", "c2", "d", "all"), 2), (("x", "y", "d3", "all"), 3), (("x", "y", "z", "all"), 4)
    }


def test_suffix_fallback_passes_over_invalid_levels(spark):
    names = ", ".join(f"{n} string" for n in DIMENSIONS)
    schema = f"type string, level int, valid int, {names}, m_w_coef double"
    table = spark.createDataFrame(
        [("ad_profit", 5, 0, "-", "b", "c", "d", "e", "f", 1.0), ("ad_profit", 2, 1, "-", "-", "-", "-", "e", "f", 2.0),
         ("ad_profit", 1, 1, "-", "-", "-", "-", "-", "f", 3.0)], schema,
    )
    others = [n for n in coefficients.COEF_VALUES if n != "m_w_coef"]
    table = table.withColumns({n: F.lit(None).cast("double") for n in others})
    rows = spark.createDataFrame(
        [("ad_profit", "a", "b", "c", "d", "e", "f"), ("ad_profit", "a", "b", "c", "d", "z", "f"),
         ("ad_profit", "a", "b", "c", "d", "e", "z")], f"type string, {names}",
    )
    found = fallback.suffix_fallback(rows, table)
    text = fallback.suffix_ref_col(F.col("coef_level"), DIMENSIONS)
    got = {(r.ora_channel_type, r.coef_level, r.m_w_coef) for r in found.collect()}
    assert got == {("e", 2, 2.0), ("z", 1, 3.0)}
    texts = rows.join(found, ["type", *DIMENSIONS[1:]], "left").select("ora_business_type", text.alias("t"))
    assert "'ora_channel_type'='-' & 'ora_business_type'='z'" in {r.t[-48:] for r in texts.collect()}


def base_rows(spark, rows):
    """rows: (class, class refer, category, department, day, reg)."""
    schema = "channel_class string, channel_class_value_refer string, channel_category string, channel_department string, ds date, reg_user_cnt bigint"
    df = spark.createDataFrame(rows, schema)
    extra = {"type": "'ad_profit'", "channel_category_value_refer": "channel_category",
             "channel_department_value_refer": "channel_department", "all_compute": "'all'", "all_refer": "'all'",
             "isprofit_d07_cnt": "1L", "profit_m02": "1D"}
    extra |= {n: "cast(reg_user_cnt as double)" for n in ["profit_d07", "profit_m01", "profit_y01", "profit_pm08", "profit_mm03"]}
    return df.withColumns({n: F.expr(e) for n, e in extra.items()})


def test_rollup_promotes_labels_and_drops_null_keys(spark):
    base = base_rows(spark, [("a", "b", "c", "d", DAY, 1), ("b", "b", "c", "d", DAY, 2), ("x", "x", None, "d", DAY, 4)])
    rolled = hierarchy.promoted_rollup(base)
    got = {(r.rollup_level, r.channel_class, r.channel_category, r.channel_department, r.reg_user_cnt) for r in rolled.collect()}
    assert {g for g in got if g[0] > 0} == {
        (1, "b", "c", "d", 3), (2, "c", "c", "d", 3), (3, "d", "d", "d", 7), (4, "all", "all", "all", 7)
    }
    assert rolled.count() == 7
    assert rolled.where("rollup_level > 0 AND profit_m02 IS NOT NULL").count() == 0


def test_rollup_dedupe_by_measures(spark):
    base = base_rows(spark, [("a", "a", "c", "d", DAY, 1), ("e", "e", "c", "d", DAY, 1)])
    assert hierarchy.promoted_rollup(base).where("channel_class = 'a'").count() == 2
    kept = hierarchy.promoted_rollup(base, "measures").where("channel_class = 'a'").collect()
    assert [(r.rollup_level, r.profit_m02) for r in kept] == [(0, 1.0)]


def test_floor_moves_only_the_multiple_types(spark):
    windows = ReferenceWindows.of(dt.date(2017, 7, 1), dt.date(2017, 7, 7))
    floor = DateWindow(dt.date(2016, 7, 14), dt.date(2016, 8, 13))
    days = [dt.date(2016, 6, 25), dt.date(2016, 7, 20), dt.date(2017, 7, 3)]
    base = base_rows(spark, [("a", "a", "c", "d", day, n) for n, day in enumerate(days, start=1)])
    both = base.unionByName(base.withColumn("type", F.lit("e_supplier_profit")))
    table = coefficients.channel_coefficients(hierarchy.promoted_rollup(both), windows, floor)
    labels = {(r.type_name, r.y_m_ds) for r in table.collect()}
    assert labels == {("ad_profit", floor.label), ("e_supplier_profit", windows.year.label)}


def test_exponential_fit_finds_the_parameters(spark):
    wanted = {"x": (9.0, 0.3, 1.0), "y": (4.0, 0.05, 0.2), "up": (0.5, -0.1, 2.0)}
    rows = [(k, *[float(a * np.exp(-b * n) + c) for n in range(36)]) for k, (a, b, c) in wanted.items()]
    means = spark.createDataFrame(rows, "channel_category string, " + ", ".join(f"m{n} double" for n in MONTHS))
    for row in curve.exp_fit(means).collect():
        assert (row.a, row.b, row.c) == pytest.approx(wanted[row.channel_category], rel=1e-3)


def test_plans_stay_in_the_jvm_and_push_down(spark, plan_of, tmp_path):
    windows = ReferenceWindows.of(dt.date(2017, 7, 1), dt.date(2017, 7, 7))
    names = [f"{n} string" for n in ["type", *DIMENSIONS]] + ["ds date", "reg_user_cnt bigint", "isprofit_d07_cnt bigint"]
    names += [f"{n} double" for n in ["profit_d07", "profit_m01", "profit_y01", "profit_pm08", "profit_mm03", "other"]]
    spark.createDataFrame([], ", ".join(names)).write.parquet(str(tmp_path / "sum"))
    rows = spark.read.parquet(str(tmp_path / "sum"))
    plan = plan_of(coefficients.suffix_coefficients(rows, windows))
    # One shuffle for the grouping sets, one for everything that follows by key.
    assert plan.count("Exchange hashpartitioning") == 2
    for word in ("Python", "NestedLoop", "Cartesian", "other"):
        assert word not in plan
    totals = plan_of(measures.window_totals(rows, ["type"], windows))
    assert "GreaterThanOrEqual(ds,2016-06-20)" in totals and "LessThanOrEqual(ds,2017-07-07)" in totals
    assert set(COMPUTE_COLS).isdisjoint(rows.columns)


def test_train_rows_are_a_fixed_permutation():
    """Golden: what a permutation with seed 1 leaves after a quarter, rounded up, is set aside."""
    golden = {1: "0", 2: "01", 3: "011", 4: "1110", 5: "10011", 8: "11011110", 10: "1101110110"}
    for n, wanted in golden.items():
        assert "".join("1" if train else "0" for train in regression.train_mask(n)) == wanted, n


def test_a_group_beyond_the_bound_is_an_error(spark):
    rows = spark.range(10).select(F.lit("k").alias("k"), F.col("id").alias("o"))
    split = regression.with_split(rows, ["k"], ["o"], F.lit(True), max_rows=5)
    with pytest.raises(Exception, match="more than 5 sample rows"):
        split.collect()


@pytest.mark.parametrize("decay", [4.0, 1.0, -0.8])
def test_decay_beyond_the_first_grid(spark, decay):
    points = [3.0 * math.exp(-decay * x) + 1.0 for x in range(36)]
    row = [("c", *points)]
    means = spark.createDataFrame(row, "channel_category string, " + ", ".join(f"m{n} double" for n in MONTHS))
    fit = curve.exp_fit(means).first()
    assert not fit.edge and fit.b == pytest.approx(decay, abs=1e-3 if decay > 0 else 1e-2)
