"""Tasks of the fixtures hold a bounded number of lines and orders."""

import datetime as dt
import re

from cohortmill.sources import fixtures as fx

ORDERS, LINES = 40, 4


def small_tables(spark, folder):
    """Forty orders of four lines, then a repeated order, one with a null key and one without lines."""
    stamp = dt.datetime(2000, 1, 1)
    orders = [(n, n % 5, "OFP"[n % 3], stamp, f"P{n % 2}") for n in range(ORDERS)]
    orders += [orders[7], (None, 1, "O", stamp, "P0"), (ORDERS, 2, "F", stamp, "P1")]
    lines = [(n, n * 3 + k, n * 7 + k, k + 1, 100.0 + n, 0.05) for n in range(ORDERS) for k in range(LINES)]
    lines += [(None, 1, 1, 1, 5.0, 0.0), lines[0]]
    rows = {
        "region": [(0, "R")],
        "nation": [(0, "N0", 0), (1, "N1", 0)],
        "customer": [(n, n % 2, f"S{n}") for n in range(5)],
        "orders": orders,
        "lineitem": lines,
    }
    for name, values in rows.items():
        spark.createDataFrame(values, fx.SCHEMAS[name]).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return orders, lines


def test_tasks_follow_the_rows_and_results_do_not(spark, tmp_path, monkeypatch, plan_of):
    orders, lines = small_tables(spark, tmp_path)
    tables = [fx.base_info, fx.channel_sum]
    whole = [sorted(map(str, table(spark, str(tmp_path)).collect())) for table in tables]
    monkeypatch.setattr(fx, "ROWS_A_TASK", 10)
    tasks = (len(orders) + len(lines)) // 10 + 1
    assert fx._tasks(spark, str(tmp_path)) == tasks
    assert [sorted(map(str, table(spark, str(tmp_path)).collect())) for table in tables] == whole

    # Lines are dealt first, and summed by the tasks that hold whole groups.
    plan = plan_of(fx._line_amounts(spark, str(tmp_path), tasks))
    assert re.findall(r"Exchange hashpartitioning\(.*, (\d+)\), (\w+)", plan) == [(str(tasks), "REPARTITION_BY_NUM")]
    # The join by order is dealt by rows too.
    plan = plan_of(fx.channel_sum(spark, str(tmp_path)))
    assert len(re.findall(rf"Exchange hashpartitioning\(o_orderkey#\d+L, {tasks}\)", plan)) == 2


def test_sums_are_those_of_all_orders_and_lines(spark, tmp_path, monkeypatch):
    orders, lines = small_tables(spark, tmp_path)
    monkeypatch.setattr(fx, "ROWS_A_TASK", 10)
    rows = fx.channel_sum(spark, str(tmp_path)).collect()
    assert sum(row.reg_user_cnt for row in rows) == 3 * len(orders)
    times = {key: sum(order[0] == key for order in orders) for key in range(ORDERS)}
    year = 0
    for key, part, supplier, _, price, discount in lines:
        if key is not None and (part % 36) * (supplier % 36) // 36 < 12:
            year += times[key] * round(price * 100) * round((1 - discount) * 100)
    assert sum(row.profit_y01 for row in rows) == year / fx.PROFIT_SCALE
