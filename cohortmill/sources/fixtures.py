"""The package's input tables, defined over order, line item and event tables (see FIXTURES.md)."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill.functions.dates import DateWindow, ReferenceWindows
from cohortmill.schema import MONTHS

# Profit type of a line item by l_suppkey % 3.
LINE_TYPES = ["e_supplier_profit", "ad_profit", "licai_order_profit"]
FIRST_DAY = dt.date(2000, 1, 1)
# A power of two: sums of multiples of 1 / PROFIT_SCALE are exact in a double, whatever their order.
PROFIT_SCALE = float(2**23)
# Lines and orders that one task sums up: nearly every one is a group of its own, so what a task holds grows with its rows.
ROWS_A_TASK = 250_000
# Slots of an amount: 0 to 35 are the months, then these.
D07, IS_PROFIT, REG = 36, 37, 38

RUN_DAY = dt.date(2001, 4, 14)
WINDOWS = ReferenceWindows.for_run("daily", RUN_DAY)
CURVE_START = FIRST_DAY
FLOOR = DateWindow(dt.date(2000, 4, 1), dt.date(2000, 5, 1))
MIN_REG = 3


# Columns used here; with a schema given, reading needs no look at the files first.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_nationkey INT, c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_orderdate TIMESTAMP_NTZ, "
    "o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, "
    "l_extendedprice DOUBLE, l_discount DOUBLE",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE",
}


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def _tasks(spark: SparkSession, sf_dir: str) -> int:
    """Number of tasks that sum up lines and orders: as many as their rows need, so that no task's memory grows with them."""
    return sum(_read(spark, sf_dir, name).count() for name in ("lineitem", "orders")) // ROWS_A_TASK + 1


def _line_amounts(spark: SparkSession, sf_dir: str, tasks: int) -> DataFrame:
    """Amounts per (order, type, lag) as ``(slot, amount)`` rows, in integer units.

    Pre-aggregated before the join by order, so an order with very many lines stays harmless. All of the
    seven-day profit has lag 0, so the lag-0 row of an order decides whether it is profitable.

    Lines are dealt to their groups' tasks before any are summed: sums of what a task reads first would hardly be
    fewer than its lines, and take memory by the size of a file's pieces.
    """
    lines = _read(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS o_orderkey",
        f"element_at(array({', '.join(map(repr, LINE_TYPES))}), cast(l_suppkey % 3 + 1 as int)) AS type",
        "cast(((l_partkey % 36) * (l_suppkey % 36)) div 36 as int) AS lag",
        "l_linenumber",
        "cast(round(l_extendedprice * 100) as bigint) * cast(round((1 - l_discount) * 100) as bigint) AS units",
    )
    group = ["o_orderkey", "type", "lag"]
    sums = lines.repartition(tasks, *group).groupBy(*group).agg(
        F.expr("sum(units) AS units"),
        F.expr("coalesce(sum(CASE WHEN lag = 0 AND l_linenumber <= 2 THEN units END), 0) AS d07"),
    )
    month, purchase = (
        "array(named_struct('slot', lag, 'amount', units))",
        f"array(named_struct('slot', {D07}, 'amount', d07), "
        f"named_struct('slot', {IS_PROFIT}, 'amount', cast(d07 > 0 as bigint)))",
    )
    return sums.selectExpr(
        "o_orderkey", "type", f"inline(CASE WHEN lag = 0 THEN concat({month}, {purchase}) ELSE {month} END)"
    )


def _registrants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: an order is a registrant."""
    # nation and region are fixed lists (25 and 5 rows), so broadcasting them is safe at any scale.
    places = _read(spark, sf_dir, "nation").join(
        F.broadcast(_read(spark, sf_dir, "region")), F.expr("n_regionkey = r_regionkey")
    )
    customers = _read(spark, sf_dir, "customer").join(F.broadcast(places), F.expr("c_nationkey = n_nationkey"))
    orders = _read(spark, sf_dir, "orders")
    return orders.join(customers, F.expr("o_custkey = c_custkey")).selectExpr(
        "o_orderkey",
        f"date_add(DATE '{FIRST_DAY}', cast(o_orderkey % 480 as int)) AS ds",
        "r_name",
        "n_name",
        "c_mktsegment",
        "o_orderstatus",
        "o_orderpriority",
        "o_custkey % 3 AS source",
    )


def _profits_by(spark: SparkSession, sf_dir: str, keys: list[str], labels: dict[str, str]) -> DataFrame:
    """Measures per (type, day, keys) from the slots; a query sums only the measures it uses.

    Every registrant counts once per profit type, with or without lines of that type. Orders are dealt to a
    number of tasks that follows their rows, not their bytes: a group of the sums holds many labels.
    """
    tasks = _tasks(spark, sf_dir)
    registrants = _registrants(spark, sf_dir)
    counted = registrants.repartition(tasks, "ds", *keys).selectExpr(
        "ds", *keys, f"explode(array({', '.join(map(repr, LINE_TYPES))})) AS type", f"{REG} AS slot", "1L AS amount"
    )
    sides = [side.repartition(tasks, "o_orderkey") for side in (registrants, _line_amounts(spark, sf_dir, tasks))]
    earned = sides[0].join(sides[1], "o_orderkey").select(*counted.columns)

    def units(condition: str) -> str:
        return f"coalesce(sum(CASE WHEN {condition} THEN amount END), 0L)"

    profits = {
        "profit_d07": f"slot = {D07}",
        "profit_y01": "slot < 12",
        "profit_pm08": "slot < 8",
        "profit_mm03": "slot BETWEEN 5 AND 7",
    }
    profits |= {f"profit_m{month}": f"slot = {n}" for n, month in enumerate(MONTHS)}
    measures = {"reg_user_cnt": units(f"slot = {REG}"), "isprofit_d07_cnt": units(f"slot = {IS_PROFIT}")}
    measures |= {name: f"{units(condition)} / {PROFIT_SCALE}D" for name, condition in profits.items()}
    totals = [F.expr(f"{total} AS {name}") for name, total in measures.items()]
    sums = counted.unionByName(earned).groupBy("type", "ds", *keys).agg(*totals)
    return sums.selectExpr("type", "ds", *[f"{label} AS {name}" for name, label in labels.items()], *measures)


def base_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input of the four-level value job and of the margin curve."""
    category = "concat_ws('|', r_name, c_mktsegment)"
    refer_status = "CASE WHEN o_orderstatus = 'P' THEN 'O' ELSE o_orderstatus END"
    labels = {
        "channel_class": f"concat_ws('|', {category}, o_orderstatus)",
        "channel_class_value_refer": f"concat_ws('|', {category}, {refer_status})",
        "channel_category": category,
        "channel_category_value_refer": category,
        "channel_department": "r_name",
        "channel_department_value_refer": "r_name",
        "all_compute": "'ALL'",
        "all_refer": "'ALL'",
    }
    return _profits_by(spark, sf_dir, ["r_name", "c_mktsegment", "o_orderstatus"], labels)


def channel_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input of the six-dimension value job."""
    labels = {
        "ora_source": "concat('SRC', source)",
        "ora_channel": "n_name",
        "ora_activity_type": "o_orderpriority",
        "ora_parent_channel": "o_orderstatus",
        "ora_channel_type": "c_mktsegment",
        "ora_business_type": "r_name",
    }
    keys = ["source", "n_name", "o_orderpriority", "o_orderstatus", "c_mktsegment", "r_name"]
    return _profits_by(spark, sf_dir, keys, labels)


def order_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct order days."""
    return _read(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()


def _amount() -> Column:
    return (F.round(F.col("value") * 100).cast("decimal(16,0)") / 100).cast("decimal(18,2)")


def income(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger incomes: purchases and signups are open, views are already paid."""
    events = _read(spark, sf_dir, "events").where(F.col("event_type").isin("purchase", "signup", "view"))
    no_amount = F.col("event_id") % 50 == 0
    return events.select(
        F.col("event_id").alias("id"),
        ((F.col("event_id") * 7919) % 1000003).alias("seq_id"),
        "user_id",
        F.col("ts").cast("date").alias("ds"),
        F.when(no_amount, F.lit(0).cast("decimal(18,2)")).otherwise(_amount()).alias("show_amount"),
        F.when(F.col("event_type") == "view", 1).otherwise(0).alias("payout_flag"),
        F.lit(None).cast("bigint").alias("payout_id"),
        F.lit(None).cast("int").alias("payout_type_id"),
        F.lit(None).cast("date").alias("payout_date"),
    )


def payout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ledger payouts, with negative amounts; every tenth user has none."""
    events = _read(spark, sf_dir, "events").where(
        F.col("event_type").isin("click", "error") & (F.col("user_id") % 10 != 0)
    )
    return events.select(
        F.col("event_id").alias("id"),
        "user_id",
        F.when(F.col("event_type") == "click", 1).otherwise(2).alias("type_id"),
        F.col("ts").cast("date").alias("ds"),
        (-_amount()).cast("decimal(18,2)").alias("show_amount"),
    )
