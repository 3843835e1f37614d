"""36-month margin share curve per channel category, with an exponential tail."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortmill.functions.dates import CURVE_START
from cohortmill.functions.ratios import exp_curve
from cohortmill.operators.measures import monthly_per_head
from cohortmill.schema import MONTHS

# Months r_m31 to r_m36 come from the fit.
OBSERVED_MONTHS = MONTHS[:30]
FITTED_MONTHS = MONTHS[30:]

# Decay search: b = k * DECAY_UNIT for whole k, so every engine tries the same doubles. The first grid
# spans [-0.5, 3.0] and leaves out b = 0. Where its best k is at an end, the search goes on beyond that end in steps
# that grow with k, up to LIMITS, where exp(-b) or its inverse after 35 months leaves the range of doubles: further
# decays give the same curve or none. Each later grid spans one step either side of the best k so far, with a tenth of the
# step, down to single units.
DECAY_UNIT = 5e-7
FIRST_GRID = (-950_000, 5_950_000, 100_000)
LIMITS = (-20.0, 745.0)
STEPS_AN_OCTAVE = 8
ROUNDS = 9


def curve_days(curve_end: dt.date, curve_start: dt.date = CURVE_START) -> Column:
    """Registration days the curve uses; the end is exclusive."""
    return (F.col("ds") >= F.lit(curve_start)) & (F.col("ds") < F.lit(curve_end))


def curve_months(base: DataFrame, days: Column) -> DataFrame:
    """Monthly margins per registrant by (category, registration month), all profit types together."""
    return monthly_per_head(base, "channel_category", days)


def curve_mean(base: DataFrame, days: Column) -> DataFrame:
    """Unweighted mean over registration months, nulls skipped."""
    means = [F.expr(f"avg(m{n}) AS m{n}") for n in MONTHS]
    return curve_months(base, days).groupBy("channel_category").agg(*means)


def curve_points(means: DataFrame) -> DataFrame:
    """36 rows per category: month index from 0 and margin, null as 0."""
    long = means.unpivot("channel_category", [f"m{n}" for n in MONTHS], "month", "profit")
    index = F.substring("month", 2, 2).cast("int") - 1
    return long.select("channel_category", index.alias("x"), F.coalesce("profit", F.lit(0.0)).alias("profit"))


def _beyond(end: int) -> list[int]:
    """Ever larger k from an end of the first grid to the limit on its side."""
    limit = LIMITS[0 if end < 0 else 1] / DECAY_UNIT
    grid = [end]
    while abs(grid[-1]) < abs(limit):
        grid.append(round(end * 2 ** (len(grid) / STEPS_AN_OCTAVE)))
    return grid


def _grid_best(points: Column, grid: Column, low: int) -> Column:
    """Best decay of a grid: struct (sse, k, a, c) of the least-squares fit ``a * exp(-b * x) + c``.

    For a given b the model is linear, so a and c have a closed form and only b is searched. Below ``low``, growth is counted
    back from the last month, as its squares would leave the range of doubles.
    """
    last = float(len(MONTHS) - 1)
    n = float(len(MONTHS))
    zero = F.lit(0.0)
    sum_y = F.aggregate(points, zero, lambda total, y: total + y)
    sum_yy = F.aggregate(points, zero, lambda total, y: total + y * y)

    def fit(k: Column) -> Column:
        b = k.cast("double") * F.lit(DECAY_UNIT)
        shift = F.when(k < low, last).otherwise(zero)
        basis = F.transform(points, lambda _, x: F.exp(-b * (x.cast("double") - shift)))
        sums = F.aggregate(
            F.arrays_zip(points.alias("y"), basis.alias("e")),
            F.struct(zero.alias("e"), zero.alias("ee"), zero.alias("ye")),
            lambda total, p: F.struct(
                (total["e"] + p["e"]).alias("e"),
                (total["ee"] + p["e"] * p["e"]).alias("ee"),
                (total["ye"] + p["y"] * p["e"]).alias("ye"),
            ),
        )
        return F.struct(k.alias("k"), sums.alias("s"))

    def solve(row: Column) -> Column:
        s = row["s"]
        spread = s["ee"] - s["e"] * s["e"] / n
        joint = s["ye"] - s["e"] * sum_y / n
        a = F.when(spread > 0, joint / spread).otherwise(zero)
        c = (sum_y - a * s["e"]) / n
        sse = sum_yy - sum_y * sum_y / n - a * joint
        back = F.exp(F.lit(DECAY_UNIT * last) * row["k"].cast("double"))
        first = F.when(row["k"] < low, a * back).otherwise(a)
        return F.struct(sse.alias("sse"), row["k"].alias("k"), first.alias("a"), c.alias("c"))

    return F.array_min(F.transform(F.transform(grid, fit), solve))


def exp_fit(means: DataFrame, first_grid: tuple[int, int, int] = FIRST_GRID) -> DataFrame:
    """Least-squares ``a, b, c`` of ``a * exp(-b * x) + c`` over x = 0..35 per category.

    Works on the one row of each category, so it needs no shuffle. Always yields the best grid point; ``edge``
    tells that it is at a limit of what doubles can hold, so the fit may lie beyond. Decays of about 20 and more all but
    vanish in the second month: any of them gives the same curve.
    """
    months = F.expr(f"array({', '.join(f'coalesce(m{n}, 0D)' for n in MONTHS)})")
    fitted = means.withColumn("_points", months)
    low, high, step = first_grid
    first = F.sequence(F.lit(low), F.lit(high), F.lit(step))
    fitted = fitted.withColumn("_best", _grid_best(F.col("_points"), first, low))
    sides = {end: _beyond(end) for end in (low, high)}
    best, at_end = F.col("_best.k"), F.col("_best.k").isin(low, high)
    beyond = F.when(best == low, F.lit(sides[low])).otherwise(F.lit(sides[high]))
    fitted = fitted.withColumn("_best", F.when(at_end, _grid_best(F.col("_points"), beyond, low)).otherwise(F.col("_best")))
    outside = (best <= low) | (best >= high)
    fitted = fitted.withColumns(
        {
            "_edge": best.isin(sides[low][-1], sides[high][-1]),
            "_step": F.when(outside, F.ceil(F.abs(best) * (2 ** (1 / STEPS_AN_OCTAVE) - 1))).otherwise(F.lit(step)).cast("int"),
        }
    )
    for _ in range(ROUNDS):
        wide = F.col("_step")
        fitted = fitted.withColumn("_finer", F.ceil(wide / 10).cast("int"))
        around = F.sequence(best - 10 * F.col("_finer"), best + 10 * F.col("_finer"), F.col("_finer"))
        found = _grid_best(F.col("_points"), around, low)
        fitted = fitted.withColumns(
            {"_best": F.when(wide > 1, found).otherwise(F.col("_best")), "_step": F.when(wide > 1, F.col("_finer")).otherwise(wide)}
        )
    return fitted.select(
        *means.columns,
        F.col("_best.a").alias("a"),
        (F.col("_best.k") * F.lit(DECAY_UNIT)).alias("b"),
        F.col("_best.c").alias("c"),
        F.col("_edge").alias("edge"),
    )


def margin_share(base: DataFrame, days: Column, tail_offset: int = 1, flagged: bool = False) -> DataFrame:
    """Shares of the first year's margin, ``r_m01`` to ``r_m36``, per category.

    Months 1 to 30 are observed, 31 to 36 fitted. The fit counts month 1 as x = 0; the tail reads month n
    at ``x = n - 1 + tail_offset``, one month late by default. Shares are null without a first-year margin. ``flagged`` adds ``fit_edge``, whether the
    fit is at a limit of the search.
    """
    first_year = " + ".join(f"m{n}" for n in MONTHS[:12])
    observed = [f"try_divide(m{n}, _year) AS r_m{n}" for n in OBSERVED_MONTHS]
    fitted = [
        exp_curve(F.lit(float(int(n) - 1 + tail_offset)), F.col("a"), F.col("b"), F.col("c")).alias(f"f{n}")
        for n in FITTED_MONTHS
    ]
    curves = exp_fit(curve_mean(base, days)).select("*", F.expr(f"{first_year} AS _year"), *fitted)
    return curves.selectExpr(
        "channel_category", *observed, *[f"try_divide(f{n}, _year) AS r_m{n}" for n in FITTED_MONTHS],
        *(["edge AS fit_edge"] if flagged else []),
    )
