"""Roll-ups along the channel hierarchies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortmill.functions.dates import DateWindow
from cohortmill.functions.levels import coarse_first_levels
from cohortmill.operators.measures import totals
from cohortmill.schema import COMPUTE_COLS, DIMENSIONS, HIERARCHY, MEASURES, REFER_COLS, ROLLED_UP

# Level of a rolled row: 0 base row, 1 referred class, 2 category, 3 department, 4 all.
LEVEL = "rollup_level"


def _marks(keys: list[str]) -> list[Column]:
    """Per key, whether a grouping set has rolled it up."""
    return [F.expr(f"grouping({name}) AS _rolled_{name}") for name in keys]


def _own_keys_present(keys: list[str]) -> str:
    """A level leaves out rows whose own keys are null."""
    return " AND ".join(f"(_rolled_{name} = 1 OR {name} IS NOT NULL)" for name in keys)


def promoted_rollup(base: DataFrame, dedupe: str = "rows", keep: list[str] | None = None) -> DataFrame:
    """Base rows together with their roll-ups, labels promoted one level down.

    Levels: referred class (class := refer class), category (class := category), department (class and
    category := department) and all (all three := all). The four roll-ups are one pass of grouping sets.
    Columns other than the seven measures are null on roll-ups.

    ``dedupe='rows'`` drops full-row duplicates; ``'measures'`` compares labels and the seven measures
    only, so that a roll-up equal to its base row does not count twice. ``rollup_level`` tells the
    finest level a row came from.

    ``keep`` names the columns the result needs, labels and measures among them. The others still tell rows
    apart, by a 64-bit hash next to the labels and exact measures, so that they are neither shuffled nor written.
    """
    if keep is not None:
        rest = [name for name in base.columns if name not in keep]
        marks = F.lit(None).cast("bigint")
        if rest:
            missing = [F.col(name).isNull() for name in rest]
            marks = F.when(~F.forall(F.array(*missing), lambda gone: gone), F.xxhash64(*rest, *missing))
        base = base.select(*keep, marks.alias("_rest"))
    klass_refer = HIERARCHY[0][1]
    tails = []
    for start in range(1, len(HIERARCHY)):
        tails.append([name for pair in HIERARCHY[start:] for name in pair])
    sets = [[klass_refer, *tails[0]], *tails]
    sets = [[*labels, "type", "ds"] for labels in sets]
    rollup_keys = sets[0]

    # Sums compose: the levels are built over one row per referred class and day, not over the base rows.
    finest = base.groupBy(*rollup_keys).agg(*totals(MEASURES))
    rolled = finest.groupingSets(sets, *rollup_keys).agg(*totals(MEASURES), *_marks(rollup_keys[:-2]))

    rolled = rolled.where(_own_keys_present(rollup_keys[:-2]) + " AND type IS NOT NULL AND ds IS NOT NULL")

    level = "1"
    for depth, (_, refer) in enumerate(HIERARCHY[:-1], start=2):
        level = f"CASE WHEN _rolled_{refer} = 1 THEN {depth} ELSE {level} END"

    # A rolled-up label takes the label of the next coarser level that is still present.
    labels = {}
    for side in (0, 1):
        promoted = labels[HIERARCHY[-1][side]] = HIERARCHY[-1][side]
        for pair in reversed(HIERARCHY[1:-1]):
            name = pair[side]
            promoted = labels[name] = f"CASE WHEN _rolled_{name} = 1 THEN {promoted} ELSE {name} END"
        name = HIERARCHY[0][side]
        labels[name] = f"CASE WHEN _rolled_{klass_refer} = 1 THEN {promoted} ELSE {klass_refer} END"

    rollups = rolled.selectExpr(
        "type", "ds", *[f"{label} AS {name}" for name, label in labels.items()], *MEASURES, f"{level} AS {LEVEL}"
    )
    rows = base.withColumn(LEVEL, F.lit(0)).unionByName(rollups, allowMissingColumns=True)
    if dedupe == "rows":
        return rows.groupBy(*base.columns).agg(F.min(LEVEL).alias(LEVEL)).drop("_rest")
    if dedupe == "measures":
        same = ["type", "ds", *COMPUTE_COLS, *REFER_COLS, *MEASURES]
        others = [name for name in base.columns if name not in same]
        finest = [F.min_by(name, LEVEL).alias(name) for name in others]
        return rows.groupBy(*same).agg(*finest, F.min(LEVEL).alias(LEVEL)).select(*base.columns, LEVEL).drop("_rest")
    raise ValueError(f"unknown dedupe {dedupe!r}")


def suffix_daily(rows: DataFrame, dims: list[str] = DIMENSIONS) -> DataFrame:
    """Daily sums for every proper suffix of the dimensions, per profit type.

    ``level`` is the number of dimensions kept; the others read ``'-'``. Neither the full key nor the
    grand total is a level. A level leaves out rows whose own keys are null.
    """
    kept = dims[1:]
    sets = [["type", "ds", *level] for level in coarse_first_levels(dims)]
    daily = rows.groupingSets(sets, "type", "ds", *kept).agg(*totals(MEASURES), *_marks(kept))
    level = " + ".join(f"cast(1 - _rolled_{name} as int)" for name in kept)
    labels = [f"CASE WHEN _rolled_{name} = 1 THEN '{ROLLED_UP}' ELSE {name} END AS {name}" for name in kept]
    return daily.where(_own_keys_present(kept) + " AND type IS NOT NULL AND ds IS NOT NULL").selectExpr(
        "type", f"{level} AS level", f"'{ROLLED_UP}' AS {dims[0]}", *labels, "ds", *MEASURES
    )


def seen_in(df: DataFrame, keys: list[str], window: DateWindow) -> DataFrame:
    """Rows of the keys that have a row in the window; ``df`` holds one row per key and day."""
    seen = F.max(window.holds(F.col("ds"))).over(Window.partitionBy(*keys))
    return df.withColumn("_seen", seen).where("_seen").drop("_seen")
