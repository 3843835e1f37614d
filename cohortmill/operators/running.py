"""Running totals per key that stay exact and balanced when one key holds a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Bits of an order key that one window task sorts: at most 65,536 distinct keys.
RADIX_BITS = 16
KEY_BITS = 64


def radix_levels(columns: list[str], bits: int = RADIX_BITS) -> list[list[tuple[str, int]]]:
    """Ever coarser groupings of rows ordered by whole-number columns, finest first.

    Each grouping is a list of ``(column, right shift)``; the last one is empty (everything together).
    Neighbouring groupings differ by ``bits`` bits of one column, so a group holds at most ``2**bits``
    groups of the next finer grouping, as long as the columns tell the rows of a key apart.
    """
    levels = []
    for last in range(len(columns) - 1, -1, -1):
        head = [(name, 0) for name in columns[:last]]
        levels += [[*head, (columns[last], shift)] for shift in range(bits, KEY_BITS, bits)]
        levels.append(head)
    return levels


def running_totals(
    rows: DataFrame,
    keys: list[str],
    order: list[str],
    totals: dict[str, Column],
    bits: int = RADIX_BITS,
) -> DataFrame:
    """Add inclusive running sums of ``totals`` over ``keys`` in the given order, by radix of the order.

    Rows are summed within small groups of neighbouring order keys; group totals, pre-aggregated, are
    summed within larger groups, and so on up to the whole key. No task sorts more than ``2**bits`` order
    keys of one key, however many rows it has. ``order`` columns are whole numbers, never null, and
    together tell the rows of a key apart; negative numbers keep their order, since shifts round down.
    """
    levels = radix_levels(order, bits)
    names = list(totals)
    measured = rows.withColumns({f"_amount_{name}": value for name, value in totals.items()})

    def group_columns(depth: int) -> dict[str, Column]:
        return {
            f"_g{depth}_{position}": F.shiftright(F.col(name).cast("bigint"), shift)
            for position, (name, shift) in enumerate(levels[depth])
        }

    grouped = measured.withColumns({n: c for d in range(len(levels)) for n, c in group_columns(d).items()})

    def offsets(parts: DataFrame, depth: int) -> DataFrame:
        """Totals before each group of a level; ``parts`` holds one row per such group."""
        own = list(group_columns(depth))
        outer = list(group_columns(depth + 1))
        before = (
            Window.partitionBy(*keys, *outer).orderBy(*own).rowsBetween(Window.unboundedPreceding, -1)
        )
        local = parts.withColumns(
            {f"_local_{n}": F.coalesce(F.sum(f"_amount_{n}").over(before), F.lit(0)) for n in names}
        )
        if not outer:
            return local.select(*keys, *own, *[F.col(f"_local_{n}").alias(f"_before_{n}") for n in names])
        coarser = [c for d in range(depth + 2, len(levels)) for c in group_columns(d)]
        sums = [F.sum(f"_amount_{n}").alias(f"_amount_{n}") for n in names]
        above = offsets(parts.groupBy(*keys, *outer, *coarser).agg(*sums), depth + 1)
        total = {f"_before_{n}": F.col(f"_local_{n}") + F.col(f"_before_{n}") for n in names}
        return local.join(above, [*keys, *outer]).withColumns(total).select(*keys, *own, *total)

    finest = list(group_columns(0))
    coarser = [c for d in range(1, len(levels)) for c in group_columns(d)]
    sums = [F.sum(f"_amount_{n}").alias(f"_amount_{n}") for n in names]
    before = offsets(grouped.groupBy(*keys, *finest, *coarser).agg(*sums), 0)
    upto = (
        Window.partitionBy(*keys, *finest)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = grouped.withColumns({f"_local_{n}": F.sum(f"_amount_{n}").over(upto) for n in names})
    return (
        local.join(before, [*keys, *finest])
        .withColumns({n: F.col(f"_local_{n}") + F.col(f"_before_{n}") for n in names})
        .select(*rows.columns, *names)
    )
