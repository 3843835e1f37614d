"""Income to payout matching per user.

Per user, open incomes in their order and payouts in theirs are laid side by side on one axis of money:
an income covers ``(lo, hi]`` of the running income, a payout likewise of the running payout. Where the
two overlap, the payout consumes that part of the income. Income beyond the last payout stays open, payout
beyond the last income is dropped. Instead of joining the overlaps, one sweep over the sorted end points
yields every overlap once: each end point closes exactly one piece, owned by the next income and the next
payout at or after it.

Users of ordinary size need one shuffle by user. Users with very many rows, found by a count up front, are
cut into chunks of bounded size first, see :func:`_heavy_pieces`. Both ways are exact and give the same
rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortmill.operators.running import RADIX_BITS, running_totals
from cohortmill.sources.checkpoints import written

USER = "user_id"
INCOME, PAYOUT = 0, 1
# Columns a match sets on an income row.
SET_COLUMNS = ["show_amount", "payout_flag", "payout_id", "payout_type_id", "payout_date"]


@dataclass(frozen=True)
class Sizes:
    """Limits of the physical path; they never change results."""

    heavy_rows: int = 1_000_000
    """A user with more rows is cut into chunks."""
    chunk_rows: int = 65_536
    """Incomes or payouts per chunk."""
    block_segments: int = 512
    """Segments looked at together when rows are handed out to segments."""
    radix_bits: int = RADIX_BITS


def _cents(amount: Column) -> Column:
    return (amount.cast("decimal(18,2)") * 100).cast("bigint")


def _amount(cents: Column) -> Column:
    return (cents.cast("decimal(18,0)") / 100).cast("decimal(18,2)")


def valid_income(income: DataFrame) -> Column:
    """Null or negative incomes cannot be laid out on the axis."""
    return F.coalesce(F.col("show_amount") >= 0, F.lit(False))


def valid_payout(payout: DataFrame) -> Column:
    """Payouts are negative amounts."""
    return F.coalesce(F.col("show_amount") < 0, F.lit(False))


def income_order(order: str) -> tuple[Column, Column]:
    """The two columns that order a user's incomes."""
    if order == "seq":
        return F.col("seq_id"), F.col("id")
    if order == "date":
        return F.unix_date("ds"), F.col("id")
    raise ValueError(f"unknown order {order!r}")


def ordered_income(order: str) -> Column:
    """An income without one of its order columns has no place in the user's order."""
    first, second = income_order(order)
    return first.isNotNull() & second.isNotNull()


def rejected(income: DataFrame, payout: DataFrame, order: str = "seq") -> DataFrame:
    """Side table of rows that take no part in matching: no user, an amount of the wrong sign, or no place in the order."""

    def bad(df: DataFrame, source: str, valid: Column, placed: Column) -> DataFrame:
        reason = F.when(F.col(USER).isNull(), "no user").when(~valid, "amount").otherwise("order")
        return df.where(~valid | F.col(USER).isNull() | ~placed).select(
            F.lit(source).alias("source"), "id", USER, "show_amount", reason.alias("reason")
        )

    incomes = bad(income, "income", valid_income(income), ordered_income(order))
    return incomes.unionByName(bad(payout, "payout", valid_payout(payout), F.col("id").isNotNull()))


def enters(income: DataFrame, order: str) -> Column:
    """Open incomes that take part in matching; never null."""
    enters = (F.col("payout_flag") == 0) & F.col(USER).isNotNull() & valid_income(income) & ordered_income(order)
    return F.coalesce(enters, F.lit(False))


def _entries(income: DataFrame, payout: DataFrame, order: str) -> DataFrame:
    """Open incomes and payouts in one shape; ``_o1, _o2`` is the order within a user and side."""
    first, second = income_order(order)
    kept = [name for name in income.columns if name not in (USER, *SET_COLUMNS)]
    incomes = income.where(enters(income, order))
    payouts = payout.where(F.col(USER).isNotNull() & valid_payout(payout) & F.col("id").isNotNull())
    return incomes.select(
        USER,
        F.lit(INCOME).alias("side"),
        first.cast("bigint").alias("_o1"),
        second.cast("bigint").alias("_o2"),
        _cents(F.col("show_amount")).alias("cents"),
        F.struct(*kept, _cents(F.col("show_amount")).alias("_cents")).alias("income"),
    ).unionByName(
        payouts.select(
            USER,
            F.lit(PAYOUT).alias("side"),
            F.col("id").cast("bigint").alias("_o1"),
            F.lit(0).cast("bigint").alias("_o2"),
            (-_cents(F.col("show_amount"))).alias("cents"),
            F.struct(
                F.col("id").alias("payout_id"),
                F.col("type_id").alias("payout_type_id"),
                F.col("ds").alias("payout_date"),
            ).alias("payout"),
        ),
        allowMissingColumns=True,
    )


def _sweep(intervals: DataFrame, keys: list[str], order: str, start: Column) -> DataFrame:
    """Pieces ``(_from, _to]`` between neighbouring end points of a group, with their owners.

    ``income`` or ``payout`` is null where no owner is left. A zero income is a piece of no length, owned
    by the first payout that ends at or after it (``seq`` order) or after it (``date`` order).

    Sorted downwards, the next owner above a point is the last one seen, and the window keeps running
    state only; looking upwards would rescan the rest of the group for every row.
    """
    income_first = F.when(F.col("side") == INCOME, 0 if order == "seq" else 1).otherwise(
        1 if order == "seq" else 0
    )
    down = Window.partitionBy(*keys).orderBy(F.col("hi").desc(), income_first.desc(), F.col("lo").desc())
    seen = down.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    swept = intervals.withColumns(
        {
            "_from": F.coalesce(F.lead("hi").over(down), start),
            "_next_income": F.last("income", ignorenulls=True).over(seen),
            "_next_payout": F.last("payout", ignorenulls=True).over(seen),
        }
    )
    is_income = F.col("side") == INCOME
    zero_income = is_income & (F.col("lo") == F.col("hi"))
    return swept.where((F.col("hi") > F.col("_from")) | zero_income).select(
        *keys,
        F.when(is_income, F.col("income")).otherwise(F.col("_next_income")).alias("income"),
        F.when(is_income, F.col("_next_payout")).otherwise(F.col("payout")).alias("payout"),
        F.when(zero_income, F.col("hi")).otherwise(F.col("_from")).alias("_from"),
        F.col("hi").alias("_to"),
    )


def _light_pieces(entries: DataFrame, order: str) -> DataFrame:
    """Pieces of users that fit one task: positions and sweep share one shuffle by user."""
    own = Window.partitionBy(USER).orderBy("side", "_o1", "_o2")
    upto = own.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    is_income = F.col("side") == INCOME
    income_upto = F.sum(F.when(is_income, F.col("cents"))).over(upto)
    payout_upto = F.sum(F.when(~is_income, F.col("cents"))).over(upto)
    placed = (
        entries.withColumn("hi", F.when(is_income, income_upto).otherwise(payout_upto))
        .withColumn("lo", F.col("hi") - F.col("cents"))
        .withColumn("_paying", F.max("side").over(Window.partitionBy(USER)) == PAYOUT)
    )
    # Every row of a user carries the same _paying, so it may ride along as a key.
    return _sweep(placed, [USER, "_paying"], order, F.lit(0).cast("bigint"))


def _handed_out(rows: DataFrame, segments: DataFrame, owner: str, sizes: Sizes) -> DataFrame:
    """Each interval once per segment of its chunk that it reaches into, cut to the segment.

    Blocks of neighbouring segments are met first, so that a chunk with very many segments is not
    compared with all of them at once.
    """
    chunk = f"_{owner}_chunk"
    numbered = segments.where(F.col(chunk).isNotNull()).withColumn(
        "_block",
        F.floor(
            (F.row_number().over(Window.partitionBy(USER, chunk).orderBy("_from")) - 1) / sizes.block_segments
        ),
    )
    blocks = numbered.groupBy(USER, chunk, "_block").agg(
        F.min("_from").alias("_block_from"), F.max("_to").alias("_block_to")
    )
    near = rows.join(blocks, [USER, chunk]).where(
        (F.col("lo") < F.col("_block_to")) & (F.col("hi") > F.col("_block_from"))
    )
    ends = numbered.select(USER, chunk, "_block", "_from", "_to")
    met = near.join(ends, [USER, chunk, "_block"]).where(
        (F.col("lo") < F.col("_to")) & (F.col("hi") > F.col("_from"))
    )
    return met.select(
        USER,
        F.col("_from").alias("_segment"),
        "side",
        F.greatest("lo", "_from").alias("lo"),
        F.least("hi", "_to").alias("hi"),
        owner,
    )


def _heavy_pieces(entries: DataFrame, order: str, sizes: Sizes) -> DataFrame:
    """Pieces of users with any number of rows; no task holds more than a few chunks of one user.

    Positions come from radix running totals. Incomes and payouts are cut into chunks by rank. A sweep
    over the chunks alone gives segments of the axis on which one income chunk meets one payout chunk;
    there are at most as many as chunks. Rows are handed out to the segments, cut at their ends, and each
    segment is swept by itself. A zero income has no length to hand out and takes the payout of the
    neighbouring income instead: the zeros, which may all be beside one income, are cut into chunks as well, and
    each chunk asks once for each neighbour. Positions and segments are used several times, so they are written out.
    """
    positive = F.when(F.col("cents") > 0, 1).otherwise(0)
    totals = {"hi": F.col("cents"), "rank": positive, "_zero_rank": F.lit(1) - positive}
    placed = running_totals(entries, [USER, "side"], ["_o1", "_o2"], totals, bits=sizes.radix_bits)
    placed = written(
        placed.withColumns(
            {
                "lo": F.col("hi") - F.col("cents"),
                "_chunk": F.floor((F.col("rank") - 1) / sizes.chunk_rows),
                "_zero_chunk": F.floor((F.col("_zero_rank") - 1) / sizes.chunk_rows),
            }
        )
    )
    incomes = placed.where(F.col("side") == INCOME).withColumnRenamed("_chunk", "_income_chunk")
    payouts = placed.where(F.col("side") == PAYOUT).withColumnRenamed("_chunk", "_payout_chunk")
    solid = incomes.where(F.col("cents") > 0).withColumn(
        "income", F.struct("income", "rank", "lo", "hi")
    )

    def chunk_spans(rows: DataFrame, side: int, name: str, owner: str) -> DataFrame:
        spans = rows.groupBy(USER, name).agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
        return spans.select(USER, F.lit(side).alias("side"), "lo", "hi", F.struct(name).alias(owner))

    spans = chunk_spans(solid, INCOME, "_income_chunk", "income").unionByName(
        chunk_spans(payouts, PAYOUT, "_payout_chunk", "payout"), allowMissingColumns=True
    )
    segments = written(
        _sweep(spans, [USER], order, F.lit(0).cast("bigint")).select(
            USER, "income._income_chunk", "payout._payout_chunk", "_from", "_to"
        )
    )
    pieces = _sweep(
        _handed_out(solid, segments, "income", sizes).unionByName(
            _handed_out(payouts, segments, "payout", sizes), allowMissingColumns=True
        ),
        [USER, "_segment"],
        order,
        F.col("_segment"),
    )

    if order == "seq":
        # Paid with the end of the income before; ahead of all incomes, by the first payout.
        beside = pieces.where(F.col("_to") == F.col("income.hi"))
        neighbour = F.col("income.rank")
        edge = payouts.where(F.col("rank") == 1).select(USER, F.lit(0).cast("bigint").alias("rank"), "payout")
    else:
        # Paid with the start of the income after; behind all incomes, by the payout that goes beyond.
        beside = pieces.where(F.col("_from") == F.col("income.lo"))
        neighbour = F.col("income.rank") - 1
        ends = incomes.groupBy(USER).agg(F.max("hi").alias("_end"), F.max("rank").alias("_last"))
        beyond = (F.col("lo") <= F.col("_end")) & (F.col("hi") > F.col("_end"))
        # The chunk of payouts that reaches beyond, then the payout in it.
        reached = spans.where(F.col("side") == PAYOUT).join(ends, USER).where(beyond)
        reached = reached.select(USER, "payout._payout_chunk", "_end", "_last")
        edge = payouts.join(reached, [USER, "_payout_chunk"]).where(beyond)
        edge = edge.select(USER, F.col("_last").alias("rank"), "payout")
    answers = beside.select(USER, neighbour.cast("bigint").alias("rank"), "payout").unionByName(edge)
    zeros = incomes.where(F.col("cents") == 0).select(USER, "rank", "_zero_chunk", "hi", "income")
    asked = zeros.select(USER, "rank", "_zero_chunk").distinct().join(answers, [USER, "rank"])
    settled = zeros.join(asked, [USER, "rank", "_zero_chunk"], "left").select(
        USER, "income", "payout", F.col("hi").alias("_from"), F.col("hi").alias("_to")
    )
    return pieces.select(USER, F.col("income.income").alias("income"), "payout", "_from", "_to").unionByName(
        settled
    )


def row_counts(income: DataFrame, payout: DataFrame, order: str = "seq") -> DataFrame:
    """Rows that take part in matching and payouts among them, per user: user_id, rows, payouts."""
    sides = _entries(income, payout, order).select(USER, "side")
    return sides.groupBy(USER).agg(F.count("*").alias("rows"), F.sum("side").alias("payouts"))


def heavy_users(counts: DataFrame, sizes: Sizes) -> DataFrame | None:
    """The users that are cut into chunks and whether they have payouts, as a written table; None when there are none."""
    found = written(
        counts.where(F.col("rows") > sizes.heavy_rows).select(USER, (F.col("payouts") > 0).alias("_paying"))
    )
    return None if found.isEmpty() else found


def pieces(
    income: DataFrame,
    payout: DataFrame,
    order: str = "seq",
    sizes: Sizes = Sizes(),
    counts: DataFrame | None = None,
) -> DataFrame:
    """Every piece of money: ``income`` and ``payout`` own it, ``cents`` is its size.

    A null payout marks an open piece, a null income a dropped part of a payout. ``paying`` tells whether
    the user has any payout. ``counts`` are the row counts of users, where they are known already.
    """
    entries = _entries(income, payout, order)
    columns = [
        USER,
        "income",
        "payout",
        (F.col("_to") - F.col("_from")).alias("cents"),
        F.col("_paying").alias("paying"),
    ]
    heavy = heavy_users(row_counts(income, payout, order) if counts is None else counts, sizes)
    if heavy is None:
        return _light_pieces(entries, order).select(*columns)
    light = _light_pieces(entries.join(heavy, USER, "left_anti"), order)
    big = _heavy_pieces(entries.join(heavy, USER, "left_semi"), order, sizes)
    return light.unionByName(big.join(heavy, USER)).select(*columns)


def income_rows(found: DataFrame, like: DataFrame) -> DataFrame:
    """Pieces as income rows: paid ones flagged 1 with their payout, open ones flagged 0."""
    columns = {
        USER: F.col(USER),
        "show_amount": _amount(F.col("cents")),
        "payout_flag": F.when(F.col("payout").isNotNull(), 1).otherwise(0),
        "payout_id": F.col("payout.payout_id"),
        "payout_type_id": F.col("payout.payout_type_id"),
        "payout_date": F.col("payout.payout_date"),
    }
    return found.where(F.col("income").isNotNull()).select(
        *[columns.get(name, F.col(f"income.{name}")).alias(name) for name in like.columns]
    )


def match(
    income: DataFrame,
    payout: DataFrame,
    order: str = "seq",
    scope: str = "incremental",
    sizes: Sizes = Sizes(),
) -> DataFrame:
    """Income rows after matching, in the columns of ``income``; a boundary income is split in two.

    ``order='seq'`` consumes incomes by ``seq_id``, ``'date'`` by ``(ds, id)``. ``scope='incremental'``
    holds users with payouts and rows open at the start; ``'full'`` also untouched users and rows that
    were closed before, as they came.
    """
    found = pieces(income, payout, order, sizes)
    if scope == "incremental":
        return income_rows(found.where("paying"), income)
    if scope != "full":
        raise ValueError(f"unknown scope {scope!r}")
    return income_rows(found, income).unionByName(income.where(~enters(income, order)))


def open_balance(matched: DataFrame) -> DataFrame:
    """Open rows kept for the next run."""
    return matched.where(F.col("payout_flag") == 0)


def splits(income: DataFrame, payout: DataFrame, order: str = "seq", sizes: Sizes = Sizes()) -> DataFrame:
    """Rows of incomes that were cut, by payouts or by the open remainder: pieces smaller than their income."""
    found = pieces(income, payout, order, sizes)
    return income_rows(found.where("paying AND cents < income._cents"), income)


def overdraft(income: DataFrame, payout: DataFrame, order: str = "seq", sizes: Sizes = Sizes()) -> DataFrame:
    """Payouts beyond the user's open income, with the amount dropped."""
    return overdraft_rows(pieces(income, payout, order, sizes))


def overdraft_rows(found: DataFrame) -> DataFrame:
    """The pieces of payouts that no income covers."""
    return found.where(F.col("income").isNull()).select(
        USER, "payout.*", _amount(F.col("cents")).alias("dropped_amount")
    )


def untouched_users(income: DataFrame, payout: DataFrame) -> DataFrame:
    """Incomes of users without any payout."""
    # Written first: a join right over two shuffles is one that is split where a user holds very many rows.
    paid = written(payout.select(USER).where(F.col(USER).isNotNull()).distinct())
    return income.join(paid, USER, "left_anti").select(*income.columns)


def resume(
    previous: DataFrame,
    income: DataFrame,
    payout: DataFrame,
    order: str = "seq",
    scope: str = "incremental",
    sizes: Sizes = Sizes(),
) -> DataFrame:
    """Next run: what an earlier run left open, plus new incomes, against new payouts.

    ``previous`` is the stored result of that run; given as a plan, it would be computed again and again.
    """
    return match(open_balance(previous).unionByName(income), payout, order, scope, sizes)
