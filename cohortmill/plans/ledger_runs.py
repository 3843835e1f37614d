"""Consecutive ledger runs: what one run leaves open is carried over to the next.

Below a path, each run adds to five tables: ``paid`` (income rows that its payouts closed), ``open`` (the open rows of all users
after it), ``closed`` (rows that came closed or take no part in matching, as they came), ``overdraft`` (payouts
beyond the open income) and ``rejected``; ``users`` keeps, for every user with open rows or payouts so far, how many rows are open and which run last
paid them. Results are never replaced: every attempt of a run writes to folders of its own, and one row
of ``log`` names the attempt once all of them are complete. A run that broke off has left no such row, so it is run
again from the same state; so can the last run be, with other inputs, and its new attempt takes the old one's place.

Rows of users without new payouts are only carried over. How many rows a user has is the sum of the stored count and the new
rows, so the open rows are read once, by the matching itself.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortmill.operators import ledger
from cohortmill.operators.ledger import USER, Sizes
from cohortmill.sources.checkpoints import written

LOG = "sequence bigint, run bigint, attempt string, previous string, match_order string, carry_overdraft boolean"
TABLES = ["paid", "open", "closed", "overdraft", "rejected", "users"]


class LedgerRuns:
    """Runs of one ledger below a path that the driver and all executors share."""

    def __init__(self, spark: SparkSession, path: str, order: str = "seq", carry_overdraft: bool = False, sizes: Sizes = Sizes()):
        """``carry_overdraft`` lets the unpaid part of a payout meet the incomes of later runs; else it is dropped."""
        ledger.income_order(order)
        self.spark, self.path = spark, path.rstrip("/")
        self.order, self.carry_overdraft, self.sizes = order, carry_overdraft, sizes
        spark.createDataFrame([], LOG).write.mode("append").parquet(f"{self.path}/log")

    def log(self) -> list:
        """The valid attempts, by run: a later attempt of a run stands for the earlier ones."""
        rows = self.spark.read.schema(LOG).parquet(f"{self.path}/log").collect()
        return [row for _, row in sorted({row.run: row for row in sorted(rows, key=lambda row: row.sequence)}.items())]

    def _folder(self, table: str, attempt: str) -> str:
        return f"{self.path}/{table}/{attempt}"

    def _read(self, table: str, attempts: list[str]) -> DataFrame:
        return self.spark.read.parquet(*[self._folder(table, attempt) for attempt in attempts])

    def run(self, number: int, income: DataFrame, payout: DataFrame) -> None:
        """Match the payouts of a run to its incomes and to all that earlier runs left open.

        Rows of the run must not have come in an earlier one. A run before the last one can't be repeated, as later ones
        go on from it.
        """
        log = self.log()
        if any(row.run > number for row in log):
            raise ValueError(f"run {number} is before the last run, {log[-1].run}")
        if any((row.match_order, row.carry_overdraft) != (self.order, self.carry_overdraft) for row in log):
            raise ValueError("earlier runs were made in another order or with another rule for overdrafts")
        before = [row.attempt for row in log if row.run < number]
        attempt = f"run-{number:08d}-{uuid.uuid4().hex}"

        def put(df: DataFrame, table: str) -> None:
            df.write.parquet(self._folder(table, attempt))

        takes_part = ledger.enters(income, self.order)
        opened, paying = income.where(takes_part), payout
        counts = ledger.row_counts(income, payout, self.order)
        if before:
            opened = self._read("open", before[-1:]).select(*income.columns).unionByName(opened)
            users = self._read("users", before[-1:])
            stored = users.where("rows > 0").select(USER, "rows", F.lit(0).cast("bigint").alias("payouts"))
            if self.carry_overdraft:
                kept = self._read("overdraft", before[-1:]).select(
                    F.col("payout_id").alias("id"),
                    USER,
                    F.col("payout_type_id").alias("type_id"),
                    F.col("payout_date").alias("ds"),
                    (-F.col("dropped_amount")).cast("decimal(18,2)").alias("show_amount"),
                )
                paying = kept.unionByName(payout.select(*kept.columns))
                one = F.lit(1).cast("bigint")
                stored = stored.unionByName(kept.select(USER, one.alias("rows"), one.alias("payouts")))
            counts = counts.unionByName(stored).groupBy(USER).agg(F.sum("rows").alias("rows"), F.sum("payouts").alias("payouts"))
        put(ledger.rejected(income, payout, self.order), "rejected")
        put(income.where(~takes_part), "closed")
        # All three results come from the same pieces, which are made once.
        pieces = written(ledger.pieces(opened, paying, self.order, self.sizes, counts))
        put(ledger.income_rows(pieces.where("payout IS NOT NULL"), income), "paid")
        put(ledger.income_rows(pieces.where("payout IS NULL"), income), "open")
        put(ledger.overdraft_rows(pieces), "overdraft")
        still = self._read("open", [attempt]).groupBy(USER).agg(F.count("*").alias("rows"))
        paid_now = paying.where(ledger.valid_payout(paying) & F.col("id").isNotNull() & F.col(USER).isNotNull())
        paid_now = paid_now.groupBy(USER).agg(F.lit(number).cast("bigint").alias("last_paid"))
        if before:
            known = users.where("last_paid IS NOT NULL").select(USER, "last_paid")
            paid_now = paid_now.unionByName(known).groupBy(USER).agg(F.max("last_paid").alias("last_paid"))
        put(still.join(paid_now, USER, "full").select(USER, F.coalesce("rows", F.lit(0)).alias("rows"), "last_paid"), "users")
        sequence = 1 + max((row.sequence for row in log), default=0)
        done = [(sequence, number, attempt, before[-1] if before else None, self.order, self.carry_overdraft)]
        self.spark.createDataFrame(done, LOG).coalesce(1).write.mode("append").parquet(f"{self.path}/log")

    def _attempts(self, upto: int | None) -> list[str]:
        found = [row.attempt for row in self.log() if upto is None or row.run <= upto]
        if not found:
            raise ValueError("no run is complete")
        return found

    def result(self, scope: str = "incremental", upto: int | None = None) -> DataFrame:
        """Income rows after all runs (or up to one), like those of one match: ``'incremental'`` has the rows of users
        that any payout reached, ``'full'`` all, also those that came closed."""
        attempts = self._attempts(upto)
        paid, still = self._read("paid", attempts), self._read("open", attempts[-1:])
        if scope == "incremental":
            reached = self._read("users", attempts[-1:]).where("last_paid IS NOT NULL").select(USER)
            return paid.unionByName(still.join(reached, USER, "left_semi"))
        if scope != "full":
            raise ValueError(f"unknown scope {scope!r}")
        return paid.unionByName(still).unionByName(self._read("closed", attempts))

    def result_of(self, number: int) -> DataFrame:
        """What one run dealt with: rows its payouts closed, and what is still open of the users that it paid."""
        attempts = self._attempts(number)
        users = self._read("users", attempts[-1:]).where(F.col("last_paid") == number).select(USER)
        return self._read("paid", attempts[-1:]).unionByName(self._read("open", attempts[-1:]).join(users, USER, "left_semi"))

    def open_rows(self, upto: int | None = None) -> DataFrame:
        """Open rows of all users."""
        return self._read("open", self._attempts(upto)[-1:])

    def overdraft(self, upto: int | None = None) -> DataFrame:
        """Payouts beyond the open income: of all runs, or, if they are carried over, what is left of them now."""
        attempts = self._attempts(upto)
        return self._read("overdraft", attempts[-1:] if self.carry_overdraft else attempts)

    def rejected(self, upto: int | None = None) -> DataFrame:
        """Rows that took no part in matching."""
        return self._read("rejected", self._attempts(upto))
