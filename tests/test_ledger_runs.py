import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cohortmill.operators import ledger
from cohortmill.plans import ledger_runs
from cohortmill.plans.ledger_runs import LedgerRuns
from tests.test_ledger import TINY, incomes, payouts, result


def parts(seed):
    """Three runs' incomes and payouts; later incomes stand behind earlier ones in both orders."""
    rng = random.Random(seed)
    income_rows, payout_rows = [], []
    for run in range(3):
        for user in range(1, 9):
            for n in range(rng.randint(0, 9)):
                cents = rng.choice([0, 1, 5, 100, 700]) if n else rng.choice([1, 5, 100])
                number = len(income_rows) + 1
                income_rows.append((run, (number, number * 10 + run, user, run, cents)))
            for _ in range(rng.choice([0, 0, 1, 4])):
                payout_rows.append((run, (len(payout_rows) + 1, user, rng.choice([1, 5, 100, 900, 2500]))))
    return income_rows, payout_rows


def of(rows, run):
    return [row for at, row in rows if at == run]


@pytest.mark.parametrize("order", ["seq", "date"])
@pytest.mark.parametrize("sizes", [ledger.Sizes(), TINY], ids=["light", "heavy"])
def test_three_runs_equal_one(spark, tmp_path, order, sizes):
    income_rows, payout_rows = parts(7)
    runs = LedgerRuns(spark, str(tmp_path / "runs"), order, carry_overdraft=True, sizes=sizes)
    for run in range(3):
        runs.run(run, incomes(spark, of(income_rows, run)), payouts(spark, of(payout_rows, run)))
    money, paid = incomes(spark, [r for _, r in income_rows]), payouts(spark, [r for _, r in payout_rows])
    for scope in ("incremental", "full"):
        assert result(runs.result(scope)) == result(ledger.match(money, paid, order, scope))
    beyond = {(r.payout_id, r.dropped_amount) for r in ledger.overdraft(money, paid, order).collect()}
    assert {(r.payout_id, r.dropped_amount) for r in runs.overdraft().collect()} == beyond and beyond


def sums(rows):
    out = Counter()
    for row in rows:
        out[row[0]] += int(row[1] * 100)
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_money_is_kept_from_run_to_run(spark, tmp_path, seed):
    income_rows, payout_rows = parts(seed)
    runs = LedgerRuns(spark, str(tmp_path / "runs"))
    came, went = Counter(), Counter()
    for run in range(3):
        runs.run(run, incomes(spark, of(income_rows, run)), payouts(spark, of(payout_rows, run)))
        for row in of(income_rows, run):
            came[row[2]] += row[4]
        for row in of(payout_rows, run):
            went[row[1]] += row[2]
        rows = runs.result("full").select("user_id", "show_amount").collect()
        assert sums(rows) == came
        paid = sums(runs.result("full").where("payout_flag = 1").select("user_id", "show_amount").collect())
        dropped = sums(runs.overdraft().select("user_id", "dropped_amount").collect())
        assert {user: paid[user] + dropped[user] for user in went} == dict(went)
        stored = {r.user_id: r.rows for r in runs._read("users", runs._attempts(None)[-1:]).collect() if r.rows}
        assert stored == dict(Counter(r.user_id for r in runs.open_rows().collect()))


def test_runs_that_lost_money_before(spark, tmp_path):
    """Users without a payout in a run, and rows paid in an earlier one, stay."""
    runs = LedgerRuns(spark, str(tmp_path / "runs"))
    runs.run(1, incomes(spark, [(1, 1, 1, 0, 500), (2, 2, 2, 0, 500)]), payouts(spark, [(1, 1, 300)]))
    runs.run(2, incomes(spark, [(3, 3, 1, 1, 100)]), payouts(spark, [(2, 1, 400)]))
    first = [(1, 1, 1, 300), (1, 1, 2, 200), (3, 1, 2, 100)]
    assert result(runs.result("full")) == Counter([*first, (2, 0, None, 500)])
    assert result(runs.result()) == Counter(first)
    assert result(runs.result_of(1)) == Counter([(1, 1, 1, 300), (1, 0, None, 200)])
    assert result(runs.result_of(2)) == Counter(first[1:])
    assert [(r.payout_id, int(r.dropped_amount * 100)) for r in runs.overdraft().collect()] == [(2, 100)]
    assert result(runs.open_rows(upto=1)) == Counter([(1, 0, None, 200), (2, 0, None, 500)])


def test_a_broken_run_is_repeated(spark, tmp_path, monkeypatch):
    runs = LedgerRuns(spark, str(tmp_path / "runs"))
    money, paid = incomes(spark, [(1, 1, 1, 0, 500)]), payouts(spark, [(1, 1, 200)])
    runs.run(1, money, paid)
    more, paid_2 = incomes(spark, [(2, 2, 1, 1, 50)]), payouts(spark, [(2, 1, 100)])
    with monkeypatch.context() as broken:
        broken.setattr(ledger_runs.ledger, "overdraft_rows", lambda found: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            runs.run(2, more, paid_2)
    before = [(1, 1, 1, 200), (1, 0, None, 300)]
    assert result(LedgerRuns(spark, str(tmp_path / "runs")).result()) == Counter(before)
    for _ in range(2):  # the second time, the run replaces itself
        runs.run(2, more, paid_2)
        wanted = [(1, 1, 1, 200), (1, 1, 2, 100), (1, 0, None, 200), (2, 0, None, 50)]
        assert result(runs.result()) == Counter(wanted)
    with pytest.raises(ValueError, match="before the last run"):
        runs.run(1, money, paid)
    with pytest.raises(ValueError, match="another order"):
        LedgerRuns(spark, str(tmp_path / "runs"), order="date").run(3, more, paid_2)


def test_rejected_and_closed_rows(spark, tmp_path):
    runs = LedgerRuns(spark, str(tmp_path / "runs"))
    money = incomes(spark, [(1, 1, 1, 0, 500), (2, None, 1, 0, 5), (3, 3, 1, 0, 7)])
    money = money.withColumn("payout_flag", F.when(F.col("id") == 3, 1).otherwise(F.col("payout_flag")))
    runs.run(1, money, payouts(spark, [(None, 1, 200)]))
    assert result(runs.result("full")) == Counter([(1, 0, None, 500), (2, 0, None, 5), (3, 1, None, 7)])
    assert sorted((r.source, r.reason) for r in runs.rejected().collect()) == [("income", "order"), ("payout", "order")]
    assert runs.result().count() == 0


def test_open_rows_are_not_read_to_count_them(spark, tmp_path, monkeypatch):
    runs = LedgerRuns(spark, str(tmp_path / "runs"))
    runs.run(1, incomes(spark, [(1, 1, 1, 0, 500)]), payouts(spark, []))
    plans = []
    real = ledger.heavy_users
    monkeypatch.setattr(
        ledger, "heavy_users", lambda counts, sizes: plans.append(counts._jdf.queryExecution().executedPlan().toString()) or real(counts, sizes)
    )
    runs.run(2, incomes(spark, [(2, 2, 1, 0, 500)]), payouts(spark, [(1, 1, 100)]))
    assert "/users/" in plans[0] and "/open/" not in plans[0]


@pytest.mark.parametrize("order", ["seq", "date"])
def test_many_zero_incomes_beside_one_income(spark, order):
    """All zeros stand at one place; no part of a join holds more of them than a chunk."""
    zeros = [(10 + n, 10 + n, 1, 0, 0) for n in range(2000)]
    ahead = [(3000 + n, -3000 + n, 1, 0, 0) for n in range(300)]
    money = incomes(spark, [*ahead, (1, 1, 1, 0, 500), *zeros, (9000, 9000, 1, 1, 500), (9001, 9001, 1, 1, 0)])
    paid = payouts(spark, [(1, 1, 500), (2, 1, 100), (3, 1, 5)])
    sizes = ledger.Sizes(heavy_rows=0, chunk_rows=100, block_segments=4)
    assert result(ledger.match(money, paid, order, sizes=sizes)) == result(ledger.match(money, paid, order))
