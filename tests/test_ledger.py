import datetime as dt
import random
from collections import Counter, defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cohortmill.operators import ledger
from cohortmill.operators.running import radix_levels, running_totals
from cohortmill.sources.tables import INCOME_SCHEMA, PAYOUT_SCHEMA

DAY = dt.date(2024, 1, 1)
TINY = ledger.Sizes(heavy_rows=0, chunk_rows=3, block_segments=2, radix_bits=16)


def incomes(spark, rows):
    """rows: (id, seq_id, user_id, day offset, cents)."""
    full = [
        (i, s, u, DAY + dt.timedelta(days=d), Decimal(c) / 100, 0, None, None, None) for i, s, u, d, c in rows
    ]
    return spark.createDataFrame(full, INCOME_SCHEMA)


def payouts(spark, rows):
    """rows: (id, user_id, cents)."""
    return spark.createDataFrame([(i, u, 1, DAY, -Decimal(c) / 100) for i, u, c in rows], PAYOUT_SCHEMA)


def result(df):
    return Counter((r.id, r.payout_flag, r.payout_id, int(r.show_amount * 100)) for r in df.collect())


def walk(income_rows, payout_rows, order):
    """One payout after the other eats the open incomes in order."""
    open_rows = defaultdict(list)
    for row in sorted(income_rows, key=(lambda r: (r[1],)) if order == "seq" else (lambda r: (r[3], r[0]))):
        open_rows[row[2]].append([row[0], row[4]])
    rows = []
    paying = set()
    for payout_id, user, amount in sorted(payout_rows):
        paying.add(user)
        left, queue = amount, open_rows[user]
        while queue and (left > 0 or (order == "seq" and queue[0][1] == 0)):
            part = min(left, queue[0][1])
            rows.append((queue[0][0], 1, payout_id, part))
            left -= part
            queue[0][1] -= part
            if queue[0][1] > 0:
                break
            queue.pop(0)
    rows += [(i, 0, None, c) for user in paying for i, c in open_rows[user]]
    return Counter(rows)


@pytest.mark.parametrize("sizes", [ledger.Sizes(), TINY], ids=["light", "heavy"])
def test_golden_cases(spark, sizes):
    money = incomes(
        spark,
        [
            (1, 1, 1, 0, 500), (2, 2, 1, 0, 500),  # exact
            (3, 1, 2, 0, 500), (4, 2, 2, 0, 500),  # split
            (5, 1, 3, 0, 500),  # overdraft
            (6, 1, 4, 0, 500), (7, 2, 4, 0, 0), (8, 3, 4, 0, 500),  # zero income
            (9, 1, 5, 0, 0),  # only zeros
        ],
    )
    paid = payouts(spark, [(1, 1, 500), (2, 2, 700), (3, 3, 800), (4, 3, 400), (5, 4, 500), (6, 5, 100)])
    shared = {
        (1, 1, 1, 500), (2, 0, None, 500),
        (3, 1, 2, 500), (4, 1, 2, 200), (4, 0, None, 300),
        (5, 1, 3, 500),
        (6, 1, 5, 500), (8, 0, None, 500),
        (9, 1, 6, 0),
    }
    assert result(ledger.match(money, paid, "seq", sizes=sizes)) == Counter(shared | {(7, 1, 5, 0)})
    assert result(ledger.match(money, paid, "date", sizes=sizes)) == Counter(shared | {(7, 0, None, 0)})
    dropped = {r.payout_id: r.dropped_amount for r in ledger.overdraft(money, paid, sizes=sizes).collect()}
    assert dropped == {3: Decimal("3.00"), 4: Decimal("4.00"), 6: Decimal("1.00")}


def random_ledger(seed):
    rng = random.Random(seed)
    income_rows, payout_rows = [], []
    for user in range(1, 13):
        seqs = rng.sample(range(-(2**40), 2**40) if user % 2 else range(200), 40)
        for seq in seqs[: rng.randint(0, 40)]:
            cents = 0 if rng.random() < 0.25 else rng.choice([1, 5, 100, 100_000])
            income_rows.append((len(income_rows) + 1, seq, user, rng.randint(0, 5), cents))
        for _ in range(rng.choice([0, 1, 3, 40])):
            payout_rows.append((len(payout_rows) + 1, user, rng.choice([1, 5, 100, 500_000])))
    return income_rows, payout_rows


@pytest.mark.parametrize("order", ["seq", "date"])
@pytest.mark.parametrize("seed", [1, 2])
def test_both_ways_equal_the_sequential_walk(spark, order, seed):
    income_rows, payout_rows = random_ledger(seed)
    money, paid = incomes(spark, income_rows), payouts(spark, payout_rows)
    wanted = walk(income_rows, payout_rows, order)
    assert result(ledger.match(money, paid, order)) == wanted
    assert result(ledger.match(money, paid, order, sizes=TINY)) == wanted


@pytest.mark.parametrize("order", ["seq", "date"])
def test_null_repeated_and_negative_order_keys(spark, order):
    """Rows without a place in the order stay out of both ways, and are listed; the rest agrees."""
    rows = [
        (1, None, 1, 0, 500), (2, 1, 1, None, 500), (None, 2, 1, 1, 500), (4, 2, 1, 1, 500), (5, 2, 1, 1, 0),
        (6, -3, 2, 0, 0), (7, -3, 2, 0, 0), (8, -5, 2, 2, 300), (9, -5, 2, 2, 300), (10, 4, 2, 1, 0),
        (11, 1, 3, 0, 100),
    ]
    full = [
        (i, s, u, d if d is None else DAY + dt.timedelta(days=d), Decimal(c) / 100, 0, None, None, None)
        for i, s, u, d, c in rows
    ]
    money = spark.createDataFrame(full, INCOME_SCHEMA)
    paid = spark.createDataFrame(
        [(i, u, 1, DAY, Decimal(c) / 100) for i, u, c in [(1, 1, -700), (None, 1, -100), (2, 2, -400)]], PAYOUT_SCHEMA
    )
    light = ledger.match(money, paid, order, scope="full")
    for threshold in (0, 2, 4):
        sizes = ledger.Sizes(heavy_rows=threshold, chunk_rows=2, block_segments=1)
        assert result(ledger.match(money, paid, order, scope="full", sizes=sizes)) == result(light)
    sums = Counter()
    for row in light.collect():
        sums[row.user_id] += int(row.show_amount * 100)
    assert sums == Counter({1: 2000, 2: 600, 3: 100})
    listed = {(r.source, r.id) for r in ledger.rejected(money, paid, order).collect()}
    assert listed == {("income", 1 if order == "seq" else 2), ("income", None), ("payout", None)}


def test_money_is_kept(spark):
    income_rows, payout_rows = random_ledger(3)
    rows = ledger.match(incomes(spark, income_rows), payouts(spark, payout_rows), scope="full").collect()
    matched, still_open, came, went = Counter(), Counter(), Counter(), Counter()
    for row in rows:
        (matched if row.payout_flag else still_open)[row.user_id] += int(row.show_amount * 100)
    for row in income_rows:
        came[row[2]] += row[4]
    for row in payout_rows:
        went[row[1]] += row[2]
    for user in came:
        assert matched[user] == min(came[user], went[user])
        assert matched[user] + still_open[user] == came[user]


def test_scopes_rejects_and_resume(spark):
    money = incomes(spark, [(1, 1, 1, 0, 500), (2, 2, 1, 0, 300), (3, 1, 2, 0, 100), (4, 1, 3, 0, -5)])
    closed = money.where("id = 2").withColumn("payout_flag", F.lit(1))
    money = money.where("id <> 2").unionByName(closed)
    paid = payouts(spark, [(1, 1, 200), (2, 1, 0)])
    assert result(ledger.match(money, paid)) == Counter([(1, 1, 1, 200), (1, 0, None, 300)])
    full = ledger.match(money, paid, scope="full")
    assert sorted(r.id for r in full.collect()) == [1, 1, 2, 3, 4]
    assert sorted((r.source, r.id) for r in ledger.rejected(money, paid).collect()) == [("income", 4), ("payout", 2)]
    assert {r.id for r in ledger.splits(money, paid).collect()} == {1}
    again = ledger.resume(full, incomes(spark, [(9, 9, 2, 0, 50)]), payouts(spark, [(7, 1, 100), (8, 2, 120)]))
    assert result(again) == Counter(
        [(1, 1, 7, 100), (1, 0, None, 200), (3, 1, 8, 100), (9, 1, 8, 20), (9, 0, None, 30)]
    )


def test_running_totals_by_radix(spark):
    rng = random.Random(5)
    keys = [rng.getrandbits(62) - 2**61 for _ in range(150)] + list(range(150))
    rows = [(n % 2, key, rng.randint(0, 9)) for n, key in enumerate(keys)]
    df = spark.createDataFrame(rows, "k int, o bigint, v bigint")
    totals = running_totals(df, ["k"], ["o"], {"total": F.col("v")})
    wanted = Counter()
    for k in (0, 1):
        total = 0
        for _, o, v in sorted(r for r in rows if r[0] == k):
            total += v
            wanted[(k, o, v, total)] += 1
    assert Counter(tuple(r) for r in totals.collect()) == wanted
    assert radix_levels(["d", "o"], 32) == [[("d", 0), ("o", 32)], [("d", 0)], [("d", 32)], []]


def test_light_path_needs_one_shuffle_and_no_python(spark, plan_of):
    money, paid = incomes(spark, [(1, 1, 1, 0, 500)]), payouts(spark, [(1, 1, 200)])
    plan = plan_of(ledger.match(money, paid))
    assert plan.count("Exchange hashpartitioning") == 1
    for word in ("Python", "NestedLoop", "Cartesian"):
        assert word not in plan
