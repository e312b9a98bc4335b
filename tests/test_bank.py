import datetime as dt

import pytest

from caseflow.plans import bank as b
from tests.fixtures import frames


@pytest.fixture(scope="module")
def t(spark):
    return frames(spark)


def rows(df, *cols):
    return sorted(tuple(x[c] for c in cols) for x in df.collect())


def test_nodes(t):
    n, r = t["customer_nodes"], t["regions"]
    assert b.unique_nodes(n).first()[0] == 4
    assert rows(b.nodes_by_region(n, r), "region_id", "region_name", "total_nodes") == \
        [(3, "Africa", 14)]
    assert rows(b.customers_by_region(n, r), "region_id", "total_customers") == [(3, 2)]
    # closed allocations of customers 1 and 2: 1,10,1,11,20,26 and 14,22,11,14,4,0
    assert b.avg_allocation_days(n).first()[0] == (1 + 10 + 1 + 11 + 20 + 26 + 14 + 22 + 11
                                                   + 14 + 4 + 0) // 12


def test_percentiles_disc(t):
    p = b.allocation_percentiles(t["customer_nodes"]).first()
    # sorted days: 0 1 1 4 10 11 11 14 14 20 22 26
    assert (p.median, p.p80, p.p95) == (11, 20, 26)


def test_transactions(t):
    tx = t["customer_transactions"]
    assert rows(b.txn_type_totals(tx), "txn_type", "total_transaction", "total_amount") == \
        [("deposit", 4, 1246), ("purchase", 2, 1276)]
    p = b.avg_deposit_profile(tx).first()
    # customer 1: 2 deposits avg 318; customer 2: 2 deposits avg 305
    assert (p.avg_count, p.avg_amount) == (2, 311)
    assert rows(b.txn_years(tx), "year") == [(2020,)]


def test_closing_balance(t):
    got = rows(b.closing_balance(t["customer_transactions"]), "customer_id", "month",
               "balance", "change_in_balance")
    assert got == [(1, 1, 312, 312), (1, 3, -640, -952), (2, 1, 549, 549), (2, 3, 610, 61)]


def test_growth_share(t):
    # customer 2 grows 549 -> 610 (11 %), customer 1 falls
    assert b.balance_growth_share(t["customer_transactions"]).first()[0] == 50.0


def test_growth_share_zero_start(spark):
    d = dt.date.fromisoformat
    tx = spark.createDataFrame(
        [(1, d("2020-01-01"), "deposit", 0), (1, d("2020-02-01"), "deposit", 10),
         (2, d("2020-01-01"), "deposit", 100), (2, d("2020-02-01"), "deposit", 4)],
        "customer_id int, txn_date date, txn_type string, txn_amount int")
    # zero start balance has no rate (not counted); 100 -> 104 is 4 % (< 5)
    assert b.balance_growth_share(tx).first()[0] == 0.0


def test_active_mix(spark):
    d = dt.date.fromisoformat
    tx = spark.createDataFrame(
        [(1, d("2020-01-01"), "deposit", 1), (1, d("2020-01-02"), "deposit", 1),
         (1, d("2020-01-03"), "purchase", 1),
         (2, d("2020-01-01"), "deposit", 1), (2, d("2020-01-02"), "deposit", 1),
         (2, d("2020-01-03"), "purchase", 1), (2, d("2020-01-04"), "purchase", 1),
         (3, d("2021-01-05"), "deposit", 1), (3, d("2021-01-06"), "deposit", 1),
         (3, d("2021-01-07"), "withdrawal", 1)],
        "customer_id int, txn_date date, txn_type string, txn_amount int")
    # month without year: customer 3's 2021 January pools with 2020's
    assert rows(b.active_mix_by_month(tx), "month", "customer_count") == [(1, 2)]


def test_exact_mean_options(t):
    n = t["customer_nodes"]
    assert abs(b.avg_allocation_days(n, integer_math=False).first()[0] - 134 / 12) < 1e-12
    p = b.avg_deposit_profile(t["customer_transactions"], integer_math=False).first()
    assert (p.avg_count, p.avg_amount) == (2.0, (318.0 + 305.0) / 2)
