import datetime as dt

import pytest

from caseflow.plans import restaurant as r
from tests.fixtures import frames


@pytest.fixture(scope="module")
def t(spark):
    return frames(spark)


def rows(df, *cols):
    return sorted(tuple(x[c] for c in cols) for x in df.collect())


def test_spend(t):
    assert rows(r.spend_by_customer(t["sales"], t["menu"]), "customer_id", "total_spent") == \
        [("A", 76), ("B", 74), ("C", 36)]


def test_visit_days(t):
    assert rows(r.visit_days(t["sales"]), "customer_id", "total_days") == \
        [("A", 4), ("B", 6), ("C", 2)]


def test_first_items_global_rank(t):
    assert rows(r.first_items(t["sales"], t["menu"]), "customer_id", "product_name") == \
        [("A", "curry"), ("A", "sushi"), ("B", "curry"), ("C", "ramen")]


def test_most_bought(t):
    assert rows(r.most_bought_by_rank(t["sales"], t["menu"]), "product_name", "number_order") \
        == [("ramen", 8)]
    # the source's literal: ascending dense rank 3 is the same row here
    assert rows(r.most_bought_by_rank(t["sales"], t["menu"], rank=3),
                "product_name", "number_order") == [("ramen", 8)]
    assert rows(r.most_bought_top1(t["sales"], t["menu"]), "product_name", "most_purchased") \
        == [("ramen", 8)]


def test_favourite_ties_kept(t):
    got = rows(r.favourite_item(t["sales"], t["menu"]),
               "customer_id", "product_name", "number_order")
    assert got == [("A", "ramen", 3), ("B", "curry", 2), ("B", "ramen", 2),
                   ("B", "sushi", 2), ("C", "ramen", 3)]


def test_member_windows(t):
    s, m, mb = t["sales"], t["menu"], t["members"]
    assert rows(r.first_after_join(s, m, mb), "customer_id", "product_name") == \
        [("A", "curry"), ("B", "sushi")]
    assert rows(r.last_before_join(s, m, mb), "customer_id", "product_name") == \
        [("A", "curry"), ("A", "sushi"), ("B", "sushi")]
    assert rows(r.pre_join_totals(s, m, mb), "customer_id", "total_item",
                "total_amount_spent") == [("A", 2, 25), ("B", 3, 40)]


def test_points(t):
    assert rows(r.loyalty_points(t["sales"], t["menu"]), "customer_id", "total_point") == \
        [("A", 860), ("B", 940), ("C", 360)]
    assert rows(r.first_week_bonus_points(t["sales"], t["menu"], t["members"]),
                "customer_id", "total_points") == [("A", 1370), ("B", 820)]


def test_member_flag_ranking(t):
    df = r.member_flag_ranking(t["sales"], t["menu"], t["members"])
    got = rows(df, "customer_id", "order_date", "member", "ranking")
    assert len(got) == 15
    d = dt.date.fromisoformat
    member_rows = [x for x in got if x[2] == "Y"]
    assert member_rows == [
        ("A", d("2021-01-07"), "Y", 1), ("A", d("2021-01-10"), "Y", 2),
        ("A", d("2021-01-11"), "Y", 3), ("A", d("2021-01-11"), "Y", 3),
        ("B", d("2021-01-11"), "Y", 1), ("B", d("2021-01-16"), "Y", 2),
        ("B", d("2021-02-01"), "Y", 3)]
    assert all(x[3] is None for x in got if x[2] == "N")
    assert {x[2] for x in got if x[0] == "C"} == {"N"}
