"""Case-study rows for unit tests.

The rows from SALES to CUSTOMER_TRANSACTIONS are fixed values: the known answers
that the tests expect are answers about these rows.
"""

import datetime as dt

from caseflow import schemas

D = dt.date.fromisoformat


def TS(s):
    return dt.datetime.fromisoformat(s)


# --- fixed values: the case-study rows that the expected answers are about ---
SALES = [("A", "2021-01-01", 1), ("A", "2021-01-01", 2), ("A", "2021-01-07", 2),
         ("A", "2021-01-10", 3), ("A", "2021-01-11", 3), ("A", "2021-01-11", 3),
         ("B", "2021-01-01", 2), ("B", "2021-01-02", 2), ("B", "2021-01-04", 1),
         ("B", "2021-01-11", 1), ("B", "2021-01-16", 3), ("B", "2021-02-01", 3),
         ("C", "2021-01-01", 3), ("C", "2021-01-01", 3), ("C", "2021-01-07", 3)]
MENU = [(1, "sushi", 10), (2, "curry", 15), (3, "ramen", 12)]
MEMBERS = [("A", "2021-01-07"), ("B", "2021-01-09")]

RUNNERS = [(1, "2021-01-01"), (2, "2021-01-03"), (3, "2021-01-08"), (4, "2021-01-15")]
CUSTOMER_ORDERS = [
    (1, 101, 1, "", "", "2020-01-01 18:05:02"),
    (2, 101, 1, "", "", "2020-01-01 19:00:52"),
    (3, 102, 1, "", "", "2020-01-02 23:51:23"),
    (3, 102, 2, "", None, "2020-01-02 23:51:23"),
    (4, 103, 1, "4", "", "2020-01-04 13:23:46"),
    (4, 103, 1, "4", "", "2020-01-04 13:23:46"),
    (4, 103, 2, "4", "", "2020-01-04 13:23:46"),
    (5, 104, 1, "null", "1", "2020-01-08 21:00:29"),
    (6, 101, 2, "null", "null", "2020-01-08 21:03:13"),
    (7, 105, 2, "null", "1", "2020-01-08 21:20:29"),
    (8, 102, 1, "null", "null", "2020-01-09 23:54:33"),
    (9, 103, 1, "4", "1, 5", "2020-01-10 11:22:59"),
    (10, 104, 1, "null", "null", "2020-01-11 18:34:49"),
    (10, 104, 1, "2, 6", "1, 4", "2020-01-11 18:34:49"),
]
RUNNER_ORDERS = [
    (1, 1, "2020-01-01 18:15:34", "20km", "32 minutes", ""),
    (2, 1, "2020-01-01 19:10:54", "20km", "27 minutes", ""),
    (3, 1, "2020-01-03 00:12:37", "13.4km", "20 mins", None),
    (4, 2, "2020-01-04 13:53:03", "23.4", "40", None),
    (5, 3, "2020-01-08 21:10:57", "10", "15", None),
    (6, 3, "null", "null", "null", "Restaurant Cancellation"),
    (7, 2, "2020-01-08 21:30:45", "25km", "25mins", "null"),
    (8, 2, "2020-01-10 00:15:02", "23.4 km", "15 minute", "null"),
    (9, 2, "null", "null", "null", "Customer Cancellation"),
    (10, 1, "2020-01-11 18:50:20", "10km", "10minutes", "null"),
]
PIZZA_NAMES = [(1, "Meatlovers"), (2, "Vegetarian")]
PIZZA_RECIPES = [(1, "1, 2, 3, 4, 5, 6, 8, 10"), (2, "4, 6, 7, 9, 11, 12")]
PIZZA_TOPPINGS = [(1, "Bacon"), (2, "BBQ Sauce"), (3, "Beef"), (4, "Cheese"), (5, "Chicken"),
                  (6, "Mushrooms"), (7, "Onions"), (8, "Pepperoni"), (9, "Peppers"),
                  (10, "Salami"), (11, "Tomatoes"), (12, "Tomato Sauce")]
RATINGS = [(1, 3), (2, 4), (3, 5), (4, 2), (5, 1), (6, 3), (7, 4), (8, 1), (9, 3), (10, 5)]

REGIONS = [(1, "Australia"), (2, "America"), (3, "Africa"), (4, "Asia"), (5, "Europe")]
# customers 1 and 2: node allocations and transactions
CUSTOMER_NODES = [
    (1, 3, 4, "2020-01-02", "2020-01-03"), (2, 3, 5, "2020-01-03", "2020-01-17"),
    (1, 3, 4, "2020-01-04", "2020-01-14"), (2, 3, 3, "2020-01-18", "2020-02-09"),
    (1, 3, 2, "2020-01-15", "2020-01-16"), (2, 3, 3, "2020-02-10", "2020-02-21"),
    (1, 3, 5, "2020-01-17", "2020-01-28"), (2, 3, 5, "2020-02-22", "2020-03-07"),
    (1, 3, 3, "2020-01-29", "2020-02-18"), (2, 3, 2, "2020-03-08", "2020-03-12"),
    (1, 3, 2, "2020-02-19", "2020-03-16"), (2, 3, 4, "2020-03-13", "2020-03-13"),
    (1, 3, 2, "2020-03-17", "9999-12-31"), (2, 3, 4, "2020-03-14", "9999-12-31"),
]
CUSTOMER_TRANSACTIONS = [
    (1, "2020-01-02", "deposit", 312), (2, "2020-01-03", "deposit", 549),
    (1, "2020-03-05", "purchase", 612), (1, "2020-03-17", "deposit", 324),
    (1, "2020-03-19", "purchase", 664), (2, "2020-03-24", "deposit", 61),
]


def _dates(rows, idx):
    return [tuple(D(v) if i in idx and v is not None else v for i, v in enumerate(r))
            for r in rows]


def _ts(rows, idx):
    return [tuple(TS(v) if i in idx and v is not None else v for i, v in enumerate(r))
            for r in rows]


def frames(spark):
    """All case-study tables as DataFrames with their declared schemas."""
    cf = spark.createDataFrame
    return {
        "sales": cf(_dates(SALES, {1}), schemas.SALES),
        "menu": cf(MENU, schemas.MENU),
        "members": cf(_dates(MEMBERS, {1}), schemas.MEMBERS),
        "runners": cf(_dates(RUNNERS, {1}), schemas.RUNNERS),
        "customer_orders": cf(_ts(CUSTOMER_ORDERS, {5}), schemas.CUSTOMER_ORDERS),
        "runner_orders": cf(RUNNER_ORDERS, schemas.RUNNER_ORDERS),
        "pizza_names": cf(PIZZA_NAMES, schemas.PIZZA_NAMES),
        "pizza_recipes": cf(PIZZA_RECIPES, schemas.PIZZA_RECIPES),
        "pizza_toppings": cf(PIZZA_TOPPINGS, schemas.PIZZA_TOPPINGS),
        "ratings": cf(RATINGS, schemas.RATINGS),
        "regions": cf(REGIONS, schemas.REGIONS),
        "customer_nodes": cf(_dates(CUSTOMER_NODES, {3, 4}), schemas.CUSTOMER_NODES),
        "customer_transactions": cf(_dates(CUSTOMER_TRANSACTIONS, {1}),
                                    schemas.CUSTOMER_TRANSACTIONS),
    }
