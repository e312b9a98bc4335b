"""One key holds a third of the rows or more."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from caseflow.plans import delivery, restaurant


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_member_ranking_of_a_busy_customer(spark, no_broadcast):
    day = dt.date(2022, 3, 1)
    sales = spark.createDataFrame(
        [("busy", day + dt.timedelta(i % 9), 1 + i % 4) for i in range(90)]
        + [(f"c{i % 20}", day + dt.timedelta(i % 5), 1 + i % 3) for i in range(100)]
        + [("busy", None, 1)], "customer_id string, order_date date, product_id int")
    menu = spark.createDataFrame([(1, "p", 3), (2, "q", 4), (3, "r", 5)],  # no product 4
                                 "product_id int, product_name string, price int")
    members = spark.createDataFrame([("busy", day + dt.timedelta(4)), ("c1", day), ("none", day)],
                                    "customer_id string, join_date date")
    got = restaurant.member_flag_ranking(sales, menu, members)
    cols = ["customer_id", "order_date", "product_name", "price", "member", "ranking"]
    j = sales.join(menu, "product_id").join(members, "customer_id", "left") \
             .withColumn("member", F.when(F.col("order_date") >= F.col("join_date"), "Y").otherwise("N"))
    w = Window.partitionBy("customer_id", "member").orderBy("order_date")
    want = j.withColumn("ranking", F.when(F.col("member") == "Y", F.rank().over(w))).select(cols)
    assert sorted(map(str, got.select(cols).collect())) == sorted(map(str, want.collect()))


def test_ingredient_counts_of_a_popular_pizza(spark, no_broadcast):
    co = spark.createDataFrame(
        [(i, 1 if i % 3 else 2, "1" if i % 2 else None, "3") for i in range(60)],
        "order_id int, pizza_id int, exclusions_new string, extras_new string")
    recipes = spark.createDataFrame([(1, "1, 2"), (2, "2")], "pizza_id int, toppings string")
    toppings = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "topping_id int, topping_name string")
    names = spark.createDataFrame([(1, "x"), (2, "y")], "pizza_id int, pizza_name string")
    out = delivery.ingredient_counts(co, recipes, toppings, names)
    want = set()
    for i in range(60):
        p = 1 if i % 3 else 2
        want |= {(i, p, "b", 1), (i, p, "c", 1)}
        if p == 1 and i % 2 == 0:
            want.add((i, p, "a", 1))
    got = [(r.order_id, r.pizza_id, r.toppings, r.n) for r in out.collect()]
    assert len(got) == len(want) and set(got) == want
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [order_id" in plan  # dealt anew between join and aggregation


def test_ingredient_tasks_grow_with_the_lines(spark, no_broadcast, monkeypatch):
    monkeypatch.setattr(delivery, "LINES_PER_TASK", 10)
    co = spark.createDataFrame([(i, 1 if i else None, None, "3") for i in range(400)],
                               "order_id int, pizza_id int, exclusions_new string, extras_new string")
    recipes = spark.createDataFrame([(1, "3")], "pizza_id int, toppings string")
    toppings = spark.createDataFrame([(3, "c")], "topping_id int, topping_name string")
    names = spark.createDataFrame([(1, "x"), (1, "x"), (1, None), (9, "y")], "pizza_id int, pizza_name string")
    out = delivery.ingredient_counts(co, recipes, toppings, names)
    got = sorted((r.order_id, str(r.name_of_pizza), r.n) for r in out.collect())
    assert got == sorted((i, name, 2) for i in range(1, 400) for name in ("x", "x", "None"))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert ", 41" in plan[plan.index("RepartitionByExpression"):].split("\n")[0]
