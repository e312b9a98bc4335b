import datetime as dt

from pyspark.sql import functions as F
from decimal import Decimal

import pytest

from caseflow.plans import delivery as dv
from tests.fixtures import frames


@pytest.fixture(scope="module")
def t(spark):
    f = frames(spark)
    f["co"] = dv.clean_orders(f["customer_orders"]).cache()
    f["ro"] = dv.clean_deliveries(f["runner_orders"]).cache()
    return f


def rows(df, *cols):
    return sorted(tuple(x[c] for c in cols) for x in df.collect())


def test_clean_orders(t):
    got = {(x.order_id, x.pizza_id, x.exclusions_new, x.extras_new) for x in t["co"].collect()}
    assert (3, 2, None, None) in got and (4, 1, "4", None) in got
    assert (10, 1, "2, 6", "1, 4") in got and (5, 1, None, "1") in got
    assert set(t["co"].columns) == {"order_id", "customer_id", "pizza_id", "order_time",
                                    "exclusions_new", "extras_new"}


def test_clean_deliveries(t):
    got = {x.order_id: (x.distance_km, x.duration_minutes, x.cancellation_new,
                        x.pickup_time_new) for x in t["ro"].collect()}
    assert got[1][:3] == (20.0, 32.0, None)
    assert got[3][:2] == (13.4, 20.0)
    assert got[4][:2] == (23.4, 40.0)
    assert got[7][:3] == (25.0, 25.0, None)
    assert got[8][:2] == (23.4, 15.0)
    assert got[10][:2] == (10.0, 10.0)
    assert got[6] == (None, None, "Restaurant Cancellation", None)


def test_order_metrics(t):
    co, ro, pn = t["co"], t["ro"], t["pizza_names"]
    assert dv.count_items(co).first()[0] == 14
    assert dv.count_orders(co).first()[0] == 10
    assert rows(dv.delivered_by_runner(co, ro), "runner_id", "delivered_orders") == \
        [(1, 6), (2, 5), (3, 1)]
    assert rows(dv.delivered_by_type(co, ro, pn), "pizzaname", "delivered_pizza") == \
        [("Meatlovers", 9), ("Vegetarian", 3)]
    assert rows(dv.type_by_customer(co, ro, pn), "pizzaname", "customer_id",
                "pizza_type_per_customer") == [
        ("Meatlovers", 101, 2), ("Meatlovers", 102, 2), ("Meatlovers", 103, 3),
        ("Meatlovers", 104, 3), ("Vegetarian", 101, 1), ("Vegetarian", 102, 1),
        ("Vegetarian", 103, 1), ("Vegetarian", 105, 1)]
    assert rows(dv.largest_order(co), "order_id", "max_single_order_pizza") == [(4, 3)]
    assert rows(dv.variety_behaviour(co, pn), "customer_id", "count_pizza",
                "behavior_order") == [
        (101, 3, "change types of pizza"), (102, 3, "change types of pizza"),
        (103, 4, "change types of pizza"), (104, 3, "no changes"), (105, 1, "no changes")]
    assert rows(dv.both_changes(co, ro), "order_id", "total_order_both_changes") == [(10, 1)]
    assert rows(dv.volume_by_hour(co), "hour", "volume_of_pizza") == \
        [(11, 1), (13, 3), (18, 3), (19, 1), (21, 3), (23, 3)]
    assert rows(dv.volume_by_weekday(co), "day", "volume_of_pizza") == \
        [(4, 5), (5, 3), (6, 1), (7, 5)]


def test_runner_metrics(t):
    co, ro = t["co"], t["ro"]
    d = dt.date.fromisoformat
    assert rows(dv.signups_by_week(t["runners"]), "week", "count_runner") == \
        [(d("2021-01-01"), 1), (d("2021-01-08"), 2), (d("2021-01-15"), 1)]
    got = dict(rows(dv.avg_pickup_minutes(co, ro), "runner_id", "avg_time"))
    assert round(got[1], 3) == 15.667 and round(got[2], 3) == 24.2 and got[3] == 10.0
    got = dict(rows(dv.prep_time_by_size(co, ro), "number_of_pizza", "avg_prep_time"))
    assert round(got[1], 1) == 12.2 and got[2] == 18.5 and got[3] == 30.0
    got = dict(rows(dv.avg_distance_by_customer(co, ro), "customer_id",
                    "distance_per_customer_km"))
    assert {k: round(v, 3) for k, v in got.items()} == \
        {101: 20.0, 102: 16.733, 103: 23.4, 104: 10.0, 105: 25.0}
    assert dv.duration_range(ro).first()[0] == 30.0
    got = {o: round(s, 4) for _, o, s in rows(dv.speed_by_delivery(ro), "runner_id",
                                                  "order_id", "avg_speed")}
    assert got == {1: 0.625, 2: 0.7407, 3: 0.67, 4: 0.585, 5: 0.6667, 7: 1.0, 8: 1.56,
                   10: 1.0}
    assert rows(dv.success_rate(ro), "runner_id", "percentage_of_successful_order") == \
        [(1, 1.0), (2, 0.75), (3, 0.5)]


def test_ingredients(t):
    co, tp, pn, pr = t["co"], t["pizza_toppings"], t["pizza_names"], t["pizza_recipes"]
    assert dv.recipe_ingredients(pr, tp).count() == 14
    assert rows(dv.top_extra(co, tp), "extra_topping_name", "number_topping") == [("Bacon", 4)]
    assert rows(dv.top_exclusion(co, tp), "exclusion_topping_name", "number_topping") == \
        [("Cheese", 4)]


def test_order_description(t):
    got = rows(dv.order_description(t["co"], t["pizza_toppings"], t["pizza_names"]),
               "order_id", "order_detail")
    assert got == [
        (1, "Meat Lovers"), (2, "Meat Lovers"), (3, "Meat Lovers"), (3, "Vegetarian"),
        (4, "Meat Lovers - Exclude Cheese"), (4, "Vegetarian - Exclude Cheese"),
        (5, "Meat Lovers - Extra Bacon"), (6, "Vegetarian"), (7, "Vegetarian - Extra Bacon"),
        (8, "Meat Lovers"), (9, "Meat Lovers - Exclude Cheese - Extra Bacon, Chicken"),
        (10, "Meat Lovers - Exclude BBQ Sauce, Mushrooms - Extra Bacon, Cheese")]
    faithful = rows(dv.order_description(t["co"], t["pizza_toppings"], t["pizza_names"],
                                         trailing_sep=True), "order_id", "order_detail")
    assert (5, "Meat Lovers - Extra Bacon, ") in faithful


def test_ingredient_counts(t):
    df = dv.ingredient_counts(t["co"], t["pizza_recipes"], t["pizza_toppings"],
                              t["pizza_names"])
    got = rows(df, "order_id", "pizza_id", "toppings", "n")
    assert len(got) == 84 and sum(x[3] for x in got) == 102
    o = lambda oid: {x[2]: x[3] for x in got if x[0] == oid and x[1] == 1}
    assert o(5)["Bacon"] == 2
    assert o(9)["Bacon"] == 2 and o(9)["Chicken"] == 2 and "Cheese" not in o(9)
    o10 = o(10)
    assert (o10["Bacon"], o10["Cheese"], o10["Beef"], o10["Chicken"]) == (3, 3, 2, 2)
    assert o10["Pepperoni"] == 2 and o10["Salami"] == 2
    assert "BBQ Sauce" not in o10 and "Mushrooms" not in o10


def test_money(t):
    co, ro, pn = t["co"], t["ro"], t["pizza_names"]
    assert dv.fixed_price_revenue(co, ro, pn).first()[0] == 138
    assert dv.revenue_with_extras(co, ro, pn).first()[0] == 142
    assert dv.revenue_with_extras(co, ro, pn, price_by_id={1: 12, 2: 10}).first()[0] == 142
    p = dv.profit(co, ro, pn).first()
    assert (p.revenue, p.total_cost, p.profit) == (138, Decimal("43.56"), Decimal("94.44"))


def test_delivery_report(t):
    df = dv.delivery_report(t["co"], t["ro"], t["ratings"])
    got = {x.order_id: (x.time_order_pickup, x.avg_speed, x.pizza_count) for x in df.collect()}
    assert got == {1: (10, 37.5, 1), 2: (10, 44.44, 1), 3: (21, 40.2, 2), 4: (29, 35.1, 3),
                   5: (10, 40.0, 1), 7: (10, 60.0, 1), 8: (20, 93.6, 1), 10: (15, 60.0, 2)}


def test_signups_anchored_option(t):
    d = dt.date.fromisoformat
    assert rows(dv.signups_by_week(t["runners"], anchor="2021-01-01"), "week", "count_runner") \
        == [(d("2021-01-01"), 2), (d("2021-01-08"), 1), (d("2021-01-15"), 1)]


def test_line_key_keeps_twins_apart(spark, t):
    from pyspark.sql import Window
    w = Window.orderBy("order_id", "pizza_id", "exclusions_new", "extras_new")
    co = t["co"].withColumn("line_id", F.row_number().over(w))
    got = rows(dv.order_description(co, t["pizza_toppings"], t["pizza_names"],
                                    line_key="line_id"), "order_id", "order_detail")
    o10 = sorted(x[1] for x in got if x[0] == 10)
    assert o10 == ["Meat Lovers",
                   "Meat Lovers - Exclude BBQ Sauce, Mushrooms - Extra Bacon, Cheese"]
    assert len(got) == 14                       # one description per line
    ic = dv.ingredient_counts(co, t["pizza_recipes"], t["pizza_toppings"], t["pizza_names"],
                              line_key="line_id")
    per_line = {}
    for r in ic.filter("order_id = 10").collect():
        per_line.setdefault(r.line_id, {})[r.toppings] = r.n
    # the unchanged line still has BBQ Sauce; the changed one excludes it
    plain, changed = sorted(per_line.values(), key=lambda m: "BBQ Sauce" in m, reverse=True)
    assert plain["BBQ Sauce"] == 1 and plain["Bacon"] == 1
    assert changed["Bacon"] == 2 and changed["Cheese"] == 2 and "Mushrooms" not in changed
