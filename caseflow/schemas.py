"""Declared schemas of the domain tables (all fields nullable: the source
tables declare no keys or NOT NULL constraints)."""

from pyspark.sql import types as T


def _s(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


I, L, S, D = T.IntegerType(), T.LongType(), T.StringType(), T.DateType()
TS = T.TimestampNTZType()
DBL = T.DoubleType()

# restaurant
SALES = _s(("customer_id", S), ("order_date", D), ("product_id", I))
MENU = _s(("product_id", I), ("product_name", S), ("price", I))
MEMBERS = _s(("customer_id", S), ("join_date", D))

# pizza delivery
RUNNERS = _s(("runner_id", I), ("registration_date", D))
CUSTOMER_ORDERS = _s(("order_id", I), ("customer_id", I), ("pizza_id", I),
                     ("exclusions", S), ("extras", S), ("order_time", TS))
RUNNER_ORDERS = _s(("order_id", I), ("runner_id", I), ("pickup_time", S),
                   ("distance", S), ("duration", S), ("cancellation", S))
PIZZA_NAMES = _s(("pizza_id", I), ("pizza_name", S))
PIZZA_RECIPES = _s(("pizza_id", I), ("toppings", S))
PIZZA_TOPPINGS = _s(("topping_id", I), ("topping_name", S))
RATINGS = _s(("order_id", I), ("rating", I))

# subscriptions
PLANS = _s(("plan_id", I), ("plan_name", S), ("price", T.DecimalType(5, 2)))
SUBSCRIPTIONS = _s(("customer_id", I), ("plan_id", I), ("start_date", D))

# bank
REGIONS = _s(("region_id", I), ("region_name", S))
CUSTOMER_NODES = _s(("customer_id", I), ("region_id", I), ("node_id", I),
                    ("start_date", D), ("end_date", D))
CUSTOMER_TRANSACTIONS = _s(("customer_id", I), ("txn_date", D),
                           ("txn_type", S), ("txn_amount", I))

# retail mart
WEEKLY_SALES = _s(("week_date", S), ("region", S), ("platform", S), ("segment", S),
                  ("customer_type", S), ("transactions", I), ("sales", I))

BY_NAME = {
    "sales": SALES, "menu": MENU, "members": MEMBERS, "runners": RUNNERS,
    "customer_orders": CUSTOMER_ORDERS, "runner_orders": RUNNER_ORDERS,
    "pizza_names": PIZZA_NAMES, "pizza_recipes": PIZZA_RECIPES,
    "pizza_toppings": PIZZA_TOPPINGS, "ratings": RATINGS, "plans": PLANS,
    "subscriptions": SUBSCRIPTIONS, "regions": REGIONS,
    "customer_nodes": CUSTOMER_NODES,
    "customer_transactions": CUSTOMER_TRANSACTIONS, "weekly_sales": WEEKLY_SALES,
}
