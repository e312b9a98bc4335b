"""Pizza-delivery jobs: cleaning (K1, K2), order metrics (M1-M10), runner
metrics (N1-N7), ingredients (G1-G5) and money (V1-V5).

Pizza lines (``customer_orders``) are many per order; delivery rows
(``runner_orders``) are one per order.  Jobs that only need per-order line
counts aggregate the lines first, so the line-to-delivery join moves one
row per order instead of one per line.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow.functions import dates as dt
from caseflow.functions import text as tx
from caseflow.functions.numeric import EXACT, exact_sum, int_div, ratio
from caseflow.operators import lists as ls
from caseflow.operators import ranking as rk
from caseflow.operators.measures import count_when

# Pizza names and prices of the case study.
MEAT_LOVERS = "Meatlovers"
RELABEL = {"Meatlovers": "Meat Lovers"}
PREMIUM_PRICE, STANDARD_PRICE = 12, 10
COST_PER_KM = "0.3"
# ingredient_counts: lines of one task; each becomes some seven rows of its aggregation
LINES_PER_TASK = 150_000


# --- cleaning ----------------------------------------------------------------

REJECT = "array<struct<column: string, value: string, reason: string>>"


def _reject(column: str, value: Column, reason: Column | str) -> Column:
    why = F.lit(reason) if isinstance(reason, str) else reason
    return F.struct(F.lit(column).alias("column"), value.alias("value"), why.alias("reason"))


def tagged_orders(customer_orders: DataFrame) -> DataFrame:
    """K1 with ``rejects``: list elements that are no topping ids (jobs leave
    them out)."""
    co = customer_orders.withColumns({"exclusions_new": tx.null_sentinels("exclusions"),
                                      "extras_new": tx.null_sentinels("extras")})
    def bad(name: str) -> Column:
        return F.transform(tx.bad_items(f"{name}_new"), lambda x: _reject(name, x, "not a topping id"))

    none = F.array().cast(REJECT)
    return (co.withColumn("rejects", F.concat(*[F.coalesce(bad(c), none)
                                                  for c in ("exclusions", "extras")]))
            .drop("exclusions", "extras"))


def clean_orders(customer_orders: DataFrame) -> DataFrame:
    """K1: exclusions/extras with 'null', '' and ' ' turned into NULL."""
    return tagged_orders(customer_orders).drop("rejects")


def tagged_deliveries(runner_orders: DataFrame, distance_units: Sequence[str] = tx.DISTANCE_UNITS,
                      duration_units: Sequence[str] = tx.DURATION_UNITS) -> DataFrame:
    """K2 in one pass, with ``rejects``: texts that are no number in one of the
    declared units, and pickup times that are none."""
    null_word = ("null",)
    ro = runner_orders.withColumns({
        "pickup_time_new": tx.null_sentinels("pickup_time", null_word),
        "cancellation_new": tx.null_sentinels("cancellation"),
        "__km": tx.null_sentinels("distance", null_word),
        "__min": tx.null_sentinels("duration", null_word)})
    ro = ro.withColumns({"distance_km": tx.unit_number("__km", distance_units),
                         "duration_minutes": tx.unit_number("__min", duration_units),
                         "__km_reason": tx.unit_reason("__km", distance_units),
                         "__min_reason": tx.unit_reason("__min", duration_units)})
    time = F.col("pickup_time_new")
    rejects = F.array_compact(F.array(
        F.when(F.col("__km_reason").isNotNull(), _reject("distance", F.col("__km"), F.col("__km_reason"))),
        F.when(F.col("__min_reason").isNotNull(), _reject("duration", F.col("__min"), F.col("__min_reason"))),
        F.when(time.isNotNull() & time.try_cast("timestamp_ntz").isNull(),
               _reject("pickup_time", time, "not a time"))))
    return ro.withColumn("rejects", rejects).drop(
        "pickup_time", "distance", "duration", "cancellation", "__km", "__min", "__km_reason", "__min_reason")


def clean_deliveries(runner_orders: DataFrame) -> DataFrame:
    """K2: NULL sentinels; distance in km and duration in minutes as double.
    ``pickup_time_new`` stays text, as in the cleaned source."""
    return tagged_deliveries(runner_orders).drop("rejects")


def rejected(tagged: DataFrame, *keys: str) -> DataFrame:
    """(keys, column, value, reason) of the values that cleaning rejects."""
    return (tagged.filter(F.size("rejects") > 0).select(*keys, F.explode("rejects").alias("r"))
            .select(*keys, "r.column", "r.value", "r.reason"))


def _pickup_ts() -> Column:
    # wall-clock text -> timestamp_ntz directly (no session time zone involved)
    return F.col("pickup_time_new").try_cast("timestamp_ntz")


def _delivered(ro: DataFrame) -> DataFrame:
    return ro.filter(F.col("pickup_time_new").isNotNull())


def _not_cancelled(ro: DataFrame) -> DataFrame:
    return ro.filter(F.col("cancellation_new").isNull())


def _lines(co: DataFrame, *keys: str) -> DataFrame:
    return co.groupBy("order_id", *keys).agg(F.count(F.lit(1)).alias("n"))


# --- order metrics -----------------------------------------------------------

def count_items(co: DataFrame) -> DataFrame:
    """M1: pizzas ordered."""
    return co.agg(F.count("pizza_id").alias("total_ordered_pizza"))


def count_orders(co: DataFrame) -> DataFrame:
    """M2: distinct orders."""
    return co.agg(F.countDistinct("order_id").alias("unique_customer_orders"))


def delivered_by_runner(co: DataFrame, ro: DataFrame) -> DataFrame:
    """M3: pizzas (lines, not orders) delivered per runner."""
    j = _lines(co).join(_delivered(ro).select("order_id", "runner_id"), "order_id")
    return j.groupBy("runner_id").agg(F.sum("n").alias("delivered_orders"))


def delivered_by_type(co: DataFrame, ro: DataFrame, names: DataFrame) -> DataFrame:
    """M4: delivered pizzas per pizza name."""
    j = (_lines(co, "pizza_id").join(_delivered(ro).select("order_id"), "order_id")
         .groupBy("pizza_id").agg(F.sum("n").alias("n"))
         .join(names.select("pizza_id", "pizza_name",
                            F.col("pizza_id").alias("named_id")), "pizza_id", "left"))
    return j.groupBy(F.col("pizza_name").alias("pizzaname")).agg(
        F.sum(F.when(F.col("named_id").isNotNull(), F.col("n")).otherwise(0))
         .alias("delivered_pizza"))


def type_by_customer(co: DataFrame, ro: DataFrame, names: DataFrame) -> DataFrame:
    """M5: pizzas per (pizza name, customer); the delivery join keeps all lines."""
    j = (co.groupBy("order_id", "customer_id", "pizza_id").agg(F.count("order_id").alias("n"))
         .join(ro.select("order_id"), "order_id", "left")
         .join(names.select("pizza_id", "pizza_name"), "pizza_id", "left"))
    return j.groupBy(F.col("pizza_name").alias("pizzaname"), "customer_id") \
            .agg(F.sum("n").alias("pizza_type_per_customer"))


def largest_order(co: DataFrame) -> DataFrame:
    """M6: the order with most pizzas (ties cut by order id)."""
    c = co.groupBy("order_id").agg(F.count("order_id").alias("max_single_order_pizza"))
    return rk.top_n(c, [F.col("max_single_order_pizza").desc(), F.col("order_id").asc()], 1)


def variety_behaviour(co: DataFrame, names: DataFrame) -> DataFrame:
    """M7: pizzas per customer, labelled by whether they ordered more than
    one pizza type."""
    j = co.select("customer_id", "order_id", "pizza_id").join(
        names.select(F.col("pizza_id"), F.col("pizza_id").alias("p_id")), "pizza_id", "left")
    return j.groupBy("customer_id").agg(
        F.count("order_id").alias("count_pizza"),
        F.when(F.countDistinct("p_id") > 1, F.lit("change types of pizza"))
         .otherwise(F.lit("no changes")).alias("behavior_order"))


def both_changes(co: DataFrame, ro: DataFrame) -> DataFrame:
    """M8: delivered pizzas having both exclusions and extras, per order."""
    c = _lines(co.filter(F.col("exclusions_new").isNotNull() & F.col("extras_new").isNotNull()))
    return (c.join(_delivered(ro).select("order_id"), "order_id")
             .groupBy("order_id").agg(F.sum("n").alias("total_order_both_changes")))


def volume_by_hour(co: DataFrame) -> DataFrame:
    """M9: pizzas per hour of day."""
    return co.groupBy(F.hour("order_time").alias("hour")) \
             .agg(F.count("order_id").alias("volume_of_pizza"))


def volume_by_weekday(co: DataFrame) -> DataFrame:
    """Pizzas per weekday (Sunday = 1)."""
    return co.groupBy(dt.day_of_week_sunday1("order_time").alias("day")) \
             .agg(F.count("order_id").alias("volume_of_pizza"))


# --- runner metrics ----------------------------------------------------------

def signups_by_week(runners: DataFrame, shift_days: int = 5,
                    anchor: str | None = None) -> DataFrame:
    """Runners per week bucket.  Default bucket = Sunday-start week plus
    ``shift_days`` (as the source computes it); with ``anchor`` (e.g.
    ``'2021-01-01'``, the stated intent) buckets are 7-day periods starting
    on the anchor date."""
    d = F.col("registration_date").cast("date")
    if anchor is None:
        wk = F.date_add(dt.week_start_sunday(d), shift_days)
    else:
        a = F.lit(anchor).cast("date")
        wk = F.date_add(a, F.floor(F.datediff(d, a) / 7).cast("int") * 7)
    return runners.groupBy(wk.alias("week")).agg(F.count("runner_id").alias("count_runner"))


def _pickup_lines(co: DataFrame, ro: DataFrame) -> DataFrame:
    """Per (order, order time): lines and pizzas, joined to the delivered
    pickup; ``timed`` counts the lines whose wait is known."""
    lines = co.groupBy("order_id", "order_time").agg(
        F.count(F.lit(1)).alias("n"), F.count("pizza_id").alias("pizzas"))
    d = _delivered(ro).select("order_id", "runner_id", _pickup_ts().alias("pickup_ts"))
    return (lines.join(d, "order_id")
            .withColumn("mins", dt.minutes_boundary("order_time", "pickup_ts"))
            .withColumn("timed", F.when(F.col("mins").isNotNull(), F.col("n")).otherwise(F.lit(0))))


def avg_pickup_minutes(co: DataFrame, ro: DataFrame) -> DataFrame:
    """Mean minute-boundary wait per runner over the lines whose wait is known."""
    j = _pickup_lines(co, ro)
    return j.groupBy("runner_id").agg(
        ratio(F.sum(F.col("timed") * F.col("mins")), F.sum("timed")).alias("avg_time"))


def prep_time_by_size(co: DataFrame, ro: DataFrame) -> DataFrame:
    """Mean preparation minutes by pizzas per order (inner mean is an
    integer mean, as in the source)."""
    j = _pickup_lines(co, ro)
    per_order = j.groupBy("order_id").agg(
        F.sum("pizzas").alias("number_of_pizza"),
        int_div(F.sum(F.col("timed") * F.col("mins")), F.sum("timed")).alias("prep_time"))
    return per_order.groupBy("number_of_pizza").agg(
        F.avg(F.col("prep_time").cast("double")).alias("avg_prep_time"))


def avg_distance_by_customer(co: DataFrame, ro: DataFrame) -> DataFrame:
    """Mean delivery distance per customer, weighted by pizza lines."""
    lines = co.groupBy("order_id", "customer_id").agg(F.count(F.lit(1)).alias("n"))
    d = ro.filter(F.col("distance_km").isNotNull()).select("order_id", "distance_km")
    j = lines.join(d, "order_id")
    total = F.sum(F.col("n") * F.col("distance_km").cast(EXACT))
    return j.groupBy("customer_id").agg(
        F.try_divide(total.cast("double"), F.sum("n")).alias("distance_per_customer_km"))


def duration_range(ro: DataFrame) -> DataFrame:
    """Longest minus shortest delivery duration."""
    d = ro.filter(F.col("duration_minutes").isNotNull())
    return d.agg((F.max("duration_minutes") - F.min("duration_minutes"))
                 .alias("diff_longest_shortest_delivery_time"))


def speed_by_delivery(ro: DataFrame) -> DataFrame:
    """Km per minute per (runner, delivered order)."""
    d = _delivered(ro)
    return d.groupBy("runner_id", "order_id").agg(
        F.try_divide(exact_sum("distance_km").cast("double"),
                     exact_sum("duration_minutes").cast("double")).alias("avg_speed"))


def success_rate(ro: DataFrame) -> DataFrame:
    """Delivered share of orders per runner (0-1)."""
    return ro.groupBy("runner_id").agg(
        ratio(F.sum(F.when(F.col("pickup_time_new").isNull(), 0).otherwise(1)),
              F.count("order_id")).alias("percentage_of_successful_order"))


# --- ingredients -------------------------------------------------------------

def recipe_ingredients(recipes: DataFrame, toppings: DataFrame) -> DataFrame:
    """G1: one row per (pizza, standard topping)."""
    e = ls.explode_ids(recipes.select("pizza_id", "toppings"), "toppings", "topping_id")
    return ls.decode_ids(e.select("pizza_id", "topping_id"), "topping_id", toppings,
                         "topping_id", ["topping_name"]) \
             .select("pizza_id", "topping_id", "topping_name")


def _top_change(co: DataFrame, toppings: DataFrame, list_col: str, name_out: str) -> DataFrame:
    e = ls.explode_ids(co.select(list_col), list_col, "topping_id")
    c = e.groupBy("topping_id").agg(F.count(F.lit(1)).alias("n"))
    j = ls.decode_ids(c, "topping_id", toppings, "topping_id", ["topping_name"])
    j = j.groupBy("topping_id", F.col("topping_name").alias(name_out)) \
         .agg(F.sum("n").alias("number_topping"))
    return rk.top_n(j, [F.col("number_topping").desc(), F.col("topping_id").asc()], 1)


def top_extra(co: DataFrame, toppings: DataFrame) -> DataFrame:
    """Most frequent extra topping (ties cut by topping id)."""
    return _top_change(co, toppings, "extras_new", "extra_topping_name")


def top_exclusion(co: DataFrame, toppings: DataFrame) -> DataFrame:
    """Most frequent excluded topping (ties cut by topping id)."""
    return _top_change(co, toppings, "exclusions_new", "exclusion_topping_name")


def _changes(co: DataFrame, toppings: DataFrame, list_col: str) -> DataFrame:
    """(order, pizza, topping id, topping name) per listed change."""
    e = ls.explode_ids(co.select("order_id", "pizza_id", list_col), list_col, "topping_id")
    return ls.decode_ids(e.select("order_id", "pizza_id", "topping_id"), "topping_id",
                         toppings, "topping_id", ["topping_name"])


def _tagged_items(lines: DataFrame, lists: Mapping[str, Column],
                  keys: Sequence[str] = ("order_id", "pizza_id")) -> DataFrame:
    """One pass over order lines: ``(*keys, kind, topping_id)`` for every
    element of every list column (``kind`` names the list).  A line whose
    lists are all empty still yields rows with a NULL id, so the result also
    carries every key of the input."""
    tagged = F.explode(F.array(*[
        F.struct(F.lit(kind).alias("kind"), col.alias("lst")) for kind, col in lists.items()]))
    t = lines.select(*keys, tagged.alias("t"))
    return t.select(*keys, F.col("t.kind").alias("kind"),
                    F.explode_outer(tx.split_list("t.lst")).alias("item")) \
            .withColumn("topping_id", tx.list_item_id("item")).drop("item")


def order_description(co: DataFrame, toppings: DataFrame, names: DataFrame,
                      relabel: Mapping[str, str] = RELABEL,
                      trailing_sep: bool = False, line_key: str | None = None) -> DataFrame:
    """G4: "Name - Exclude a, b - Extra c" per distinct (order, text).

    As in the source, the change names are gathered per *order* and attached
    to every (order, pizza) that has a change of that kind.  ``trailing_sep``
    reproduces the ", " left after the last name.  With ``line_key`` (a
    column identifying each order line) every line is described by its own
    changes instead, so two lines of the same pizza stay apart.

    Plan: one explode of both lists per line, names decoded by a broadcast
    join of the topping dimension, then two map-side-combined aggregations:
    name sets per order (per line with ``line_key``; bounded by the number
    of toppings) and per-(order, pizza) flags, joined on the order.
    """
    line = [line_key] if line_key else []
    keys = ["order_id", *line, "pizza_id"]
    items = _tagged_items(co, {"x": F.col("exclusions_new"), "e": F.col("extras_new")}, keys)
    d = ls.decode_ids(items, "topping_id", toppings, "topping_id", ["topping_name"], how="left")
    dedup = d.select(*keys, "kind", "topping_name")
    named = F.col("topping_name").isNotNull()
    sep = ", "

    def name_list(kind: str) -> Column:
        lst = F.array_join(F.sort_array(F.collect_set(
            F.when(named & (F.col("kind") == kind), F.col("topping_name")))), sep)
        return F.concat(lst, F.lit(sep)) if trailing_sep else lst

    per_order = dedup.groupBy("order_id", *line).agg(name_list("x").alias("x_names"),
                                                     name_list("e").alias("e_names"))
    flags = dedup.groupBy(*keys).agg(
        F.max(named & (F.col("kind") == "x")).alias("has_x"),
        F.max(named & (F.col("kind") == "e")).alias("has_e"))
    j = (flags.join(per_order, ["order_id", *line])
              .join(names.select("pizza_id", "pizza_name"), "pizza_id"))
    detail = tx.join_phrases(
        tx.relabel("pizza_name", relabel),
        tx.optional_phrase(" - Exclude ", F.when(F.col("has_x"), F.col("x_names"))),
        tx.optional_phrase(" - Extra ", F.when(F.col("has_e"), F.col("e_names"))))
    out = j.select("order_id", *line, detail.alias("order_detail"))
    return out.distinct() if not line else out


def ingredient_counts(co: DataFrame, recipes: DataFrame, toppings: DataFrame,
                      names: DataFrame, line_key: str | None = None) -> DataFrame:
    """Topping counts per (order, pizza): standard toppings minus the
    excluded ones plus extras.  Lines of the same pizza in one order share
    their changes, as in the source; with ``line_key`` each line keeps its
    own changes (output gains that column).

    Plan: every line is joined to its recipe and name and its three lists
    (recipe, exclusions, extras) are exploded in one pass; a single aggregation
    per (order, pizza, topping id) counts standard and extra rows and flags
    exclusions, which zero the standard count (the source's anti-join).  The
    lines are dealt by (order, pizza) between the two: the aggregation does not
    rest on the recipe join's partitioning by pizza, so a popular pizza is
    spread over the tasks and the join itself can be split.  Names come with the
    lines, as there are several times as many counts, and lines are dealt to
    tasks of LINES_PER_TASK, as each becomes many rows of the aggregation.
    """
    line = [line_key] if line_key else []
    keys = ["order_id", *line, "pizza_id"]
    # names that repeat for a pizza give their rows as often
    named = names.groupBy("pizza_id", "pizza_name").agg(F.count(F.lit(1)).alias("__copies"))
    pizzas = named.join(recipes.select("pizza_id", "toppings"), "pizza_id", "left")
    tasks = max(int(co.sparkSession.conf.get("spark.sql.shuffle.partitions")), co.count() // LINES_PER_TASK + 1)
    lines = co.select(*keys, "exclusions_new", "extras_new").join(pizzas, "pizza_id").repartition(tasks, *keys)
    keys += ["pizza_name", "__copies"]
    items = _tagged_items(lines, {"s": F.col("toppings"), "x": F.col("exclusions_new"),
                                  "e": F.col("extras_new")}, keys)
    k = F.col("kind")
    agg = items.filter(F.col("topping_id").isNotNull()) \
        .groupBy(*keys, "topping_id").agg(
            count_when(k == "s").alias("n_std"), count_when(k == "e").alias("n_extra"),
            F.max(k == "x").alias("excluded"))
    n = F.when(F.col("excluded"), F.lit(0)).otherwise(F.col("n_std")) + F.col("n_extra")
    out = agg.withColumn("n", n.cast("long")).filter(F.col("n") > 0)
    # ids without a topping name drop out here, as with the source's inner joins
    out = ls.decode_ids(out, "topping_id", toppings, "topping_id", ["topping_name"])
    return (out.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "__copies")))
            .select("order_id", *line, "pizza_id", "topping_id", F.col("pizza_name").alias("name_of_pizza"),
                    F.col("topping_name").alias("toppings"), "n"))


# --- money ---------------------------------------------------------------------

def _price_by_name(names: DataFrame, premium: str) -> DataFrame:
    return names.select("pizza_id", F.when(F.col("pizza_name") == premium, PREMIUM_PRICE)
                        .otherwise(STANDARD_PRICE).alias("pizza_cost"))


def fixed_price_revenue(co: DataFrame, ro: DataFrame, names: DataFrame,
                        premium: str = MEAT_LOVERS) -> DataFrame:
    """V1: revenue of non-cancelled orders at fixed prices."""
    j = (_lines(co, "pizza_id").join(_not_cancelled(ro).select("order_id"), "order_id")
         .join(_price_by_name(names, premium), "pizza_id"))
    return j.agg(F.sum(F.col("n") * F.col("pizza_cost")).alias("total_revenue"))


def revenue_with_extras(co: DataFrame, ro: DataFrame, names: DataFrame,
                        premium: str = MEAT_LOVERS,
                        price_by_id: Mapping[int, int] | None = None,
                        count_items: bool = False) -> DataFrame:
    """V2: revenue with +1 for a one-character extras list and +2 for any
    longer one (byte length, as in the source; ``count_items=True`` charges
    per listed extra instead).  Prices come from the premium name rule, or
    from ``price_by_id`` (ids not listed get no price)."""
    lines = co.join(_not_cancelled(ro).select("order_id"), "order_id")
    if price_by_id is not None:
        cost = None
        for pid, price in price_by_id.items():
            cost = (F.when(F.col("pizza_id") == pid, price) if cost is None
                    else cost.when(F.col("pizza_id") == pid, price))
        lines = lines.withColumn("pizza_cost", cost)
    else:
        lines = lines.join(_price_by_name(names, premium), "pizza_id")
    ex = F.col("extras_new")
    if count_items:
        charge = F.col("pizza_cost") + F.coalesce(tx.item_count(ex), F.lit(0))
    else:
        charge = (F.when(ex.isNull(), F.col("pizza_cost"))
                   .when(tx.byte_length(ex) == 1, F.col("pizza_cost") + 1)
                   .otherwise(F.col("pizza_cost") + 2))
    return lines.agg(F.sum(charge).alias("total_earn"))


def ratings_table(ratings: DataFrame) -> DataFrame:
    """V3: the ratings side table as stored."""
    return ratings.select("order_id", "rating")


def delivery_report(co: DataFrame, ro: DataFrame, ratings: DataFrame) -> DataFrame:
    """V4: one row per non-cancelled order line group with pickup wait
    (minute field), speed (km/h, rounded) and pizza count.  Orders without a
    delivery row survive (left join, NULL cancellation)."""
    lines = co.groupBy("customer_id", "order_id", "order_time") \
              .agg(F.count("pizza_id").alias("pizzas"), F.count(F.lit(1)).alias("n"))
    j = (lines.join(ro.select("order_id", "runner_id", "pickup_time_new", "distance_km",
                              "duration_minutes", "cancellation_new"), "order_id", "left")
              .join(ratings.select("order_id", "rating"), "order_id", "left")
              .filter(F.col("cancellation_new").isNull()))
    # several delivery or rating rows of an order meet in one row again
    j = j.withColumns({
        "speed": F.try_divide("distance_km", "duration_minutes") * 60,
        "time_order_pickup": dt.minutes_field("order_time", _pickup_ts())})
    known = F.sum(F.when(F.col("speed").isNotNull(), F.col("n")))
    # rounded as a decimal, so that a tie doesn't hang on a double's last bit
    mean = (F.sum(F.col("n") * F.col("speed")) / known).cast("decimal(38,9)")
    return (j.groupBy("customer_id", "order_id", "runner_id", "rating", "order_time",
                      "pickup_time_new", "time_order_pickup", "duration_minutes")
            .agg(F.round(mean, 2).cast("double").alias("avg_speed"),
                 F.sum("pizzas").alias("pizza_count")))


def profit(co: DataFrame, ro: DataFrame, names: DataFrame, premium: str = MEAT_LOVERS,
           cost_per_km: str = COST_PER_KM) -> DataFrame:
    """V5: revenue, runner cost (per km, each order's distance once) and
    profit over non-cancelled orders."""
    per_order = (co.select("order_id", "pizza_id")
                 .join(_price_by_name(names, premium), "pizza_id")
                 .groupBy("order_id").agg(F.sum("pizza_cost").alias("pizza_cost")))
    j = _not_cancelled(ro).select("order_id", "distance_km").join(per_order, "order_id")
    rate = F.lit(cost_per_km).cast("decimal(18,6)")
    dist = exact_sum("distance_km").cast("decimal(28,9)")
    return j.agg(
        F.sum("pizza_cost").alias("revenue"),
        (dist * rate).cast("decimal(18,2)").alias("total_cost"),
        (F.sum("pizza_cost") - dist * rate).cast("decimal(18,2)").alias("profit"))
