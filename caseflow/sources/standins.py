"""Domain tables derived from the driver's TPC-H-style tables.

The case-study tables (restaurant sales, pizza orders, bank transactions,
weekly mart sales) are rebuilt deterministically from the parquet tables so
every job runs over data that grows with the scale factor.  Only Spark
built-ins are used and every derivation is deterministic, so a lost task
recomputes the same rows.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.functions.dates import format_dmy
from caseflow.operators.joins import bounded_broadcast
from caseflow.sources.tables import DriverTables
from caseflow.sources.writers import built_once, kept_once

# Stand-in parameters for constants the case studies hard-code.
BONUS_PRODUCT_NAME = "small ring"      # plays the double-points menu item
BONUS_PRODUCT_ID = 1                   # plays product id 1 in the bonus rule
POINTS_MONTH = "1999-01-01"            # points are counted to this month's end
PREMIUM_PIZZA = "small ring"           # plays the 12-dollar pizza
PIZZA_RELABEL = {"small ring": "Small Ring"}
BASELINE_DATE = "1998-06-15"           # before/after baseline (a Monday)
OPEN_END = "9999-12-31"


def _floor_long(c: str) -> Column:
    return F.floor(F.col(c)).cast("long")


def _order_time() -> Column:
    # order date (midnight) plus a second-of-day taken from the order total
    return F.timestamp_add("SECOND", _floor_long("o_totalprice") % 86400, F.col("o_orderdate"))


def _sales_lines(t: DriverTables) -> DataFrame:
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    return li.join(o, li.l_orderkey == o.o_orderkey, "inner")


def _supplier_region(t: DriverTables) -> DataFrame:
    """supplier key -> region key/name (nation and region are fixed-size).

    The lookup is size-checked for broadcast: joined to line items it must be
    the build side, never the streamed side (otherwise Catalyst may broadcast
    the projected line items and produce every joined row in one task)."""
    nat = bounded_broadcast(t.nation.select("n_nationkey", "n_regionkey"))
    reg = bounded_broadcast(t.region.select("r_regionkey", "r_name"))
    s = t.supplier.select("s_suppkey", "s_nationkey")
    sr = (s.join(nat, s.s_nationkey == nat.n_nationkey)
           .join(reg, F.col("n_regionkey") == reg.r_regionkey)
           .select("s_suppkey", "n_regionkey", "r_name"))
    return bounded_broadcast(sr)


# --- restaurant ------------------------------------------------------------

def sales(t: DriverTables) -> DataFrame:
    return _sales_lines(t).select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("l_partkey").alias("product_id"))


def menu(t: DriverTables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.floor("p_retailprice").cast("int").alias("price"))


def members(t: DriverTables) -> DataFrame:
    c = t.customer
    offset = (F.floor(F.col("c_acctbal") / 5) + 200).cast("int")
    return (c.filter(F.col("c_mktsegment") != "HOUSEHOLD")
             .select(F.col("c_custkey").alias("customer_id"),
                     F.date_add(F.lit("1995-01-01").cast("date"), offset).alias("join_date")))


# --- pizza delivery --------------------------------------------------------

def customer_orders(t: DriverTables) -> DataFrame:
    j = _sales_lines(t)
    ok, sk, pk, ln = (F.col("l_orderkey"), F.col("l_suppkey"), F.col("l_partkey"),
                      F.col("l_linenumber"))
    s25 = (sk % 25).cast("string")
    exclusions = (F.when(ok % 5 == 0, F.lit("null"))
                   .when(ok % 5 == 1, F.lit(""))
                   .when(ok % 5 == 2, F.lit(None).cast("string"))
                   .when(ok % 5 == 3, s25)
                   .otherwise(F.concat(s25, F.lit(", "), ((sk + ln) % 25).cast("string"))))
    p25 = (pk % 25).cast("string")
    extras = (F.when(ln % 4 == 0, F.lit(" "))
               .when(ln % 4 == 1, F.lit("null"))
               .when(ln % 4 == 2, p25)
               .otherwise(F.concat(p25, F.lit(","), ((pk + 7) % 25).cast("string"))))
    # some lists name no topping, some lines have no pizza, some orders no time
    extras = F.when((ok + ln) % 43 == 0, F.concat(F.lit("abc, "), p25)).otherwise(extras)
    return j.select(
        ok.alias("order_id"), F.col("o_custkey").alias("customer_id"),
        F.when((ok + ln) % 31 != 0, pk).alias("pizza_id"),
        exclusions.alias("exclusions"), extras.alias("extras"),
        F.when(ok % 37 != 0, _order_time()).alias("order_time"))


def runner_orders(t: DriverTables) -> DataFrame:
    o = t.orders
    ok = F.col("o_orderkey")
    cancelled = F.col("o_orderstatus") == "P"
    tp = _floor_long("o_totalprice")
    pickup = F.timestamp_add("SECOND", 600 + tp % 1800, _order_time())
    d10 = tp % 250 + 10
    dist_text = F.concat(F.call_function("div", d10, F.lit(10)).cast("string"),
                         F.when(d10 % 10 == 0, F.lit(""))
                          .otherwise(F.concat(F.lit("."), (d10 % 10).cast("string"))))
    dist_unit = F.when(ok % 3 == 0, F.lit("km")).when(ok % 3 == 1, F.lit(" km")).otherwise(F.lit(""))
    # more decimals, no digit before the point, other units, a decimal comma
    whole = F.call_function("div", d10, F.lit(10)).cast("string")
    distance = (F.when(ok % 11 == 0, F.concat(whole, F.lit("."), F.lpad((tp % 1000).cast("string"), 3, "0"), F.lit("km")))
                 .when(ok % 13 == 0, F.lit(".5km"))
                 .when(ok % 17 == 0, F.concat(whole, F.lit(" miles")))
                 .when(ok % 19 == 0, F.concat(whole, F.lit(",5 km")))
                 .otherwise(F.concat(dist_text, dist_unit)))
    dur = tp % 31 + 10
    dur_unit = (F.when(ok % 4 == 0, F.lit(" minutes")).when(ok % 4 == 1, F.lit("mins"))
                 .when(ok % 4 == 2, F.lit(" minute")).otherwise(F.lit("")))
    dur_unit = F.when(ok % 23 == 0, F.lit(" hours")).otherwise(dur_unit)
    cancellation = F.when(cancelled, F.when(ok % 2 == 0, F.lit("Restaurant Cancellation"))
                                      .otherwise(F.lit("Customer Cancellation"))) \
                    .otherwise(F.when(ok % 3 == 0, F.lit("null"))
                                .when(ok % 3 == 1, F.lit(""))
                                .otherwise(F.lit(None).cast("string")))
    null_txt = F.lit("null")
    # some orders are delivered by two runners
    o = o.withColumn("__turn", F.explode(F.when(ok % 29 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return o.select(
        ok.alias("order_id"),
        ((F.substring("o_orderpriority", 1, 1).cast("int") + F.col("__turn") - 1) % 5 + 1).alias("runner_id"),
        # a cast keeps wall-clock text (date_format would go through the
        # session time zone); values have whole seconds: yyyy-MM-dd HH:mm:ss
        F.when(cancelled, null_txt).otherwise(pickup.cast("string")).alias("pickup_time"),
        F.when(cancelled, null_txt).otherwise(distance).alias("distance"),
        F.when(cancelled, null_txt).otherwise(
            F.concat(dur.cast("string"), dur_unit)).alias("duration"),
        cancellation.alias("cancellation"))


def runners(t: DriverTables) -> DataFrame:
    e = t.events
    return (e.filter(F.col("event_type") == "signup")
             .select(F.col("user_id").alias("runner_id"),
                     F.col("ts").cast("date").alias("registration_date")))


def pizza_names(t: DriverTables) -> DataFrame:
    return t.part.select(F.col("p_partkey").alias("pizza_id"), F.col("p_name").alias("pizza_name"))


def pizza_recipes(t: DriverTables) -> DataFrame:
    sz = F.col("p_size")
    items = [((sz + k) % 25).cast("string") for k in (0, 3, 11, 17)]
    return t.part.select(F.col("p_partkey").alias("pizza_id"),
                         F.concat_ws(", ", *items).alias("toppings"))


def pizza_toppings(t: DriverTables) -> DataFrame:
    return t.nation.select(F.col("n_nationkey").alias("topping_id"),
                           F.col("n_name").alias("topping_name"))


def ratings(t: DriverTables) -> DataFrame:
    # some orders are rated twice
    stars = (_floor_long("o_totalprice") % 5 + 1).cast("int")
    both = F.when(F.col("o_orderkey") % 41 == 0, F.array(stars, 6 - stars)).otherwise(F.array(stars))
    return t.orders.select(F.col("o_orderkey").alias("order_id"), F.explode(both).alias("rating"))


# --- subscriptions -----------------------------------------------------------

def plans(t: DriverTables) -> DataFrame:
    key = F.col("r_regionkey")
    return t.region.select(key.cast("int").alias("plan_id"), F.lower("r_name").alias("plan_name"),
                           F.when(key < 4, (key * F.lit("9.90").cast("decimal(5,2)")).cast("decimal(5,2)"))
                            .alias("price"))


def subscriptions(t: DriverTables) -> DataFrame:
    return t.orders.select(F.col("o_custkey").alias("customer_id"),
                           (F.col("o_orderkey") % 5).cast("int").alias("plan_id"),
                           F.col("o_orderdate").cast("date").alias("start_date"))


# --- bank --------------------------------------------------------------------

def regions(t: DriverTables) -> DataFrame:
    return t.region.select(F.col("r_regionkey").alias("region_id"),
                           F.col("r_name").alias("region_name"))


def customer_nodes(t: DriverTables) -> DataFrame:
    li = t.lineitem.select("l_orderkey", "l_suppkey", "l_shipdate", "l_linestatus")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    sr = _supplier_region(t)
    j = (li.join(o, li.l_orderkey == o.o_orderkey)
           .join(sr, F.col("l_suppkey") == sr.s_suppkey))
    od, sd = F.col("o_orderdate").cast("date"), F.col("l_shipdate").cast("date")
    return j.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("n_regionkey").alias("region_id"),
        F.col("l_suppkey").alias("node_id"),
        F.least(od, sd).alias("start_date"),
        F.when(F.col("l_linestatus") == "O", F.lit(OPEN_END).cast("date"))
         .otherwise(F.greatest(od, sd)).alias("end_date"))


def customer_transactions(t: DriverTables) -> DataFrame:
    st = F.col("o_orderstatus")
    return t.orders.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("txn_date"),
        F.when(st == "F", F.lit("deposit")).when(st == "O", F.lit("purchase"))
         .otherwise(F.lit("withdrawal")).alias("txn_type"),
        F.floor(F.col("o_totalprice") / 100).cast("int").alias("txn_amount"))


# --- retail mart -------------------------------------------------------------

def weekly_sales(t: DriverTables) -> DataFrame:
    li = t.lineitem.select("l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
                           "l_discount", "l_returnflag", "l_linestatus", "l_shipdate")
    sr = _supplier_region(t)
    j = li.join(sr, li.l_suppkey == sr.s_suppkey)
    digit = (F.col("l_linenumber") % 4 + 1).cast("string")
    rf = F.col("l_returnflag")
    segment = (F.when(rf == "A", F.concat(F.lit("C"), digit))
                .when(rf == "R", F.concat(F.lit("F"), digit)).otherwise(F.lit("null")))
    disc = F.col("l_discount")
    ctype = (F.when(disc < 0.035, F.lit("New")).when(disc < 0.07, F.lit("Existing"))
              .otherwise(F.lit("Guest")))
    return j.select(
        format_dmy("l_shipdate").alias("week_date"),
        F.col("r_name").alias("region"),
        F.when(F.col("l_linestatus") == "O", F.lit("Retail")).otherwise(F.lit("Shopify"))
         .alias("platform"),
        segment.alias("segment"),
        ctype.alias("customer_type"),
        F.floor("l_quantity").cast("int").alias("transactions"),
        F.floor("l_extendedprice").cast("int").alias("sales"))


@dataclass
class Domain:
    """All stand-in domain tables of one scale-factor folder.

    With ``persist=True`` (default) each table is derived once per
    application, written under the shared checkpoint folder and read back
    (the load step of the case studies); ``persist=False`` keeps every
    table a lazy plan over the driver tables.
    """

    spark: SparkSession
    root: str
    persist: bool = True
    _t: DriverTables = field(init=False)
    _stamp: str | None = field(init=False, default=None)

    def __post_init__(self):
        self._t = DriverTables(self.spark, self.root)

    def derived(self, name: str, build, partition_by=()) -> DataFrame:
        """A table derived from this folder's data, persisted like the others."""
        if not self.persist:
            return build()
        return built_once(self.spark, self._key(name), build, partition_by)

    def once(self, name: str, build) -> DataFrame:
        """What ``build`` has written itself, built once per application."""
        return kept_once(self.spark, self._key(name), build) if self.persist else build()

    def _key(self, name: str) -> str:
        if self._stamp is None:
            self._stamp = hashlib.md5(self._t.stamp().encode(), usedforsecurity=False).hexdigest()[:8]
        return f"{self.root}/{self._stamp}/{name}"

    def lazy(self, name: str) -> DataFrame:
        """The table as a plan over the driver tables, not persisted (for
        tables only read once, e.g. raw input of a persisted cleaning)."""
        return _BUILDERS[name](self._t)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in _BUILDERS:
            raise AttributeError(name)
        return self.derived(name, lambda: _BUILDERS[name](self._t))


_BUILDERS = {
    "sales": sales, "menu": menu, "members": members,
    "customer_orders": customer_orders, "runner_orders": runner_orders,
    "runners": runners, "pizza_names": pizza_names, "pizza_recipes": pizza_recipes,
    "pizza_toppings": pizza_toppings, "ratings": ratings,
    "plans": plans, "subscriptions": subscriptions,
    "regions": regions, "customer_nodes": customer_nodes,
    "customer_transactions": customer_transactions, "weekly_sales": weekly_sales,
}
