"""Restaurant jobs (R1-R11): spend, visits, first/favourite items, member
windows and loyalty points over ``sales``, ``menu`` and ``members``.

Fact rows are pre-aggregated to (customer, product[, date]) counts before
they meet the menu, so the join shuffles distinct combinations rather than
every sale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.functions.dates import month_end
from caseflow.operators import membership as mb
from caseflow.operators import ranking as rk


def _counts(sales: DataFrame, *keys: str) -> DataFrame:
    return sales.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def spend_by_customer(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Total amount each customer spent."""
    c = _counts(sales, "customer_id", "product_id")
    return (c.join(menu.select("product_id", "price"), "product_id")
             .groupBy("customer_id").agg(F.sum(F.col("n") * F.col("price")).alias("total_spent")))


def visit_days(sales: DataFrame) -> DataFrame:
    """R2: number of distinct days each customer visited."""
    return sales.groupBy("customer_id").agg(F.countDistinct("order_date").alias("total_days"))


def first_items(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Items bought on the earliest order date of all sales (the rank is
    global, not per customer), one row per (customer, item)."""
    per = sales.groupBy("customer_id", "product_id").agg(F.min("order_date").alias("first_date"))
    per = per.join(menu.select("product_id", "product_name"), "product_id")
    first = rk.rows_at_global_min(per, "first_date")
    return first.select("customer_id", "product_name").distinct()


def _item_counts(sales: DataFrame, menu: DataFrame) -> DataFrame:
    c = _counts(sales, "product_id")
    return (c.join(menu.select("product_id", "product_name"), "product_id")
             .groupBy("product_name").agg(F.sum("n").alias("number_order")))


def most_bought_by_rank(sales: DataFrame, menu: DataFrame, rank: int | None = None) -> DataFrame:
    """item(s) at an ascending dense rank of purchase count.  ``rank=None``
    takes the top rank (the most purchased, ties kept)."""
    counts = _item_counts(sales, menu)
    if rank is None:
        return rk.rows_at_max(counts, "number_order")
    return rk.rows_at_dense_rank(counts, "number_order", rank)


def most_bought_top1(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """The single most purchased product (ties cut by product id)."""
    c = (_counts(sales, "product_id")
         .join(menu.select("product_id", "product_name"), "product_id"))
    top = rk.top_n(c, [F.col("n").desc(), F.col("product_id").asc()], 1)
    return top.select(F.col("n").alias("most_purchased"), "product_name")


def favourite_item(sales: DataFrame, menu: DataFrame) -> DataFrame:
    """Each customer's most bought item(s), ties kept."""
    c = (_counts(sales, "customer_id", "product_id")
         .join(menu.select("product_id", "product_name"), "product_id")
         .groupBy("customer_id", "product_name").agg(F.sum("n").alias("number_order")))
    return rk.top_per_group(c, ["customer_id"], [F.col("number_order").desc()], 1, "rank")


def _member_sales(sales: DataFrame, members: DataFrame, side: str) -> DataFrame:
    j = mb.with_membership(sales, members.select("customer_id", "join_date"), "customer_id")
    return mb.relative_to_join(j, "order_date", "join_date", side)


def _nearest_items(sales: DataFrame, menu: DataFrame, members: DataFrame, side: str) -> DataFrame:
    """Lines of each member's sales day nearest to joining, on one side of it.

    Counts by (customer, date, product) meet the members; the nearest day comes
    from one aggregation of them, and the menu is joined to that day alone.
    Only products of the menu make a day count, as in the source's joins."""
    c = _counts(sales, "customer_id", "order_date", "product_id")
    c = c.join(menu.select("product_id"), "product_id", "left_semi")
    s = _member_sales(c, members, side)
    order = F.col("order_date").asc() if side == "after" else F.col("order_date").desc()
    day = rk.top_per_group(s, ["customer_id"], [order], 1, "dense_rank")
    j = day.join(menu.select("product_id", "product_name"), "product_id")
    # one row per sale of that day again
    return j.select("customer_id", "product_name", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("i")) \
            .drop("i")


def first_after_join(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """item(s) of each member's first order on or after joining (one row
    per sale of that day)."""
    return _nearest_items(sales, menu, members, "after")


def last_before_join(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """item(s) of each member's last order before joining."""
    return _nearest_items(sales, menu, members, "before")


def pre_join_totals(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """Items and amount per member before joining (sales are reduced to
    (customer, date, product) counts before they meet the member table)."""
    c = _counts(sales, "customer_id", "order_date", "product_id")
    s = _member_sales(c, members, "before")
    j = s.join(menu.select("product_id", "product_name", "price"), "product_id")
    return j.groupBy("customer_id").agg(
        F.sum(F.when(F.col("product_name").isNotNull(), F.col("n")).otherwise(0))
         .alias("total_item"),
        F.sum(F.col("n") * F.col("price")).alias("total_amount_spent"))


def loyalty_points(sales: DataFrame, menu: DataFrame, bonus_name: str = "sushi",
                   per_unit: int = 10, bonus_mult: int = 2) -> DataFrame:
    """Points per customer: ``per_unit`` per currency unit, times
    ``bonus_mult`` for the bonus item."""
    pts = menu.select("product_id", mb.tiered_points(
        F.col("price"), [(F.col("product_name") == bonus_name, per_unit * bonus_mult)],
        per_unit).alias("point"))
    c = _counts(sales, "customer_id", "product_id")
    return c.join(pts, "product_id").groupBy("customer_id") \
            .agg(F.sum(F.col("n") * F.col("point")).alias("total_point"))


def first_week_bonus_points(sales: DataFrame, menu: DataFrame, members: DataFrame,
                            points_month: str = "2021-01-01", bonus_product_id: int = 1,
                            per_unit: int = 10, bonus_mult: int = 2,
                            bonus_days: int = 7) -> DataFrame:
    """Member points up to the end of ``points_month``; double points
    for the bonus product and for everything in the first ``bonus_days``
    days from joining (join day included)."""
    last_date = month_end(F.lit(points_month).cast("date"))
    m = members.select("customer_id", "join_date",
                       F.date_add("join_date", bonus_days - 1).alias("valid_date"))
    c = (_counts(sales.filter(F.col("order_date") <= last_date),
                 "customer_id", "order_date", "product_id")
         .join(m, "customer_id")
         .join(menu.select("product_id", "price"), "product_id"))
    pts = mb.tiered_points(F.col("price"), [
        (F.col("product_id") == bonus_product_id, per_unit * bonus_mult),
        (F.col("order_date").between(F.col("join_date"), F.col("valid_date")),
         per_unit * bonus_mult)], per_unit)
    return c.groupBy("customer_id").agg(F.sum(F.col("n") * pts).alias("total_points"))


def member_flag_ranking(sales: DataFrame, menu: DataFrame, members: DataFrame) -> DataFrame:
    """Every sale with member flag and, for member rows, the rank of
    its date among the customer's member-period sales.

    Sales are counted once by (customer, date, product).  The counts meet the
    menu and the members; ranks come from them by customer and date, and each
    count gives its rows again at the end, so a busy customer is at most one
    row a day in the sort and no line travels twice."""
    c = (_counts(sales, "customer_id", "order_date", "product_id")
         .join(menu.select("product_id", "product_name", "price"), "product_id"))
    j = (c.join(members.select("customer_id", "join_date"), "customer_id", "left")
         .withColumn("member", mb.member_flag("order_date", "join_date")))
    ranked = rk.gated_rank(j, ["customer_id"], "order_date", F.col("member") == "Y", weight="n")
    return ranked.select("customer_id", "order_date", "product_name", "price", "member", "ranking",
                         F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("i")).drop("i")
