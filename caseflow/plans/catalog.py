"""Named queries over the driver tables: each entry is
``(spark, sf_dir) -> DataFrame`` running one job of the case studies on the
stand-in domain tables of ``sf_dir`` (whole tables, no sampling)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.plans import bank, delivery, mart, restaurant
from caseflow.sources import dump_files
from caseflow.sources import standins as si
from caseflow.sources.writers import write_ordered

Query = Callable[[SparkSession, str], DataFrame]


def _dom(spark: SparkSession, root: str) -> si.Domain:
    return si.Domain(spark, root)


def _tagged_orders(d: si.Domain) -> DataFrame:
    """Cleaned order lines and what cleaning rejects, from one pass (kept, like
    the source's in-place cleaning)."""
    return d.derived("clean_orders", lambda: delivery.tagged_orders(d.lazy("customer_orders")))


def _tagged_deliveries(d: si.Domain) -> DataFrame:
    return d.derived("clean_deliveries", lambda: delivery.tagged_deliveries(d.lazy("runner_orders")))


def _co(d: si.Domain) -> DataFrame:
    return _tagged_orders(d).drop("rejects")


def _ro(d: si.Domain) -> DataFrame:
    return _tagged_deliveries(d).drop("rejects")


def _cws(d: si.Domain) -> DataFrame:
    """``clean_weekly_sales`` (CTAS in the source), partitioned by year."""
    return d.derived("clean_weekly", lambda: mart.clean_weekly(d.lazy("weekly_sales")),
                     partition_by=["calendar_year"])


def _q(fn: Callable[[si.Domain], DataFrame]) -> Query:
    def run(spark: SparkSession, root: str) -> DataFrame:
        return fn(_dom(spark, root))
    run.__doc__ = fn.__doc__
    return run


def _load(case: str, table: str) -> Query:
    return lambda spark, root: dump_files.load_table(spark, root, case, table)


QUERIES: dict[str, Query] = {
    # restaurant
    "spend_by_customer": _q(lambda d: restaurant.spend_by_customer(d.sales, d.menu)),
    "visit_days": _q(lambda d: restaurant.visit_days(d.sales)),
    "first_items": _q(lambda d: restaurant.first_items(d.sales, d.menu)),
    "most_bought_by_rank": _q(lambda d: restaurant.most_bought_by_rank(d.sales, d.menu)),
    "most_bought_at_rank": _q(lambda d: restaurant.most_bought_by_rank(d.sales, d.menu, rank=3)),
    "most_bought_top1": _q(lambda d: restaurant.most_bought_top1(d.sales, d.menu)),
    "favourite_item": _q(lambda d: restaurant.favourite_item(d.sales, d.menu)),
    "first_after_join": _q(lambda d: restaurant.first_after_join(d.sales, d.menu, d.members)),
    "last_before_join": _q(lambda d: restaurant.last_before_join(d.sales, d.menu, d.members)),
    "pre_join_totals": _q(lambda d: restaurant.pre_join_totals(d.sales, d.menu, d.members)),
    "loyalty_points": _q(lambda d: restaurant.loyalty_points(
        d.sales, d.menu, bonus_name=si.BONUS_PRODUCT_NAME)),
    "first_week_bonus_points": _q(lambda d: restaurant.first_week_bonus_points(
        d.sales, d.menu, d.members, points_month=si.POINTS_MONTH,
        bonus_product_id=si.BONUS_PRODUCT_ID)),
    "member_flag_ranking": _q(lambda d: restaurant.member_flag_ranking(
        d.sales, d.menu, d.members)),
    # pizza delivery: cleaning
    "clean_orders": _q(_co),
    "clean_deliveries": _q(_ro),
    "order_rejects": _q(lambda d: delivery.rejected(_tagged_orders(d), "order_id", "pizza_id")),
    "delivery_rejects": _q(lambda d: delivery.rejected(_tagged_deliveries(d), "order_id", "runner_id")),
    # order metrics
    "count_items": _q(lambda d: delivery.count_items(_co(d))),
    "count_orders": _q(lambda d: delivery.count_orders(_co(d))),
    "delivered_by_runner": _q(lambda d: delivery.delivered_by_runner(_co(d), _ro(d))),
    "delivered_by_type": _q(lambda d: delivery.delivered_by_type(_co(d), _ro(d), d.pizza_names)),
    "type_by_customer": _q(lambda d: delivery.type_by_customer(_co(d), _ro(d), d.pizza_names)),
    "largest_order": _q(lambda d: delivery.largest_order(_co(d))),
    "variety_behaviour": _q(lambda d: delivery.variety_behaviour(_co(d), d.pizza_names)),
    "both_changes": _q(lambda d: delivery.both_changes(_co(d), _ro(d))),
    "volume_by_hour": _q(lambda d: delivery.volume_by_hour(_co(d))),
    "volume_by_weekday": _q(lambda d: delivery.volume_by_weekday(_co(d))),
    # runner metrics
    "signups_by_week": _q(lambda d: delivery.signups_by_week(d.runners)),
    "avg_pickup_minutes": _q(lambda d: delivery.avg_pickup_minutes(_co(d), _ro(d))),
    "prep_time_by_size": _q(lambda d: delivery.prep_time_by_size(_co(d), _ro(d))),
    "avg_distance_by_customer": _q(lambda d: delivery.avg_distance_by_customer(_co(d), _ro(d))),
    "duration_range": _q(lambda d: delivery.duration_range(_ro(d))),
    "speed_by_delivery": _q(lambda d: delivery.speed_by_delivery(_ro(d))),
    "success_rate": _q(lambda d: delivery.success_rate(_ro(d))),
    # ingredients
    "recipe_ingredients": _q(lambda d: delivery.recipe_ingredients(
        d.pizza_recipes, d.pizza_toppings)),
    "top_extra": _q(lambda d: delivery.top_extra(_co(d), d.pizza_toppings)),
    "top_exclusion": _q(lambda d: delivery.top_exclusion(_co(d), d.pizza_toppings)),
    "order_description": _q(lambda d: delivery.order_description(
        _co(d), d.pizza_toppings, d.pizza_names, relabel=si.PIZZA_RELABEL)),
    "ingredient_counts": _q(lambda d: delivery.ingredient_counts(
        _co(d), d.pizza_recipes, d.pizza_toppings, d.pizza_names)),
    # money
    "fixed_price_revenue": _q(lambda d: delivery.fixed_price_revenue(
        _co(d), _ro(d), d.pizza_names, premium=si.PREMIUM_PIZZA)),
    "revenue_with_extras": _q(lambda d: delivery.revenue_with_extras(
        _co(d), _ro(d), d.pizza_names, premium=si.PREMIUM_PIZZA)),
    "ratings_table": _q(lambda d: delivery.ratings_table(d.ratings)),
    "delivery_report": _q(lambda d: delivery.delivery_report(_co(d), _ro(d), d.ratings)),
    "profit": _q(lambda d: delivery.profit(_co(d), _ro(d), d.pizza_names,
                                           premium=si.PREMIUM_PIZZA)),
    # bank: nodes
    "unique_nodes": _q(lambda d: bank.unique_nodes(d.customer_nodes)),
    "nodes_by_region": _q(lambda d: bank.nodes_by_region(d.customer_nodes, d.regions)),
    "customers_by_region": _q(lambda d: bank.customers_by_region(d.customer_nodes, d.regions)),
    "avg_allocation_days": _q(lambda d: bank.avg_allocation_days(d.customer_nodes)),
    "allocation_percentiles": _q(lambda d: bank.allocation_percentiles(d.customer_nodes)),
    # bank: transactions
    "txn_type_totals": _q(lambda d: bank.txn_type_totals(d.customer_transactions)),
    "avg_deposit_profile": _q(lambda d: bank.avg_deposit_profile(d.customer_transactions)),
    "txn_years": _q(lambda d: bank.txn_years(d.customer_transactions)),
    "active_mix_by_month": _q(lambda d: bank.active_mix_by_month(d.customer_transactions)),
    "closing_balance": _q(lambda d: bank.closing_balance(d.customer_transactions)),
    "balance_growth_share": _q(lambda d: bank.balance_growth_share(d.customer_transactions)),
    # retail mart
    "clean_weekly": _q(_cws),
    "weekday_used": _q(lambda d: mart.weekday_used(_cws(d))),
    "missing_weeks": _q(lambda d: mart.missing_weeks(_cws(d))),
    "txns_by_year": _q(lambda d: mart.txns_by_year(_cws(d))),
    "sales_by_region_month": _q(lambda d: mart.sales_by_region_month(_cws(d))),
    "txn_rows_by_platform": _q(lambda d: mart.txn_rows_by_platform(_cws(d))),
    "monthly_platform_share": _q(lambda d: mart.monthly_platform_share(_cws(d))),
    "demographic_share_by_year": _q(lambda d: mart.demographic_share_by_year(_cws(d))),
    "segment_contribution": _q(lambda d: mart.segment_contribution(_cws(d))),
    "avg_txn_size": _q(lambda d: mart.avg_txn_size(_cws(d))),
    "baseline_week": _q(lambda d: mart.baseline_week(_cws(d), si.BASELINE_DATE)),
    "before_after_4w": _q(lambda d: mart.before_after_total(_cws(d), si.BASELINE_DATE, 4)),
    "before_after_12w": _q(lambda d: mart.before_after_total(_cws(d), si.BASELINE_DATE, 12)),
    "before_after_4w_by_year": _q(lambda d: mart.before_after_by_year(
        _cws(d), si.BASELINE_DATE, 4)),
    "before_after_12w_by_year": _q(lambda d: mart.before_after_by_year(
        _cws(d), si.BASELINE_DATE, 12)),
    # loading: dump files of each case study, parsed once for all its tables
    **{f"dump_load_{job}": _load(case, table) for job, case, table in [
        ("sales", "restaurant", "sales"), ("menu", "restaurant", "menu"), ("members", "restaurant", "members"),
        ("runners", "pizza", "runners"), ("orders", "pizza", "customer_orders"),
        ("deliveries", "pizza", "runner_orders"), ("pizza_names", "pizza", "pizza_names"),
        ("pizza_recipes", "pizza", "pizza_recipes"), ("pizza_toppings", "pizza", "pizza_toppings"),
        ("plans", "subscriptions", "plans"), ("subscriptions", "subscriptions", "subscriptions"),
        ("regions", "bank", "regions"), ("nodes", "bank", "customer_nodes"),
        ("transactions", "bank", "customer_transactions")]},
    "dump_quarantine": lambda spark, root: dump_files.load_quarantine(spark, root, "bank"),
}

# the order in which the source lists a job's rows; a minus sign: descending
ORDERS: dict[str, list[str]] = {
    "type_by_customer": ["customer_id"],
    "speed_by_delivery": ["runner_id", "order_id"],
    "ingredient_counts": ["order_id", "pizza_id", "topping_id"],
    "delivery_report": ["customer_id"],
    "nodes_by_region": ["region_id"],
    "customers_by_region": ["region_id"],
    "sales_by_region_month": ["region", "month_number"],
    "monthly_platform_share": ["platform", "calendar_year", "month_number"],
    "demographic_share_by_year": ["demographic", "calendar_year"],
    "segment_contribution": ["-percent_sale"],
    "avg_txn_size": ["platform", "calendar_year"],
    "before_after_4w_by_year": ["calendar_year"],
    "before_after_12w_by_year": ["calendar_year"],
}


def _order(name: str) -> list[Column]:
    return [F.desc(c[1:]) if c.startswith("-") else F.asc(c) for c in ORDERS[name]]


def in_order(name: str) -> Query:
    """A job with its rows in the source's order (range-partitioned sort)."""
    return lambda spark, root: QUERIES[name](spark, root).orderBy(*_order(name))


def write_in_order(spark: SparkSession, root: str, name: str, path: str) -> None:
    """A job's rows as files that follow each other in the source's order."""
    write_ordered(QUERIES[name](spark, root), path, _order(name))
