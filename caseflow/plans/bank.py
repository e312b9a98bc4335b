"""Bank jobs: node allocations (B1-B5) and transactions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.functions.dates import days_between
from caseflow.functions.numeric import int_avg
from caseflow.operators import balances as bl
from caseflow.operators.joins import bounded_broadcast
from caseflow.operators.measures import count_when, percentiles_disc

# Open-ended allocation sentinel and the percentiles reported.
OPEN_END = "9999-12-31"
ALLOCATION_PERCENTILES = {"median": 0.5, "p80": 0.8, "p95": 0.95}


def _closed(nodes: DataFrame, open_end: str) -> DataFrame:
    return nodes.filter(F.col("end_date") != F.lit(open_end).cast("date"))


def unique_nodes(nodes: DataFrame) -> DataFrame:
    """B1: distinct node ids."""
    return nodes.agg(F.countDistinct("node_id").alias("unique_nodes"))


def nodes_by_region(nodes: DataFrame, regions: DataFrame) -> DataFrame:
    """B2: allocation rows (not distinct nodes) per region."""
    c = nodes.groupBy("region_id").agg(F.count("node_id").alias("total_nodes"))
    return c.join(bounded_broadcast(regions.select("region_id", "region_name")), "region_id") \
            .select("region_id", "region_name", "total_nodes")


def customers_by_region(nodes: DataFrame, regions: DataFrame) -> DataFrame:
    """Distinct customers per region."""
    c = nodes.groupBy("region_id").agg(F.countDistinct("customer_id").alias("total_customers"))
    return c.join(bounded_broadcast(regions.select("region_id", "region_name")), "region_id") \
            .select("region_id", "region_name", "total_customers")


def avg_allocation_days(nodes: DataFrame, open_end: str = OPEN_END,
                        integer_math: bool = True) -> DataFrame:
    """Mean allocation length over closed allocations (an integer mean
    as in the source; ``integer_math=False`` gives the exact double)."""
    d = _closed(nodes, open_end).select(days_between("start_date", "end_date").alias("days"))
    avg = int_avg("days") if integer_math else F.avg("days")
    return d.agg(avg.alias("avg_days"))


def allocation_percentiles(nodes: DataFrame, open_end: str = OPEN_END,
                           named: Mapping[str, float] = ALLOCATION_PERCENTILES) -> DataFrame:
    """Exact discrete percentiles of allocation length per region."""
    d = _closed(nodes, open_end).select(
        "region_id", days_between("start_date", "end_date").alias("allocation_days"))
    return percentiles_disc(d, ["region_id"], "allocation_days", named)


def txn_type_totals(txns: DataFrame) -> DataFrame:
    """Count and amount per transaction type."""
    return txns.groupBy("txn_type").agg(F.count(F.lit(1)).alias("total_transaction"),
                                        F.sum("txn_amount").alias("total_amount"))


def avg_deposit_profile(txns: DataFrame, integer_math: bool = True) -> DataFrame:
    """Mean deposit count and mean deposit amount per customer (integer
    means at both levels, as in the source; ``integer_math=False`` keeps
    fractions)."""
    mean = int_avg if integer_math else F.avg
    per = (txns.filter(F.col("txn_type") == "deposit").groupBy("customer_id")
               .agg(F.count("customer_id").alias("time_deposit"),
                    mean("txn_amount").alias("amount_deposit")))
    return per.agg(mean("time_deposit").alias("avg_count"),
                   mean("amount_deposit").alias("avg_amount"))


def txn_years(txns: DataFrame) -> DataFrame:
    """Distinct transaction years."""
    return txns.select(F.year("txn_date").alias("year")).distinct()


def active_mix_by_month(txns: DataFrame, min_deposits: int = 1) -> DataFrame:
    """Customers per calendar month (years pooled) with more than
    ``min_deposits`` deposits and exactly one purchase or one withdrawal."""
    t = F.col("txn_type")
    per = txns.groupBy("customer_id", F.month("txn_date").alias("month")).agg(
        count_when(t == "deposit").alias("deposit_time"),
        count_when(t == "purchase").alias("purchase_time"),
        count_when(t == "withdrawal").alias("withdrawal_time"))
    sel = per.filter((F.col("deposit_time") > min_deposits) &
                     ((F.col("purchase_time") == 1) | (F.col("withdrawal_time") == 1)))
    return sel.groupBy("month").agg(F.count(F.lit(1)).alias("customer_count"))


def closing_balance(txns: DataFrame) -> DataFrame:
    """T4: month-end balance and monthly change per customer (calendar month,
    years pooled; months without activity are absent)."""
    net = bl.signed_period_sums(txns, "customer_id", F.month("txn_date"), "txn_type",
                                "txn_amount", period_name="month", out="change_in_balance")
    return bl.running_balance(net, "customer_id", "month", "change_in_balance") \
             .select("customer_id", "month", "balance", "change_in_balance")


def balance_growth_share(txns: DataFrame, min_growth_pct: int = 5) -> DataFrame:
    """T5: percent of customers whose last balance exceeds the first and grew
    by at least ``min_growth_pct`` percent (integer rate; customers with a
    zero first balance have no rate and are not counted)."""
    fl = bl.first_last(closing_balance(txns), "customer_id", "month", "balance")
    rate = bl.growth_rate_int("start_balance", "end_balance")
    grown = (rate >= min_growth_pct) & (F.col("end_balance") > F.col("start_balance"))
    # every customer with a transaction has a balance, so these rows are the population
    return bl.share_of_keys(fl, "customer_id", grown, "percent_customer")
