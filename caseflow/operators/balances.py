"""Account balances: signed period sums, running balance, first/last balance
and growth share (W6, W7, T4, T5)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseflow.functions.numeric import int_div

# Sign of each transaction type in a balance.
TXN_SIGNS = {"deposit": 1, "purchase": -1, "withdrawal": -1}


def signed_period_sums(df: DataFrame, key: str, period: Column, type_col: str,
                       amount_col: str, signs: Mapping[str, int] = TXN_SIGNS,
                       period_name: str = "month", out: str = "total") -> DataFrame:
    """Net signed amount per (key, period): one aggregation, combined map-side."""
    t, a = F.col(type_col), F.col(amount_col)
    signed = None
    for name, sign in signs.items():
        term = F.when(t == name, a * sign).otherwise(0)
        signed = term if signed is None else signed + term
    return (df.groupBy(F.col(key), period.alias(period_name))
              .agg(F.sum(signed).alias(out)))


def running_balance(df: DataFrame, key: str, period: str, change: str,
                    out: str = "balance") -> DataFrame:
    """Cumulative sum of ``change`` per key in period order
    (``ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW``).  Input is
    already one row per (key, period), so partitions are small."""
    w = Window.partitionBy(key).orderBy(period).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    return df.withColumn(out, F.sum(change).over(w))


def first_last(df: DataFrame, key: str, order: str, value: str,
               first: str = "start_balance", last: str = "end_balance") -> DataFrame:
    """First and last ``value`` per key by ``order`` (deterministic form of
    FIRST_VALUE/LAST_VALUE), as a plain aggregation."""
    return df.groupBy(key).agg(F.min_by(value, order).alias(first),
                               F.max_by(value, order).alias(last))


def growth_rate_int(start: str, end: str) -> Column:
    """``(end - start) * 100 / start`` with integer truncation; NULL when start is 0."""
    return int_div((F.col(end) - F.col(start)) * 100, F.col(start))


def share_of_keys(df: DataFrame, key: str, selected: Column, out: str) -> DataFrame:
    """``COUNT(selected keys) * 100.0 / COUNT(keys)`` of a frame with one row
    per key, in one pass."""
    picked = F.count(F.when(selected, F.col(key)))
    return df.agg(F.try_divide(picked.cast("double") * 100, F.count(key)).alias(out))
