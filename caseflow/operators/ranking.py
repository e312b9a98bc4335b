"""Ranking operators.

Rank filters are written as window + filter so Catalyst inserts a partial
``WindowGroupLimit`` before the shuffle; global "first" rows compare with a
scalar subquery (a map-side-combined min/max) instead of an un-partitioned
window, which would pull every row into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseflow.operators.ranges import dense_ranks


def rows_at_global_min(df: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` equals the global minimum
    (``DENSE_RANK() OVER (ORDER BY col) = 1`` without a single-partition window).
    Give it an aggregated frame: rows and minimum then read the same shuffle,
    and the input is scanned once."""
    return df.filter(F.col(col) == df.agg(F.min(col)).scalar())


def rows_at_max(df: DataFrame, col: str) -> DataFrame:
    """Rows whose ``col`` equals its global maximum (top dense rank); of an
    aggregated frame, as for :func:`rows_at_global_min`."""
    return df.filter(F.col(col) == df.agg(F.max(col)).scalar())


def rows_at_dense_rank(df: DataFrame, col: str, rank: int, descending: bool = False) -> DataFrame:
    """Rows whose ``col`` has dense rank ``rank`` over the whole frame."""
    ranks = dense_ranks(df, col, descending, "__rank").filter(F.col("__rank") == rank)
    return df.join(ranks.select(col), col).select(*df.columns)


def top_per_group(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column],
                  n: int = 1, method: str = "rank") -> DataFrame:
    """Rows ranked ``<= n`` within each partition; ties kept (rank/dense_rank)
    or cut (row_number, which then needs a total order)."""
    fn = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}[method]
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn("__rk", fn().over(w)).filter(F.col("__rk") <= n).drop("__rk")


def top_n(df: DataFrame, order_by: Sequence[Column], n: int = 1) -> DataFrame:
    """``SELECT TOP n ... ORDER BY``; pass a tie-break key last so the result
    is deterministic (planned as ``TakeOrderedAndProject``)."""
    return df.orderBy(*order_by).limit(n)


def gated_rank(df: DataFrame, partition_by: Sequence[str], order_col: str,
               gate: Column, out_col: str = "ranking", weight: str | None = None) -> DataFrame:
    """``CASE WHEN NOT gate THEN NULL ELSE RANK() OVER (PARTITION BY p ORDER BY o) END``.

    ``RANK`` of a row equals 1 + the number of rows of its partition with a
    smaller ``order_col``.  That is computed on the histogram of distinct
    (partition, order value) pairs and joined back, so a partition holding a
    third of all rows is never sorted in one task: only its distinct order
    values are.  With ``weight`` a row of ``df`` stands for that many rows.
    """
    keys = list(partition_by) + [order_col]
    n = F.count(F.lit(1)) if weight is None else F.sum(weight)
    hist = df.filter(gate).groupBy(*keys).agg(n.alias("__n"))
    w = Window.partitionBy(*partition_by).orderBy(order_col).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ranks = hist.withColumn("__rank", (F.sum("__n").over(w) - F.col("__n") + 1).cast("int")) \
                .drop("__n").withColumn("__g", F.lit(True))
    out = df.withColumn("__g", gate).join(ranks, keys + ["__g"], "left")
    return out.withColumn(out_col, F.when(F.col("__g"), F.col("__rank"))).drop("__g", "__rank")
