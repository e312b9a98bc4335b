"""Aggregate measures: conditional sums, shares, percentiles, before/after
comparisons (A8, A9, A15, W8-W11, X11)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseflow.functions.numeric import pct_change, percent_of
from caseflow.operators.ranges import (BEFORE, PART, TOTAL, UP_TO, before_ranges, in_ranges,
                                       running)


def count_when(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)``."""
    return F.sum(F.when(cond, 1).otherwise(0))


def sum_when(cond: Column, value: Column, otherwise: Column | int | None = None) -> Column:
    """``SUM(CASE WHEN cond THEN value [ELSE otherwise] END)``; without an
    ELSE the sum is NULL when no row qualifies."""
    e = F.when(cond, value)
    if otherwise is not None:
        e = e.otherwise(otherwise)
    return F.sum(e)


def share_within(df: DataFrame, fine: Sequence[str], coarse: Sequence[str], value: str,
                 total_col: str, pct_col: str) -> DataFrame:
    """Sum ``value`` at the ``fine`` grain and its percentage of the
    ``coarse`` total (``SUM() OVER (PARTITION BY fine) / SUM() OVER
    (PARTITION BY coarse)`` + DISTINCT, rewritten as aggregate-then-window:
    the window only sees the small aggregated frame)."""
    if not coarse:
        raise ValueError("coarse grain required; use share_of_total for the grand total")
    agg = df.groupBy(*fine).agg(F.sum(value).alias(total_col))
    denom = F.sum(total_col).over(Window.partitionBy(*coarse))
    return agg.withColumn(pct_col, percent_of(total_col, denom))


def share_of_total(df: DataFrame, fine: Sequence[str], value: str, total_col: str,
                   pct_col: str) -> DataFrame:
    """Sum at ``fine`` grain as a percentage of the grand total; the total
    is a scalar subquery (one value, evaluated once), not a join."""
    # parts and total read the same shuffle, so the input is scanned once
    agg = df.groupBy(*fine).agg(F.sum(value).alias(total_col))
    return agg.withColumn(pct_col, percent_of(total_col, agg.agg(F.sum(total_col)).scalar()))


def percentiles_disc(df: DataFrame, keys: Sequence[str], value: str,
                     named: Mapping[str, float]) -> DataFrame:
    """Exact ``PERCENTILE_DISC(p) WITHIN GROUP (ORDER BY value)`` per group, in
    the value's type: the first value up to which at least the share p of the
    group's non-null values lie.

    (group, value) counts are dealt into ranges; a range's total and the totals
    before it say which one holds a percentile, and only that range of the
    group is summed up value by value.  So a group may have any number of
    distinct values: no task holds them all, and none are sorted in one."""
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("__n"))
    counts = counts.withColumn("__w", F.when(F.col(value).isNotNull(), F.col("__n")).otherwise(0))
    ranged = in_ranges(counts, keys, value)
    parts = before_ranges(ranged, keys, "__w")
    asked = F.explode(F.array(*[
        F.struct(F.lit(name).alias("name"), F.lit(repr(float(p))).cast("decimal(18,12)").alias("p"))
        for name, p in named.items()])).alias("__a")
    want = F.greatest(F.ceil(F.col("__a.p") * F.col(TOTAL)), F.lit(1))
    slots = parts.select(*keys, PART, BEFORE, TOTAL, F.col("__n").alias("__in"), asked).withColumn(
        "__want", F.when(F.col(TOTAL) > 0, want))
    inside = (F.col("__want") > F.col(BEFORE)) & (F.col("__want") <= F.col(BEFORE) + F.col("__in"))
    slots = slots.filter(inside).select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
                                        F.col(PART).alias("__p"), F.col("__a.name").alias("__name"),
                                        (F.col("__want") - F.col(BEFORE)).alias("__at"))
    same = F.col(PART) == F.col("__p")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    up = running(ranged.filter(F.col(value).isNotNull()), keys, value, "__w")
    hit = up.join(slots, same).filter(
        (F.col(UP_TO) >= F.col("__at")) & (F.col(UP_TO) - F.col("__w") < F.col("__at")))
    found = hit.groupBy(*keys).agg(*[
        F.max(F.when(F.col("__name") == name, F.struct(F.col(value).alias("v")))).alias(name) for name in named])
    # a group without values has NULL
    groups = parts.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).distinct() if keys else None
    if groups is None:
        return found.select(*[F.col(f"{name}.v").alias(name) for name in named])
    match = F.lit(True)
    for i, k in enumerate(keys):
        match = match & F.col(f"__k{i}").eqNullSafe(F.col(k))
    return groups.join(found, match, "left").select(
        *[F.col(f"__k{i}").alias(k) for i, k in enumerate(keys)],
        *[F.col(f"{name}.v").alias(name) for name in named])


def before_after(df: DataFrame, week_col: str, value_col: str, baseline_week: Column | int,
                 span: int, group_by: Sequence[str] = (), names: Sequence[str] | None = None,
                 prefilter: bool = True) -> DataFrame:
    """Sums of ``value`` over the ``span`` weeks before the baseline week and
    the ``span`` weeks from it on, in one pass (one shuffle at most).

    ``names`` = (before, after); with ``prefilter`` the week window is also
    applied as a row filter, which Spark pushes into the scan.
    """
    b = F.lit(baseline_week) if isinstance(baseline_week, int) else baseline_week
    w = F.col(week_col)
    before_name, after_name = names or ("before_change", "after_change")
    if prefilter:
        df = df.filter(w.between(b - span, b + span - 1))
    aggs = [sum_when(w.between(b - span, b - 1), F.col(value_col)).alias(before_name),
            sum_when(w.between(b, b + span - 1), F.col(value_col)).alias(after_name)]
    return df.groupBy(*group_by).agg(*aggs)


def with_change(df: DataFrame, before: str, after: str, change: str, rate: str,
                digits: int | None = None) -> DataFrame:
    """Add absolute change and percent rate (optionally rounded)."""
    r = pct_change(after, before)
    if digits is not None:
        r = F.round(r, digits)
    return df.withColumn(change, F.col(after) - F.col(before)).withColumn(rate, r)
