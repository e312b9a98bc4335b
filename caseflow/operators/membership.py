"""Membership-relative selections and tiered point rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_membership(facts: DataFrame, members: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """Attach each member's join date to its fact rows (equi-join on ``key``)."""
    return facts.join(members, key, how)


def relative_to_join(df: DataFrame, date_col: str, join_col: str, side: str) -> DataFrame:
    """Rows before (``'before'``: date < join) or on/after (``'after'``) joining."""
    if side == "before":
        return df.filter(F.col(date_col) < F.col(join_col))
    if side == "after":
        return df.filter(F.col(date_col) >= F.col(join_col))
    raise ValueError(side)


def member_flag(date_col: str, join_col: str) -> Column:
    """'Y' on/after the join date, else 'N' (also for non-members)."""
    return F.when(F.col(date_col) >= F.col(join_col), F.lit("Y")).otherwise(F.lit("N"))


def tiered_points(value: Column, rules: Sequence[tuple[Column, int]], default: int) -> Column:
    """First matching rule's multiplier times ``value`` (``CASE WHEN`` chain)."""
    out = None
    for cond, mult in rules:
        out = F.when(cond, value * mult) if out is None else out.when(cond, value * mult)
    return value * default if out is None else out.otherwise(value * default)
