"""Numeric helpers for T-SQL integer semantics and period comparisons
(A5, X8, X11)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def int_div(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Integer division truncating toward zero (``int / int`` in T-SQL);
    NULL instead of an error when ``b`` is 0."""
    a, b = _c(a), _c(b)
    return F.when(b != 0, F.call_function("div", a, b))


def int_avg(c: ColumnOrName) -> Column:
    """``AVG`` over an integer column: the truncated integer mean."""
    c = _c(c)
    return int_div(F.sum(c), F.count(c))


def ratio(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``CAST(a AS FLOAT) / b`` with NULL for a zero denominator."""
    return F.try_divide(_c(a).cast("double"), _c(b))


def percent_of(part: ColumnOrName, whole: ColumnOrName) -> Column:
    """``100 * CAST(part AS FLOAT) / whole``."""
    return F.try_divide(F.lit(100) * _c(part).cast("double"), _c(whole))


def pct_change(after: ColumnOrName, before: ColumnOrName) -> Column:
    """``100 * (CAST(after AS FLOAT) - before) / before``; NULL when
    ``before`` is 0 or NULL."""
    after, before = _c(after), _c(before)
    return F.try_divide(F.lit(100) * (after.cast("double") - before), before)


def round_half_up(c: ColumnOrName, digits: int = 2) -> Column:
    """Round to ``digits`` decimals, halves away from zero."""
    return F.round(_c(c), digits)


EXACT = "decimal(38,12)"


def exact_mean(c: ColumnOrName) -> Column:
    """Mean of values summed as decimals (12 places, more than any parsed
    input has), so it does not depend on the order rows are added."""
    c = _c(c)
    return F.try_divide(F.sum(c.cast(EXACT)).cast("double"), F.count(c))


def exact_sum(c: ColumnOrName) -> Column:
    """Order-independent sum, as a decimal with 12 places."""
    return F.sum(_c(c).cast(EXACT))
