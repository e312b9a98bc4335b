"""Date/time column helpers with T-SQL meanings (D1-D13 of the survey).

All helpers return Column expressions built from Spark built-ins, so they
stay inside whole-stage code generation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_date(x: ColumnOrName) -> Column:
    return _c(x).cast("date")


def week_us(d: ColumnOrName) -> Column:
    """``DATEPART(week, d)`` with US rules: week 1 holds January 1st and
    weeks start on Sunday (not ISO; 2020-06-15 is week 25)."""
    d = as_date(d)
    jan1_dow = F.dayofweek(F.trunc(d, "year"))          # Sunday = 1
    return (F.call_function("div", F.dayofyear(d) + jan1_dow - 2, F.lit(7)) + 1).cast("int")


def week_jan1_7day(d: ColumnOrName) -> Column:
    """Alternative week rule: days 1-7 of the year are week 1, 8-14 week 2..."""
    return (F.call_function("div", F.dayofyear(as_date(d)) - 1, F.lit(7)) + 1).cast("int")


def week_start_sunday(d: ColumnOrName) -> Column:
    """``DATETRUNC(WEEK, d)``: back to the Sunday on or before ``d``
    (Spark's ``date_trunc('week')`` goes to Monday)."""
    d = as_date(d)
    return F.date_sub(d, F.dayofweek(d) - 1)


def day_of_week_sunday1(ts: ColumnOrName) -> Column:
    """``DATEPART(DW, ts)`` with Sunday = 1."""
    return F.dayofweek(_c(ts))


def weekday_name(d: ColumnOrName) -> Column:
    """``DATENAME(WEEKDAY, d)``."""
    return F.date_format(_c(d), "EEEE")


def month_end(d: ColumnOrName) -> Column:
    """``EOMONTH(d)``."""
    return F.last_day(as_date(d))


def _minute_of_day(ts: Column) -> Column:
    return F.hour(ts) * 60 + F.minute(ts)


def minutes_boundary(start: ColumnOrName, end: ColumnOrName) -> Column:
    """``DATEDIFF(minute, start, end)``: number of minute boundaries crossed
    (10:00:59 -> 10:01:00 is 1), not elapsed whole minutes.  Computed from
    wall-clock fields (day difference x 1440 + minute-of-day difference), so
    the session time zone and its daylight-saving changes do not enter."""
    start, end = _c(start), _c(end)
    days = F.datediff(end.cast("date"), start.cast("date"))
    return (days * 1440 + _minute_of_day(end) - _minute_of_day(start)).cast("int")


def minutes_field(start: ColumnOrName, end: ColumnOrName) -> Column:
    """``DATEPART(minute, end - start)``: the minute field of the difference
    (0-59), not its total minutes."""
    return F.date_part(F.lit("MINUTE"), _c(end) - _c(start)).cast("int")


def days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """``DATEDIFF(day, start, end)``."""
    return F.datediff(as_date(end), as_date(start))


def parse_dmy(s: ColumnOrName, pivot_year: int = 2049) -> Column:
    """``CONVERT(date, s, 3)`` for ``dd/mm/yy`` text.

    Two-digit years up to the cutoff's last two digits (default 49) are
    20xx, later ones 19xx, so ``'15/6/95'`` is 1995-06-15.  Text that is not
    ``d/m/yy`` or not a calendar date yields NULL.

    The expression is one linear chain (the year is widened in the text,
    then parsed once), with no sub-expression used twice: Catalyst may
    inline it into pushed-down filters, and a chain costs one evaluation
    per copy.
    """
    cut = pivot_year % 100
    low = "|".join(f"{y:02d}" for y in range(cut + 1))
    century = pivot_year - cut
    # anything but exactly two year digits cannot parse after this step
    text = F.regexp_replace(_c(s), r"^.*/\d{3,}$|^[^/]*$", "x")
    text = F.regexp_replace(text, r"^(\d{1,2}/\d{1,2}/)(" + low + r")$",
                            f"$1{century // 100}$2")
    text = F.regexp_replace(text, r"^(\d{1,2}/\d{1,2}/)(\d{2})$",
                            f"$1{(century - 100) // 100}$2")
    return F.try_to_date(text, "d/M/yyyy")


def format_dmy(d: ColumnOrName) -> Column:
    """Date as ``d/M/yy`` text (day and month without padding)."""
    d = as_date(d)
    return F.concat_ws("/", F.dayofmonth(d).cast("string"), F.month(d).cast("string"),
                       F.lpad((F.year(d) % 100).cast("string"), 2, "0"))
