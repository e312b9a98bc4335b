"""String column helpers: sentinel cleaning, unit stripping, list text,
optional phrases and code-character labels (X4, X12-X18)."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Text that stands for "no value" in the raw order tables.
NULL_SENTINELS = ("null", "")

# Unit suffixes written after delivery numbers.
DISTANCE_UNITS = ("km",)
DURATION_UNITS = ("minutes", "minute", "mins")


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def null_sentinels(c: ColumnOrName, sentinels: Sequence[str] = NULL_SENTINELS) -> Column:
    """Map sentinel text to NULL.  The comparison trims first, so ``' '``
    and ``''`` both match the empty sentinel (blank-padded equality)."""
    c = _c(c)
    return F.when(F.trim(c).isin(list(sentinels)), F.lit(None).cast("string")).otherwise(c)


_NUMBER = r"[+-]?(?:\d+(?:\.\d*)?|\.\d+)"


def _with_unit(units: Sequence[str]) -> str:
    """Pattern of a text that is one number with one of the units, or none."""
    names = "|".join(re.escape(u) for u in sorted(units, key=len, reverse=True))
    return rf"(?i)^\s*({_NUMBER})\s*(?:{names})?\s*$"


def unit_number(c: ColumnOrName, units: Sequence[str]) -> Column:
    """Number of text such as ``'23.4 km'``, ``'.5km'`` or ``'25mins'`` as
    double.  The whole text must be one number and at most one of ``units``;
    anything else gives NULL (and a :func:`unit_reason`)."""
    return F.regexp_extract(_c(c), _with_unit(units), 1).try_cast("double")


def unit_reason(c: ColumnOrName, units: Sequence[str]) -> Column:
    """Why a text is no number with one of ``units``; NULL if it is, or is NULL."""
    c = _c(c)
    word = F.regexp_extract(c, rf"^\s*{_NUMBER}\s*([A-Za-z]+)\s*$", 1)
    return (F.when(c.rlike(_with_unit(units)), F.lit(None).cast("string"))
             .when(word != "", F.concat(F.lit("unknown unit "), word))
             .when(c.isNotNull(), F.lit("not a number")))


def strip_units(c: ColumnOrName, units: Sequence[str]) -> Column:
    """Remove the first matching unit suffix and cast to double (the literal
    REPLACE-then-CONVERT form)."""
    c = _c(c)
    pattern = "(" + "|".join(re.escape(u) for u in sorted(units, key=len, reverse=True)) + ")$"
    return F.trim(F.regexp_replace(c, pattern, "")).try_cast("double")


def split_list(c: ColumnOrName, sep: str = ",") -> Column:
    """Comma-joined list text to ``array<string>`` (NULL stays NULL)."""
    return F.split(_c(c), sep)


def list_item_id(c: ColumnOrName) -> Column:
    """List element such as ``' 2'`` to an int id (``' 2'`` equals 2)."""
    return F.trim(_c(c)).try_cast("int")


def bad_items(c: ColumnOrName, sep: str = ",") -> Column:
    """The elements of a list text that are no ids (NULL for NULL)."""
    return F.filter(F.transform(split_list(c, sep), lambda x: F.trim(x)), lambda x: x.try_cast("int").isNull())


def optional_phrase(prefix: str, c: ColumnOrName) -> Column:
    """``prefix + c``: NULL when ``c`` is NULL (the ``+`` concatenation)."""
    return F.concat(F.lit(prefix), _c(c))


def join_phrases(*parts: ColumnOrName) -> Column:
    """``CONCAT(a, b, ...)``: NULL parts are skipped."""
    return F.concat_ws("", *[_c(p) for p in parts])


def relabel(c: ColumnOrName, mapping: Mapping[str, str]) -> Column:
    """Replace whole values by the mapping; others pass through."""
    c = _c(c)
    out = c
    for src, dst in mapping.items():
        out = F.when(c == F.lit(src), F.lit(dst)).otherwise(out)
    return out


def code_char(c: ColumnOrName, pos: int) -> Column:
    """``SUBSTRING(c, pos, 1)`` (1-based)."""
    return F.substring(_c(c), pos, 1)


def byte_length(c: ColumnOrName) -> Column:
    """``DATALENGTH(c)`` for single-byte text."""
    return F.octet_length(_c(c))


def item_count(c: ColumnOrName, sep: str = ",") -> Column:
    """Number of items in a list text (NULL for NULL)."""
    c = _c(c)
    return F.when(c.isNull(), F.lit(None).cast("int")).otherwise(F.size(F.split(c, sep)))
