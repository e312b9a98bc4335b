"""Join helpers: size-checked broadcast of dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Dimensions up to this many rows are shipped to every task; larger ones
# take the shuffle path (sort-merge, or AQE's runtime broadcast when the
# measured shuffle output turns out small).
DEFAULT_BROADCAST_ROWS = 100_000


# (application id, plan hash, bound) -> within bound; a plan over the same
# files checked once per application is not counted again.
_CHECKED: dict[tuple[str, int, int], bool] = {}


def bounded_broadcast(dim: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Mark ``dim`` for broadcast only if it has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows, so it stays cheap on a
    large table; beyond the bound the plan keeps the shuffle join.
    """
    key = (dim.sparkSession.sparkContext.applicationId, dim.semanticHash(), max_rows)
    if key not in _CHECKED:
        _CHECKED[key] = dim.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(dim) if _CHECKED[key] else dim

