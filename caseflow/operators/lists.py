"""List-valued text columns: explode, decode ids, gather names.

Lists arrive as comma-joined text (``'2, 6'``).  Exploding is a per-row
``Generate`` (no shuffle); decoding joins a dimension of item names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.functions.text import list_item_id, split_list
from caseflow.operators.joins import bounded_broadcast


def explode_ids(df: DataFrame, list_col: str, id_col: str = "item_id",
                sep: str = ",") -> DataFrame:
    """One row per list element (``CROSS APPLY string_split``).

    A NULL list yields no row.  Elements are trimmed and cast to int, so
    ``' 2'`` equals 2; an element that is not a number becomes NULL.
    """
    return (df.withColumn(id_col, F.explode(split_list(list_col, sep)))
              .withColumn(id_col, list_item_id(id_col)))


def decode_ids(df: DataFrame, id_col: str, dim: DataFrame, dim_id: str,
               dim_cols: Sequence[str], how: str = "inner") -> DataFrame:
    """Join item names onto exploded ids (dimension broadcast when small)."""
    d = bounded_broadcast(dim.select(F.col(dim_id).alias(id_col), *dim_cols))
    return df.join(d, id_col, how)


def names_per_key(df: DataFrame, keys: Sequence[str], name_col: str, out_col: str,
                  sep: str = ", ", trailing_sep: bool = False) -> DataFrame:
    """Distinct names per key, sorted, joined by ``sep``.

    De-duplication happens first (map-side combined), so the collected list
    per key is bounded by the number of distinct names, however many rows
    a hot key has.  ``trailing_sep`` reproduces the ``name + ', '`` form
    that leaves a separator after the last name.
    """
    distinct = df.select(*keys, name_col).dropDuplicates([*keys, name_col])
    joined = F.array_join(F.sort_array(F.collect_list(name_col)), sep)
    if trailing_sep:
        joined = F.concat(joined, F.lit(sep))
    return distinct.groupBy(*keys).agg(joined.alias(out_col))
