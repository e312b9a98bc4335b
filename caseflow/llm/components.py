"""Connected components of a distributed edge list."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(id, component) of every id on an edge (u, v): the component is its
    smallest id.  Alternating stars: each id links its larger neighbours to
    the smallest one it sees, then the smaller ones, until every edge leads to
    its component's smallest id.  Each round is written to the shared folder;
    an id with very many neighbours is only ever reduced to a minimum."""
    e = edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    e = stored(e.distinct(), "edges")
    state = _state(e)
    while state[0]:
        both = e.union(e.select("v", "u").toDF("u", "v"))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(low, "u").filter("v > m")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).union(low).distinct())
        e = stored(small, "edges")
        was, state = state, _state(e)
        if was == state:
            break
    return e.select(F.col("u").alias("id"), F.col("v").alias("component"))
