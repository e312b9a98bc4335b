"""Positions in a sorted frame without sorting it, or a group of it, in one
task: distinct values are dealt into ranges, each range is counted, and what
lies before a range is added to the positions inside it.

The ranges are written to the shared folder once (``checkpoint()``), so that
all later steps see the same borders, also after a lost executor.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from caseflow.session import ensure_checkpoint_dir

PART, BEFORE, TOTAL, UP_TO = "__part", "__before", "__total", "__up_to"


def in_ranges(counts: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``counts`` (one row per key and value) in ranges of (keys, value), with
    the range's number."""
    ensure_checkpoint_dir(counts.sparkSession)
    dealt = counts.repartitionByRange(*keys, value).withColumn(PART, F.spark_partition_id())
    return dealt.checkpoint()


def before_ranges(ranged: DataFrame, keys: Sequence[str], weight: str) -> DataFrame:
    """(keys, range, weight in it, before it and of the whole group): a row for
    each group and range that has values of it."""
    parts = ranged.groupBy(*keys, PART).agg(F.sum(weight).alias("__n"))
    if keys:
        own = Window.partitionBy(*keys)
        run = own.orderBy(PART).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return parts.withColumns({BEFORE: F.sum("__n").over(run) - F.col("__n"),
                                  TOTAL: F.sum("__n").over(own)})
    # one group: as many rows as there are ranges, in one array
    rows = parts.agg(F.array_sort(F.collect_list(F.struct(PART, "__n"))).alias("p"))
    add = F.aggregate("p", F.struct(F.lit(0).cast("bigint").alias("sum"), F.array().cast("array<bigint>").alias("out")),
                      lambda a, x: F.struct((a["sum"] + x["__n"]).alias("sum"),
                                            F.array_append(a["out"], a["sum"]).alias("out")))
    rows = rows.select("p", add.alias("a")).select(
        F.explode(F.arrays_zip("p", F.col("a.out").alias("out"))).alias("x"), F.col("a.sum").alias(TOTAL))
    return rows.select(F.col(f"x.p.{PART}").alias(PART), F.col("x.p.__n").alias("__n"),
                       F.col("x.out").alias(BEFORE), TOTAL)


def running(ranged: DataFrame, keys: Sequence[str], value: str, weight: str) -> DataFrame:
    """``ranged`` with the weight up to each value inside its range."""
    w = Window.partitionBy(*keys, PART).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return ranged.withColumn(UP_TO, F.sum(weight).over(w))


def dense_ranks(df: DataFrame, col: str, descending: bool = False, out: str = "dense_rank") -> DataFrame:
    """(``col``, ``out``): the dense rank of each distinct value over the whole
    frame (``DENSE_RANK() OVER (ORDER BY col)``; nulls first, or last if
    descending)."""
    ranged = in_ranges(df.select(col).distinct().withColumn("__one", F.lit(1).cast("bigint")), [], col)
    parts = before_ranges(ranged, [], "__one").drop("__n")
    up = running(ranged, [], col, "__one").join(parts, PART)
    rank = F.col(BEFORE) + F.col(UP_TO)
    return up.select(col, (F.col(TOTAL) + 1 - rank if descending else rank).cast("int").alias(out))
