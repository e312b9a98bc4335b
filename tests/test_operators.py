"""Operator properties, checked against brute force on random small frames."""

import datetime as dt
import random
import tempfile

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from caseflow.operators import balances as bl
from caseflow.operators import lists as ls
from caseflow.operators import ranking as rk
from caseflow.operators.joins import bounded_broadcast
from caseflow.sources.writers import append, built_once

rows_strategy = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 6), st.booleans()),
    min_size=1, max_size=40)


@settings(max_examples=8, deadline=None)
@given(rows=rows_strategy)
def test_gated_rank_equals_window_rank(spark, rows):
    data = [(k, dt.date(2021, 1, 1) + dt.timedelta(days=d), g) for k, d, g in rows]
    df = spark.createDataFrame(data, "k string, d date, g boolean")
    got = rk.gated_rank(df, ["k"], "d", F.col("g"), "r")
    w = Window.partitionBy("k", "g").orderBy("d")
    want = df.withColumn("r", F.when(F.col("g"), F.rank().over(w)))
    norm = lambda x: sorted((r.k, r.d, r.g, r.r) for r in x.collect())
    assert norm(got) == norm(want)


def test_gated_rank_hot_key(spark):
    # one key holds most rows: ranks still follow RANK() semantics (ties share a rank)
    rnd = random.Random(7)
    data = [("hot", dt.date(2021, 1, 1) + dt.timedelta(days=rnd.randint(0, 30)), True)
            for _ in range(3000)] + [("cold", dt.date(2021, 1, 2), True)]
    df = spark.createDataFrame(data, "k string, d date, g boolean")
    got = rk.gated_rank(df, ["k"], "d", F.col("g"), "r")
    want = df.withColumn("r", F.rank().over(Window.partitionBy("k").orderBy("d")))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_top_per_group_keeps_ties(spark):
    df = spark.createDataFrame([("a", 3), ("a", 3), ("a", 1), ("b", 2)], "k string, v int")
    got = rk.top_per_group(df, ["k"], [F.col("v").desc()], 1, "rank")
    assert sorted(tuple(r) for r in got.collect()) == [("a", 3), ("a", 3), ("b", 2)]


def test_names_per_key(spark):
    df = spark.createDataFrame([(1, "b"), (1, "a"), (1, "b"), (2, "c")], "k int, n string")
    got = dict(ls.names_per_key(df, ["k"], "n", "names").collect())
    assert got == {1: "a, b", 2: "c"}
    got = dict(ls.names_per_key(df, ["k"], "n", "names", trailing_sep=True).collect())
    assert got[1] == "a, b, "


def test_running_balance_last_equals_total(spark):
    rnd = random.Random(3)
    data = [(c, m, rnd.randint(-50, 50)) for c in range(5) for m in range(1, 13)
            if rnd.random() < 0.7]
    df = spark.createDataFrame(data, "c int, m int, x int")
    rb = bl.running_balance(df, "c", "m", "x")
    last = bl.first_last(rb, "c", "m", "balance")
    totals = dict(df.groupBy("c").agg(F.sum("x")).collect())
    assert {r.c: r.end_balance for r in last.collect()} == totals


def test_bounded_broadcast(spark):
    small = spark.range(10)
    big = spark.range(1000)
    assert "broadcast" in bounded_broadcast(small, 100)._jdf.queryExecution() \
        .analyzed().toString().lower()
    assert "broadcast" not in bounded_broadcast(big, 100)._jdf.queryExecution() \
        .analyzed().toString().lower()


def test_built_once_and_append(spark):
    calls = []

    def build():
        calls.append(1)
        return spark.createDataFrame([(1, 2020), (2, 2021)], "v int, calendar_year int") \
                    .select("calendar_year", "v")

    a = built_once(spark, "test/built_once", build, partition_by=["calendar_year"])
    b = built_once(spark, "test/built_once", build, partition_by=["calendar_year"])
    assert len(calls) == 1 and a.columns == b.columns == ["calendar_year", "v"]
    assert sorted(tuple(r) for r in b.collect()) == [(2020, 1), (2021, 2)]
    path = tempfile.mkdtemp(prefix="cf-append-") + "/t"
    append(spark.createDataFrame([(1,)], "x int"), path)
    append(spark.createDataFrame([(2,)], "x int"), path)
    assert sorted(r.x for r in spark.read.parquet(path).collect()) == [1, 2]


@settings(max_examples=8, deadline=None)
@given(vals=st.lists(st.tuples(st.sampled_from([1, 2]), st.integers(0, 30)),
                     min_size=1, max_size=40))
def test_percentiles_disc_matches_definition(spark, vals):
    from caseflow.operators.measures import percentiles_disc
    df = spark.createDataFrame(vals, "g int, v int")
    ps = {"p50": 0.5, "p80": 0.8, "p95": 0.95}
    got = {r.g: (r.p50, r.p80, r.p95) for r in percentiles_disc(df, ["g"], "v", ps).collect()}

    want = {}
    for g in {g for g, _ in vals}:
        xs = [v for gg, v in vals if gg == g]
        want[g] = tuple(min(x for x in xs if sum(y <= x for y in xs) / len(xs) >= p)
                        for p in ps.values())
    assert got == want


@settings(max_examples=8, deadline=None)
@given(rows=st.lists(st.tuples(st.integers(1, 40), st.integers(0, 100)), min_size=1,
                     max_size=50),
       base=st.integers(5, 30), span=st.integers(1, 6))
def test_before_after_matches_python(spark, rows, base, span):
    from caseflow.operators.measures import before_after
    df = spark.createDataFrame(rows, "week_number int, sales int")
    r = before_after(df, "week_number", "sales", base, span).first()
    before = [s for w, s in rows if base - span <= w <= base - 1]
    after = [s for w, s in rows if base <= w <= base + span - 1]
    assert r.before_change == (sum(before) if before else None)
    assert r.after_change == (sum(after) if after else None)


def test_percentiles_of_many_values(spark):
    """A million distinct values in one group, ties, nulls and a null group."""
    from caseflow.operators.measures import percentiles_disc
    n = 1_000_000
    big = spark.range(n).select(F.lit("big").alias("g"), (F.col("id") * 7919 % n).alias("v"))
    small = spark.createDataFrame([("few", 3), ("few", 3), ("few", None), ("few", 9), (None, 4), ("none", None)],
                                  "g string, v long")
    got = {r.g: tuple(r)[1:] for r in percentiles_disc(
        big.unionByName(small), ["g"], "v", {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p100": 1.0}).collect()}
    assert got == {"big": (0, n // 2 - 1, n * 95 // 100 - 1, n - 1), "few": (3, 3, 9, 9), None: (4, 4, 4, 4),
                   "none": (None, None, None, None)}
    whole = percentiles_disc(big, [], "v", {"p50": 0.5}).collect()
    assert [tuple(r) for r in whole] == [(n // 2 - 1,)]


def test_dense_ranks_of_the_whole_frame(spark):
    from caseflow.operators.ranges import dense_ranks
    values = [5, 3, 3, None, 9, 5, -2]
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(3)
    assert {tuple(r) for r in dense_ranks(df, "v").collect()} == {(None, 1), (-2, 2), (3, 3), (5, 4), (9, 5)}
    assert {tuple(r) for r in dense_ranks(df, "v", True).collect()} == {(9, 1), (5, 2), (3, 3), (-2, 4), (None, 5)}
    big = spark.range(100_000).select((F.col("id") * 31 % 50_000).alias("v"))
    assert dense_ranks(big, "v").filter("dense_rank <> v + 1").count() == 0
    assert [r.v for r in rk.rows_at_dense_rank(df, "v", 4).collect()] == [5, 5]
    assert dense_ranks(df.limit(0), "v").count() == 0
