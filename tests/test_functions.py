import datetime as dt

from pyspark.sql import functions as F

from caseflow.functions import dates as d
from caseflow.functions import numeric as n
from caseflow.functions import text as tx


def one(spark, col, data, schema):
    return spark.createDataFrame(data, schema).select(col.alias("x")).collect()


def test_week_us_and_sunday(spark):
    df = spark.createDataFrame([(dt.date(2020, 6, 15),), (dt.date(2021, 1, 3),),
                                (dt.date(2021, 1, 1),), (dt.date(2020, 1, 4),),
                                (dt.date(2020, 1, 5),)], "d date")
    got = df.select(d.week_us("d").alias("w"), d.week_start_sunday("d").alias("s"),
                    d.week_jan1_7day("d").alias("j")).collect()
    assert [r.w for r in got] == [25, 2, 1, 1, 2]
    assert got[1].s == dt.date(2021, 1, 3) and got[2].s == dt.date(2020, 12, 27)
    assert got[0].j == 24


def test_minutes(spark):
    ts = dt.datetime
    df = spark.createDataFrame([(ts(2020, 1, 1, 10, 0, 59), ts(2020, 1, 1, 10, 1, 0)),
                                (ts(2020, 1, 8, 21, 0, 29), ts(2020, 1, 8, 21, 10, 57)),
                                (ts(2020, 1, 1, 10, 0, 0), ts(2020, 1, 1, 11, 30, 0))],
                               "a timestamp_ntz, b timestamp_ntz")
    got = df.select(d.minutes_boundary("a", "b").alias("m"),
                    d.minutes_field("a", "b").alias("f")).collect()
    assert [(r.m, r.f) for r in got] == [(1, 0), (10, 10), (90, 30)]


def test_parse_dmy(spark):
    df = spark.createDataFrame([("15/6/95",), ("31/8/20",), ("not a date",)], "s string")
    got = [r.x for r in df.select(d.parse_dmy("s").alias("x")).collect()]
    assert got == [dt.date(1995, 6, 15), dt.date(2020, 8, 31), None]


def test_sentinels_and_units(spark):
    df = spark.createDataFrame([("null",), ("",), (" ",), (None,), ("2, 6",)], "s string")
    assert [r.x for r in df.select(tx.null_sentinels("s").alias("x")).collect()] == \
        [None, None, None, None, "2, 6"]
    df = spark.createDataFrame([("20km",), ("23.4 km",), ("10",), ("25mins",),
                                ("15 minute",), ("null",), (None,)], "s string")
    assert [r.x for r in df.select(tx.unit_number("s", tx.DISTANCE_UNITS + tx.DURATION_UNITS).alias("x")).collect()] == \
        [20.0, 23.4, 10.0, 25.0, 15.0, None, None]
    assert [r.x for r in df.select(tx.strip_units("s", ["km", "minute", "mins"]).alias("x"))
            .collect()][:5] == [20.0, 23.4, 10.0, 25.0, 15.0]


def test_phrases(spark):
    df = spark.createDataFrame([("Meatlovers", None, "Bacon")], "a string, b string, c string")
    got = df.select(tx.join_phrases(tx.relabel("a", {"Meatlovers": "Meat Lovers"}),
                                    tx.optional_phrase(" - Exclude ", "b"),
                                    tx.optional_phrase(" - Extra ", "c")).alias("x")).first()
    assert got.x == "Meat Lovers - Extra Bacon"


def test_integer_math(spark):
    df = spark.createDataFrame([(-7, 2), (7, 2), (5, 0)], "a int, b int")
    assert [r.x for r in df.select(n.int_div("a", "b").alias("x")).collect()] == [-3, 3, None]
    g = spark.createDataFrame([(1,), (2,), (2,)], "v int")
    assert g.agg(n.int_avg("v").alias("x")).first().x == 1
    p = spark.createDataFrame([(110, 100), (5, 0)], "a int, b int")
    assert [r.x for r in p.select(n.pct_change("a", "b").alias("x")).collect()] == [10.0, None]


def test_parse_dmy_edges(spark):
    df = spark.createDataFrame([("5/6/49",), ("5/6/50",), ("31/2/20",), ("1/1/2020",),
                                ("01/12/01",), (None,), ("a/b/cc",)], "s string")
    got = [r.x for r in df.select(d.parse_dmy("s").alias("x")).collect()]
    assert got == [dt.date(2049, 6, 5), dt.date(1950, 6, 5), None, None, dt.date(2001, 12, 1),
                   None, None]


def test_format_dmy(spark):
    df = spark.createDataFrame([(dt.date(1995, 6, 5),), (dt.date(2001, 11, 14),)], "d date")
    assert [r.x for r in df.select(d.format_dmy("d").alias("x")).collect()] == \
        ["5/6/95", "14/11/01"]
