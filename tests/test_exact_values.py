"""Values that a cut or a wrong weight would change."""

from datetime import datetime

import pytest

from caseflow.functions.numeric import exact_mean
from caseflow.functions.text import DISTANCE_UNITS, unit_number, unit_reason
from caseflow.plans import delivery
from caseflow.session import ensure_checkpoint_dir

CO = ("order_id int, customer_id int, pizza_id int, exclusions_new string, extras_new string, "
      "order_time timestamp_ntz")
RO = ("order_id int, runner_id int, pickup_time_new string, distance_km double, "
      "duration_minutes double, cancellation_new string")
T0 = datetime(2031, 5, 1, 10, 0)


@pytest.fixture()
def tables(spark):
    co = spark.createDataFrame([(1, 1, 1, None, None, T0), (1, 1, None, None, None, T0),
                                (2, 1, 1, "3", "4", None)], CO)
    ro = spark.createDataFrame([(1, 7, "2031-05-01 10:10:00", 13.44, 32.0, None),
                                (2, 7, "2031-05-01 11:00:00", 5.0, 10.0, None)], RO)
    return co, ro


@pytest.mark.parametrize("text,want,why", [
    ("13.44km", 13.44, None), (".5km", 0.5, None), ("-3 KM", -3.0, None), ("20", 20.0, None), (None, None, None),
    ("20 miles", None, "unknown unit miles"), ("25 mins", None, "unknown unit mins"), ("1,5 km", None, "not a number"),
    ("approx 20 or 30 km", None, "not a number"), ("", None, "not a number"), ("km", None, "not a number")])
def test_unit_number(spark, text, want, why):
    df = spark.createDataFrame([(text,)], "t string")
    got = df.select(unit_number("t", DISTANCE_UNITS), unit_reason("t", DISTANCE_UNITS)).first()
    assert tuple(got) == (want, why)


def test_rejects_leave_a_trace(spark):
    from caseflow.plans import delivery
    raw = spark.createDataFrame(
        [(1, 7, "2031-05-01 10:10:00", "20 miles", "15 mins", ""), (2, 7, "soon", "1,5 km", "20 hours", "null"),
         (3, 8, "null", "null", "null", "Customer Cancellation"), (4, 8, None, "3.25km", None, None)],
        "order_id int, runner_id int, pickup_time string, distance string, duration string, cancellation string")
    tagged = delivery.tagged_deliveries(raw)
    assert sorted(map(tuple, delivery.rejected(tagged, "order_id").collect())) == [
        (1, "distance", "20 miles", "unknown unit miles"), (2, "distance", "1,5 km", "not a number"),
        (2, "duration", "20 hours", "unknown unit hours"), (2, "pickup_time", "soon", "not a time")]
    clean = delivery.clean_deliveries(raw).orderBy("order_id").select("distance_km", "duration_minutes").collect()
    assert [tuple(r) for r in clean] == [(None, 15.0), (None, None), (None, None), (3.25, None)]
    co = spark.createDataFrame([(1, 5, "1, abc", " "), (2, 6, "null", "x y,3,"), (3, 6, None, "4")],
                               "order_id int, pizza_id int, exclusions string, extras string")
    assert sorted(map(tuple, delivery.rejected(delivery.tagged_orders(co), "order_id", "pizza_id").collect())) == [
        (1, 5, "exclusions", "abc", "not a topping id"), (2, 6, "extras", "", "not a topping id"),
        (2, 6, "extras", "x y", "not a topping id")]



def test_mean_keeps_decimals(spark):
    df = spark.createDataFrame([(13.44,), (0.125,)], "x double")
    assert df.agg(exact_mean("x")).first()[0] == pytest.approx(6.7825, abs=1e-12)


def test_lines_without_pizza_or_time(tables):
    co, ro = tables
    assert delivery.avg_pickup_minutes(co, ro).first()["avg_time"] == 10.0
    assert delivery.avg_distance_by_customer(co, ro).first()[1] == pytest.approx((2 * 13.44 + 5) / 3)
    assert delivery.delivered_by_runner(co, ro).first()[1] == 3


def test_report_groups_again(spark, tables):
    co, ro = tables
    ratings = spark.createDataFrame([(1, 5), (1, 5)], "order_id int, rating int")
    got = delivery.delivery_report(co, ro, ratings).filter("order_id = 1").collect()
    assert len(got) == 1 and got[0]["pizza_count"] == 2
    assert got[0]["avg_speed"] == round(13.44 / 32 * 60, 2)


def test_rate_has_more_than_two_decimals(spark, tables):
    co, ro = tables
    names = spark.createDataFrame([(1, "Meatlovers")], "pizza_id int, pizza_name string")
    got = delivery.profit(co.filter("pizza_id is not null"), ro, names, cost_per_km="0.125").first()
    assert float(got["total_cost"]) == pytest.approx(2.31, abs=0.005)  # (13.44 + 5) * 0.125


def test_off_local_mode_a_shared_folder_is_needed():
    class Context:
        master = "spark://somewhere:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError):
        ensure_checkpoint_dir(Session())
