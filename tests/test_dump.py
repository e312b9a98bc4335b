import datetime as dt

from caseflow.sources import dump
from caseflow.streaming.dump_stream import BANK


LINES = [
    "CREATE TABLE customer_transactions (",
    "INSERT INTO customer_transactions",
    "  (customer_id, txn_date, txn_type, txn_amount)",
    "VALUES",
    "  ('41', '2017-08-12', 'refund', '77'),",
    "  ('42', '2017-08-13', 'refund', '640');",
    "INSERT INTO customer_nodes",
    "  (customer_id, region_id, node_id, start_date, end_date)",
    "VALUES",
    "  ('908', '2017-09-01', 'refund', '15'),\r",          # mis-headed: 4 values
    "  ('41', '8', '6', '2017-08-12', '2017-08-30'),",
    "  ('42', '8', 'x', '2017-08-13', '2017-08-31'),",        # bad int -> quarantine
    "  ('9', 'too', 'wide', '1', '2', '3');",                # unknown width -> quarantine
    "VALUES ('44', '2017-10-05', 'fee', null);",         # bare null keyword
]


def test_routes_by_shape(spark):
    df = spark.createDataFrame([(x,) for x in LINES], "value string")
    out = dump.load_dump(df, BANK)
    tx = sorted(tuple(r) for r in out["customer_transactions"].collect())
    assert tx == [(41, dt.date(2017, 8, 12), "refund", 77), (42, dt.date(2017, 8, 13), "refund", 640),
                  (44, dt.date(2017, 10, 5), "fee", None),
                  (908, dt.date(2017, 9, 1), "refund", 15)]
    nodes = [tuple(r) for r in out["customer_nodes"].collect()]
    assert nodes == [(41, 8, 6, dt.date(2017, 8, 12), dt.date(2017, 8, 30))]
    reasons = sorted(r.reason for r in out["_quarantine"].collect())
    assert reasons == ["cast failed for customer_nodes", "unknown tuple width"]


def test_cast_datetime_and_quoted_lists(spark):
    from caseflow import schemas
    lines = ["  ('60', '731', '5', '9, 3', '7, 8', CAST('2017-04-22 06:07:08' AS DATETIME)),",
             "  ('50', '730', '4', '', NULL, CAST('2017-04-21 05:06:07' AS DATETIME)),"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    out = dump.load_dump(df, {6: ("customer_orders", schemas.CUSTOMER_ORDERS)})
    got = sorted(tuple(r) for r in out["customer_orders"].collect())
    assert got[0] == (50, 730, 4, "", None, dt.datetime(2017, 4, 21, 5, 6, 7))
    assert got[1][3:5] == ("9, 3", "7, 8")


def test_subscription_plans_decimal_and_null(spark):
    from decimal import Decimal

    from caseflow import schemas
    lines = ["INSERT INTO plans", "  (plan_id, plan_name, price)", "VALUES",
             "  ('20', 'guest', '0'),", "  ('21', 'weekly small', '3.25'),",
             "  ('23', 'two years', '310'),", "  ('24', 'left', null);"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    out = dump.load_dump(df, {3: ("plans", schemas.PLANS)})
    got = sorted(tuple(r) for r in out["plans"].collect())
    assert got == [(20, "guest", Decimal("0.00")), (21, "weekly small", Decimal("3.25")),
                   (23, "two years", Decimal("310.00")), (24, "left", None)]
    assert out["_quarantine"].count() == 0


def test_read_typed_uses_declared_schema(spark):
    import tempfile

    from caseflow import schemas
    from caseflow.sources.tables import read_typed
    path = tempfile.mkdtemp(prefix="cf-typed-") + "/regions.csv"
    spark.createDataFrame([("6", "North"), ("7", "South")], "a string, b string") \
         .write.mode("overwrite").csv(path)
    df = read_typed(spark, path, schemas.REGIONS, fmt="csv")
    assert df.dtypes == [("region_id", "int"), ("region_name", "string")]
    assert sorted(tuple(r) for r in df.collect()) == [(6, "North"), (7, "South")]
