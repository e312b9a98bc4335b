"""Every line of a dump ends in a table, in quarantine, or holds no data."""

import datetime as dt

from caseflow.sources.dump import load_dump, parse_dump
from caseflow.streaming.dump_stream import BANK


def _load(spark, *lines):
    out = load_dump(spark.createDataFrame([(x,) for x in lines], "value string"), BANK)
    return ({tuple(r) for r in out["customer_transactions"].collect()},
            {(r.line, r.reason) for r in out["_quarantine"].collect()})


def test_tuples_of_all_shapes(spark):
    d = dt.date(2018, 2, 3)
    rows, bad = _load(
        spark,
        "INSERT INTO customer_transactions (customer_id, txn_date, txn_type, txn_amount) VALUES"
        " (51, '2018-02-03', 'one', 5), (52, '2018-02-03', 'two', 6);",
        "  ('53', '2018-02-03', 'it''s', '7'),",
        "  ('54', '2018-02-03', 'all values (new)', '8'),",
        "  ('55', CAST('2018-02-03' AS DATE), 'cast', '9'),",
        "(NULL, NULL, NULL, NULL),",
        "  (customer_id, txn_date, txn_type, txn_amount)",
        "-- a comment with (1, 2, 3, 4)", "CREATE TABLE t (", '  "customer_id" INTEGER,', ");", "", None)
    assert rows == {(51, d, "one", 5), (52, d, "two", 6), (53, d, "it's", 7),
                    (54, d, "all values (new)", 8), (55, d, "cast", 9), (None, None, None, None)}
    assert bad == set()


def test_what_does_not_parse_is_quarantined(spark):
    rows, bad = _load(spark, "  ('61', '2018-02-03',", "   'in two', '3'),", "('62', 'no date', 'x', '1')",
                      "(1, 2, 3)", "('open, 1)", "(63, '2018-02-03', 'after it', 4);", "what is this",
                      "('64', '2018-02-03', (1), 2)")
    d = dt.date(2018, 2, 3)
    assert rows == {(61, d, "in two", 3), (63, d, "after it", 4)}
    assert bad == {("('62', 'no date', 'x', '1')", "cast failed for customer_transactions"),
                   ("(1, 2, 3)", "unknown tuple width"), ("('open, 1)", "unparsed line"),
                   ("what is this", "unparsed line"), ("('64', '2018-02-03', (1), 2)", "unparsed line")}


def test_long_line(spark):
    n = 20_000
    line = ", ".join(f"({i}, '2018-02-03', 'a''b', {i})" for i in range(n))
    df = spark.createDataFrame([(line,)], "value string")
    assert parse_dump(df).filter("size(vals) = 4").count() == n
