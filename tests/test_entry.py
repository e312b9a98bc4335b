"""Driver contract: entry() smoke run, queries()/oracle_sql() keys, and jobs
against their DuckDB oracle on sf0.001."""

import os

import duckdb
import pytest

import __spark_entry__ as se

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_entry_runs(spark):
    df = se.entry(spark)
    assert df.columns == ["customer_id", "month", "balance", "change_in_balance"]
    assert df.count() > 0


def test_every_reference_query_has_oracle():
    from caseflow.plans.catalog import QUERIES
    assert set(QUERIES) <= set(se.oracle_sql())
    assert set(se.oracle_sql()) <= set(se.queries())


@pytest.mark.parametrize("name", ["spend_by_customer", "order_description",
                                  "ingredient_counts", "member_flag_ranking",
                                  "allocation_percentiles", "balance_growth_share",
                                  "before_after_4w_by_year", "first_items", "favourite_item",
                                  "first_after_join", "last_before_join", "pre_join_totals",
                                  "first_week_bonus_points", "type_by_customer", "top_extra",
                                  "revenue_with_extras", "profit", "active_mix_by_month",
                                  "closing_balance", "clean_weekly", "missing_weeks",
                                  "monthly_platform_share", "before_after_12w", "delivery_report", "order_rejects",
                                  "delivery_rejects", "most_bought_at_rank", "segment_contribution",
                                  "dump_load_deliveries", "dump_load_transactions", "dump_load_plans",
                                  "dump_quarantine"])
def test_against_oracle(spark, name):
    con = duckdb.connect()
    for t in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
              "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    res = con.execute(se.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = sorted((tuple(r[cols.index(c)] for c in sorted(cols)) for r in res.fetchall()), key=repr)
    df = se.queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(cols)
    got = sorted((tuple(r[c] for c in sorted(cols)) for r in df.collect()), key=repr)
    assert got == want
