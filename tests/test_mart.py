import datetime as dt
from decimal import Decimal

import pytest

from caseflow import schemas
from caseflow.plans import mart as m
from caseflow.sources.writers import Versions


def _weekly_rows():
    out = []
    segs = ["C1", "F2", "C3", "F4", "null", None]
    for yy, year in (("18", 2018), ("19", 2019), ("20", 2020)):
        for i, (day, mon) in enumerate([("23", "3"), ("18", "5"), ("8", "6"), ("15", "6"),
                                        ("6", "7"), ("31", "8"), ("5", "1")]):
            seg = segs[i % len(segs)]
            plat = "Retail" if i % 2 == 0 else "Shopify"
            out.append((f"{day}/{mon}/{yy}", "ASIA", plat, seg, "New", 10 + i, 1000 * (i + 1)))
    out.append(("15/6/95", "EUROPE", "Retail", "C4", "Guest", 3, 10))
    return out


@pytest.fixture(scope="module")
def cws(spark):
    raw = spark.createDataFrame(_weekly_rows(), schemas.WEEKLY_SALES)
    return m.clean_weekly(raw).cache()


def test_clean_weekly_parsing(cws):
    got = {x.week_date: x for x in cws.collect()}
    r = got[dt.date(2020, 6, 15)]
    assert (r.week_number, r.month_number, r.calendar_year) == (25, 6, 2020)
    assert got[dt.date(1995, 6, 15)].calendar_year == 1995       # yy pivot
    assert got[dt.date(2018, 3, 23)].age_band == "Young Adults"
    assert got[dt.date(2018, 3, 23)].demographic == "Couples"
    # the source's band-4 test reads the first character: F4 / C4 are unknown
    f4 = [x for x in cws.collect() if x.week_date == dt.date(2018, 6, 15)][0]
    assert (f4.age_band, f4.demographic) == ("unknown", "Families")
    assert got[dt.date(1995, 6, 15)].age_band == "unknown"
    nul = got[dt.date(2018, 7, 6)]
    assert (nul.age_band, nul.demographic) == ("unknown", "unknown")
    assert got[dt.date(2018, 3, 23)].avg_transaction == Decimal("100.00")
    assert got[dt.date(2018, 5, 18)].avg_transaction == Decimal("181.82")


def test_fix_age_band(spark):
    raw = spark.createDataFrame(_weekly_rows(), schemas.WEEKLY_SALES)
    fixed = m.clean_weekly(raw, fix_age_band=True, keep_segment=True)
    r = [x for x in fixed.collect() if x.week_date == dt.date(2018, 6, 15)][0]
    assert (r.segment, r.age_band) == ("F4", "Retirees")
    segs = {x.segment for x in fixed.collect()}
    assert "unknown" in segs and None not in segs and "null" not in segs


def test_week_rule_option(spark):
    raw = spark.createDataFrame(_weekly_rows(), schemas.WEEKLY_SALES)
    alt = m.clean_weekly(raw, week_rule="jan1_7day")
    r = [x for x in alt.collect() if x.week_date == dt.date(2020, 6, 15)][0]
    assert r.week_number == 24


def test_exploration(cws):
    assert {x.week_day for x in m.weekday_used(cws).collect()} >= {"Monday", "Friday"}
    n_weeks = cws.select("week_number").distinct().count()
    assert m.missing_weeks(cws).first()[0] == 52 - len(
        [w for w in cws.select("week_number").distinct().collect() if w[0] <= 52])
    assert n_weeks > 0
    share = m.monthly_platform_share(cws).collect()
    by = {}
    for x in share:
        by.setdefault((x.platform, x.calendar_year), 0.0)
        by[(x.platform, x.calendar_year)] += x.percent_sales_monthly
    assert all(abs(v - 100.0) < 1e-9 for v in by.values())
    seg = m.segment_contribution(cws).collect()
    assert abs(sum(x.percent_sale for x in seg) - 100.0) < 1e-9
    dem = m.demographic_share_by_year(cws).collect()
    assert abs(sum(x.percent_sale for x in dem if x.calendar_year == 2020) - 100.0) < 1e-9


def test_before_after(cws):
    assert [x.week_number for x in m.baseline_week(cws, "2020-06-15").collect()] == [25]
    r = m.before_after_total(cws, "2020-06-15", 4).first()
    # 2020 before: weeks 21 (18 May) 2000 + 24 (8 June) 3000; after: 25 (15 June) 4000
    # + 28 (6 July) 5000
    assert (r.before_change, r.after_change) == (5000, 9000)
    assert r.sale_change == 4000 and r.rate_change == 80.0
    y = {x.calendar_year: x for x in m.before_after_by_year(cws, "2020-06-15", 12).collect()}
    assert set(y) == {1995, 2018, 2019, 2020}
    assert y[1995].before_change_12_week == 10 and y[1995].after_change_12_week is None


def test_avg_txn_size(cws):
    got = {(x.platform, x.calendar_year): x for x in m.avg_txn_size(cws).collect()}
    r = got[("Retail", 2020)]
    assert isinstance(r.avg_transaction_group, int)


def test_write_clean_weekly_partitioned(spark, cws):
    import os
    import tempfile
    path = tempfile.mkdtemp(prefix="cf-cws-") + "/clean_weekly_sales"
    back = m.write_clean_weekly(cws, path)
    assert back.count() == cws.count()
    version, = Versions(spark, path).names()
    assert os.path.isdir(f"{path}/{version}/calendar_year=2020")
    pruned = back.filter("calendar_year = 2020")
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and pruned.count() == 7
