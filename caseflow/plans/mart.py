"""Retail-mart jobs: cleaning (E0), exploration (E1-E9) and before/after
analysis (H0-H3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow.functions import dates as dt
from caseflow.functions.numeric import int_div
from caseflow.functions.text import code_char
from caseflow.operators.measures import before_after, share_of_total, share_within, with_change
from caseflow.sources.writers import materialize

# Segment code labels.
AGE_BANDS = {"1": "Young Adults", "2": "Middle Aged", "3": "Retirees", "4": "Retirees"}
DEMOGRAPHICS = {"C": "Couples", "F": "Families"}
UNKNOWN = "unknown"


def _age_band(segment: Column, fix_age_band: bool) -> Column:
    second = code_char(segment, 2)
    retiree = (second == "3") | ((second == "4") if fix_age_band else (code_char(segment, 1) == "4"))
    return (F.when(second == "1", F.lit(AGE_BANDS["1"]))
             .when(second == "2", F.lit(AGE_BANDS["2"]))
             .when(retiree, F.lit(AGE_BANDS["3"]))
             .otherwise(F.lit(UNKNOWN)))


def _demographic(segment: Column) -> Column:
    first = code_char(segment, 1)
    return (F.when(first == "C", F.lit(DEMOGRAPHICS["C"]))
             .when(first == "F", F.lit(DEMOGRAPHICS["F"])).otherwise(F.lit(UNKNOWN)))


def clean_weekly(weekly_sales: DataFrame, fix_age_band: bool = False,
                 keep_segment: bool = False, week_rule: str = "us") -> DataFrame:
    """Typed weekly sales with week/month/year, age band, demographic and
    average transaction (decimal(10,2), half-up).

    Defaults follow the source query: US ``DATEPART(week)``, the age-band
    test that reads the first character for band 4 (so ``C4``/``F4`` become
    'unknown'), and segment not kept.  ``fix_age_band``, ``keep_segment``
    (NULL/'null' -> 'unknown') and ``week_rule='jan1_7day'`` give the intent
    stated in the task text.
    """
    # parse once in its own projection; the derived columns refer to it
    weekly_sales = weekly_sales.withColumn("__date", dt.parse_dmy("week_date"))
    d = F.col("__date")
    week = dt.week_us(d) if week_rule == "us" else dt.week_jan1_7day(d)
    seg = F.col("segment")
    cols = [d.alias("week_date"), week.alias("week_number"),
            F.month(d).alias("month_number"), F.year(d).alias("calendar_year")]
    if keep_segment:
        cols.append(F.when(seg.isNull() | (seg == "null"), F.lit(UNKNOWN)).otherwise(seg)
                    .alias("segment"))
    avg_tx = F.try_divide(F.col("sales").cast("decimal(18,0)"), F.col("transactions")) \
              .cast("decimal(10,2)")
    cols += [_age_band(seg, fix_age_band).alias("age_band"),
             _demographic(seg).alias("demographic"),
             "region", "platform", "customer_type", "transactions",
             F.col("sales").cast("long").alias("sales"),
             avg_tx.alias("avg_transaction")]
    return weekly_sales.select(*cols)


def write_clean_weekly(cws: DataFrame, path: str) -> DataFrame:
    """E0 as CTAS: replace the table at ``path``, partitioned by year so the
    year filters of the before/after jobs prune files."""
    return materialize(cws, path, partition_by=["calendar_year"])


def weekday_used(cws: DataFrame) -> DataFrame:
    """Weekday names present in week_date."""
    return cws.select(dt.weekday_name("week_date").alias("week_day")).distinct()


def missing_weeks(cws: DataFrame, weeks_in_year: int = 52) -> DataFrame:
    """How many of week numbers 1..52 never occur."""
    spark = cws.sparkSession
    allw = spark.range(1, weeks_in_year + 1).select(F.col("id").cast("int").alias("week_number"))
    present = cws.select(F.col("week_number").alias("w")).distinct()
    # null-safe key: no IS NOT NULL predicate is inferred and pushed into the
    # scan (the 1..52 side has no NULLs, so the result is the same)
    return allw.join(present, allw.week_number.eqNullSafe(present.w), "left_anti").agg(
        F.count(F.lit(1)).alias("missing_weeks"))


def txns_by_year(cws: DataFrame) -> DataFrame:
    """Transactions per calendar year."""
    return cws.groupBy("calendar_year").agg(F.sum("transactions").alias("total_transaction"))


def sales_by_region_month(cws: DataFrame) -> DataFrame:
    """Sales per (region, month number), years pooled."""
    return cws.groupBy("region", "month_number").agg(F.sum("sales").alias("total_sales"))


def txn_rows_by_platform(cws: DataFrame) -> DataFrame:
    """E5: rows (not transactions) per platform."""
    return cws.groupBy("platform").agg(F.count("transactions").alias("total_transaction"))


def monthly_platform_share(cws: DataFrame) -> DataFrame:
    """Monthly sales per platform and year, as percent of that
    platform-year."""
    return share_within(cws, ["platform", "calendar_year", "month_number"],
                        ["platform", "calendar_year"], "sales", "sale_monthly",
                        "percent_sales_monthly")


def demographic_share_by_year(cws: DataFrame) -> DataFrame:
    """Sales per demographic and year as percent of the year."""
    return share_within(cws, ["demographic", "calendar_year"], ["calendar_year"], "sales",
                        "total_sale", "percent_sale")


def segment_contribution(cws: DataFrame) -> DataFrame:
    """Sales per (age band, demographic) as percent of all sales."""
    return share_of_total(cws, ["age_band", "demographic"], "sales", "total_sale",
                          "percent_sale")


def avg_txn_size(cws: DataFrame) -> DataFrame:
    """Mean of row averages vs. sales/transactions (integer division)
    per platform and year."""
    a = F.col("avg_transaction")
    return cws.groupBy("platform", "calendar_year").agg(
        F.try_divide(F.sum(a).cast("double"), F.count(a)).alias("avg_transaction_row"),
        int_div(F.sum("sales"), F.sum("transactions")).alias("avg_transaction_group"))


def baseline_week(cws: DataFrame, baseline_date: str) -> DataFrame:
    """H0: week number(s) of rows dated on the baseline date."""
    return cws.filter(F.col("week_date") == F.lit(baseline_date).cast("date")) \
              .select("week_number").distinct()


def _baseline(baseline_date: str) -> Column:
    return dt.week_us(F.lit(baseline_date).cast("date"))


def before_after_total(cws: DataFrame, baseline_date: str, span: int) -> DataFrame:
    """H1/H2: sales in the ``span`` weeks before vs. from the baseline week,
    in the baseline's year, with change and percent rate."""
    year = F.year(F.lit(baseline_date).cast("date"))
    d = cws.filter(F.col("calendar_year") == year)
    ba = before_after(d, "week_number", "sales", _baseline(baseline_date), span)
    return with_change(ba, "before_change", "after_change", "sale_change", "rate_change")


def before_after_by_year(cws: DataFrame, baseline_date: str, span: int) -> DataFrame:
    """H3: the same comparison for every calendar year (weeks fixed by the
    baseline date's week number), rate rounded to 2 decimals."""
    sfx = f"{span}_week"
    b, a = f"before_change_{sfx}", f"after_change_{sfx}"
    ba = before_after(cws, "week_number", "sales", _baseline(baseline_date), span,
                      group_by=["calendar_year"], names=(b, a), prefilter=False)
    return with_change(ba, b, a, f"sale_change_{span}w", f"rate_change_{span}w", digits=2)
