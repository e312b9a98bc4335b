"""Replaced tables, tables of a catalog, ordered files, memos of read files."""

import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from caseflow.plans import catalog
from caseflow.sources.tables import DriverTables
from caseflow.sources.writers import Versions, materialize, save_table, write_ordered

SF = "/root/testdata/sf0.001"


def files(path):
    """A folder's files by part number."""
    return sorted((f for f in os.listdir(path) if f.startswith("part-")), key=lambda f: int(f.split("-")[1]))


def test_a_reader_sees_old_or_new_rows(spark, tmp_path):
    table = Versions(spark, str(tmp_path / "t"))
    with pytest.raises(ValueError):
        table.read()
    old = materialize(spark.range(10), table.path)
    new = table.replace(spark.range(100, 105).withColumn("p", F.col("id") % 2), ["p"])
    assert old.count() == 10 and new.count() == 5 and table.read().count() == 5
    table.replace(spark.range(1))  # the first version goes, the one before stays
    assert new.count() == 5 and table.read().count() == 1
    assert len([d for d in os.listdir(table.path) if d.startswith("v-")]) == 2

    broken = spark.range(3).select(F.raise_error(F.lit("no")).alias("x"))
    with pytest.raises(Exception, match="no"):
        table.replace(broken)
    assert table.read().count() == 1
    table.replace(spark.range(2))
    assert len([d for d in os.listdir(table.path) if d.startswith("v-")]) == 2


def test_a_table_made_from_itself(spark, tmp_path):
    table = Versions(spark, str(tmp_path / "t"))
    table.replace(spark.range(4))
    table.replace(table.read().select((F.col("id") + 1).alias("id")))
    assert sorted(r.id for r in table.read().collect()) == [1, 2, 3, 4]


def test_save_table(spark):
    save_table(spark.range(3), "cf_saved")
    save_table(spark.range(5), "cf_saved")
    assert spark.table("cf_saved").count() == 5
    spark.sql("DROP TABLE cf_saved")


def test_order_over_several_files(spark, tmp_path):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("a"), F.lit("x").alias("b")).repartition(5)
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        write_ordered(df, path := str(tmp_path / "o"), [F.desc("a")])
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert len(files(path)) > 1
    got = [x for f in files(path) for x in pq.read_table(f"{path}/{f}").column("a").to_pylist()]
    assert got == list(range(19_999, -1, -1))


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_jobs_in_the_order_of_the_source(spark, tmp_path):
    got = [(r.runner_id, r.order_id) for r in catalog.in_order("speed_by_delivery")(spark, SF).collect()]
    assert got == sorted(got) and len(got) > 100
    catalog.write_in_order(spark, SF, "sales_by_region_month", path := str(tmp_path / "s"))
    rows = [x for f in files(path) for x in pq.read_table(f"{path}/{f}").to_pylist()]
    keys = [(r["region"], r["month_number"]) for r in rows]
    assert keys == sorted(keys) and len(keys) > 10
    assert set(catalog.ORDERS) <= set(catalog.QUERIES)


def test_changed_files_are_read_anew(spark, tmp_path):
    tables = DriverTables(spark, str(tmp_path))
    spark.range(3).write.parquet(str(tmp_path / "region.parquet"))
    assert tables.region.count() == 3
    spark.range(7).write.mode("overwrite").parquet(str(tmp_path / "region.parquet"))
    assert tables.region.count() == 7
