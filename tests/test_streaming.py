import datetime as dt

from pyspark.sql import functions as F

from caseflow.streaming.dump_stream import start_dump_stream


def _load(spark, src, out):
    q = start_dump_stream(spark, str(src), str(out), available_now=True)
    q.awaitTermination(120)


def _transactions(spark, out):
    t = spark.read.parquet(f"{out}/customer_transactions").drop("batch_id")
    return sorted(tuple(r) for r in t.collect())


def test_dump_stream_resumes_without_a_named_checkpoint(spark, tmp_path):
    src, out = tmp_path / "in", tmp_path / "out"
    src.mkdir()
    (src / "one.sql").write_text(
        "INSERT INTO customer_nodes\n  (customer_id, region_id, node_id, start_date, end_date)\n"
        "VALUES\n  ('71', '2019-05-06', 'purchase', '88'),\n"
        "  ('72', '2', '5', '2019-05-06', '2019-05-19');\n")
    _load(spark, src, out)
    first = (71, dt.date(2019, 5, 6), "purchase", 88)
    assert _transactions(spark, out) == [first]
    assert spark.read.parquet(f"{out}/customer_nodes").count() == 1
    # a later application has another spark.checkpoint.dir folder, but the same target
    before = spark.sparkContext.getCheckpointDir()
    spark.sparkContext.setCheckpointDir(str(tmp_path / "other"))
    (src / "two.sql").write_text("  ('73', '2019-05-07', 'withdrawal', '9');\n")
    _load(spark, src, out)
    if before:
        spark.sparkContext.setCheckpointDir(before.rsplit("/", 1)[0])
    assert _transactions(spark, out) == [first, (73, dt.date(2019, 5, 7), "withdrawal", 9)]
    ids = spark.read.parquet(f"{out}/customer_transactions").select(F.countDistinct("batch_id"))
    assert ids.first()[0] == 2
