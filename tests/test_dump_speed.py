"""The loader's work per row: one parse, no shuffle of rows, files written where they are."""

import os

import pytest
from pyspark.sql import functions as F

from caseflow import schemas
from caseflow.sources import dump
from caseflow.sources.dump_lexer import Lexer
from caseflow.sources.writers import Versions, kept_once


def test_common_tuples_are_not_cut_into_parts(monkeypatch):
    def parts(self, text):
        raise AssertionError(text)

    monkeypatch.setattr(Lexer, "_parse", parts)
    lexer, got = Lexer(table="t"), []
    for line in ["  ('1', CAST('2020-01-01 10:00:00' AS DATETIME), NULL),", "  ('it''s',", "   cast( 'x' as date ), 5);"]:
        got += [(v, line) for v, line, *_ in lexer.line(line)]
    assert got == [(["1", "2020-01-01 10:00:00", None], "  ('1', CAST('2020-01-01 10:00:00' AS DATETIME), NULL),"),
                   (["it's", "x", "5"], "  ('it''s',\n   cast( 'x' as date ), 5);")]


@pytest.mark.parametrize("lines", [["(1, CAST('a' AS X), /*c*/)"], ["(1, CAST('a' AS X), --x)"], ["(1, --x", "'a')"]])
def test_what_may_be_a_comment_is_left_to_the_parser(lines):
    lexer = Lexer(table="t")
    got = [v for line in lines for v, *_ in lexer.line(line)] + [v for v, *_ in lexer.end()]
    assert got in ([None], [["1", "a"]], [None, None])


def test_rows_are_routed_as_they_are_parsed(spark, tmp_path, monkeypatch):
    rows = "\n".join(f"  ({i}, {i % 5}, {i % 3}, '2020-01-01', '2020-02-01')," for i in range(400))
    (tmp_path / "d.sql").write_text(f"INSERT INTO customer_nodes (customer_id, region_id, node_id, start_date, end_date)"
                                    f"\nVALUES\n{rows}\n  (1, 2, 3, 4, 5, 6, 7, 8, 9),\n")
    written = []
    monkeypatch.setattr(dump, "_stored", lambda df, name, old=dump._stored: written.append((name, old(df, name))) or
                        written[-1][1])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        got = dump.read_dump(spark, str(tmp_path / "d.sql"), schemas.BY_NAME)
        assert got["customer_nodes"].count() == 400
        assert [(r.line.strip(), r.reason) for r in got[dump.QUARANTINE].collect()] == [("(1, 2, 3, 4, 5, 6, 7, 8, 9),", "unknown tuple width")]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [n for n, _ in written] == ["parsed", "borders", "late"]
    parsed = written[0][1]
    assert "route" in parsed.columns
    # rows that are routed need their text no more
    assert not parsed.filter("kind = 'tuple' AND route IS NOT NULL AND table IS NOT NULL AND line IS NOT NULL").count()


def test_a_version_is_written_without_a_shuffle(spark, tmp_path):
    table = Versions(spark, str(tmp_path / "t"))
    table.replace(spark.range(0, 100, 1, 3))
    at = f"{table.path}/{table.names()[0]}"
    assert len([f for f in os.listdir(at) if f.endswith(".parquet")]) == 3
    table.replace(spark.range(0, 100, 1, 3).withColumn("p", F.col("id") % 2), ["p"])
    at = f"{table.path}/{table.names()[0]}"
    assert [len([f for f in os.listdir(f"{at}/p={k}") if f.endswith(".parquet")]) for k in (0, 1)] == [3, 3]
    assert table.read().count() == 100
    assert "spark.sql.maxConcurrentOutputFileWriters" not in spark.conf.getAll


def test_kept_once(spark):
    calls = []
    for _ in range(2):
        kept_once(spark, "test/kept", lambda: calls.append(1) or spark.range(2))
    assert calls == [1]
