"""Dump files cut anywhere, tables of one width, headers and column lists."""

import datetime as dt
import random

import pytest

from caseflow import schemas
from caseflow.sources.dump import load_dump, read_dump
from caseflow.sources.dump_files import dump_lines
from caseflow.sources.dump_lexer import Lexer
from caseflow.streaming.dump_stream import BANK


def write(path, lines):
    path.mkdir()
    (path / "dump.sql").write_text("\n".join(lines) + "\n")
    return str(path)


def batches(seed):
    """A dump with wrapped tuples, odd texts and wrong headers, and the rows
    of its tables."""
    r = random.Random(seed)
    lines, nodes, txns, bad = ["-- the bank's dump", "CREATE TABLE customer_nodes (", "  customer_id INTEGER,",
                               "  end_date DATE", ");", ""], [], [], []
    day = dt.date(2019, 4, 5)
    for b in range(12):
        of_nodes = b % 3 == 0
        if of_nodes and b % 2:
            lines += ["INSERT INTO dbo.[customer_nodes]", "  (end_date, node_id,", "   region_id, customer_id, start_date)",
                      "VALUES"]
        elif b % 4 == 2:
            lines += ["INSERT INTO customer_transactions (customer_id, txn_date, txn_type, txn_amount) VALUES"]
        else:
            lines += ["INSERT INTO customer_nodes", "  (customer_id, region_id, node_id, start_date, end_date)", "VALUES"]
        for k in range(r.randint(1, 30)):
            i = 1000 * b + k
            if of_nodes:
                f = [str(i), "3", str(k), f"'{day}'", f"'{day}'"]
                nodes.append((i, 3, k, day, day))
                f = [f[4], f[2], f[1], f[0], f[3]] if b % 2 else f
            else:
                text = r.choice(["plain", "it's", "a, b (c", "two\nlines", "x\n\ny -- no note", "), ('", "VALUES"])
                f = [f"'{i}'", f"'{day}'", "'" + text.replace("'", "''") + "'", r.choice(["NULL", "'7'"])]
                txns.append((i, day, text, None if f[3] == "NULL" else 7))
            gap = r.choice([", ", ", ", ",\n     ", " ,\n\t"])
            lines += f"  ({gap.join(f)}){r.choice([',', ',', ', -- it is noted', ''])}".split("\n")
        if b % 5 == 1:
            bad.append(f"  ('{b}, 'open', 3)")
            lines.append(bad[-1])
        if b % 5 == 3:
            lines[-1] += ";"
    return lines, nodes, txns, bad


def expected(out, nodes, txns, bad):
    got = {n: [tuple(x) for x in df.collect()] for n, df in out.items()}
    assert sorted(got["customer_nodes"], key=repr) == sorted(nodes, key=repr)
    assert sorted(got["customer_transactions"], key=repr) == sorted(txns, key=repr)
    assert sorted(got["_quarantine"]) == sorted((x, "unparsed line") for x in bad)


def test_splits_may_be_anywhere(spark):
    """Borders after any line, between any two of them, several splits a task."""
    rows, want = [], ([], [], [])
    for f, most in enumerate((1, 2, 3, 7, 40, 10_000)):
        lines, *found = batches(f)
        for all_of, some in zip(want, found, strict=True):
            all_of += some
        r, block, n = random.Random(f), 0, 1
        for line in lines:
            rows.append((f"file{f}", block, line))
            n -= 1
            if not n:
                block, n = block + 10, r.randint(1, most)
    df = spark.createDataFrame(rows, "file string, block long, value string").coalesce(1)
    expected(load_dump(df, BANK), *want)


def test_a_file_in_several_splits(spark, tmp_path):
    keys = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    old = [spark.conf.get(k) for k in keys]
    lines, *want = batches(3000)
    spark.conf.set(keys[0], "2500")
    spark.conf.set(keys[1], "1")
    try:
        assert spark.read.text(path := write(tmp_path / "d", lines)).rdd.getNumPartitions() > 2
        expected(read_dump(spark, path, BANK), *want)
    finally:
        for k, v in zip(keys, old, strict=True):
            spark.conf.set(k, v)


def test_tables_of_one_width_go_by_header_then_types(spark, tmp_path):
    lines = ["INSERT INTO sales VALUES ('A', '2021-03-01', 1);", "INSERT INTO menu (product_id, product_name, price)",
             "VALUES", " (1, 'soup', 4),", " ('B', '2021-03-02', 2),", " (2, 'rice', 5);",
             "INSERT INTO menu (price, product_id) VALUES (9, 3);", "INSERT INTO menu (price, size) VALUES (9, 3);",
             "INSERT INTO other VALUES (1, 'x', 2);", "INSERT INTO sales VALUES ('7', 'x', 'y');"]
    tables = {n: schemas.BY_NAME[n] for n in ("sales", "menu", "members")}
    out = read_dump(spark, write(tmp_path / "d", lines), tables)
    d = dt.date
    assert sorted(map(tuple, out["sales"].collect())) == [("A", d(2021, 3, 1), 1), ("B", d(2021, 3, 2), 2)]
    assert sorted(map(tuple, out["menu"].collect()), key=repr) == [(1, "soup", 4), (2, "rice", 5), (3, None, 9)]
    assert sorted(map(tuple, out["_quarantine"].collect())) == [
        ("INSERT INTO menu (price, size) VALUES (9, 3);", "cast failed for members"),
        ("INSERT INTO other VALUES (1, 'x', 2);", "unknown table other"),
        ("INSERT INTO sales VALUES ('7', 'x', 'y');", "cast failed for sales")]


def test_all_declared_tables_load_and_ambiguous_tuples_do_not(spark):
    lines = ["(1, 'a text')", "INSERT INTO regions VALUES (5, 'north');", "INSERT INTO pizza_names VALUES (6, 'round');"]
    out = load_dump(spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1))
    assert out["regions"].collect() == [(5, "north")] and out["pizza_names"].collect() == [(6, "round")]
    (line, reason), = out["_quarantine"].collect()
    assert line == "(1, 'a text')" and reason.startswith("fits several tables: ")


def test_written_dump_reads_back(spark, tmp_path):
    rows = [(i, "it's\n(" if i % 3 else None, dt.datetime(2020, 1, 2, 3, 4, i % 60), i * 2) for i in range(100)]
    df = spark.createDataFrame(rows, "a int, b string, c timestamp_ntz, d long")
    dump_lines(df, ["t", "other"], ["d", "c", "b", "a"], batch=7, wrap=df.a % 2 == 0).write.text(str(tmp_path / "w"))
    out = read_dump(spark, str(tmp_path / "w"), {"t": df.schema, "other": df.schema})
    got = [tuple(x) for n in ("t", "other") for x in out[n].collect()]
    assert sorted(got, key=repr) == sorted(rows, key=repr) and out["_quarantine"].count() == 0


def test_empty_and_unreadable(spark, tmp_path):
    out = read_dump(spark, write(tmp_path / "d", ["", "-- nothing"]), BANK)
    assert all(df.count() == 0 for df in out.values())
    out = read_dump(spark, write(tmp_path / "e", ["INSERT INTO regions VALUES (1, 'never", "closed"]), BANK)
    assert sorted(r.line for r in out["_quarantine"].collect()) == ["INSERT INTO regions VALUES (1, 'never", "closed"]


def test_lexer_holds_one_run():
    lexer = Lexer("t")
    assert list(lexer.line("(1,")) == [] and lexer.run == ["(1,"]
    assert list(lexer.line("2)")) == [(["1", "2"], "(1,\n2)", "t", None)] and lexer.run == []
    two = "INSERT INTO a VALUES (1); INSERT INTO b (x) VALUES (2);"
    assert [x[2:] for x in lexer.line(two)] == [("a", None), ("b", ["x"])]
