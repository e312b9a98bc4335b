"""Distributed loader for ``INSERT ... VALUES`` dumps.

A dump holds several batches per table; some batches carry the header of
another table, and a tuple may be wrapped over lines.  The files are read as
text, any number of them, cut into splits anywhere:

1. *Parse.*  Each task reads the lines of its splits once (``dump_lexer``) and
   gives tuples with the header they stand under.  What a split can't know goes
   into one small row: its lines before the first sure border, the lines of a
   run that is open at its end, and its last header.
2. *Borders.*  These rows meet by file.  Lines of either side of a split border
   are parsed together; a prefix "last header" over the splits of a file gives
   the header to tuples whose split had none yet.
3. *Routes.*  A tuple goes to the table of its header if its values fit the
   declared types (by the header's column list, if it has one).  A tuple that
   doesn't fit there goes to the one declared table that it fits by width and
   types.  All others, and lines that can't be parsed, are quarantined with the
   reason.

Tuples whose header stands in their own split are routed as they are parsed;
the rows are written once to the shared folder, so that tables and quarantine
come from one parse.  Only tuples before a split's first header and around
borders are routed afterwards.  A line of text is never cut by the reader, so
tuples on one line are one task's.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator, Mapping
from itertools import accumulate, repeat

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow import schemas
from caseflow.session import ensure_checkpoint_dir, ship_package
from caseflow.sources.dump_lexer import Lexer, sure_border

QUARANTINE = "_quarantine"
BATCH = 5_000
_STRINGS = pa.list_(pa.string())
_PARSED = pa.schema([
    ("kind", pa.string()), ("file", pa.string()), ("block", pa.int64()), ("table", pa.string()),
    ("columns", _STRINGS), ("vals", _STRINGS), ("line", pa.string()), ("head", _STRINGS),
    ("tail", _STRINGS), ("whole", pa.bool_()), ("listing", pa.bool_()), ("other", pa.bool_())])
PARSED = ("kind string, file string, block bigint, table string, columns array<string>, vals array<string>, "
          "line string, head array<string>, tail array<string>, whole boolean, listing boolean, other boolean")

Tables = Mapping[str, T.StructType]


def dump_text(lines: DataFrame) -> DataFrame:
    """(value, file, block) of a text reader's lines, batch or stream."""
    return lines.select("value", F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_block_start").alias("block"))


def placed(lines: DataFrame, col: str = "value") -> DataFrame:
    """Lines with the file and split they come from; lines that come from no
    file are one text in the order of their partitions."""
    if {"file", "block"} <= set(lines.columns):
        return lines.select("file", "block", F.col(col).alias("value"))
    return lines.select(F.lit("").alias("file"), F.spark_partition_id().cast("bigint").alias("block"),
                        F.col(col).alias("value"))


class _Rows:
    """Rows of the parse, a batch at a time; tuples column by column."""

    def __init__(self):
        self.rows: list[dict] = []
        self._clear()

    def _clear(self) -> None:
        self.file, self.block, self.header, self.flat, self.sizes, self.line = [], [], [], [], [], []
        self.headers: dict[tuple, int] = {}

    def __len__(self) -> int:
        return len(self.rows) + len(self.line)

    def tuples(self, file: str, block: int, got: Iterator[tuple]) -> None:
        for vals, line, table, columns in got:
            key = (table, columns and tuple(columns))
            self.header.append(self.headers.setdefault(key, len(self.headers)))
            self.file.append(file)
            self.block.append(block)
            self.line.append(line)
            self.sizes.append(None if vals is None else len(vals))
            self.flat += vals or ()

    def take(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            rows, self.rows = self.rows, []
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.get(f.name) for r in rows], f.type) for f in _PARSED], schema=_PARSED)
        n, bad = len(self.line), [x is None for x in self.sizes]
        header = pa.array(self.header, pa.int32())
        offsets = list(accumulate((x or 0 for x in self.sizes), initial=0))
        vals = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(self.flat, pa.string()),
                                        mask=pa.array(bad, pa.bool_()) if any(bad) else None)
        known = {
            "kind": pa.array(["bad" if x else "tuple" for x in bad], pa.string()),
            "file": pa.array(self.file, pa.string()), "block": pa.array(self.block, pa.int64()),
            "table": pa.array([h[0] for h in self.headers], pa.string()).take(header),
            "columns": pa.array([h[1] for h in self.headers], _STRINGS).take(header),
            "vals": vals, "line": pa.array(self.line, pa.string())}
        self._clear()
        yield pa.RecordBatch.from_arrays(
            [known[f.name] if f.name in known else pa.nulls(n, f.type) for f in _PARSED], schema=_PARSED)


def _cells(col: pa.Array) -> Iterable:
    """The values of a column that mostly holds a single one."""
    one = col[0].as_py() if len(col) else None
    if one is not None and not col.null_count and pc.all(pc.equal(col, col[0])).as_py():
        return repeat(one, len(col))
    return col.to_pylist()


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tuples of whole splits, and one row for each split."""
    out, key, lexer, head, before, inside = _Rows(), None, None, [], None, False

    def split_row():
        file, block = key
        out.rows.append({"kind": "split", "file": file, "block": block, "table": lexer.table,
                         "columns": lexer.columns, "head": head, "tail": lexer.run, "whole": not inside,
                         "listing": lexer._listing, "other": lexer._other})

    for b in batches:
        for file, block, line in zip(*(_cells(b.column(c)) for c in ("file", "block", "value")), strict=True):
            if (file, block) != key:
                if key is not None:
                    split_row()
                # the start of a file is a sure border
                key, lexer, head, before, inside = (file, block), Lexer(), [], "", not block
            if line is None:
                continue
            if "\r" in line:
                line = line.replace("\r", "")
            inside = inside or sure_border(before, line)
            if inside:
                out.tuples(file, block, lexer.line(line))
            else:
                head.append(line)
            before = line
            if len(out) >= BATCH:
                yield from out.take()
    if key is not None:
        split_row()
    yield from out.take()


def _parse_border(key: tuple[pa.Scalar, ...], lines: pa.Table) -> pa.Table:
    """Tuples of the lines around one split border, and the header after it."""
    rows = sorted(lines.to_pylist(), key=lambda r: r["block"])
    file, block = rows[-1]["file"], rows[-1]["block"]
    out, lexer = _Rows(), Lexer(_listing=bool(rows[0]["listing"]), _other=bool(rows[0]["other"]))
    for r in rows:
        for line in r["lines"]:
            out.tuples(file, block, lexer.line(line))
    out.tuples(file, block, lexer.end())
    if lexer.table or lexer.columns:
        out.rows.append({"kind": "split", "file": file, "block": block, "table": lexer.table,
                         "columns": lexer.columns})
    return pa.Table.from_batches(list(out.take()))


def _stored(df: DataFrame, name: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/caseflow_dumps/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parse_dump(lines: DataFrame, col: str = "value") -> DataFrame:
    """(table, columns, vals, line) of every tuple, with the header it stands
    under (null: none), and rows with null ``vals`` for lines that can't be
    parsed."""
    ship_package(lines.sparkSession)
    parsed = _stored(placed(lines, col).mapInArrow(_parse, PARSED), "parsed")
    known = parsed.filter("kind <> 'split' AND table IS NOT NULL").select("table", "columns", "vals", "line")
    return known.unionByName(_across_borders(parsed))


def _across_borders(parsed: DataFrame) -> DataFrame:
    """(table, columns, vals, line) of the tuples around split borders, and of
    those before the first header of their split."""
    splits = parsed.filter("kind = 'split'")
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # the last split before that has a sure border: where this split's first run may have begun
    known = F.when(~F.col("whole"), F.struct("block", "listing", "other"))
    splits = splits.withColumn("__of", F.last(known, ignorenulls=True).over(before))
    heads = splits.filter(F.size("head") > 0).select(
        "file", F.coalesce("__of.block", F.lit(-1)).alias("chain"), "block", F.col("head").alias("lines"),
        F.col("__of.listing").alias("listing"), F.col("__of.other").alias("other"))
    tails = splits.filter(F.size("tail") > 0).select(
        "file", F.col("block").alias("chain"), "block", F.col("tail").alias("lines"), "listing", "other")
    borders = _stored(heads.unionByName(tails).groupBy("file", "chain").applyInArrow(_parse_border, PARSED), "borders")

    def header(table: str, columns: str) -> Column:
        return F.when(F.col(table).isNotNull() | F.col(columns).isNotNull(),
                      F.struct(F.col(table).alias("table"), F.col(columns).alias("columns")))

    found = borders.filter("kind = 'split'").select("file", "block", header("table", "columns").alias("__border"))
    events = (splits.select("file", "block", header("table", "columns").alias("__own"))
              .join(found, ["file", "block"], "left"))
    event = F.coalesce("__own", "__border")
    # a column list that a border parts from its INSERT has no table by itself
    events = events.withColumn("__before", F.struct(
        F.last(event["table"], ignorenulls=True).over(before).alias("table"),
        F.last(event, ignorenulls=True).over(before)["columns"].alias("columns")))
    border, of = F.col("__border"), F.col("__before")
    after = F.when(border.isNotNull(), F.struct(F.coalesce(border["table"], of["table"]).alias("table"),
                                                border["columns"].alias("columns"))).otherwise(of)
    events = events.select("file", "block", "__before", after.alias("__after"))
    # one row for each split, of which the driver's list of files has more
    headers = F.broadcast(events)

    def resolved(rows: DataFrame, which: str) -> DataFrame:
        of = F.col(which)
        j = rows.filter("kind <> 'split'").join(headers, ["file", "block"], "left")
        own = F.col("table").isNotNull()
        return j.select(F.coalesce("table", of["table"]).alias("table"),
                        F.when(own | F.col("columns").isNotNull(), F.col("columns"))
                         .otherwise(of["columns"]).alias("columns"), "vals", "line")

    return resolved(parsed.filter("table IS NULL"), "__after").unionByName(resolved(borders, "__before"))


def _fits(values: list[Column], schema: T.StructType) -> Column:
    """Whether all values are NULL or cast to the declared types."""
    out = F.lit(True)
    for v, f in zip(values, schema.fields, strict=True):
        if not isinstance(f.dataType, T.StringType):
            out = out & (v.isNull() | F.trim(v).try_cast(f.dataType).isNotNull())
    return out


def _by_place(schema: T.StructType) -> list[Column]:
    return [F.get(F.col("vals"), i) for i in range(len(schema.fields))]


def _by_header(schema: T.StructType) -> list[Column]:
    """Values by the header's column list; columns that it lacks are NULL."""
    named = F.map_from_arrays("columns", "vals")
    return [F.when(F.col("in_order"), p).otherwise(F.try_element_at(named, F.lit(f.name.lower())))
            for p, f in zip(_by_place(schema), schema.fields, strict=True)]


def _worked_out(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with more columns, worked out once: the optimizer neither copies
    their expressions into later ones nor moves filters on them below (a
    one-element explode stands between)."""
    one = F.explode(F.array(F.struct(*[c.alias(n) for n, c in columns.items()])))
    return df.select("*", one.alias("__x")).select("*", "__x.*").drop("__x")


def route(tuples: DataFrame, tables: Tables) -> DataFrame:
    """``tuples`` with ``route`` (the table a tuple goes to) or ``reason``, and
    ``in_order``: its values are in the order of the declared columns; other
    columns pass through."""
    names = {name: F.array(*[F.lit(f.name.lower()) for f in s.fields]) for name, s in tables.items()}
    width, table, columns = F.col("width"), F.col("table"), F.col("columns")
    # a header's column list counts for its own table, if it has all names right
    listed, order = F.lit(False), F.lit(False)
    for name in tables:
        own = table == F.lit(name)
        order = F.when(own, columns == names[name]).otherwise(order)
        listed = F.when(own, (F.size(columns) == F.size("vals")) & (F.size(F.array_distinct(columns)) == F.size("vals"))
                        & (F.size(F.array_except(columns, names[name])) == 0)).otherwise(listed)
    t = _worked_out(tuples, width=F.when(F.col("vals").isNotNull(), F.size("vals")),
                    in_order=F.coalesce(columns.isNull() | order, F.lit(False)),
                    listed=F.coalesce(listed, F.lit(False)))
    own, able, wide = F.lit(None).cast("string"), [], []
    for name, s in tables.items():
        n = len(s.fields)
        place = (width == n) & _fits(_by_place(s), s)
        named = F.when(F.col("in_order"), place).otherwise(F.col("listed") & _fits(_by_header(s), s))
        own = F.when(table == F.lit(name), F.when(named, F.lit(name))).otherwise(own)
        able.append(F.when(place, F.lit(name)))
        wide.append(F.when(width == n, F.lit(name)))
    t = _worked_out(t, own=own)
    known = table.isNull() | table.isin(list(tables))
    asked = F.col("own").isNull() & known & width.isNotNull()
    t = _worked_out(t, able=F.when(asked, F.array_compact(F.array(*able))),
                    wide=F.when(F.col("own").isNull(), F.array_compact(F.array(*wide))))
    reason = (F.when(width.isNull(), F.lit("unparsed line"))
              .when(~known, F.concat(F.lit("unknown table "), table))
              .when(F.size("able") > 1, F.concat(F.lit("fits several tables: "), F.array_join("able", ", ")))
              .when(F.array_contains("wide", table), F.concat(F.lit("cast failed for "), table))
              .when(F.size("wide") == 0, F.lit("unknown tuple width"))
              .when(F.size("wide") == 1, F.concat(F.lit("cast failed for "), F.get(F.col("wide"), 0)))
              .otherwise(F.lit("cast failed for all tables of its width")))
    t = _worked_out(t, route=F.coalesce("own", F.when(F.size("able") == 1, F.get(F.col("able"), 0))))
    # a tuple that goes by its types has its values in that table's order
    return t.select(*tuples.columns, F.when(F.col("own").isNull(), F.lit(True)).otherwise(F.col("in_order"))
                    .alias("in_order"), "route", F.when(F.col("route").isNull(), reason).alias("reason"))


def routed_dump(lines: DataFrame, tables: Tables, col: str = "value") -> DataFrame:
    """(vals, columns, in_order, line, route, reason) of every tuple, read from
    what one parse has written; a routed tuple needs its text no more."""
    ship_package(lines.sparkSession)

    def text_of(rejected: Column) -> dict[str, Column]:
        return {"line": F.when(rejected, F.col("line"))}

    out = ["vals", "columns", "in_order", "line", "route", "reason"]
    rows = route(placed(lines, col).mapInArrow(_parse, PARSED), tables)
    rows = _stored(rows.withColumns(text_of(F.col("table").isNull() | F.col("route").isNull())), "parsed")
    late = route(_across_borders(rows.drop("in_order", "route", "reason")), tables)
    late = _stored(late.withColumns(text_of(F.col("route").isNull())).select(*out), "late")
    return rows.filter("kind <> 'split' AND table IS NOT NULL").select(*out).unionByName(late)


def table_rows(routed: DataFrame, name: str, schema: T.StructType) -> DataFrame:
    """The typed rows of one table."""
    own = routed.filter(F.col("route") == name)
    return own.select(*[
        (v if isinstance(f.dataType, T.StringType) else F.trim(v).try_cast(f.dataType)).alias(f.name)
        for v, f in zip(_by_header(schema), schema.fields, strict=True)])


def _tables(tables) -> Tables:
    """Tables by name; also from tuple width -> (name, schema)."""
    return {v[0]: v[1] for v in tables.values()} if tables and all(isinstance(k, int) for k in tables) else tables


def load_dump(lines: DataFrame, tables: Tables = schemas.BY_NAME, col: str = "value") -> dict[str, DataFrame]:
    """``{table: rows, "_quarantine": DataFrame(line, reason)}`` from lines of a
    dump; one parse for all of them."""
    tables = _tables(tables)
    # tables and quarantine read what is routed once
    routed = routed_dump(lines, tables, col)
    out = {name: table_rows(routed, name, s) for name, s in tables.items()}
    out[QUARANTINE] = routed.filter("route IS NULL").select("line", "reason")
    return out


def read_dump(spark: SparkSession, paths: str | list[str], tables: Tables = schemas.BY_NAME) -> dict[str, DataFrame]:
    """:func:`load_dump` over dump files."""
    return load_dump(dump_text(spark.read.text(paths)), tables)
