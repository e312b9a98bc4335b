"""Tables written as ``INSERT ... VALUES`` dump files, and the dumps of the
stand-in tables that the load jobs read back."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.session import ensure_checkpoint_dir
from caseflow.sources import standins as si
from caseflow.sources.dump import Tables, dump_text, routed_dump, table_rows

BATCH_ROWS = 5_000
WRAP_EVERY = 7  # of the tuples that may be wrapped


def literal(col: str, kind: T.DataType) -> Column:
    """A value as SQL text: quoted, quotes doubled, times in a CAST, or NULL."""
    text = F.concat(F.lit("'"), F.replace(F.col(col).cast("string"), F.lit("'"), F.lit("''")), F.lit("'"))
    if isinstance(kind, T.TimestampNTZType | T.TimestampType):
        text = F.concat(F.lit("CAST("), text, F.lit(" AS DATETIME)"))
    return F.coalesce(text, F.lit("NULL"))


def dump_lines(df: DataFrame, headers: Sequence[str], columns: Sequence[str] | None = None,
               batch: int = BATCH_ROWS, wrap: Column | None = None) -> DataFrame:
    """``value``: the rows of ``df`` as dump text, for a text writer.  Each file
    has batches of ``batch`` tuples, headed by ``headers`` in turn; the column
    list is ``columns`` (default: all).  Tuples where ``wrap`` holds go on in a
    second line."""
    columns = list(columns or df.columns)
    fields = [literal(c, df.schema[c].dataType) for c in columns]
    gap = F.when(wrap, F.lit(",\n   ")).otherwise(F.lit(", ")) if wrap is not None else F.lit(", ")
    parts: list[Column] = []
    for k, f in enumerate(fields):
        parts += [f] if not k else [gap if k == 2 else F.lit(", "), f]
    # the place of a row in its file, fixed as the row is written
    rows = df.select(F.concat(F.lit("  ("), *parts, F.lit(")")).alias("t"),
                     F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("n"))
    names = F.lit("  (" + ", ".join(columns) + ")")
    turn = F.floor(F.col("n") / batch) % len(headers)
    into = F.get(F.array(*[F.lit(h) for h in headers]), turn.cast("int"))
    head = F.concat(F.lit("INSERT INTO "), into, F.lit("\n"), names, F.lit("\nVALUES\n"))
    return rows.select(F.concat(
        F.when(F.col("n") % batch == 0, head).otherwise(F.lit("")), "t",
        F.when(F.col("n") % batch == batch - 1, F.lit(";")).otherwise(F.lit(","))).alias("value"))


def _bad_lines(t) -> DataFrame:
    """Lines of a transaction batch that no table takes: a value that is no
    date, too many values, an open quote."""
    key = F.col("o_orderkey").cast("string")
    kind = F.col("o_orderkey") % 300
    line = (F.when(kind == 1, F.concat(F.lit("  ('"), key, F.lit("', 'n/a', 'deposit', '5'),")))
             .when(kind == 101, F.concat(F.lit("  ('"), key, F.lit("', 1, 2, 3, 4, 5, 6),")))
             .when(kind == 201, F.concat(F.lit("  ('"), key, F.lit(", 'open, 5)"))))
    rows = t.orders.select(line.alias("line")).filter("line IS NOT NULL")
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    head = "INSERT INTO customer_transactions\n  (customer_id, txn_date, txn_type, txn_amount)\nVALUES\n"
    return rows.select(F.concat(F.when(first, F.lit(head)).otherwise(F.lit("")), "line").alias("value"))


def write_standin_dump(d: si.Domain, case: str) -> tuple[str, Tables]:
    """Dump files of one case study's stand-in tables, in the shared folder,
    and the declared schemas of its tables."""
    path = f"{ensure_checkpoint_dir(d.spark)}/caseflow_dumps/{case}-{uuid.uuid4().hex[:12]}"

    def put(lines: DataFrame) -> None:
        lines.write.mode("append").option("compression", "none").text(path)

    if case == "restaurant":
        names = ("sales", "menu", "members")
        wrapped = {"sales": F.col("product_id") % WRAP_EVERY == 0}
    elif case == "pizza":
        names = ("runners", "customer_orders", "runner_orders", "pizza_names", "pizza_recipes", "pizza_toppings")
        wrapped = {"customer_orders": F.col("order_id") % WRAP_EVERY == 0}
    elif case == "subscriptions":
        names = ("plans", "subscriptions")
        wrapped = {"subscriptions": F.col("plan_id") == 0}
    else:
        names = ("regions", "customer_nodes", "customer_transactions")
        wrapped = {"customer_transactions": F.col("txn_amount") % WRAP_EVERY == 0}
    tables = {}
    for name in names:
        df = d.lazy(name)  # read this once
        tables[name] = df.schema
        # as in the source, most batches of transactions have the nodes' header;
        # a column list in another order than the table's holds for its batch
        headers = [name] if name != "customer_transactions" else [name, "customer_nodes", "customer_nodes"]
        columns = df.columns[::-1] if name == "runner_orders" else None
        lines = dump_lines(df, headers, columns, wrap=wrapped.get(name))
        if name == "customer_transactions":
            # under the nodes' header the column list is the nodes' as well
            lines = lines.select(F.regexp_replace(
                "value", r"(?s)^(INSERT INTO customer_nodes\n  )\([^)]*\)",
                "$1(" + ", ".join(d.lazy("customer_nodes").columns) + ")").alias("value"))
        put(lines)
    if case == "bank":
        put(_bad_lines(d._t))
    return path, tables


def loaded(d: si.Domain, case: str) -> DataFrame:
    """The routed tuples of one case's dump files, parsed once per application."""

    def build() -> DataFrame:
        path, tables = write_standin_dump(d, case)
        return routed_dump(dump_text(d.spark.read.text(path)), tables)

    return d.once(f"dump_{case}", build)


def load_table(spark: SparkSession, root: str, case: str, name: str) -> DataFrame:
    """One table of a case's dump, typed as declared."""
    d = si.Domain(spark, root)
    return table_rows(loaded(d, case), name, d.lazy(name).schema)


def load_quarantine(spark: SparkSession, root: str, case: str) -> DataFrame:
    """(line, reason) of what no table of a case's dump takes."""
    return loaded(si.Domain(spark, root), case).filter("route IS NULL").select("line", "reason")
