"""Operator 8: line dedup by a log-template tree.

A line's place in the tree has a fixed depth: its number of tokens, then its
``DEPTH`` leading tokens, where a token with a digit stands for any such token.
A leaf holds any number of templates.

*Identical lines* found in ``SAME_DOCS`` documents, the fewest that recur, are
templates without wildcards, and settled by counts alone.  So of documents that
are copies of each other no line stays: they are dropped before, if at all.
*Wildcards.*  The other lines of a leaf are its seeds.  A seed's neighbours are
the leaf's lines that share at least ``FIXED`` of their tokens with it, place
by place.  Each neighbours' document has one vote for each place and token: a
place gets the token that at least half of the documents have there, or a
wildcard.  The vote is taken by all neighbours, by those that share ``LIKE`` of
their tokens, and by those that no template holds yet, so a common line does
not outvote a rarer one.  A template needs ``FIXED`` of its places fixed; lines
of at most ``DEPTH`` tokens, which the tree describes in full, need one.  A line
belongs to a template if it has at least ``LIKE`` of the fixed tokens.
Templates whose lines come from ``MIN_DOCS`` documents (one more, as two lines
may be alike by chance) are dropped from all texts.  Lines that a template holds are no seeds; the vote is repeated, with
``MORE`` times as many seeds of a leaf at once, until no seed is left.

Everything is DataFrame code; counts combine before each shuffle.  A leaf's
lines are compared to its seeds, so a leaf with many lines that belong to no
template costs their number squared.

Defined results: a null text counts as empty; lines end at \\n; lines without
tokens are never dropped; a line repeated in one document counts as one
document.  Rows that repeat an id are one document for the counts, and each
loses its own lines; a row with a null id loses none.  An empty
table gives an empty result.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseflow.llm.common import WORD, documents, stored, whole_text

DEPTH = 4
SAME_DOCS = 2
MIN_DOCS = 3
LIKE = 0.7
FIXED = 0.5
MORE = 8
ANY = "<*>"


def _equal(a: str, b: str) -> Column:
    """In how many places two token lists have the same token."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x))


def _templates(found: DataFrame, seeds: DataFrame, depth: int, like: float, fixed: float) -> DataFrame:
    """(leaf, template) that the neighbours of each seed vote for; a wildcard
    is null."""
    size = F.size("tokens")
    near = found.join(seeds, "leaf").withColumn("same", _equal("tokens", "want"))
    near = near.filter((F.col("same") >= size * fixed) | (size <= depth)).select(
        "leaf", "seed", "doc_id", "tokens", F.lit(1).alias("v0"),
        (F.col("same") >= size * like).cast("int").alias("v1"), F.col("open").cast("int").alias("v2"))
    votes = ["v0", "v1", "v2"]

    def by_document(rows: DataFrame, *keys: str) -> DataFrame:
        once = rows.groupBy(*keys, "doc_id").agg(*[F.max(v).alias(v) for v in votes])
        return once.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in votes])

    voters = by_document(near, "leaf", "seed").select("leaf", "seed", *[F.col(v).alias("of_" + v) for v in votes])
    held = by_document(near.select("leaf", "seed", "doc_id", *votes, F.posexplode("tokens").alias("at", "token")),
                       "leaf", "seed", "at", "token")
    held = held.groupBy("leaf", "seed", "at").agg(*[F.max(F.struct(v, "token")).alias(v) for v in votes])
    held = held.join(voters, ["leaf", "seed"]).select("leaf", "seed", "at", *[
        F.when(F.col(f"{v}.{v}") * 2 >= F.col("of_" + v), F.col(f"{v}.token")).alias(v) for v in votes])
    places = F.array_sort(F.collect_list(F.struct("at", *votes)))
    voted = held.groupBy("leaf", "seed").agg(places.alias("places"))
    lists = F.array(*[F.col("places")[v] for v in votes])
    voted = voted.select("leaf", F.explode(F.array_distinct(lists)).alias("template")).distinct()
    known = F.size(F.filter("template", lambda t: t.isNotNull()))
    size = F.size("template")
    return voted.withColumn("known", known).filter(
        (F.col("known") > 0) & ((F.col("known") >= size * fixed) | (size <= depth)))


def row_key() -> Column:
    return F.xxhash64(whole_text())


def dropped_lines(docs: DataFrame, depth: int = DEPTH, min_docs: int = MIN_DOCS, like: float = LIKE,
                  fixed: float = FIXED, same_docs: int = SAME_DOCS) -> DataFrame:
    """(doc_id, row, line_no) of the lines of recurring templates; ``row`` tells
    texts of one id apart."""
    lines = docs.select("doc_id", row_key().alias("row"), F.posexplode(F.split(whole_text(), "\n", -1)).alias("line_no", "line"))
    tokens = F.regexp_extract_all(F.col("line"), F.lit(WORD), F.lit(0))
    lines = lines.withColumn("tokens", tokens).filter(F.size("tokens") > 0)
    lead = F.transform(F.slice("tokens", 1, depth),
                       lambda t: F.when(t.rlike("[0-9]"), F.lit(ANY)).otherwise(t))
    lines = lines.select("doc_id", "row", "line_no", "line", F.xxhash64(F.size("tokens"), lead).alias("leaf"),
                         F.xxhash64("tokens").alias("key"))

    def in_documents(rows: DataFrame, *keys: str) -> DataFrame:
        once = rows.groupBy(*keys, "doc_id").agg(F.lit(1).alias("c"))
        return once.groupBy(*keys).agg(F.count(F.lit(1)).alias("docs"))

    # with the lines' text, so that no line is cut into tokens here again
    placed = stored(lines, "line_places")
    counts = stored(in_documents(placed, "leaf", "key"), "line_counts")
    gone = counts.filter(F.col("docs") >= same_docs).select("leaf", "key")

    # leaves where other lines may form a template: no document counts twice for one line
    often = counts.groupBy("leaf").agg(F.sum("docs").alias("most"), F.min("docs").alias("least"),
                                       F.count(F.lit(1)).alias("n"))
    often = often.filter((F.col("most") >= min_docs) & (F.col("least") < same_docs) & (F.col("n") > 1))
    # lines travel as text, which is smaller than their tokens
    found = (placed.select("leaf", "key", "doc_id", "line").join(often.select("leaf"), "leaf", "left_semi")
             .groupBy("leaf", "key", "doc_id").agg(F.first("line").alias("line")))
    found = found.join(counts, ["leaf", "key"]).select(
        "leaf", "key", "doc_id", F.regexp_extract_all("line", F.lit(WORD), F.lit(0)).alias("tokens"),
        (F.col("docs") < same_docs).alias("open"))
    found = stored(found, "line_candidates")
    pool = found.filter("open").select("leaf", "key", "tokens").dropDuplicates(["leaf", "key"])
    pool = stored(pool, "line_seeds")
    at_once = 1
    while not pool.isEmpty():
        turn = Window.partitionBy("leaf").orderBy("key")
        ranked = pool.withColumn("__turn", F.row_number().over(turn))
        seeds = ranked.filter(F.col("__turn") <= at_once).select(
            "leaf", F.col("key").alias("seed"), F.col("tokens").alias("want"))
        seeds = stored(seeds, "line_seeds_now")
        template = stored(_templates(found, seeds, depth, like, fixed), "line_templates")
        member = (found.join(template, "leaf").filter(_equal("tokens", "template") >= F.col("known") * like)
                  .select("leaf", "key", "doc_id", "template"))
        member = stored(member.withColumn("template", F.xxhash64("template", F.transform(
            "template", lambda t: t.isNull()))), "line_members")
        recurring = in_documents(member, "leaf", "template").filter(F.col("docs") >= min_docs)
        new = stored(member.join(recurring, ["leaf", "template"], "left_semi")
                     .select("leaf", "key").distinct(), "line_gone")
        gone = gone.union(new)
        tried = seeds.select("leaf", F.col("seed").alias("key"))
        pool = stored(pool.join(tried.union(new).distinct(), ["leaf", "key"], "left_anti"), "line_seeds")
        held = new.withColumn("__held", F.lit(True))
        found = (found.join(pool.select("leaf").distinct(), "leaf", "left_semi")
                 .join(held, ["leaf", "key"], "left")
                 .withColumn("open", F.col("open") & F.col("__held").isNull()).drop("__held"))
        found = stored(found, "line_candidates")
        at_once *= MORE
    gone = stored(gone.distinct(), "line_gone")
    return placed.join(gone, ["leaf", "key"]).select("doc_id", "row", "line_no")


def drop_lines(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, text, n_lines, n_dropped) of every row, without the lines of
    recurring templates."""
    gone = (dropped_lines(docs, **options).groupBy("doc_id", "row")
            .agg(F.collect_set("line_no").alias("__gone")))
    lines = F.split(whole_text(), "\n", -1)
    rows = docs.select("doc_id", "text", row_key().alias("row")).join(gone.hint("merge"), ["doc_id", "row"], "left")
    rows = rows.select("doc_id", lines.alias("lines"),
                       F.coalesce("__gone", F.array().cast("array<int>")).alias("gone"))
    kept = F.filter("lines", lambda x, i: ~F.array_contains(F.col("gone"), i))
    return rows.select("doc_id", F.array_join(kept, "\n").alias("text"),
                       F.size("lines").cast("bigint").alias("n_lines"),
                       F.size("gone").cast("bigint").alias("n_dropped"))


def op8_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = drop_lines(documents(spark, sf_dir))
    return got.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
