"""Operator 5: mixing sources to target weights by Sainte-Lague apportionment.

1. Targets.  Every source has a weight and a size (words of its documents).
   The mix is to hold as many words as the input; each source's share is in
   proportion to its weight, but at most ``MAX_REPEATS`` times its size, with
   the excess shared again by weight.  That fixed point is
   ``min(cap, level * weight)`` for one common level, read off the sources
   sorted by cap / weight.
2. Quotas.  The target is handed out in blocks of ``BLOCK_WORDS`` words by
   highest quotients target / (2 q + 1).  A source's documents are spread over
   shards by a hash, and the source's blocks are apportioned to its shards in
   the same way, so no task ever orders a whole source.
3. Selection.  In a shard the documents lie end to end in seeded order and are
   cut into blocks.  A quota of n times the shard's blocks takes everything n
   times; the rest is a run of blocks from a seeded start, wrapping around.
   What a document gives then has a closed form: no block becomes a row.

Defined results: a null text has size 0; a null source is a source of its own,
last in order; documents without words are never taken; a source without words
has target 0.  Rows that repeat an id lie in one shard, ordered by id hash and
size, and are counted each.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseflow.llm.common import WORD, documents, stored, whole_text

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
BLOCK_WORDS = 4
SHARD_WORDS = 2_000_000
SEED = 20


def size_of(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("bigint")


def targets(sources: DataFrame, weights=WEIGHTS, repeats: int = MAX_REPEATS) -> DataFrame:
    """(source, source_size) -> adds ``target``.  One row per source goes
    through the two global windows, never a document."""
    byte_order = Window.orderBy(F.col("source").cast("binary").asc_nulls_last())
    cap_order = Window.orderBy("__ratio", "__rank")
    every = Window.partitionBy()
    w = F.array(*[F.lit(float(x)) for x in weights])
    ranked = (sources.withColumn("__rank", F.row_number().over(byte_order) - 1)
              .withColumn("__w", F.element_at(w, (F.col("__rank") % len(weights) + 1).cast("int")))
              .withColumn("__cap", F.col("source_size") * repeats)
              .withColumn("__ratio", F.col("__cap") / F.col("__w"))
              .withColumn("__total", F.sum("source_size").over(every)))
    # level if the sources up to this one are at their caps
    before = cap_order.rowsBetween(Window.unboundedPreceding, -1)
    level = ((F.col("__total") - F.coalesce(F.sum("__cap").over(before), F.lit(0)))
             / (F.sum("__w").over(every) - F.coalesce(F.sum("__w").over(before), F.lit(0.0))))
    leveled = ranked.withColumn("__level", level)
    # the level is the first one that its source's cap can hold
    final = F.min(F.when(F.col("__level") <= F.col("__ratio"), F.struct("__ratio", "__level"))
                  ).over(every)["__level"]
    return (leveled.withColumn("__final", final)
            .withColumn("target", F.least(F.col("__cap").cast("double"),
                                          F.col("__final") * F.col("__w")))
            .select("source", "source_size", "target"))


def apportion(frame: DataFrame, group: list[str], votes: str, most: str, seats: str,
              order: Column, out: str) -> DataFrame:
    """Sainte-Lague: in each ``group`` hand ``seats`` (a column, the same in
    the whole group) out by the highest quotients votes / (2 q + 1), nobody
    getting more than ``most``; ties go by ``order``.

    Rounding votes / divisor gives almost all seats.  The right divisor shifts
    a party by at most 1.5 * parties * share + 2 seats from that, so only those
    quotients are listed and ranked.
    """
    own = Window.partitionBy(*group)
    f = (frame.withColumn("__v", F.col(votes).cast("double"))
         .withColumn("__sum", F.sum("__v").over(own))
         .withColumn("__n", F.count(F.lit(1)).over(own))
         .withColumn("__share", F.when(F.col("__sum") > 0, F.col("__v") / F.col("__sum"))
                     .otherwise(F.lit(0.0)))
         .withColumn("__near", F.round(F.col("__share") * F.col(seats)).cast("bigint"))
         .withColumn("__reach", F.ceil(F.col("__share") * F.col("__n") * 1.5).cast("bigint") + 2)
         .withColumn("__base", F.least(F.greatest(F.col("__near") - F.col("__reach"), F.lit(0)),
                                       F.col(most)))
         .withColumn("__top", F.least(F.col("__near") + F.col("__reach"), F.col(most)))
         .withColumn("__left", F.col(seats) - F.sum("__base").over(own))
         .withColumn("__order", order))
    keys = frame.columns
    tries = f.withColumn("__q", F.explode_outer(F.when(
        (F.col("__top") > F.col("__base")) & (F.col("__v") > 0),
        F.sequence(F.col("__base"), F.col("__top") - 1))))
    best = Window.partitionBy(*group).orderBy(
        (F.col("__v") / (2 * F.col("__q") + 1)).desc_nulls_last(), "__order")
    won = (F.col("__q").isNotNull() & (F.row_number().over(best) <= F.col("__left"))).cast("bigint")
    ranked = tries.withColumn("__won", won)
    return (ranked.groupBy(*keys)
            .agg((F.first("__base") + F.sum("__won")).alias(out)))


def _mixed(docs: DataFrame, weights=WEIGHTS, repeats: int = MAX_REPEATS,
        block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS,
        seed: int = SEED) -> DataFrame:
    """(doc_id, key, source, size, source_size, target, full, spans) of every
    row: how many times the whole text is taken, and the spans of words [lo, hi)
    taken besides, where the run of blocks starts or ends inside it."""
    sized = stored(docs.select("doc_id", F.xxhash64(whole_text()).alias("key"), "source",
                               size_of(whole_text()).alias("size")), "mix_sizes")
    src = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    src = targets(src, weights, repeats).withColumn(
        "__shards", F.ceil(F.col("source_size") / shard_words).cast("bigint"))
    src = (src.withColumn("__most", F.ceil(F.col("source_size") / block_words) * repeats)
           .withColumn("__seats", F.round(F.sum("target").over(Window.partitionBy())
                                          / block_words).cast("bigint"))
           .withColumn("__g", F.lit(0)))
    src = stored(apportion(src, ["__g"], "target", "__most", "__seats",
                           F.col("source").cast("binary"), "__quota"), "mix_sources")

    # ids are hashed once; a shard is a part of one source of bounded size
    small = src.select("source", "source_size", "target", "__shards", "__quota")
    at = F.xxhash64(F.lit(seed), F.col("doc_id"))
    placed = (sized.alias("d").join(small.alias("s"),
                                    F.col("d.source").eqNullSafe(F.col("s.source")))
              .select("d.doc_id", "d.key", "d.source", "d.size", "s.source_size", "s.target", "s.__shards",
                      "s.__quota", at.alias("__at"))
              .withColumn("__shard", F.when(F.col("__shards") > 0, F.pmod(
                  F.xxhash64(F.lit(seed + 1), F.col("doc_id")), F.col("__shards")))
                  .otherwise(F.lit(0)).cast("bigint")))
    shards = (placed.groupBy("source", "__shard", "__quota")
              .agg(F.sum("size").alias("__words")))
    shards = shards.withColumn("__blocks", F.ceil(F.col("__words") / block_words).cast("bigint")) \
                   .withColumn("__cap", F.col("__blocks") * repeats)
    shards = (apportion(shards, ["source"], "__words", "__cap", "__quota", F.col("__shard"),
                        "__part")
              .select(F.col("source").alias("__source"), F.col("__shard").alias("__s"),
                      "__words", "__blocks", "__part"))
    lined = (placed.withColumn("__end", F.sum("size").over(
        Window.partitionBy("source", "__shard").orderBy("__at", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("__start", F.col("__end") - F.col("size")))
    j = lined.join(shards, lined["source"].eqNullSafe(shards["__source"])
                   & (lined["__shard"] == shards["__s"]))
    rest = F.col("__part") % F.col("__blocks")
    start = F.pmod(F.xxhash64(F.lit(seed + 2), F.col("source"), F.col("__shard")),
                   F.col("__blocks"))
    j = (j.withColumn("__full", F.when(F.col("__blocks") > 0, F.floor(
            F.col("__part") / F.col("__blocks"))).otherwise(F.lit(0)).cast("bigint"))
         .withColumn("__from", F.when(F.col("__blocks") > 0, start).otherwise(F.lit(0)))
         .withColumn("__to", F.when(F.col("__blocks") > 0, F.col("__from") + rest)
                     .otherwise(F.lit(0))))

    def span(first: Column, last: Column) -> Column:
        """Words of the document inside blocks [first, last)."""
        lo = F.greatest(F.col("__start"), first * block_words) - F.col("__start")
        hi = F.least(F.col("__end"), last * block_words) - F.col("__start")
        return F.struct(lo.cast("bigint").alias("lo"), hi.cast("bigint").alias("hi"))

    spans = F.filter(F.array(
        span(F.col("__from"), F.least("__to", "__blocks")),
        span(F.lit(0), F.greatest(F.col("__to") - F.col("__blocks"), F.lit(0)))), lambda x: x["hi"] > x["lo"])
    j = j.withColumn("__spans", spans)
    whole = F.size(F.filter("__spans", lambda x: x["hi"] - x["lo"] == F.col("size")))
    return j.select("doc_id", "key", "source", "size", "source_size", "target",
                    (F.col("__full") + whole).cast("bigint").alias("full"),
                    F.filter("__spans", lambda x: x["hi"] - x["lo"] < F.col("size")).alias("spans"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of every row."""
    part = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, x: a + x["hi"] - x["lo"])
    taken = F.when(F.col("size") > 0, F.col("full") * F.col("size") + part).otherwise(F.lit(0))
    return _mixed(docs, **options).select("doc_id", "source", "size", "source_size", "target",
                                          taken.cast("bigint").alias("taken"))


def apply_mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed rows, with the input's columns: a document taken n times gives
    n whole rows, and one row for each span of its words taken besides (with
    their spacing).  Rows equal in id and text are taken together; their rows
    have the other columns of one of them."""
    cols = docs.columns
    per = _mixed(docs, **options).filter("size > 0 AND (full > 0 OR size(spans) > 0)")
    per = per.groupBy(F.col("doc_id").alias("__doc"), F.col("key").alias("__key")).agg(
        F.sum("full").alias("__n"), F.flatten(F.collect_list(F.when(F.size("spans") > 0, F.col("spans")))).alias("__spans"),
        F.count(F.lit(1)).alias("__rows"))
    per = stored(per, "mix_taken")
    keyed = docs.withColumn("__text_key", F.xxhash64(whole_text()))
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__text_key") == F.col("__key"))
    # by shuffle at any size: what a row gives grows with the rows and is no table to send whole
    got = keyed.join(per.hint("merge"), same)
    rows = got.filter("__rows = 1")
    # of rows that repeat id and text, one stands for all
    again = got.filter("__rows > 1").dropDuplicates(["__doc", "__key"])
    rows = rows.unionByName(again)
    whole = F.transform(F.sequence(F.lit(1).cast("bigint"), F.col("__n")),
                        lambda i: F.struct(F.lit(0).cast("bigint").alias("lo"), F.lit(-1).cast("bigint").alias("hi")))
    piece = F.concat(F.when(F.col("__n") > 0, whole).otherwise(F.array().cast("array<struct<lo: bigint, hi: bigint>>")),
                     F.col("__spans"))
    rows = rows.withColumn("__piece", F.explode(piece))
    words = F.regexp_extract_all(whole_text(), F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0))
    cut = F.array_join(F.slice(words, (F.col("__piece.lo") + 1).cast("int"),
                               (F.col("__piece.hi") - F.col("__piece.lo")).cast("int")), "")
    part = F.col("__piece.hi") >= 0
    out = rows.withColumn("__cut", F.when(part, cut))
    changed = {"text": F.coalesce("__cut", "text")}
    if "n_chars" in cols:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(part, F.char_length("__cut").cast(kind)).otherwise(F.col("n_chars"))
    return out.withColumns(changed).select(*cols)


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")
