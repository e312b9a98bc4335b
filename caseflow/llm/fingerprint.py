"""Operator 3: document fingerprints by one-permutation MinHash.

A text's five-word shingles (fewer words: all of them as one shingle) are
hashed once.  The top bits of a hash name its bin; the least hash of each bin
is kept.  An empty bin takes the value of a filled bin: every empty bin visits
all bins in an order of its own, given by a hash of (empty bin, visited bin),
and stops at the first filled one (optimal densification).  Of each bin the
low ``BITS`` bits are stored, and the share of equal bins is corrected for
chance agreement, ``(share - 2^-BITS) / (1 - 2^-BITS)``.

Everything is array expressions inside a row: nothing is exploded.  Hashes are
sorted, so the least hash of a bin is the first of its run.

Defined results: a null text counts as empty; a text without words has the
empty fingerprint, which is like another empty one (1.0) and unlike any other
(0.0); equal texts have equal fingerprints.  Rows that repeat an id follow each
other in the order of their texts; rows with a null id come first.  The next
document of the last is the first; a table of one row is its own next.  An
empty table gives an empty result.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseflow.llm.common import SHINGLE_WORDS, WORD, documents, whole_text

BIN_BITS = 7
BITS = 8
BINS = 1 << BIN_BITS
LOW = (1 << BITS) - 1
BUCKETS_PER_PARTITION = 4


def with_codes(df: DataFrame, text: str, out: str) -> DataFrame:
    """Adds ``out``: the sorted array of ``bin * 2^BITS + low bits``, all bins
    filled, or empty for a text without words."""
    n = SHINGLE_WORDS
    word, hashes, least, codes = (f"__{out}_{x}" for x in ("w", "h", "l", "c"))
    df = df.withColumn(word, F.transform(F.regexp_extract_all(F.col(text), F.lit(WORD), F.lit(0)),
                                         lambda w: F.xxhash64(w)))
    shingle = F.transform(F.sequence(F.lit(0), F.size(word) - n),
                          lambda i: F.xxhash64(*[F.get(F.col(word), i + k) for k in range(n)]))
    df = df.withColumn(hashes, F.sort_array(
        F.when(F.size(word) >= n, shingle)
        .when(F.size(word) > 0, F.array(F.xxhash64(F.col(word))))
        .otherwise(F.array().cast("array<bigint>"))))

    def bin_of(x: Column) -> Column:
        return F.shiftrightunsigned(x, 64 - BIN_BITS)

    df = df.withColumn(least, F.filter(
        F.col(hashes), lambda x, i: (i == 0) | (bin_of(x) != bin_of(F.get(F.col(hashes), i - 1)))))
    df = df.withColumn(codes, F.transform(
        F.col(least), lambda x: F.shiftleft(bin_of(x), BITS).bitwiseOR(x.bitwiseAND(F.lit(LOW)))))
    bins = F.transform(F.col(codes), lambda c: F.shiftright(c, BITS))
    empty = F.array_except(F.sequence(F.lit(0), F.lit(BINS - 1)).cast("array<bigint>"), bins)
    # the visiting order's hash above the visited bin's low bits, in one number
    first = lambda e: F.array_min(F.transform(
        F.col(codes), lambda c: F.xxhash64(e, F.shiftright(c, BITS)).bitwiseAND(F.lit(~LOW))
        .bitwiseOR(c.bitwiseAND(F.lit(LOW)))))
    filled = F.transform(empty, lambda e: F.shiftleft(e, BITS).bitwiseOR(
        first(e).bitwiseAND(F.lit(LOW))))
    df = df.withColumn(out, F.when(F.size(codes) > 0, F.sort_array(F.concat(F.col(codes), filled)))
                       .otherwise(F.col(codes)))
    return df.drop(word, hashes, least, codes)


def packed(codes: str) -> Column:
    """Hexadecimal text of the low bits in bin order."""
    digits = F.array(*[F.lit(f"{x:02x}") for x in range(LOW + 1)])
    return F.array_join(F.transform(F.col(codes), lambda c: F.get(
        digits, c.bitwiseAND(F.lit(LOW)).cast("int"))), "")


def likeness(a: str, b: str) -> Column:
    """Estimated share of common shingles, 0 to 1."""
    chance = 2.0 ** -BITS
    share = F.size(F.array_intersect(F.col(a), F.col(b))) / F.lit(float(BINS))
    est = F.greatest((share - chance) / (1 - chance), F.lit(0.0))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(est)


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) of every row."""
    df = with_codes(docs.select("doc_id", whole_text().alias("text")), "text", "codes")
    return df.select("doc_id", packed("codes").alias("fingerprint"))


def in_order(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, text, __bucket, __ghost): consecutive ids share a bucket,
    and each bucket also holds, as a ghost, the first row of the next one.

    Only ids are read to find the bucket bounds; a bounded number of them (a
    few for each shuffle partition) comes to the driver."""
    spark = docs.sparkSession
    ids = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions")) * BUCKETS_PER_PARTITION
    cuts = sorted(set(ids.agg(F.percentile_approx(
        "doc_id", [i / n for i in range(1, n)], 20 * n)).first()[0] or []))
    cut_list = F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>")
    bucket = F.coalesce(F.size(F.filter(cut_list, lambda c: c <= F.col("doc_id"))), F.lit(0))
    bucket = F.when(F.col("doc_id").isNull(), 0).otherwise(bucket)
    firsts = (ids.groupBy(bucket.alias("b"))
              .agg(F.min("doc_id").alias("lo"), F.count_if(F.col("doc_id").isNull()).alias("nulls"))
              .collect())
    firsts = sorted((r["b"], None if r["nulls"] else r["lo"]) for r in firsts)
    # first id of each bucket -> the bucket before it (the last one for the first)
    before = [(lo, firsts[i - 1][0]) for i, (_, lo) in enumerate(firsts)]
    keys = F.array(*[F.lit(lo) for lo, _ in before if lo is not None]).cast("array<bigint>")
    prior = F.array(*[F.lit(b) for lo, b in before if lo is not None]).cast("array<int>")
    at = F.array_position(keys, F.col("doc_id")).cast("int")
    ghost_in = F.when(at > 0, F.get(prior, at - 1))
    if before and before[0][0] is None:
        ghost_in = F.when(F.col("doc_id").isNull(), F.lit(before[0][1])).otherwise(ghost_in)
    real = F.struct(bucket.cast("int").alias("b"), F.lit(False).alias("g"))
    ghost = F.struct(ghost_in.alias("b"), F.lit(True).alias("g"))
    return (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
            .withColumn("__at", F.explode(F.when(ghost_in.isNotNull(), F.array(real, ghost))
                                          .otherwise(F.array(real))))
            .select("doc_id", "text", F.col("__at.b").alias("__bucket"),
                    F.col("__at.g").alias("__ghost"))
            .repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "__bucket"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = with_codes(in_order(documents(spark, sf_dir)), "text", "codes")
    follow = Window.partitionBy("__bucket").orderBy("__ghost", "doc_id", "text")
    half = F.floor(F.col("n_chars") / 2).cast("int")
    df = (df.withColumns({"next_text": F.lead("text").over(follow),
                          "next_codes": F.lead("codes").over(follow)})
          .filter(~F.col("__ghost"))
          .withColumn("n_chars", F.char_length("text"))
          .withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars") - half),
                                         F.substring(F.col("next_text"), F.lit(1), half))))
    df = with_codes(df, "edited", "edited_codes")
    return df.select(
        "doc_id", F.col("n_chars").cast("bigint").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        packed("codes").alias("fingerprint"), packed("edited_codes").alias("edited_fingerprint"),
        likeness("codes", "edited_codes").alias("near_edited"),
        likeness("codes", "next_codes").alias("near_next"))
