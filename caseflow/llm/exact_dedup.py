"""Operator 7: exact dedup against a persistent digest index.

The index is a table bucketed and sorted by the SHA-256 digest of the text.
A batch is reduced to one entry per digest and written, the entries that the index does
not hold are found by a sort-merge anti-join (the index side is read in its
buckets, without a shuffle) and appended.  Everything is DataFrame code.

Defined results: a null text counts as the empty text, and all empty texts
are equal.  Within a batch the row with the largest ``doc_id`` stays (a null
id is smaller than any); a text that an earlier batch put into the index is
dropped from a later batch, whatever its id.  A batch may have a name; added
again under it, it gets the verdict that it got first.  Rows repeated with the same id
and text get the same verdict, and ``keep_rows`` returns one of them.  An
empty table gives an empty result.  Only ``doc_id`` and ``text`` are read;
other columns pass through ``keep_rows`` untouched.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.llm.common import documents, scratch, stored, whole_text

ENTRY = "digest string, keep_id bigint, group_size bigint, same_id bigint, batch string"
# A digest with more than 1/HOT_PARTS of all rows is joined by broadcast;
# there are fewer than HOT_PARTS such digests at any size.
HOT_PARTS = 500


class DigestIndex:
    """Bucketed, sorted table of digests under ``path``; survives the
    session: open it again with the same path and bucket count."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.table = f"digest_index_{uuid.uuid4().hex[:12]}"
        spark.sql(f"CREATE TABLE {self.table} ({ENTRY}) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS "
                  f"LOCATION '{path}'")

    def entries(self) -> DataFrame:
        return self.spark.table(self.table)

    def new_entries(self, batch: DataFrame) -> DataFrame:
        """Entries of ``batch`` whose digest the index does not hold."""
        return batch.join(self.entries().select("digest").hint("merge"), "digest", "left_anti")

    def append(self, new: DataFrame, batch: str) -> None:
        """Add a batch's entries, one file for each bucket."""
        (new.select("digest", "keep_id", "group_size", "same_id", F.lit(batch).alias("batch"))
         .repartition(self.buckets, "digest")
         .write.mode("append").format("parquet").option("path", self.path)
         .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.table))
        self.spark.catalog.refreshTable(self.table)


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, digest) of every row."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.sha2(whole_text().cast("binary"), 256).alias("digest"))


def batch_entries(ids: DataFrame) -> DataFrame:
    """One entry per digest; counts combine before the shuffle, so a digest
    with a third of all rows is a few partial rows."""
    per_id = ids.groupBy("digest", "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return per_id.groupBy("digest").agg(
        F.max("doc_id").alias("keep_id"), F.sum("n").alias("group_size"),
        F.coalesce(F.max_by("n", "doc_id"), F.max("n")).alias("same_id"))


def resolve(ids: DataFrame, index: DataFrame) -> DataFrame:
    """(doc_id, digest) rows with their index entry.  Very common digests (a
    bounded number) are looked up by broadcast, so that no join task gets
    their rows; the others join the index's buckets."""
    total = index.agg(F.sum("group_size")).first()[0] or 0
    hot = index.filter(F.col("group_size") * HOT_PARTS > F.lit(total))
    few = F.broadcast(hot)
    cold = ids.join(F.broadcast(hot.select("digest")), "digest", "left_anti")
    return ids.join(few, "digest").unionByName(cold.join(index.hint("merge"), "digest"))


def add_batch(docs: DataFrame, index: DigestIndex, batch: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Put a batch into the index; returns each row's verdict (doc_id, digest,
    keep_id, group_size, same_id) and the entries that came with the batch.  A
    batch that the index has under the same name already, as a job that was
    lost after the append is run again, gets its own verdict once more."""
    ids = stored(digests(docs), "digests")
    mine = index.entries().filter(F.col("batch") == batch) if batch else None
    if mine is None or mine.isEmpty():
        # written before the join, so that rows are combined before any shuffle
        entries = stored(batch_entries(ids), "batch_entries")
        mine = stored(index.new_entries(entries), "new_entries")
        index.append(mine, batch or uuid.uuid4().hex)
    return resolve(ids, index.entries()), mine


def keep_rows(docs: DataFrame, index: DigestIndex, batch: str | None = None) -> DataFrame:
    """The rows of a batch that stay, with all their columns."""
    _, new = add_batch(docs, index, batch)
    cols = docs.columns
    marked = docs.withColumns({
        "__id": F.col("doc_id").cast("bigint"),
        "__digest": F.sha2(whole_text().cast("binary"), 256)})
    stay = new.select(F.col("digest").alias("__digest"), F.col("keep_id").alias("__keep"),
                      F.col("same_id").alias("__same"))
    # (digest, id) is all but unique, so no key of this join is hot
    got = marked.join(stay, (marked["__digest"] == stay["__digest"])
                      & marked["__id"].eqNullSafe(stay["__keep"])).drop(stay["__digest"])
    once = got.filter("__same = 1").select(*cols)
    again = got.filter("__same > 1").dropDuplicates(["__digest"]).select(*cols)
    return once.unionByName(again)


def new_index(spark: SparkSession) -> DigestIndex:
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return DigestIndex(spark, scratch(spark, "digest_index"), buckets)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdict, _ = add_batch(documents(spark, sf_dir), new_index(spark))
    return verdict.select("doc_id", "keep_id", "group_size",
                          F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                          F.col("digest").alias("text_sha256"))


ORACLE = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
