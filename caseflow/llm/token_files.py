"""Operator 2: token-id files.

Format: a folder of Parquet files.  Rows are in ascending ``doc_id`` order
within a file, and files follow each other in the order of ``part``:

    part int, doc_id bigint, at bigint, n_tokens int, ids list<int>

``at`` counts the ids before the document in its part; ``manifest`` beside the
files has the number of ids before each part.  Ids are delta-encoded (or
dictionary-encoded), row groups and pages have set sizes, and Parquet's column
and offset indexes let a reader fetch the metadata columns alone, or the ids of
a range of documents alone (``read_documents``).

Text is tokenized by the tokenizers library.  The pre-tokenizer always starts
a new piece at a single space followed by a printing character, so the text is
cut there; each distinct cut is encoded once per worker and remembered (a
bounded number of them).

Defined results: a null text counts as empty and has the end id alone; the text
of a special token gives its id, as in the library; rows that repeat an id follow each other
in the order of their texts, null ids come first.  An empty table gives files
without rows.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseflow.llm.common import documents, scratch, ship_package, whole_text
from caseflow.llm.words import IdTable, Split, bounded, ragged_take

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
REMEMBERED = 400_000
ROW_GROUP_BYTES = 32 << 20
PAGE_BYTES = 256 << 10
PAGE_ROWS = 2_000
FILE_SCHEMA = "part int, doc_id bigint, at bigint, n_tokens int, ids array<int>"
# White space and characters that some rule may count as such (fixed values):
# a space is a safe place to cut where none of these follows.
BLANK = r"\x{0}-\x{20}\x{7f}-\x{a0}\x{1680}\x{180e}\x{2000}-\x{200f}\x{2028}-\x{202f}\x{205f}-\x{2064}\x{3000}\x{feff}"
UNSAFE = rf" (?:[{BLANK}]|\z)"
CUT = re.compile(" (?=[^" + re.sub(r"\\x\{(\w+)\}", lambda m: f"\\u{int(m[1], 16):04x}", BLANK) + "])")


class TextEncoder:
    """Ids of whole texts, each with an end id."""

    JOINED = 256

    def __init__(self, file: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(file)
        space = self.tokenizer.encode(" ", add_special_tokens=False).tokens[0]
        size = self.tokenizer.get_vocab_size()
        self.starts = np.array([(self.tokenizer.id_to_token(i) or "").startswith(space)
                                for i in range(size)])
        # a special token ends the text before it: no cut between spaces and it
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.unsafe = "|".join([UNSAFE, *[f" {t}" for t in special]])
        self.cut = re.compile(CUT.pattern + "".join(f"(?!{t})" for t in special)).split
        self.rest = IdTable(self._encode_cuts, REMEMBERED)
        self.first = IdTable(self._encode_firsts, REMEMBERED)

    def _ids(self, text: str) -> np.ndarray:
        got = self.tokenizer.encode_batch_fast([text], add_special_tokens=False)
        return np.array(got[0].ids, dtype="<u4")

    def _encode_cuts(self, cuts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of each cut after its space.  Cuts follow each other in one
        text; where they start is seen by the ids that start with a space."""
        inner = pc.match_substring(cuts, " ").to_numpy(zero_copy_only=False)
        plain, odd = np.flatnonzero(~inner), np.flatnonzero(inner)
        words = cuts.take(pa.array(plain)).to_pylist()
        flat, sizes = [], []
        for lo in range(0, len(words), self.JOINED):
            some = words[lo:lo + self.JOINED]
            ids = self._ids(" " + " ".join(some))
            at = np.flatnonzero(self.starts[ids])
            if len(at) != len(some):
                raise ValueError("the tokenizer doesn't start a token at each space")
            flat.append(ids)
            sizes.append(np.diff(at, append=len(ids)))
        each = [self._ids(" " + c) for c in cuts.take(pa.array(odd)).to_pylist()]
        flat = np.concatenate([*flat, *each, np.empty(0, "<u4")])
        sizes = np.concatenate([*sizes, np.array([len(x) for x in each], np.int64)])
        order = np.argsort(np.concatenate([plain, odd]), kind="stable")
        return ragged_take(flat, (np.cumsum(sizes) - sizes)[order], sizes[order]), sizes[order]

    def _encode_firsts(self, cuts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of cuts that start a text."""
        each = [self._ids(c) if c else np.empty(0, "<u4") for c in cuts.to_pylist()]
        return np.concatenate([*each, np.empty(0, "<u4")]), np.array([len(x) for x in each], np.int64)

    def encode(self, texts: pa.Array, end_id: int) -> pa.ListArray:
        """Ids of each text and the end id."""
        split = Split(texts, self.unsafe, self.cut)
        at = split.offsets[:-1]
        # a text's first word has no space before it: entries of their own
        firsts, code = np.unique(split.codes[at], return_inverse=True)
        place = self.rest.places(split.array)
        first = self.first.places(split.array.take(pa.array(firsts)))
        flat = np.concatenate([self.rest.flat, self.first.flat, np.array([end_id], "<u4")])
        starts = np.concatenate([self.rest.starts[place], len(self.rest.flat) + self.first.starts[first],
                                 [len(flat) - 1]])
        # the end id is one more word of each text
        sizes = np.concatenate([self.rest.sizes[place], self.first.sizes[first], [1]])
        codes = split.codes.astype(np.int64)
        codes[at] = len(place) + code
        codes = np.insert(codes, split.offsets[1:], len(sizes) - 1)
        taken = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(taken)])
        offsets = ends[split.offsets + np.arange(len(split.offsets))]
        values = ragged_take(flat, starts[codes], taken).astype("<i4")
        return split.back(pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values)))


_ENCODERS: dict[str, TextEncoder] = {}


def encoder(file: str) -> TextEncoder:
    """One encoder per worker process and tokenizer file."""
    if file not in _ENCODERS:
        _ENCODERS[file] = TextEncoder(file)
    return _ENCODERS[file]


def write_tokens(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID,
                 encoding: str = "delta", parts: int | None = None) -> None:
    """Encode every text and write the files and their manifest to ``path``."""
    spark = docs.sparkSession
    ship_package(spark)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    file = public_tokenizers.path(tokenizer)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, at = encoder(file), 0
        for whole in batches:
            for b in bounded(whole, "text"):
                lists = enc.encode(b.column("text"), end_id)
                n = pc.list_value_length(lists).to_numpy()
                ends = np.cumsum(n, dtype=np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column("part"), b.column("doc_id"), pa.array(at + ends - n, pa.int64()),
                     pa.array(n, pa.int32()), lists],
                    names=["part", "doc_id", "at", "n_tokens", "ids"])
                at += int(n.sum())

    rows = (docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
            .repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "text")
            .withColumn("part", F.spark_partition_id()))
    (rows.mapInArrow(encode, FILE_SCHEMA).write
     .option("parquet.writer.version", "v2").option("compression", "zstd")
     .option("parquet.enable.dictionary", str(encoding == "dictionary").lower())
     .option("parquet.block.size", ROW_GROUP_BYTES).option("parquet.page.size", PAGE_BYTES)
     .option("parquet.page.row.count.limit", PAGE_ROWS).parquet(f"{path}/tokens"))
    # one row per part; only two narrow columns are read
    ends = (spark.read.schema(FILE_SCHEMA).parquet(f"{path}/tokens")
            .groupBy("part").agg(F.max(F.col("at") + F.col("n_tokens")).alias("ids"),
                                 F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    (ends.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))
     .write.parquet(f"{path}/manifest"))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids); unused columns are not read."""
    manifest = spark.read.parquet(f"{path}/manifest").select("part", F.col("start").alias("__s"))
    rows = spark.read.schema(FILE_SCHEMA).parquet(f"{path}/tokens")
    # the manifest has one row for each part written: a fixed, small number
    return rows.join(F.broadcast(manifest), "part").select(
        "doc_id", (F.col("at") + F.col("__s")).alias("start"),
        F.col("n_tokens").cast("bigint").alias("n_tokens"), "ids")


def read_documents(spark: SparkSession, path: str, first_id: int, last_id: int) -> DataFrame:
    """Documents of a range of ids; page indexes skip the other pages."""
    return read_tokens(spark, path).filter(F.col("doc_id").between(first_id, last_id))


def with_checksums(tokens: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from rows of ``read_tokens``."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("ids")
            flat = np.asarray(ids.values).astype("<u4", copy=False)
            offs = np.asarray(ids.offsets)
            crc = [zlib.crc32(flat[i:j].tobytes()) for i, j in zip(offs[:-1], offs[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("start"), b.column("n_tokens"),
                 pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    ship_package(tokens.sparkSession)
    return tokens.mapInArrow(sums, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "token_files")
    write_tokens(documents(spark, sf_dir), path)
    return with_checksums(read_tokens(spark, path))
