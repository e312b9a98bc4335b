"""Operator 11: sum-of-squares packing of documents into windows of tokens.

Each task packs the documents of its partition as they come.  ``Levels`` has,
for each fill level h, the partly filled windows at h; N(h) is their number.
A document of n tokens goes to the level (or to a new window) that leaves the
sum of N(h)^2 smallest, of equal ones to the fullest.  A document longer than
a window fills windows of its own first, its rest is placed like a document.

*Closing.*  A task holds ``OPEN`` partly filled windows at most.  Beyond that,
the level with the most windows is emptied: its pieces, one after the other,
are cut into full windows and one partly filled one.  At the end of a task all
windows left are closed in the same way, and the last partly filled one is cut
into windows whose fills are powers of two.  So no window is padded, and only
the pieces of closed windows are cut.

Text is tokenized by the tokenizers library.  The tokenizer drops white space,
so words between ASCII white space are encoded apart, each once while a worker
remembers it.  Letters and a sign that follows them are two words, as the
pre-tokenizer cuts there too, and A-Z is lower-cased first, as it does.

Defined results: a null text counts as empty and has the end id alone.  Rows
that repeat an id, or have a null id, are documents of their own.  The text of
a special token gives its id, as in the library.  An empty table gives an empty
result.  Only ``doc_id`` and ``text`` are read.  ``sequence_id`` has the task's
partition in its upper bits; reruns over the same files agree.  ``docs`` must
be a scan (or a written table), whose partitions a lost executor reads again in
the same order.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.llm.common import documents, ship_package, whole_text
from caseflow.llm.words import IdTable, bounded, ragged_take

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
WINDOW = 2048
OPEN = 1024
REMEMBERED = 400_000
PART_BITS = 40
# a letter and a sign after it, which the pre-tokenizer cuts apart; not those
# of the special tokens or the apostrophe
CUT = r"([A-Za-zÀ-ÖØ-öø-ÿ])([!\"#$%&()*+,\-./:;=?@\[\\\]^_`{}~])"
PLAIN = "^[a-zà-öø-ÿ]+$"
PIECE = ("doc_id bigint, start bigint, length bigint, {what}, doc_tokens bigint, "
         "sequence_id bigint, offset bigint")


class Levels:
    """Partly filled windows by fill level, and the sum-of-squares choice."""

    def __init__(self, size: int):
        self.size = size
        self.at: list[list] = [[] for _ in range(size + 1)]
        self.open = 0
        # what N(h)^2 changes by as a window leaves a level, or comes to it
        self.leaves = np.full(size + 1, 1 << 40, np.int64)
        self.leaves[0] = 0
        self.comes = np.ones(size + 1, np.int64)
        self.comes[size] = 0

    def _count(self, h: int, by: int) -> None:
        self.open += by
        n = len(self.at[h])
        self.leaves[h] = 1 - 2 * n if n else 1 << 40
        self.comes[h] = 1 + 2 * n

    def choose(self, n: int) -> int:
        """The level where a document of n tokens goes; 0: a new window."""
        cost = self.leaves[:self.size - n + 1] + self.comes[n:]
        return len(cost) - 1 - int(cost[::-1].argmin())

    def take(self, h: int):
        """A window at level h, which leaves it; at 0 a new one."""
        if not h:
            return []
        window = self.at[h].pop()
        self._count(h, -1)
        return window

    def put(self, h: int, window) -> None:
        self.at[h].append(window)
        self._count(h, 1)

    def fullest(self) -> int:
        """The level with the most windows."""
        return int((self.comes[1:self.size]).argmax()) + 1

    def empty(self, h: int) -> list:
        """All windows at level h, which leave it."""
        windows, self.at[h] = self.at[h], []
        self._count(h, -len(windows))
        return windows


class Packer:
    """Packs one task's documents.  A piece is (doc_id, start, ids,
    doc_tokens); ``rows`` are the pieces of windows that are done."""

    def __init__(self, size: int, most: int, first: int):
        self.levels, self.size, self.most, self.next, self.rows = Levels(size), size, most, first, []

    def _done(self, window: list) -> None:
        at = 0
        for doc, start, ids, total in window:
            self.rows.append((doc, start, ids, total, self.next, at))
            at += len(ids)
        self.next += 1

    def add(self, doc, ids: np.ndarray) -> None:
        n, size = len(ids), self.size
        whole = n - n % size
        for at in range(0, whole, size):
            self._done([(doc, at, ids[at:at + size], n)])
        rest = n - whole
        if not rest:
            return
        h = self.levels.choose(rest)
        window = self.levels.take(h)
        window.append((doc, whole, ids[whole:].copy(), n))
        if h + rest == size:
            self._done(window)
        else:
            self.levels.put(h + rest, window)
        if self.levels.open > self.most:
            left, fill = self._cut(self.levels.empty(self.levels.fullest()))
            if fill:
                self.levels.put(fill, left)

    def _cut(self, windows: list) -> tuple[list, int]:
        """Full windows of the pieces; the partly filled one and its fill."""
        window, fill = [], 0
        for doc, start, ids, total in (p for w in windows for p in w):
            while len(ids):
                n = min(len(ids), self.size - fill)
                window.append((doc, start, ids[:n], total))
                fill, start, ids = fill + n, start + n, ids[n:]
                if fill == self.size:
                    self._done(window)
                    window, fill = [], 0
        return window, fill

    def finish(self) -> None:
        """Close all windows."""
        windows = [w for h in range(self.size - 1, 0, -1) for w in self.levels.empty(h)]
        left, fill = self._cut(windows)
        size = self.size
        while fill:
            self.size = 1 << (fill.bit_length() - 1)
            left, fill = self._cut([left])
        self.size = size


class WordEncoder:
    """Ids of whole texts, by words."""

    JOINED = 64

    def __init__(self, file: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(file)
        # for words of lower-case letters, which the normalizer leaves as they
        # are and the pre-tokenizer in one piece: these steps without patterns
        self.plain = Tokenizer(self.tokenizer.model)
        self.plain.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        size = self.tokenizer.get_vocab_size()
        # a run of letters gives one piece of text, and its last id ends it
        end = self.tokenizer.encode("a", add_special_tokens=False).tokens[0].removeprefix("a")
        self.ends = np.array([(self.tokenizer.id_to_token(i) or "").endswith(end) for i in range(size)])
        self.words = IdTable(self._encode_words, REMEMBERED)

    def _encode_letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that have one end each, and their numbers."""
        ids, sizes = [], []
        for lo in range(0, len(words), self.JOINED):
            some = words[lo:lo + self.JOINED]
            text = self.plain.encode_batch_fast([" ".join(some)], add_special_tokens=False)
            got = np.array(text[0].ids, "<u4")
            at = np.flatnonzero(self.ends[got])
            if len(at) != len(some):
                raise ValueError("the tokenizer doesn't end a word of letters once")
            ids.append(got)
            sizes.append(np.diff(at, prepend=-1))
        return np.concatenate(ids), np.concatenate(sizes)

    def _encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        plain = pc.match_substring_regex(words, PLAIN).to_numpy(zero_copy_only=False)
        first, rest = np.flatnonzero(plain), np.flatnonzero(~plain)
        flat, sizes = np.empty(0, "<u4"), np.empty(0, np.int64)
        if len(first):
            flat, sizes = self._encode_letters(words.take(pa.array(first)).to_pylist())
        if len(rest):
            got = self.tokenizer.encode_batch_fast(words.take(pa.array(rest)).to_pylist(),
                                                   add_special_tokens=False)
            ids = [x.ids for x in got]
            sizes = np.concatenate([sizes, np.array([len(x) for x in ids], np.int64)])
            flat = np.concatenate([flat, np.array([i for x in ids for i in x], "<u4")])
        # back in the order of the words
        order = np.argsort(np.concatenate([first, rest]), kind="stable")
        return ragged_take(flat, (np.cumsum(sizes) - sizes)[order], sizes[order]), sizes[order]

    def encode(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, text after text with the end id, and their offsets."""
        # case matters in the text of a special token alone
        texts = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        texts = pc.replace_substring_regex(texts, CUT, r"\1 \2")
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        at = self.words.places(coded.dictionary)
        # the end id is one more word of each text
        starts = np.append(self.words.starts[at], len(self.words.flat))
        sizes = np.append(self.words.sizes[at], 1)
        offsets = np.asarray(lists.offsets) - lists.offsets[0].as_py()
        codes = np.insert(np.asarray(coded.indices), offsets[1:], len(at))
        taken = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(taken)])
        flat = np.append(self.words.flat, np.uint32(end_id)).astype("<u4", copy=False)
        return ragged_take(flat, starts[codes], taken), ends[offsets + np.arange(len(offsets))]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(file: str) -> WordEncoder:
    """One encoder per worker process and tokenizer file."""
    if file not in _ENCODERS:
        _ENCODERS[file] = WordEncoder(file)
    return _ENCODERS[file]


def pack(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID, size: int = WINDOW,
         most_open: int = OPEN, checksums: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length, ids (or their ids_crc32),
    doc_tokens, sequence_id, offset."""
    file = public_tokenizers.path(tokenizer)
    schema = PIECE.format(what="ids_crc32 bigint" if checksums else "ids array<int>")
    names = [x.split()[0] for x in schema.split(", ")]

    def batch(rows: list) -> pa.RecordBatch:
        doc, start, ids, total, sequence, at = zip(*rows, strict=True) if rows else [()] * 6
        sizes = np.array([len(x) for x in ids], np.int64)
        if checksums:
            what = pa.array([zlib.crc32(x.tobytes()) for x in ids], pa.int64())
        else:
            flat = np.concatenate(ids).astype("<i4") if ids else np.empty(0, "<i4")
            what = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(flat))
        return pa.RecordBatch.from_arrays(
            [pa.array(doc, pa.int64()), pa.array(start, pa.int64()), pa.array(sizes), what,
             pa.array(total, pa.int64()), pa.array(sequence, pa.int64()), pa.array(at, pa.int64())],
            names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(file)
        packer = Packer(size, most_open, TaskContext.get().partitionId() << PART_BITS)
        for whole in batches:
            for b in bounded(whole, "text"):
                flat, ends = enc.encode(b.column("text"), end_id)
                ends = ends.tolist()
                for doc, i, j in zip(b.column("doc_id").to_pylist(), ends[:-1], ends[1:], strict=True):
                    packer.add(doc, flat[i:j])
                yield batch(packer.rows)
                packer.rows = []
        packer.finish()
        yield batch(packer.rows)

    ship_package(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return rows.mapInArrow(run, schema)


def op11_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), checksums=True)
