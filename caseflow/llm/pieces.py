"""Operator 1: SentencePiece BPE encoding and decoding by backtracking.

The model's merges are given by piece scores: of all neighbouring pairs whose
joined text is a piece, the best one (highest score, then leftmost) is merged.
Instead of merging, the encoder takes at each place the longest piece that an
Aho-Corasick automaton finds, and keeps it if it is compatible with the piece
before it, that is, if merging the two pieces' text again gives just these two.
If not, it tries the next shorter piece that starts there, and if none is left
it goes back one piece; a bitfield has the places from which no way leads on.

Texts are cut before each space (no piece of the model has a space after
another character; a model for which that is not so is encoded in one cut), and
each distinct cut is encoded and decoded once per worker and remembered, with a
bounded memory.  Characters that the model lacks become byte pieces.  Pieces
whose scores tie (runs of spaces) follow the leftmost rule, which depends on
the place, so cuts that contain one are merged directly.

Defined results: a null text counts as empty and has no ids; its decoded text
is empty.  Equal texts have equal ids; rows that repeat an id are encoded each.
An empty table gives an empty result.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.llm.common import documents, whole_text
from caseflow.llm.words import Memo, Split, bounded, remembering

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
PAIRS_REMEMBERED = 2_000_000
DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


class PieceCodec:
    """Ids of one cut of text, and text of ids."""

    def __init__(self, file: str):
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=file)
        n = sp.get_piece_size()
        self.text = [sp.id_to_piece(i) for i in range(n)]
        self.bytes = {int(self.text[i][1:-1], 16): i for i in range(n) if sp.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i)
                                             or sp.is_unused(i))]
        self.silent = {i for i in range(n) if sp.is_control(i)}
        self.unknown = sp.unk_id()
        self.odd = {*self.byte_of, *self.silent, self.unknown}
        self.id = {self.text[i]: i for i in plain}
        self.score = {self.text[i]: sp.get_score(i) for i in plain}
        self.chars = {p for p in self.id if len(p) == 1}
        by_score: dict[float, list[str]] = {}
        for p, s in self.score.items():
            if len(p) > 1:
                by_score.setdefault(s, []).append(p)
        self.tied = {p for ps in by_score.values() if len(ps) > 1 for p in ps}
        self.cuts = not any(SPACE in p.lstrip(SPACE) for p in self.id)
        self.machine = ahocorasick.Automaton()
        for p in self.id:
            self.machine.add_word(p, -len(p) if p in self.tied else len(p))
        self.machine.make_automaton()
        self.shorter: dict[str, str | None] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.whole: dict[str, bool] = {}

    def merged(self, s: str) -> list[str]:
        """Pieces of ``s`` by merging, best pair first."""
        part: list[str | None] = list(s)
        nxt = list(range(1, len(s) + 1))
        prv = list(range(-1, len(s) - 1))
        heap: list = []

        def offer(i: int) -> None:
            j = nxt[i]
            if j < len(part):
                both = part[i] + part[j]
                if both in self.score:
                    heapq.heappush(heap, (-self.score[both], i, len(both), both))

        for i in range(len(part) - 1):
            offer(i)
        while heap:
            _, i, size, both = heapq.heappop(heap)
            j = nxt[i]
            if part[i] is None or j >= len(part) or len(part[i]) + len(part[j]) != size \
                    or part[i] + part[j] != both:
                continue
            part[i], part[j] = both, None
            nxt[i] = nxt[j]
            if nxt[j] < len(part):
                prv[nxt[j]] = i
            if prv[i] >= 0:
                offer(prv[i])
            offer(i)
        return [p for p in part if p is not None]

    def is_whole(self, p: str) -> bool:
        got = self.whole.get(p)
        if got is None:
            got = self.whole[p] = self.merged(p) == [p]
        return got

    def compatible(self, a: str, b: str) -> bool:
        got = self.pairs.get((a, b))
        if got is None:
            if len(self.pairs) >= PAIRS_REMEMBERED:
                self.pairs.clear()
            got = self.pairs[a, b] = self.merged(a + b) == [a, b]
        return got

    def next_shorter(self, p: str) -> str | None:
        """The longest piece that starts ``p`` and is shorter."""
        if p not in self.shorter:
            self.shorter[p] = next((p[:k] for k in range(len(p) - 1, 0, -1) if p[:k] in self.id),
                                   None)
        return self.shorter[p]

    def backtracked(self, s: str) -> list[str]:
        """Pieces of ``s``, all of whose characters the model has."""
        n = len(s)
        longest = [1] * n
        for end, size in self.machine.iter(s):
            if size < 0:
                return self.merged(s)
            start = end - size + 1
            if size > longest[start]:
                longest[start] = size
        dead = bytearray((n >> 3) + 1)  # one bit for each place
        whole, pairs = self.whole.get, self.pairs.get
        out: list[str] = []
        at, last, p = 0, None, s[:longest[0]]
        while True:
            end = at + len(p)
            good = whole(p)
            if good is None:
                good = self.is_whole(p)
            if good and last is not None:
                good = pairs((last, p))
                if good is None:
                    good = self.compatible(last, p)
            if good and not dead[end >> 3] >> (end & 7) & 1:
                out.append(p)
                if end == n:
                    return out
                at, last = end, p
                p = s[at:at + longest[at]]
                continue
            p = self.next_shorter(p)
            while p is None:
                if not out:
                    raise ValueError(f"no encoding found for {s[:80]!r}")
                dead[at >> 3] |= 1 << (at & 7)
                p = out.pop()
                at -= len(p)
                last = out[-1] if out else None
                p = self.next_shorter(p)

    def encode_cut(self, s: str) -> list[int]:
        id_of = self.id
        if self.chars.issuperset(s):
            return [id_of[p] for p in self.backtracked(s)]
        ids: list[int] = []
        lo = 0
        for i, c in enumerate(s):
            if c not in self.chars:
                if i > lo:
                    ids += [id_of[p] for p in self.backtracked(s[lo:i])]
                ids += [self.bytes[b] for b in c.encode()] if self.bytes else [self.unknown]
                lo = i + 1
        if lo < len(s):
            ids += [id_of[p] for p in self.backtracked(s[lo:])]
        return ids

    def decode_cut(self, ids: list[int]) -> str:
        """Text of ids, with spaces; byte pieces join to characters."""
        if self.odd.isdisjoint(ids):
            return "".join([self.text[i] for i in ids]).replace(SPACE, " ")
        out, raw = [], bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                raw.append(b)
                continue
            if raw:
                out.append(raw.decode(errors="replace"))
                raw.clear()
            if i not in self.silent:
                out.append(" ⁇ " if i == self.unknown else self.text[i].replace(SPACE, " "))
        if raw:
            out.append(raw.decode(errors="replace"))
        return "".join(out)


RUNS = re.compile(f"{SPACE}+[^{SPACE}]*")
# texts with runs of spaces are cut by RUNS
SPECIAL = f"^ |  |{SPACE}"


class Codec:
    """Encoding and decoding of whole texts, cut by cut.  A remembered cut
    (without the space before it) has its number of ids, the ids as text, and
    the text decoded from the ids."""

    def __init__(self, file: str):
        self.pieces = PieceCodec(file)
        self.number = [str(i) for i in range(len(self.pieces.text))]
        self.memo = Memo(self._make)

    def _make(self, cuts: list[str]) -> list[tuple[int, str, str]]:
        out = []
        encode, decode, number = self.pieces.encode_cut, self.pieces.decode_cut, self.number
        for c in cuts:
            ids = encode(SPACE + c)
            out.append((len(ids), ",".join([number[i] for i in ids]), decode(ids)))
        return out

    def cuts(self, text: str) -> list[str]:
        if not text:
            return []
        s = SPACE + text.replace(" ", SPACE)
        return [c[1:] for c in RUNS.findall(s)] if self.pieces.cuts else [s[1:]]

    def _encoded(self, texts: pa.Array) -> tuple[Split, list[tuple[int, str, str]]]:
        split = Split(texts, SPECIAL if self.pieces.cuts else "", self.cuts)
        return split, self.memo.all(split.words)

    def encode(self, texts: pa.Array) -> pa.Array:
        split, known = self._encoded(texts)
        ids = [list(map(int, k[1].split(","))) for k in known]
        lists = [[i for c in split.codes[a:b].tolist() for i in ids[c]]
                 for a, b in zip(split.offsets[:-1], split.offsets[1:], strict=True)]
        return split.back(pa.array(lists, pa.list_(pa.int32())))

    def decode(self, ids: list[int]) -> str:
        """The leading space that encoding puts before a text is taken off."""
        got = self.pieces.decode_cut(ids)
        return got[1:] if got.startswith(" ") and ids[0] not in self.pieces.byte_of else got

    def digests(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """Number of ids, SHA-256 of the ids and of the text decoded from them."""
        split, known = self._encoded(texts)
        sizes, ids, back = zip(*known, strict=True) if known else ((), (), ())
        codes = pa.array(split.codes)
        ends = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64)[split.codes])])
        n = np.diff(ends[split.offsets])

        def digest(parts: tuple[str, ...], between: str, skip: int) -> pa.Array:
            words = pa.array(parts, pa.large_string()).take(codes)
            lists = pa.LargeListArray.from_arrays(pa.array(split.offsets, pa.int64()), words)
            texts = pc.binary_join(lists, pa.scalar(between, pa.large_string()))
            return pa.array([hashlib.sha256(x.as_buffer()[skip:]).hexdigest()
                             for x in texts.cast(pa.large_binary())], pa.string())

        return split.back(n), split.back(digest(ids, ",", 0)), split.back(digest(back, "", 1))


_CODECS: dict[str, Codec] = {}


def codec(file: str) -> Codec:
    """One codec per worker process and model file."""
    if file not in _CODECS:
        _CODECS[file] = Codec(file)
    return _CODECS[file]


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))


def encode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, ids) of every text."""
    file = public_tokenizers.path(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(file)
        for whole in batches:
            for b in bounded(whole, "text"):
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), c.encode(b.column("text"))],
                                                 names=["doc_id", "ids"])

    return _texts(docs).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, text) of rows of ``encode``."""
    file = public_tokenizers.path(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(file)
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([c.decode(i or []) for i in b.column("ids").to_pylist()],
                                              pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def encode_digests(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every text."""
    file = public_tokenizers.path(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(file)
        with remembering(c.memo):
            for whole in batches:
                for b in bounded(whole, "text"):
                    n, ids, back = c.digests(b.column("text"))
                    yield pa.RecordBatch.from_arrays(
                        [b.column("doc_id"), pa.array(n, pa.int64()), ids, back],
                        names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _texts(docs).mapInArrow(run, DIGESTS)


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(documents(spark, sf_dir))
