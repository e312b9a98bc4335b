"""Packing against the library's ids, the windows' contract, and a plain
search for the sum-of-squares choice."""

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from caseflow.llm import packing

SCHEMA = "doc_id long, text string, start string, ids int, sequence_id double"


def words(n, seed):
    r = random.Random(seed)
    return " ".join("".join(r.choice("abcdefghé'.") for _ in range(r.randint(1, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    odd = ["", None, " \t\n", "It's <|endoftext|>now<|ENDOFTEXT|>. <|endoftext|>", "ÉTÉ Straße ﬁn Ⅳ x̂ ét́",
           "don't.'s a.b,c! 12.5 ($x) don＇t", "ΑΣ Σ. İstanbul ǅ", "a" * 5000, "= ̸x ≠ ≮", "one\x0btwo\x1cthree four"]
    out = [(i, t) for i, t in enumerate(odd)] + [(10, odd[3]), (10, odd[3]), (None, "no id")]
    out += [(100 + i, words(random.Random(i).randint(1, 400), i)) for i in range(200)]
    out += [(1000, words(60_000, 1)), (1001, "word " * 2047), (1002, "word " * 2048)]
    return [(i, t, "x", 1, 0.5) for i, t in out]


def check(pieces, rows, size=2048):
    """Pieces make up the documents, and windows are gapless; returns the
    number of padded ids and of pieces."""
    tok = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    want = defaultdict(list)
    for i, t, *_ in rows:
        want[i].append(tok.encode(t or "", add_special_tokens=False).ids + [packing.END_ID])
    got = defaultdict(list)
    windows = defaultdict(list)
    for p in pieces:
        got[p["doc_id"]].append((p["start"], p["ids"], p["doc_tokens"]))
        assert p["length"] == len(p["ids"]) > 0
        windows[p["sequence_id"]].append((p["offset"], p["length"]))
    for i, texts in want.items():
        of = sorted(got.pop(i))
        if len(texts) == 1:
            at = 0
            for start, ids, total in of:
                assert start == at and total == len(texts[0]) and ids == texts[0][at:at + len(ids)]
                at += len(ids)
            assert at == len(texts[0])
        else:  # equal rows
            assert sum(len(x[1]) for x in of) == sum(map(len, texts))
    assert not got
    padded = 0
    for spans in windows.values():
        at = 0
        for offset, n in sorted(spans):
            assert offset == at
            at += n
        assert at <= size
        padded += 0 if at & (at - 1) == 0 else size - at
    return padded, len(pieces)


def test_pieces_and_windows(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    docs.write.mode("overwrite").parquet(path := f"{spark.sparkContext.getCheckpointDir()}/packing_docs")
    docs = spark.read.parquet(path)
    got = packing.pack(docs).collect()
    assert check(got, rows)[0] == 0
    assert check(packing.pack(docs, most_open=3).collect(), rows)[0] == 0
    key = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset"]
    sums = {tuple(r[k] for k in key): r["ids_crc32"] for r in packing.pack(docs, checksums=True).collect()}
    assert sums == {tuple(r[k] for k in key): zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in got}
    assert packing.pack(docs.limit(0)).count() == 0


def test_choice_is_the_least_sum_of_squares():
    r = random.Random(4)
    levels, counts = packing.Levels(32), [0] * 33
    for _ in range(3000):
        n = r.choice([3, 5, 8, 11, 13, 17, 20, 31])
        h = levels.choose(n)

        def after(level):
            c = counts.copy()
            c[level] -= level > 0
            c[level + n] += level + n < 32
            return sum(x * x for x in c)

        able = [k for k in range(33 - n) if k == 0 or counts[k]]
        assert h in able and (after(h), -h) == min((after(k), -k) for k in able)
        window = levels.take(h)
        if h + n < 32:
            levels.put(h + n, window)
        counts[h] -= h > 0
        counts[h + n] += h + n < 32
        assert [len(x) for x in levels.at[1:32]] == counts[1:32]


def test_few_documents_are_cut(rows):
    r = random.Random(1)
    packer = packing.Packer(2048, packing.OPEN, 0)
    docs = [(i, np.arange(r.randint(1, 1500), dtype=np.uint32)) for i in range(20_000)]
    for i, ids in docs:
        packer.add(i, ids)
    packer.finish()
    assert len(packer.rows) < 1.06 * len(docs)
    assert sum(len(x[2]) for x in packer.rows) == sum(len(x[1]) for x in docs)


def test_id_table():
    import pyarrow as pa

    from caseflow.llm.words import IdTable
    table = IdTable(lambda w: (np.array([len(x) for x in w.to_pylist() for _ in x], "<u4"),
                               np.array([len(x) for x in w.to_pylist()])), 5)
    for batch in (["a", "", "ccc"], ["dd", "a"], ["eeee", "dd", "ff"], ["a", "b", "c", "d", "e", "fffff", "g"], ["g"]):
        at = table.places(pa.array(batch))
        for w, k in zip(batch, at.tolist(), strict=True):
            assert table.flat[table.starts[k]:table.starts[k] + table.sizes[k]].tolist() == [len(w)] * len(w)
