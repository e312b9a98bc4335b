"""op9 at size: what is sorted, what is told apart, and results by brute force."""

from __future__ import annotations

import random

import numpy as np
from pyspark.sql import types as T

from caseflow.llm import suffix_dedup as S


def _brute(rows: list[tuple[int | None, str | None]]) -> dict:
    """For each (id, text) the number of bytes in windows of smaller ids."""
    least: dict[bytes, int] = {}
    raw = [(i, (t or "").encode()) for i, t in rows]
    for i, b in raw:
        for k in range(len(b) - S.LENGTH + 1 if i is not None else 0):
            w = b[k:k + S.LENGTH]
            least[w] = min(i, least.get(w, i))
    out = {}
    for i, b in raw:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - S.LENGTH + 1 if i is not None else 0):
            if least[b[k:k + S.LENGTH]] < i:
                gone[k:k + S.LENGTH] = True
        out[i, len(b), int(gone.sum())] = out.get((i, len(b), int(gone.sum())), 0) + 1
    return out


def _contexts(n: int, seed: int = 3) -> tuple:
    """n contexts of one anchor with one passage of LENGTH bytes and more, and
    each its own bytes around it (n up to 256)."""
    r = np.random.default_rng(seed)
    ctx = r.integers(97, 123, (n, S.CONTEXT), dtype=np.uint8)
    ctx[:, 10:70] = ctx[0, 10:70]
    ctx[:, 9] = ctx[:, 70] = np.arange(n)
    return (np.full(n, 7, np.uint64), np.arange(n)[::-1].copy(), np.zeros(n, np.int8),
            np.full(n, S.CONTEXT, np.int8), ctx)


def test_equal_suffixes_are_sorted_as_one(monkeypatch):
    sizes, sort = [], S.Suffixes.sort

    def counted(self, row, at, group):
        sizes.append(len(row))
        return sort(self, row, at, group)

    monkeypatch.setattr(S.Suffixes, "sort", counted)
    key, doc, low, high, ctx = _contexts(250)
    got = S.repeated_windows(key, doc, low, high, ctx)
    # of 31 places in 250 contexts, the 11 inside the passage repeat
    want = np.zeros_like(got)
    want[:-1, 10:21] = True
    assert (got == want).all()
    assert sum(sizes) == 11


def test_windows_by_brute_force():
    r = np.random.default_rng(11)
    ctx = r.integers(97, 123, (60, S.CONTEXT), dtype=np.uint8)
    ctx[:, 5:75] = ctx[np.repeat(r.integers(0, 6, 12), 5), 5:75]  # few bodies, also in several ids
    flips = r.integers(0, S.CONTEXT, 60)
    ctx[np.arange(60), flips] = 65
    key = np.sort(r.integers(0, 4, 60)).astype(np.uint64)
    doc = r.integers(0, 25, 60)
    low, high = r.integers(0, 12, 60).astype(np.int8), r.integers(60, 81, 60).astype(np.int8)
    least: dict = {}
    for k in range(60):
        for p in range(S.WINDOW):
            if low[k] <= p and p + S.LENGTH <= high[k]:
                w = int(key[k]), p, ctx[k, p:p + S.LENGTH].tobytes()
                least[w] = min(least.get(w, doc[k]), doc[k])
    want = np.array([[bool(low[k] <= p and p + S.LENGTH <= high[k] and
                           least[int(key[k]), p, ctx[k, p:p + S.LENGTH].tobytes()] < doc[k])
                      for p in range(S.WINDOW)] for k in range(60)])
    assert want.any()
    assert (S.repeated_windows(key, doc, low, high, ctx) == want).all()


def test_contexts_of_other_ranges_have_other_keys():
    """A byte more at the start must not undo the other range in the key."""
    h = np.arange(256, dtype=np.uint64)
    ctx = np.full((256, S.CONTEXT), 97, np.uint8)
    ctx[:, 0] = 0
    one = S._context_key(h, np.full(256, 1, np.int8), np.full(256, 51, np.int8), ctx)
    for byte in range(1, 256):
        ctx[:, 0] = byte
        other = S._context_key(h, np.zeros(256, np.int8), np.full(256, 51, np.int8), ctx)
        assert not (one == other).any(), byte


def test_messages_are_the_arrays():
    parts = (np.arange(5), np.array([], np.int64), np.array([-3, 7], np.int8), np.arange(6, dtype=np.uint8))
    got = S._unpack(S._pack(*parts), "i8", "i8", "i1", "u1")
    assert all((a == b).all() and a.dtype == b.dtype for a, b in zip(got, parts, strict=True))


def test_hash_parts_reach_their_buckets():
    r = np.random.default_rng(5)
    doc = np.array([-9_000_000_000_000_000_000, -4, 3, 9_000_000_000_000_000_000])
    rank, bucket = r.integers(0, 4, 500), r.integers(0, 7, 500)
    h = r.integers(0, 1 << 24, 500).astype(np.uint64)
    parts = list(S._hash_parts(bucket, doc, rank, h, S.TELL, 9))
    assert len(parts) == 9
    for k, part in enumerate(parts):
        d, g = S._hashes([S._unpack(S._pack(*part), *S.HASHES)], S.TELL)
        assert sorted(zip(d.tolist(), g.tolist(), strict=True)) == sorted(
            zip(doc[rank[bucket == k]].tolist(), h[bucket == k].tolist(), strict=True))


def test_common_passage_in_unlike_texts(spark):
    """A passage with other words around it in each text; texts of one letter,
    short, null and empty ones, ids with several texts, repeated rows, null ids."""
    rnd = random.Random(8)

    def words(n):
        return " ".join("".join(rnd.choice("abcdefgé") for _ in range(rnd.randint(2, 9))) for _ in range(n))

    passage, other = words(14), words(9)
    rows = [(i, f"{words(6)} {passage} {words(5)}" + (f" {other} {words(2)}" if i % 3 == 0 else ""))
            for i in range(40)]
    rows += [(50 + i, "of " * (15 + i)) for i in range(6)]
    rows += [(7, f"{passage} again {words(9)}"), (60, None), (61, ""), (62, passage[:30]), rows[5], rows[5],
             (None, rows[3][1]), (-4, f"{words(2)} {passage}"), (63, passage), (63, other + passage)]
    rnd.shuffle(rows)
    docs = spark.createDataFrame(rows, T.StructType([T.StructField("doc_id", T.LongType()),
                                                     T.StructField("text", T.StringType())])).repartition(5)
    got: dict = {}
    for x in S.digests(S.remove_repeats(docs)).collect():
        k = x.doc_id, x.n_bytes, x.n_removed
        got[k] = got.get(k, 0) + 1
    assert got == _brute(rows)
