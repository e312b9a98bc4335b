"""Operator 9: repeated byte strings, by a hash-compared suffix sort.

Each byte covered by a ``LENGTH``-byte string that also starts in a document
with a smaller id is removed.

*Which suffixes.*  All ``GRAM``-byte substrings are hashed, and in every
LENGTH-byte window those with the least hash are its anchors.  Equal windows
have equal anchors at equal places, so a window repeats only where an anchor
does.  Anchors found in one document only are left out; of the others the
context, all windows around the anchor, is sorted.

*Sort.*  Contexts meet by anchor.  Equal contexts are settled by their smallest
id.  Of the others, the suffixes that start at the same place before the same
anchor are mergesorted, those whose LENGTH bytes have a hash that no other
document has there left out, those of one hash as one; two suffixes are compared
by their longest common extension, found by binary search over prefix hashes,
and the byte after it.  Neighbours with a common extension of LENGTH bytes are
compared byte by byte before they count.

*Common strings.*  A task that sees an anchor (or context) in several documents
settles those itself and sends only the one with the smallest id on, so a
passage in a third of all documents is one row of each task.

Defined results: a null text counts as empty; matches neither cross documents
nor come from rows with the same id; a row with a null id neither loses bytes
nor takes any.  An empty table gives an empty result.  Only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.llm.common import documents, ship_package, whole_text
from caseflow.llm.hashing import BASE, mix, tables
from caseflow.llm.words import bounded, ragged_take

LENGTH = 50
GRAM = 20
WINDOW = LENGTH - GRAM + 1  # grams in a window
BEFORE = LENGTH - GRAM      # bytes of a context before its anchor
CONTEXT = BEFORE + LENGTH
NONE = np.uint32(0xFFFFFFFF)
ROWS = 50_000               # contexts sorted at once, of whole anchors
PIECE_BYTES = 1 << 20       # of text at once, so that its hashes stay in the cache
MEET, TELL = 6, 3            # bytes of an anchor's hash: among all documents, within one
PAIRS = 1 << 17             # suffixes compared byte by byte at once
MESSAGE = "bucket int, body binary"
HASHES = ("i8", "i4", "u1")


def _slide(x: np.ndarray, fold: np.ufunc, pad: np.uint32) -> np.ndarray:
    """fold over x[i:i + WINDOW] for each i (the end is padded), from spans of
    twice the length each time."""
    y = np.concatenate([x, np.full(WINDOW - 1, pad, x.dtype)])
    width = 1
    while 2 * width <= WINDOW:
        y = fold(y[:-width], y[width:])
        width *= 2
    rest = WINDOW - width
    return fold(y[:len(x)], y[rest:rest + len(x)])


def _order_hashes(data: np.ndarray) -> np.ndarray:
    """32-bit hashes of all grams, from spans of twice the length each time."""
    spans = {1: data.astype(np.uint32) + np.uint32(1)}
    width, whole, done = 1, None, 0
    while True:
        if GRAM & width:  # the gram is put together from its powers of two
            x = spans[width]
            if whole is None:
                whole = x
            else:
                n = len(data) - done - width + 1
                whole = whole[:n] * np.uint32(pow(BASE, width, 1 << 32)) + x[done:done + n]
            done += width
        if 2 * width > GRAM:
            break
        x = spans.pop(width)
        spans[2 * width] = x[:-width] * np.uint32(pow(BASE, width, 1 << 32)) + x[width:]
        width *= 2
    g = whole ^ (whole >> np.uint32(15))
    g *= np.uint32(0x2C1B3C6D)
    g ^= g >> np.uint32(13)
    return np.minimum(g, NONE - np.uint32(1), out=g)


def _gram_hashes(grams: np.ndarray) -> np.ndarray:
    """64-bit hashes of rows of GRAM bytes."""
    words = np.zeros((len(grams), -(-GRAM // 8) * 8), np.uint8)
    words[:, :GRAM] = grams
    words = words.view("<u8")
    out = np.zeros(len(grams), np.uint64)
    for k in range(words.shape[1]):
        out = mix(out ^ words[:, k])
    return out


def anchors(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of the batch, starts of the texts (and the end), and positions
    and hashes of the anchors; the hashes' upper half orders them."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    starts = np.cumsum([0] + [len(t) for t in texts])
    n = len(data) - GRAM + 1
    if n <= 0:
        return data, starts, np.empty(0, np.int64), np.empty(0, np.uint64)
    g = _order_hashes(data)
    for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
        g[a if b - a < LENGTH else b - GRAM + 1:b] = NONE  # no window, or the gram leaves the text
    least = _slide(g, np.minimum, NONE)
    least[max(0, n - WINDOW + 1):] = 0  # no whole window starts here
    # a gram is an anchor if it is the least of any window that it is in
    least[least == NONE] = 0
    behind = _slide(least[::-1], np.maximum, np.uint32(0))[::-1]
    at = np.flatnonzero((g == behind) & (g != NONE))
    grams = np.lib.stride_tricks.sliding_window_view(data, GRAM)[at]
    h = (g[at].astype(np.uint64) << np.uint64(32)) | (_gram_hashes(grams) & np.uint64(NONE))
    return data, starts, at, h


def reach(at: np.ndarray, h: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple:
    """The bytes of each anchor's context that its windows cover: those in its
    text in which no neighbouring anchor has a lesser hash (of equal ones the
    first counts).  Equal windows are so tested at the same anchor."""
    low = np.maximum(start, at - BEFORE)
    high = np.minimum(end, at + LENGTH)
    if len(at) > 1:
        low[1:] = np.maximum(low[1:], np.where(h[:-1] <= h[1:], at[:-1] + 1, 0))
        high[:-1] = np.minimum(high[:-1], np.where(h[1:] < h[:-1], at[1:] + GRAM - 1, high[:-1]))
    return low - at + BEFORE, high - at + BEFORE


@functools.lru_cache
def _codec(level: int) -> tuple:
    return zstandard.ZstdCompressor(level=level), zstandard.ZstdDecompressor()


def _pack(*arrays: np.ndarray, level: int = 1) -> bytes:
    head = np.array([a.nbytes for a in arrays], np.int64)
    return _codec(level)[0].compress(b"".join([head.tobytes(), *(a.tobytes() for a in arrays)]))


def _unpack(body: bytes, *types: str) -> list[np.ndarray]:
    data = _codec(1)[1].decompress(body)
    ends = np.cumsum([8 * len(types), *np.frombuffer(data, np.int64, len(types))]).tolist()
    return [np.frombuffer(data[a:b], t) for a, b, t in zip(ends[:-1], ends[1:], types, strict=True)]


def _owners(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by key and id, the starts of the keys in it, and for each row in
    order whether its key has several ids."""
    order = np.lexsort((doc, key))
    k, d = key[order], doc[order]
    starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.empty(0, int)
    sizes = np.diff(np.append(starts, len(k)))
    several = np.repeat(d[starts] != d[starts + sizes - 1], sizes) if len(k) else np.empty(0, bool)
    return order, starts, several


def _shared(key: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Order by key, the starts of the keys in it, the smallest id of each, and
    for each row in order whether its key has several ids."""
    if not len(key):
        return np.empty(0, int), np.empty(0, int), doc, np.empty(0, bool)
    order = np.argsort(key)
    k, d = key[order], doc[order]
    starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]]))
    least = np.minimum.reduceat(d, starts)
    several = least != np.maximum.reduceat(d, starts)
    return order, starts, least, np.repeat(several, np.diff(starts, append=len(k)))


def _dealt(rows: np.ndarray, bucket: np.ndarray, buckets: int) -> list[np.ndarray]:
    """``rows`` by their buckets, each in the order given."""
    order = np.argsort(bucket, kind="stable")
    return np.split(rows[order], np.searchsorted(bucket[order], np.arange(1, buckets)))


def _batch(buckets: list[int], bodies: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array(bodies, pa.binary())],
                                      names=["bucket", "body"])


def _messages(got: Iterable[tuple[int, bytes]]) -> pa.Table:
    got = list(got)
    return pa.Table.from_batches([_batch([k for k, _ in got], [x for _, x in got])])


def _low(x: np.ndarray, n: int) -> np.ndarray:
    """The low ``n`` bytes of each value."""
    return np.ascontiguousarray(x.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :n]


def _wide(x: np.ndarray, n: int) -> np.ndarray:
    """The values of ``n`` bytes each."""
    out = np.zeros((len(x) // n, 8), np.uint8)
    out[:, :n] = x.reshape(-1, n)
    return out.view("<u8").ravel()


def _relays(source: int, bucket: np.ndarray, width: int) -> np.ndarray:
    """Results go from bucket to bucket by relays, one for each group of sources
    and group of targets: with ``width`` the root of the number of buckets, a
    bucket sends and gets ``width`` messages instead of one from every other."""
    return source % width * width + bucket // width


def _width(buckets: int) -> int:
    return math.isqrt(buckets - 1) + 1


def _hash_parts(bucket: np.ndarray, doc: np.ndarray, rank: np.ndarray, h: np.ndarray, size: int,
                buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each bucket its ids (as steps from one to the next), their numbers of
    hashes and the hashes; ``doc`` has the ids by ``rank``."""
    key = bucket.astype(np.int64) * len(doc) + rank
    order = np.argsort(key)
    key = key[order]
    new = np.flatnonzero(np.diff(key, prepend=-1))
    ids, n = doc[key[new] % max(1, len(doc))], np.diff(new, append=len(key)).astype(np.int32)
    h = _low(h[order], size)
    edges = np.searchsorted(key[new], np.arange(buckets + 1) * len(doc)).tolist()
    at = np.append(new, len(key))[edges].tolist()
    for a, b, x, y in zip(edges[:-1], edges[1:], at[:-1], at[1:], strict=True):
        yield np.diff(ids[a:b], prepend=0), n[a:b], h[x:y]


def _hashes(parts: list[tuple], size: int) -> tuple[np.ndarray, np.ndarray]:
    return (np.concatenate([np.empty(0, np.int64), *(np.repeat(np.cumsum(d), n) for d, n, _ in parts)]),
            np.concatenate([np.empty(0, np.uint64), *(_wide(h, size) for _, _, h in parts)]))


def _hash_messages(bucket: np.ndarray, doc: np.ndarray, h: np.ndarray, buckets: int) -> pa.Table:
    doc, rank = np.unique(doc, return_inverse=True)
    parts = _hash_parts(bucket, doc, rank, h, TELL, buckets)
    return _messages((k, _pack(*x)) for k, x in enumerate(parts) if len(x[0]))


def _told(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return _hashes([_unpack(x.as_py(), *HASHES) for x in table.column("body")], TELL)


def _hash_lists(table: pa.Table) -> pa.Table:
    """(id, hashes) with the packed hashes of each id, from all buckets."""
    doc, h = _told(table)
    order = np.lexsort((h, doc))
    doc, h = doc[order], _low(h[order], TELL)
    at = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    ends = np.append(at[1:], len(doc))
    return pa.table({"id": pa.array(doc[at], pa.int64()),
                     "hashes": pa.array([h[a:b].tobytes() for a, b in zip(at, ends, strict=True)],
                                        pa.binary())})


def shared_anchors(rows: DataFrame, buckets: int) -> DataFrame:
    """(id, hashes): the anchors of each id that other ids have as well.

    Anchors meet by ``MEET`` bytes of their hashes, and ``TELL`` bytes tell those
    of one document apart: a chance hit only sends a context too many."""
    width = _width(buckets)
    low = np.uint64((1 << 8 * MEET) - 1)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, owners, hashes, seen = [], [], [], 0
        for whole in batches:
            for b in bounded(whole, "text", PIECE_BYTES):
                _, starts, at, h = anchors([t.encode() for t in b.column("text").to_pylist()])
                ids.append(np.asarray(b.column("id")))
                owners.append(seen + np.searchsorted(starts, at, side="right") - 1)
                hashes.append(h & low)
                seen += b.num_rows
        if not sum(map(len, hashes)):
            return
        doc, rank = np.unique(np.concatenate(ids), return_inverse=True)
        rank, h = rank[np.concatenate(owners)], np.concatenate(hashes)
        del ids, owners, hashes
        order, first, least, several = _shared(h, rank)
        h = h[order]
        # settled here and on the way to their documents, and those to meet others
        known = _hash_parts(doc[rank[order][several]] % buckets, doc, rank[order][several], h[several],
                            TELL, buckets)
        met = _hash_parts((h[first] % np.uint64(buckets)).astype(np.int64), doc, least, h[first],
                          MEET, buckets)
        for k, (x, y) in enumerate(zip(known, met, strict=True)):
            if len(x[0]) or len(y[0]):
                yield _batch([k], [_pack(*x, *y)])

    def settle(bucket: tuple, table: pa.Table) -> pa.Table:
        parts = [_unpack(x.as_py(), *HASHES, *HASHES) for x in table.column("body")]
        doc, h = _hashes([x[:3] for x in parts], TELL)
        d, g = _hashes([x[3:] for x in parts], MEET)
        del parts
        order, _, _, several = _shared(g, d)
        order = order[several]
        doc = np.concatenate([doc, d[order]])
        h = np.concatenate([h, g[order] & np.uint64((1 << 8 * TELL) - 1)])
        return _hash_messages(_relays(bucket[0].as_py(), doc % buckets, width), doc, h, width * width)

    def relay(table: pa.Table) -> pa.Table:
        doc, h = _told(table)
        return _hash_messages(doc % buckets, doc, h, buckets)

    return (rows.mapInArrow(send, MESSAGE).groupBy("bucket").applyInArrow(settle, MESSAGE)
            .groupBy("bucket").applyInArrow(relay, MESSAGE)
            .groupBy("bucket").applyInArrow(_hash_lists, "id bigint, hashes binary"))


class Suffixes:
    """Suffixes of contexts: row and place in it; compared on LENGTH bytes."""

    def __init__(self, contexts: np.ndarray):
        self.bytes = np.ascontiguousarray(contexts).ravel()
        flat = np.zeros((len(contexts), CONTEXT + 1), np.uint64)
        np.cumsum((contexts.astype(np.uint64) + np.uint64(1)) * tables(CONTEXT)[0][:CONTEXT],
                  axis=1, out=flat[:, 1:])
        self.prefix = flat.ravel()

    def common(self, r: np.ndarray, s: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Longest common extension, LENGTH at most, of the suffixes of rows r
        and s from the same place, by binary search over prefix hashes."""
        width = CONTEXT + 1
        a, b = r * width + at, s * width + at
        gap = self.prefix[a] - self.prefix[b]  # stays as long as the bytes are equal
        out = np.full(len(r), LENGTH)
        left = np.flatnonzero(self.prefix[a + LENGTH] - self.prefix[b + LENGTH] != gap)
        a, b, gap = a[left], b[left], gap[left]
        low, high = np.zeros(len(left), np.int64), np.full(len(left), LENGTH - 1)
        for _ in range(LENGTH.bit_length()):
            mid = (low + high + 1) >> 1
            same = self.prefix[a + mid] - self.prefix[b + mid] == gap
            low = np.where(same, mid, low)
            high = np.where(same, high, np.maximum(mid - 1, low))
        out[left] = low
        return out

    def less(self, r: np.ndarray, s: np.ndarray, at: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        n = self.common(r, s, at)
        end = np.minimum(at + n, CONTEXT - 1)
        return np.where(n == LENGTH, or_equal,
                        self.bytes[r * CONTEXT + end] < self.bytes[s * CONTEXT + end])

    def sort(self, row: np.ndarray, at: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Order of the suffixes in each group (rows of a group follow each
        other): a mergesort whose merges find each suffix's rank in the other
        run by binary search, for all runs of all groups together."""
        n = len(row)
        order = np.arange(n)
        first = np.concatenate([[True], group[1:] != group[:-1]])
        start = np.maximum.accumulate(np.where(first, np.arange(n), 0))
        end = np.append(np.flatnonzero(first)[1:], n)[np.cumsum(first) - 1]
        width = 1
        while True:
            some = np.flatnonzero(end - start > width)  # groups that still have two runs
            if not len(some):
                return order
            place = some - start[some]
            left = place // width % 2 == 0
            run = start[some] + place // width * width
            other = np.where(left, run + width, run - width)
            stop = np.where(left, np.minimum(other + width, end[some]), run)
            stop = np.maximum(stop, other)
            stop = np.where(other >= end[some], other, stop)
            lo, hi = other.copy(), stop.copy()
            me = order[some]
            while True:
                open_ = np.flatnonzero(lo < hi)
                if not len(open_):
                    break
                mid = (lo[open_] + hi[open_]) // 2
                them, us = order[mid], me[open_]
                # of equal suffixes those of the left run come first
                before = self.less(row[them], row[us], at[us], ~left[open_])
                lo[open_] = np.where(before, mid + 1, lo[open_])
                hi[open_] = np.where(before, hi[open_], mid)
            rank = lo - other
            merged = np.where(left, some + rank, some - width + rank)
            new = order.copy()
            new[merged] = me
            order = new
            width *= 2


def _window_hashes(contexts: np.ndarray) -> Iterator[np.ndarray]:
    """For each place the hashes of the contexts' LENGTH bytes from there."""
    base, back, last = (np.uint64(pow(BASE, k, 1 << 64)) for k in (1, -1, LENGTH - 1))
    columns = np.ascontiguousarray(contexts.T)
    h = np.zeros(len(contexts), np.uint64)
    for k in reversed(range(LENGTH)):
        h *= base
        h += columns[k]
        h += np.uint64(1)
    for p in range(WINDOW):
        yield h
        if p + 1 < WINDOW:
            h = (h - columns[p] - np.uint64(1)) * back + (columns[p + LENGTH] + np.uint64(1)) * last


def _recurring(group: np.ndarray, doc: np.ndarray, low: np.ndarray, high: np.ndarray,
               contexts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffixes (row, place) whose LENGTH bytes have a hash that several ids have
    at that place of the group, those of one hash together, and where each hash
    starts."""
    salt = mix(group.astype(np.uint64) + np.uint64(1))
    rows, places, starts, seen = [], [], [], 0
    for p, h in enumerate(_window_hashes(contexts)):
        r = np.flatnonzero((low <= p) & (p + LENGTH <= high))
        key = mix(h[r] + salt[r])
        order, first, _, several = _shared(key, doc[r])
        if several.any():
            key = key[order][several]
            rows.append(r[order][several])
            places.append(np.full(len(key), p))
            starts.append(seen + np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])))
            seen += len(key)
    if not rows:
        return np.empty(0, int), np.empty(0, int), np.empty(0, int)
    return np.concatenate(rows), np.concatenate(places), np.concatenate(starts)


def _same_bytes(contexts: np.ndarray, r: np.ndarray, s: np.ndarray, at: np.ndarray,
                to: np.ndarray) -> np.ndarray:
    """Whether the LENGTH bytes of rows r from ``at`` are those of rows s from ``to``."""
    spans = np.lib.stride_tricks.sliding_window_view(contexts.ravel(), LENGTH)
    out = np.empty(len(r), bool)
    for k in range(0, len(r), PAIRS):
        x = slice(k, k + PAIRS)
        out[x] = (spans[r[x] * CONTEXT + at[x]] == spans[s[x] * CONTEXT + to[x]]).all(axis=1)
    return out


def repeated_windows(key: np.ndarray, doc: np.ndarray, low: np.ndarray, high: np.ndarray,
                     contexts: np.ndarray) -> np.ndarray:
    """For contexts (anchor, id, valid range of bytes) in the order of their
    keys: which of the WINDOW windows of each also are in one with a smaller
    id."""
    out = np.zeros((len(key), WINDOW), bool)
    _, ids = np.unique(key, return_inverse=True)
    row, at, start = _recurring(ids, doc, low, high, contexts)
    if not len(row):
        return out
    # the first suffix of each hash is sorted, the others follow it
    group = ids[row[start]].astype(np.int64) * WINDOW + at[start]
    o = np.argsort(group, kind="stable")
    some, first = np.unique(row[start][o], return_inverse=True)
    place, group = at[start][o], group[o]
    sufs = Suffixes(contexts[some])
    order = sufs.sort(first, place, group)
    first, place, group = first[order], place[order], group[order]
    near = np.zeros(len(start), bool)  # of one extension with the one before
    pair = np.flatnonzero(group[1:] == group[:-1])
    near[pair + 1] = sufs.common(first[pair], first[pair + 1], place[pair]) == LENGTH
    o = o[order]
    size = np.diff(start, append=len(row))[o]
    r, p = (ragged_take(x, start[o], size) for x in (row, at))
    equal = np.ones(len(r), bool)  # to the suffix before
    equal[np.cumsum(size) - size] = near
    x = np.flatnonzero(equal)
    equal[x] = _same_bytes(contexts, r[x], r[x - 1], p[x], p[x - 1])
    run = np.cumsum(~equal) - 1
    least = np.full(run[-1] + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, run, doc[r])
    out[r, p] = doc[r] > least[run]
    return out


def _merge(start: np.ndarray, end: np.ndarray, group: np.ndarray) -> tuple:
    """Unions of [start, end) that touch or overlap, within each group; sorted
    by group and start."""
    if not len(start):
        return start, end, group
    big = np.int64(1) << np.int64(40)
    reach = np.maximum.accumulate(group * big + end) - group * big
    new = np.concatenate([[True], (group[1:] != group[:-1]) | (start[1:] > reach[:-1])])
    at = np.flatnonzero(new)
    return start[at], np.maximum.reduceat(end, at), group[at]


def _context_key(h: np.ndarray, low: np.ndarray, high: np.ndarray, contexts: np.ndarray) -> np.ndarray:
    """Equal for equal contexts: 16 bytes as a pair of hashes would do, here
    one of the bytes and the valid range."""
    out = mix(h * np.uint64(31) + low.astype(np.uint64) * np.uint64(131) + high.astype(np.uint64))
    words = np.ascontiguousarray(contexts).view(np.uint64)
    for k in range(words.shape[1]):
        out = mix(out ^ words[:, k])
    return out


SPANS = "id bigint, row_key bigint, spans binary"
RANGES = ("i8", "i8", "i8", "i8")


def _merged(doc: np.ndarray, row: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Unions of the ranges of each row."""
    o = np.lexsort((start, row, doc))
    doc, row = doc[o], row[o]
    new = np.concatenate([np.ones(min(1, len(o)), bool), (doc[1:] != doc[:-1]) | (row[1:] != row[:-1])])
    start, end, group = _merge(start[o], end[o], np.cumsum(new) - 1)
    at = np.flatnonzero(new)[group]
    return [doc[at], row[at], start, end]


def _ranges(table: pa.Table) -> list[np.ndarray]:
    parts = [_unpack(body.as_py(), *RANGES) for body in table.column("body")]
    return _merged(*(np.concatenate(x) for x in zip(*parts, strict=True)))


def _gather(table: pa.Table) -> pa.Table:
    """One row for each text, with its ranges from all buckets."""
    doc, row, start, end = _ranges(table)
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (row[1:] != row[:-1])]))
    ends = np.append(new[1:], len(doc))
    body = np.stack([start, end], axis=1).astype(np.int64)
    return pa.table({"id": pa.array(doc[new], pa.int64()), "row_key": pa.array(row[new], pa.int64()),
                     "spans": pa.array([body[x:y].tobytes() for x, y in zip(new, ends, strict=True)],
                                       pa.binary())})


def _rows(docs: DataFrame) -> DataFrame:
    return docs.filter(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("bigint").alias("id"), whole_text().alias("text"),
        F.xxhash64(whole_text()).alias("row_key"))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(id, spans): the byte ranges to remove from an id's texts, as
    (row_key, spans) entries; ``row_key`` is the xxhash64 of the text."""
    spark = docs.sparkSession
    ship_package(spark)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))  # few: short messages pack badly
    width = _width(buckets)
    rows = _rows(docs)
    shared = shared_anchors(rows, buckets)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = []
        for whole in batches:
            for b in bounded(whole, "text", PIECE_BYTES):
                data, starts, at, h = anchors([t.encode() for t in b.column("text").to_pylist()])
                text = np.searchsorted(starts, at, side="right") - 1
                lists = b.column("hashes").to_pylist()
                known = _wide(np.frombuffer(b"".join(lists), np.uint8), TELL).astype(np.int64) \
                    + (np.repeat(np.arange(b.num_rows), [len(x) // TELL for x in lists]) << 8 * TELL)
                mine = (h & np.uint64((1 << 8 * TELL) - 1)).astype(np.int64) + (text << 8 * TELL)
                keep = np.append(known, -1)[np.searchsorted(known, mine)] == mine
                low, high = reach(at, h, starts[text], starts[text + 1])
                keep &= high - low >= LENGTH
                at, h, text, low, high = at[keep], h[keep], text[keep], low[keep], high[keep]
                off = at - BEFORE
                padded = np.concatenate([np.zeros(BEFORE, np.uint8), data, np.zeros(CONTEXT, np.uint8)])
                ctx = np.lib.stride_tricks.sliding_window_view(padded, CONTEXT)[at].copy()
                place = np.arange(CONTEXT)[None, :]
                ctx[(place < low[:, None]) | (place >= high[:, None])] = 0
                parts.append((h, np.asarray(b.column("id"))[text], np.asarray(b.column("row_key"))[text],
                              off - starts[text], low.astype(np.int8), high.astype(np.int8), ctx))
        if not parts:
            return
        h, doc, row, off, low, high, ctx = (np.concatenate(x) for x in zip(*parts, strict=True))
        del parts
        # equal contexts of this task: those of the smallest id stand for all
        order, first, _ = _owners(_context_key(h, low, high, ctx), doc)
        own = doc[order] == np.repeat(doc[order[first]], np.diff(np.append(first, len(order))))
        later, sent = order[~own], order[own]
        later = later[high[later] - low[later] >= LENGTH]
        sent = sent[np.argsort(h[sent], kind="stable")]
        both = zip(_dealt(later, doc[later] % buckets, buckets),
                   _dealt(sent, (h[sent] % np.uint64(buckets)).astype(np.int64), buckets), strict=True)
        for k, (x, y) in enumerate(both):
            if len(x) or len(y):
                yield _batch([k], [_pack(doc[x], row[x], off[x] + low[x], off[x] + high[x],
                                         doc[y], row[y], off[y], low[y], high[y], ctx[y], level=6)])

    def messages(keys: np.ndarray, doc: np.ndarray, row: np.ndarray, start: np.ndarray,
                 end: np.ndarray) -> pa.Table:
        return _messages((k, _pack(doc[m], row[m], start[m], end[m]))
                         for k, m in enumerate(_dealt(np.arange(len(doc)), keys, width * width)) if len(m))

    def settle(bucket: tuple, table: pa.Table) -> pa.Table:
        spans, parts = [], []
        for body in table.column("body"):
            got = _unpack(body.as_py(), *RANGES, "i8", "i8", "i8", "i1", "i1", "u1")
            spans.append(got[:4])
            parts.append(got[4:])
        doc, row, off, low, high, ctx = (np.concatenate(x) for x in zip(*parts, strict=True))
        del parts
        if len(doc):
            ctx = ctx.reshape(-1, CONTEXT)
            h = _gram_hashes(ctx[:, BEFORE:BEFORE + GRAM])
            order, first, _ = _owners(_context_key(h, low, high, ctx), doc)
            which = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(order))))
            own = doc[order] == doc[order[first]][which]
            later = order[~own]
            later = later[high[later] - low[later] >= LENGTH]
            spans.append([doc[later], row[later], off[later] + low[later], off[later] + high[later]])
            # the places of each context in its smallest id
            places, which = order[own], which[own]
            # contexts that differ, of anchors that have several of them
            key = h[order[first]]
            one = np.argsort(key, kind="stable")
            _, inverse, count = np.unique(key[one], return_inverse=True, return_counts=True)
            one = one[count[inverse] > 1]
            key = key[one]
            edge = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]])) \
                if len(one) else np.zeros(1, int)
            lo = 0
            while lo < len(edge) - 1:
                hi = max(lo + 1, int(np.searchsorted(edge, edge[lo] + ROWS, side="right")) - 1)
                some = one[edge[lo]:edge[hi]]
                x = order[first[some]]
                hit, place = np.nonzero(repeated_windows(h[x], doc[x], low[x], high[x], ctx[x]))
                # windows side by side are one range
                new, last = (np.flatnonzero(np.diff(hit * 2 * WINDOW + place, **{end: -2}) != 1)
                             for end in ("prepend", "append"))
                size, hit, place = place[last] - place[new] + LENGTH, hit[new], place[new]
                begin = np.searchsorted(which, some[hit])
                times = np.searchsorted(which, some[hit], side="right") - begin
                x = ragged_take(places, begin, times)
                start = off[x] + np.repeat(place, times)
                spans.append([doc[x], row[x], start, start + np.repeat(size, times)])
                lo = hi
        doc, row, start, end = _merged(*(np.concatenate(x) for x in zip(*spans, strict=True)))
        return messages(_relays(bucket[0].as_py(), doc % buckets, width), doc, row, start, end)

    def relay(table: pa.Table) -> pa.Table:
        doc, row, start, end = _ranges(table)
        return messages(doc % buckets, doc, row, start, end)

    near = rows.join(shared.hint("merge"), "id")
    return (near.mapInArrow(send, MESSAGE).groupBy("bucket").applyInArrow(settle, MESSAGE)
            .groupBy("bucket").applyInArrow(relay, MESSAGE)
            .groupBy("bucket").applyInArrow(_gather, SPANS)
            .groupBy("id").agg(F.collect_list(F.struct("row_key", "spans")).alias("spans")))


KEPT = "doc_id bigint, n_bytes bigint, kept binary, starts array<bigint>, ends array<bigint>"


def _with_spans(docs: DataFrame) -> DataFrame:
    # the texts are dealt by id once, for this join and the one inside
    got = _rows(docs).join(repeated_spans(docs).hint("merge"), "id", "left")
    own = F.transform(F.filter("spans", lambda s: s["row_key"] == F.col("row_key")),
                      lambda s: s["spans"])
    none = docs.filter(F.col("doc_id").isNull()).select(
        F.lit(None).cast("bigint").alias("id"), whole_text().alias("text"),
        F.lit(None).cast("array<binary>").alias("spans"))
    return got.select("id", "text", own.alias("spans")).union(none)


def _cut(batch: pa.RecordBatch) -> Iterator[tuple]:
    """(id, bytes, spans, bytes left) of each row."""
    for i, text, spans in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(),
                              batch.column("spans").to_pylist(), strict=True):
        raw = text.encode()
        s = np.frombuffer(b"".join(spans or ()), np.int64).reshape(-1, 2)
        s = s[np.argsort(s[:, 0], kind="stable")]
        start, end, _ = _merge(s[:, 0], s[:, 1], np.zeros(len(s), np.int64))
        a = [0, *end.tolist()]
        b = [*start.tolist(), len(raw)]
        yield i, raw, start, end, b"".join([raw[x:y] for x, y in zip(a, b, strict=True)])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, kept, starts, ends): the bytes left of each text and
    the ranges that were removed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in bounded(whole, "text", PIECE_BYTES):
                got = [(i, len(raw), kept, s.tolist(), e.tolist()) for i, raw, s, e, kept in _cut(b)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*got, strict=True), (
                        pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()),
                        pa.list_(pa.int64())), strict=True)],
                    names=["doc_id", "n_bytes", "kept", "starts", "ends"])

    return _with_spans(docs).mapInArrow(run, KEPT)


def digests(kept: DataFrame) -> DataFrame:
    """The counts and digest of rows of ``remove_repeats``."""
    return kept.select("doc_id", "n_bytes",
                       (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
                       F.size("starts").cast("bigint").alias("n_spans"),
                       F.sha2("kept", 256).alias("kept_sha256"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(remove_repeats(documents(spark, sf_dir)))
