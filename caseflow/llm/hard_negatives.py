"""Operator 12: hard negatives from Hilbert-ordered blocks with zone maps.

*Blocks.*  Rows are sorted by label and by their place on a Hilbert curve
through all dimensions (each cut into 2^``BITS`` parts around its mean), and
written as Parquet blocks of at most ``ROWS`` rows of one label.  A block's
zone map is the least and largest component in each dimension.  ``SHELF``
blocks make a shelf.

*Windows.*  A search asks, for each anchor and score window [low, high], for
the first ``TOP`` rows by score.  Positives have one window: all scores from
the anchor's fifth best inside its own block on.  Negatives have one window for
each positive p: from 0.8 p to p.  The anchor times a zone map, in interval
arithmetic, bounds the scores of a block from both sides; a block is read for
the anchors of which it may hold a score inside a window, and for no others.

*Work.*  Anchors are dealt in groups of at most ``GROUP``.  First each (group,
shelf) meets the zone maps and names the blocks to read; then the named blocks
alone meet the group.  A task holds one group and one shelf; its result is at
most ``TOP`` rows for a window, and a merge by window ends the search.  Nothing
depends on the size of a label or on repeated vectors.

Defined results: rows with a null label, a null vector, or a null or non-finite
component take no part.  Shorter vectors count as padded with zeros; an empty
vector has score 0 with any.  floor(256 x) is held between -2^20 and 2^20, so
that scores are exact (no such component is in a unit vector).  Rows that repeat
an id are rows of their own: each is an anchor if the id says so, and only the
anchor row itself isn't among its positives.  A null id is no anchor, and comes
last among equal scores.  Rows equal in score and id are interchangeable.  An
empty table gives an empty result.  Only ``vec_id``, ``embedding`` and
``label`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseflow.llm.common import renamed, ship_package, stored

ROWS = 256
VALUES = 1 << 18  # components of a block at most
SHELF = 32
GROUP = 2048
BITS = 3
TOP = 5
SCALE = 256
MOST = 1 << 20
ANCHORS = 100  # ids that this divides
RELABEL, LABELS = 7, 10
LOW_PART, OF = 80, 100
HELD = 1 << 20  # candidates that a task holds before it keeps the best alone
ROW = "vec_id bigint, label bigint, q array<int>"
PLACED = ROW + ", row bigint"
BLOCK = ("part int, k int, label bigint, anchors int, anchors_before bigint, lo array<int>, hi array<int>, "
         "ids array<bigint>, q array<int>")
FOUND = "anchor bigint, slot int, score bigint, id bigint"


def hilbert_keys(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve, as rows of bytes that sort like them, of
    points with coordinates below 2^bits (one point a row).  The transform is
    Skilling's (Programming the Hilbert curve, 2004)."""
    x = cells.T.astype(np.uint32)
    for b in range(bits - 1, 0, -1):
        low = np.uint32((1 << b) - 1)
        for i in range(len(x)):
            up = (x[i] >> np.uint32(b) & np.uint32(1)).astype(bool)
            swap = np.where(up, np.uint32(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(up, low, swap)
            x[i] ^= swap
    x = np.bitwise_xor.accumulate(x, axis=0)
    turn = np.zeros(x.shape[1], np.uint32)
    for b in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> np.uint32(b) & np.uint32(1), np.uint32((1 << b) - 1), np.uint32(0))
    x ^= turn
    planes = [(x >> np.uint32(b) & np.uint32(1)).astype(np.uint8) for b in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T, axis=1)


def matrix(lists: pa.Array, dims: int) -> np.ndarray:
    """Lists as rows, padded with zeros."""
    offsets = np.asarray(lists.offsets)
    sizes = np.diff(offsets)
    flat = np.asarray(lists.values)[offsets[0]:offsets[-1]]
    if (sizes == dims).all():
        return flat.reshape(-1, dims)
    out = np.zeros((len(sizes), dims), flat.dtype)
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T of integers, exact."""
    most = max(1, a.shape[1]) * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def bounds(v: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest score that each anchor can have in a block."""
    up, down = np.maximum(v, 0), np.minimum(v, 0)
    return product(up, lo) + product(down, hi), product(up, hi) + product(down, lo)


def prepare(embeddings: DataFrame) -> DataFrame:
    """(vec_id, label, q) of the rows that take part."""
    label = F.col("label").cast("bigint")
    label = F.when(F.col("vec_id") % RELABEL == 0, (label + 1) % LABELS).otherwise(label)
    rows = embeddings.select(F.col("vec_id").cast("bigint").alias("vec_id"), label.alias("label"),
                             F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.filter("label IS NOT NULL AND v IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column("v")
            offsets = np.asarray(lists.offsets)
            x = lists.values.to_numpy(zero_copy_only=False).astype(np.float64)  # null: NaN
            bad = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
            fit = bad[offsets[1:]] == bad[offsets[:-1]]
            with np.errstate(over="ignore", invalid="ignore"):
                q = np.clip(np.floor(np.nan_to_num(x * SCALE)), -MOST, MOST).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(q))
            out = pa.RecordBatch.from_arrays([b.column("vec_id"), b.column("label"), lists],
                                             names=["vec_id", "label", "q"])
            yield out.filter(pa.array(fit))

    ship_package(embeddings.sparkSession)
    return rows.mapInArrow(run, ROW)


def spreads(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Mean and spread of each dimension: tasks add up, the driver gets two
    numbers a dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((3, 0))
        for b in batches:
            lists = b.column("q")
            sizes = np.diff(np.asarray(lists.offsets))
            x = matrix(lists, int(sizes.max(initial=0))).astype(np.float64)
            if x.shape[1] > sums.shape[1]:
                sums = np.pad(sums, ((0, 0), (0, x.shape[1] - sums.shape[1])))
            sums[:, :x.shape[1]] += [np.full(x.shape[1], len(x)), x.sum(axis=0), (x * x).sum(axis=0)]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(sums.shape[1]), pa.int32()), *map(pa.array, sums)],
                                         names=["dim", "n", "s", "ss"])

    got = (rows.select("q").mapInArrow(run, "dim int, n double, s double, ss double").groupBy("dim")
           .agg(*[F.sum(c).alias(c) for c in ("n", "s", "ss")]).orderBy("dim").collect())
    n, s, ss = (np.array([r[c] for r in got]) for c in ("n", "s", "ss"))
    mean = s / np.maximum(n, 1)
    return mean, np.sqrt(np.maximum(ss / np.maximum(n, 1) - mean * mean, 1e-9))


def sorted_blocks(rows: DataFrame, mean: np.ndarray, spread: np.ndarray, block_rows: int, shelf: int) -> DataFrame:
    """The blocks, numbered from 0 in the order of the curve."""
    dims = len(mean)
    most = max(1, min(block_rows, VALUES // max(1, dims)))

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            # cells of equal width over two spreads on either side of the mean
            x = (matrix(b.column("q"), dims) - mean) / (4 * spread) + 0.5
            cells = np.clip(np.floor(x * (1 << BITS)), 0, (1 << BITS) - 1)
            keys = hilbert_keys(cells, BITS) if dims else np.zeros((b.num_rows, 1), np.uint8)
            keys = pa.array([k.tobytes() for k in keys], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns, keys], names=["vec_id", "label", "q", "row", "key"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, before = TaskContext.get().partitionId(), 0, 0
        ids, label, q = np.empty(0, object), np.empty(0, np.int64), np.empty((0, dims), np.int32)

        def blocks(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal k, before, ids, label, q
            edges = np.flatnonzero(np.diff(label, prepend=label[:1] - 1, append=label[-1:] + 1)).tolist()
            done = 0
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                for lo in range(a, b, most):
                    hi = min(lo + most, b)
                    if hi == len(label) and not last and hi - lo < most:
                        break
                    some = q[lo:hi]
                    anchors = sum(i is not None and i % ANCHORS == 0 for i in ids[lo:hi])
                    yield pa.RecordBatch.from_pylist(
                        [{"part": part, "k": k, "label": int(label[lo]), "anchors": anchors,
                          "anchors_before": before, "lo": some.min(axis=0), "hi": some.max(axis=0),
                          "ids": list(ids[lo:hi]), "q": some.ravel()}], BLOCK_SCHEMA)
                    k, before, done = k + 1, before + anchors, hi
            ids, label, q = ids[done:], label[done:], q[done:]

        for b in batches:
            ids = np.concatenate([ids, np.array(b.column("vec_id").to_pylist(), object)])
            label = np.concatenate([label, np.asarray(b.column("label"))])
            q = np.concatenate([q, matrix(b.column("q"), dims)])
            yield from blocks(False)
        if len(label):
            yield from blocks(True)

    # equal vectors lie side by side, in as many tasks as they need
    order = ["label", "key", "row"]
    cut_rows = (rows.mapInArrow(keyed, PLACED + ", key binary").repartitionByRange(*order)
                .sortWithinPartitions(*order).drop("key", "row").mapInArrow(cut, BLOCK))
    blocks = stored(cut_rows, "negative_blocks")
    # numbers over all parts: one row for each part written
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = (blocks.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("anchors").alias("a"))
             .select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__n"),
                     F.coalesce(F.sum("a").over(before), F.lit(0)).alias("__a")))
    numbered = blocks.join(F.broadcast(first), "part").withColumn("block", F.col("__n") + F.col("k"))
    return numbered.select("block", F.floor(F.col("block") / shelf).cast("bigint").alias("shelf"), "label",
                           (F.col("__a") + F.col("anchors_before")).alias("first_anchor"), "anchors",
                           "lo", "hi", "ids", "q")


BLOCK_SCHEMA = pa.schema([("part", pa.int32()), ("k", pa.int32()), ("label", pa.int64()), ("anchors", pa.int32()),
                          ("anchors_before", pa.int64()), ("lo", pa.list_(pa.int32())),
                          ("hi", pa.list_(pa.int32())), ("ids", pa.list_(pa.int64())), ("q", pa.list_(pa.int32()))])
NO_SCORE = -(1 << 62)


def anchors_of(blocks: DataFrame, top: int, group: int) -> DataFrame:
    """(anchor, grp, block, pos, vec_id, label, v, low, high): each anchor with
    the window of its positives, which the other rows of its block open."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("anchor", pa.int64()), ("grp", pa.int64()), ("block", pa.int64()), ("pos", pa.int32()),
                            ("vec_id", pa.int64()), ("label", pa.int64()), ("v", pa.list_(pa.int32())),
                            ("low", pa.list_(pa.int64())), ("high", pa.list_(pa.int64()))])
        for b in batches:
            for r in b.to_pylist():
                q = np.array(r["q"], np.int32).reshape(len(r["ids"]), -1)
                at = [i for i, x in enumerate(r["ids"]) if x is not None and x % ANCHORS == 0]
                scores = product(q[at], q)
                out = []
                for n, (i, s) in enumerate(zip(at, scores, strict=True)):
                    rest = np.delete(s, i)
                    low = int(np.partition(rest, -top)[-top]) if len(rest) >= top else NO_SCORE
                    no = r["first_anchor"] + n
                    out.append({"anchor": no, "grp": no // group, "block": r["block"], "pos": i, "vec_id": r["ids"][i],
                                "label": r["label"], "v": q[i], "low": [low], "high": [-NO_SCORE]})
                yield pa.RecordBatch.from_pylist(out, schema)

    rows = blocks.filter("anchors > 0").select("block", "label", "first_anchor", "ids", "q")
    return rows.mapInArrow(run, "anchor bigint, grp bigint, block bigint, pos int, vec_id bigint, label bigint, "
                                "v array<int>, low array<bigint>, high array<bigint>")


def _windows(lists: pa.Array, pad: int) -> np.ndarray:
    """Window bounds of each anchor, filled up with windows of no score."""
    sizes = np.diff(np.asarray(lists.offsets))
    out = np.full((len(sizes), int(sizes.max(initial=1))), pad, np.int64)
    out[np.arange(out.shape[1]) < sizes[:, None]] = lists.flatten()
    return out


class Anchors:
    """A group's anchors in arrays."""

    def __init__(self, t: pa.Table, dims: int):
        t = t.combine_chunks()
        column = {c: t.column(c).combine_chunks() for c in t.column_names}
        self.no, self.block, self.pos, self.label = (np.asarray(column[c]) for c in ("anchor", "block", "pos", "label"))
        self.v = matrix(column["v"], dims)
        self.low, self.high = _windows(column["low"], -NO_SCORE), _windows(column["high"], NO_SCORE)

    def wants(self, label: np.ndarray, lo: np.ndarray, hi: np.ndarray, same: bool) -> np.ndarray:
        """Which anchors must read which blocks."""
        least, most = bounds(self.v, lo, hi)
        want = np.zeros(least.shape, bool)
        for k in range(self.low.shape[1]):
            want |= (most >= self.low[:, k:k + 1]) & (least <= self.high[:, k:k + 1])
        return want & ((self.label[:, None] == label[None]) == same)


class Best:
    """The first ``top`` rows for each anchor's window, of the rows seen."""

    def __init__(self, anchors: Anchors, top: int):
        self.of, self.top = anchors, top
        self.a, self.score, self.id, self.null = (np.empty(0, t) for t in (np.int64, np.int64, np.int64, bool))

    def add(self, a: np.ndarray, score: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        new = zip((self.a, self.score, self.id, self.null), (a, score, ids, null), strict=True)
        self.a, self.score, self.id, self.null = (np.concatenate(x) for x in new)
        if len(self.a) > HELD:
            keep = np.unique(np.concatenate([at for _, at in self.first()]))
            self.a, self.score, self.id, self.null = (x[keep] for x in (self.a, self.score, self.id, self.null))

    def first(self) -> Iterator[tuple[int, np.ndarray]]:
        """For each window its rows, by their places here."""
        order = np.lexsort((self.id, self.null, -self.score, self.a))
        a, score = self.a[order], self.score[order]
        for k in range(self.of.low.shape[1]):
            fit = np.flatnonzero((score >= self.of.low[a, k]) & (score <= self.of.high[a, k]))
            own = a[fit]
            start = np.searchsorted(own, own)
            yield k, order[fit[np.arange(len(fit)) - start < self.top]]


def search(anchors: DataFrame, blocks: DataFrame, dims: int, same: bool, top: int) -> DataFrame:
    """(anchor, slot, score, id, rank): the first ``top`` rows by score and id
    inside each window (slot), of the anchor's label or of the other labels."""
    last = blocks.agg(F.max("shelf")).first()[0] or 0
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(last).cast("bigint")))
    dealt = anchors.drop("vec_id").withColumn("shelf", every)
    groups = anchors.select("grp").distinct().withColumn("shelf", every)
    zones = renamed(groups.join(blocks.select("shelf", "block", "label", "lo", "hi"), "shelf"))

    def choose(key, some: pa.Table, of: pa.Table) -> pa.Table:
        names = pa.array([], pa.int64())
        if some.num_rows and of.num_rows:
            lo, hi = (matrix(of.column(c).combine_chunks(), dims) for c in ("lo", "hi"))
            want = Anchors(some, dims).wants(np.asarray(of.column("label").combine_chunks()), lo, hi, same)
            names = of.column("block").combine_chunks().filter(pa.array(want.any(axis=0)))
        n = len(names)
        return pa.table([pa.array([key[0].as_py()] * n, pa.int64()), pa.array([key[1].as_py()] * n, pa.int64()),
                         names], names=["grp", "shelf", "block"])

    def read(key, some: pa.Table, of: pa.Table) -> pa.Table:
        got = []
        if some.num_rows and of.num_rows:
            group = Anchors(some, dims)
            best = Best(group, top)
            lo, hi = (matrix(of.column(c).combine_chunks(), dims) for c in ("lo", "hi"))
            want = group.wants(np.asarray(of.column("label").combine_chunks()), lo, hi, same)
            low, high = group.low.min(axis=1), group.high.max(axis=1)
            for k, r in enumerate(of.select(["block", "ids", "q"]).to_batches(max_chunksize=1)):
                who = np.flatnonzero(want[:, k])
                if not len(who):
                    continue
                ids = r.column("ids").flatten()
                null = np.asarray(ids.is_null())
                ids = np.asarray(ids.fill_null(0))
                scores = product(group.v[who], np.asarray(r.column("q").flatten()).reshape(len(ids), dims))
                fit = (scores >= low[who, None]) & (scores <= high[who, None])
                if same:
                    own = np.flatnonzero(group.block[who] == r.column("block")[0].as_py())
                    fit[own, group.pos[who[own]]] = False
                a, at = np.nonzero(fit)
                best.add(who[a], scores[a, at], ids[at], null[at])
            for slot, at in best.first():
                ids = pa.array(best.id[at], mask=best.null[at])
                got.append(pa.table([pa.array(group.no[best.a[at]], pa.int64()),
                                     pa.array(np.full(len(at), slot), pa.int32()),
                                     pa.array(best.score[at], pa.int64()), ids],
                                    names=["anchor", "slot", "score", "id"]))
        return pa.concat_tables(got) if got else pa.table(
            [pa.array([], t) for t in (pa.int64(), pa.int32(), pa.int64(), pa.int64())],
            names=["anchor", "slot", "score", "id"])

    keys = ["grp", "shelf"]
    named = stored(dealt.groupBy(*keys).cogroup(zones.groupBy(*keys)).applyInArrow(
        choose, "grp bigint, shelf bigint, block bigint"), "negative_named")
    chosen = renamed(named.join(blocks.select("block", "label", "lo", "hi", "ids", "q"), "block"))
    found = dealt.groupBy(*keys).cogroup(chosen.groupBy(*keys)).applyInArrow(read, FOUND)
    first = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= top)


def mine(embeddings: DataFrame, top: int = TOP, block_rows: int = ROWS, shelf: int = SHELF,
         group: int = GROUP) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score)."""
    # a number for each row, fixed as it is written
    rows = stored(prepare(embeddings).withColumn("row", F.monotonically_increasing_id()), "negative_rows")
    mean, spread = spreads(rows)
    blocks = stored(sorted_blocks(rows, mean, spread, block_rows, shelf), "negative_numbered")
    anchors = stored(anchors_of(blocks, top, group), "negative_anchors")
    positives = stored(search(anchors, blocks, len(mean), True, top), "negative_positives")
    # a window for each positive, in the order of their ranks
    p = F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"])
    least = F.transform("p", lambda s: -F.floor(s * -LOW_PART / F.lit(OF).cast("decimal(3,0)")).cast("bigint"))
    windows = (positives.groupBy("anchor").agg(p.alias("p"))
               .select("anchor", least.alias("low"), F.transform("p", lambda s: s).alias("high")))
    asked = stored(anchors.drop("low", "high").join(windows, "anchor"), "negative_asked")
    negatives = search(asked, blocks, len(mean), False, top)
    of = positives.select("anchor", (F.col("rank") - 1).alias("slot"), F.col("id").alias("positive_id"),
                          F.col("score").alias("positive_score"))
    ids = anchors.select("anchor", F.col("vec_id").alias("anchor_id"))
    return (negatives.join(of, ["anchor", "slot"]).join(ids, "anchor")
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_dot_product(a.q, b.q)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
ranked AS (
  SELECT p.anchor_id, p.positive_id,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id
                            ORDER BY s.score DESC, s.other_id)::INTEGER AS rank,
         s.other_id AS negative_id, p.positive_score, s.score AS negative_score
  FROM positives p JOIN scored s ON p.anchor_id = s.anchor_id AND NOT s.same
   AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score)
SELECT * FROM ranked WHERE rank <= 5
"""
