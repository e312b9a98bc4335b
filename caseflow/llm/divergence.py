"""Operator 13: how the sources of a language differ in their terms.

*Fold.*  Each task folds whole documents into hash stripes: for each language
and term the number of documents, and the occurrences by source.  A task that
holds ``HELD`` entries spills its stripes and goes on.
*Merge.*  Stripes are dealt and sorted by (lang, term); a task adds up those of
one key as they pass, and holds one stripe of a key that goes on.  Terms in fewer than ``MIN_DOCS``
documents of their language end here.
*Emit.*  A language's kept stripes are cut into chunks of at most ``DENSE``
(term, source) places, each with the language's totals.  A chunk gives each
pair of sources the sum of their differences over its terms, and each source
its ``TOP`` terms; sums and ranks over the chunks are small.

A term is a run of ASCII letters and of characters from U+0080 on, with A-Z
lower-cased.  With count c of a term in a group of N occurrences of V kept
terms, p = 1 + floor(10^9 (c + 5) / (N + 5 V)); all numbers are integers.

Defined results: null text, lang and source count as ''; each row is a
document, also where ids repeat or are null.  A group without kept terms has
N = 0; in a language without kept terms all pairs have the value 0.  Equal
values are ranked by the UTF-8 bytes of their item.  An empty table gives an
empty result.  Only ``text``, ``lang`` and ``source`` are read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseflow.llm.common import documents, renamed, ship_package, stored

MIN_DOCS = 30
SMOOTH = 5
SCALE_STEPS, SCALE_STEP = 3, 1000  # 10^9 in steps, so that no product leaves 64 bits
TOP = 50
HELD = 600_000
PIECE = 1 << 20
DENSE = 1 << 16
AT_ONCE = 20_000  # rows of stripes that are added up together
STRIPE = "lang string, term string, docs bigint, sources array<string>, counts array<bigint>"
STRIPES = pa.schema([("lang", pa.string()), ("term", pa.string()), ("docs", pa.int64()),
                     ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
# letters to lower case, bytes from 128 on as they are, all others to spaces
TO_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32
                 for b in range(256))


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, a piece of it at a time."""
    at = 0
    while len(text) - at > PIECE:
        cut = at + PIECE
        while cut < len(text) and TO_TERMS[text[cut]] != 32:
            cut += 1
        yield text[at:cut].translate(TO_TERMS).split()
        at = cut
    yield text[at:].translate(TO_TERMS).split()


def _lists(values: pa.Array, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), values)


def _batch(lang, term, docs, sources: pa.Array, counts: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
    def strings(x) -> pa.Array:
        return x if isinstance(x, pa.Array) else pa.array(x, pa.string())

    return pa.RecordBatch.from_arrays(
        [strings(lang), strings(term), pa.array(docs, pa.int64()), _lists(sources, sizes),
         _lists(pa.array(counts, pa.int64()), sizes)], schema=STRIPES)


class Fold:
    """Stripes of one task, kept by source: lang -> source -> term -> count,
    and lang -> term -> documents."""

    def __init__(self):
        self.counts: dict[str, dict[str, Counter]] = defaultdict(lambda: defaultdict(Counter))
        self.docs: dict[str, Counter] = defaultdict(Counter)
        self.held = 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        counts, seen = self.counts[lang][source], set()
        before = len(counts)
        for terms in terms_of(text):
            counts.update(terms)
            seen.update(terms)
        docs = self.docs[lang]
        self.held += len(counts) - before - len(docs)
        docs.update(seen)
        self.held += len(docs)

    def spill(self) -> Iterator[pa.RecordBatch]:
        """The stripes, and a stripe without term that has each language's
        sources."""
        for lang, by_source in self.counts.items():
            names = pa.array(list(by_source), pa.string())
            yield _batch([lang], [None], [0], names, np.zeros(len(names), np.int64), np.array([len(names)]))
            docs = self.docs[lang]
            place = dict(zip(docs, range(len(docs)), strict=True))
            at = [np.fromiter(map(place.__getitem__, c), np.int64, len(c)) for c in by_source.values()]
            counts = np.concatenate([np.fromiter(c.values(), np.int64, len(c)) for c in by_source.values()])
            source = np.repeat(np.arange(len(at)), [len(x) for x in at])
            at = np.concatenate(at)
            order = np.argsort(at, kind="stable")
            sizes = np.bincount(at, minlength=len(docs))
            ends = np.cumsum(sizes)
            terms, n = list(docs), list(docs.values())
            for lo in range(0, len(terms), 20_000):
                hi = min(lo + 20_000, len(terms))
                own = order[ends[lo] - sizes[lo]:ends[hi - 1]]
                yield _batch([lang] * (hi - lo), [t.decode() for t in terms[lo:hi]], n[lo:hi],
                             names.take(pa.array(source[own])), counts[own], sizes[lo:hi])
        self.__init__()


def fold(docs: DataFrame, held: int = HELD) -> DataFrame:
    """Partial stripes of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stripes = Fold()
        for b in batches:
            texts = b.column("text").cast(pa.binary())
            for lang, source, text in zip(b.column("lang").to_pylist(), b.column("source").to_pylist(),
                                          texts, strict=True):
                stripes.add(lang, source, text.as_py())
                if stripes.held > held:
                    yield from stripes.spill()
        yield from stripes.spill()

    ship_package(docs.sparkSession)
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
                         for c in ("lang", "source", "text")])
    return rows.mapInArrow(run, STRIPE)


def _starts(t: pa.Table) -> np.ndarray:
    """Where each (lang, term) of a sorted table starts."""
    n, new = t.num_rows, np.zeros(max(0, t.num_rows - 1), bool)
    for name in ("lang", "term"):
        column = pc.fill_null(t.column(name), "").combine_chunks()  # no term is empty
        new |= pc.not_equal(column.slice(1), column.slice(0, n - 1)).to_numpy(zero_copy_only=False)
    return np.concatenate([[0], np.flatnonzero(new) + 1])


def _added(t: pa.Table) -> pa.RecordBatch:
    """One stripe for each (lang, term) of a sorted table."""
    starts = _starts(t)
    group = np.repeat(np.arange(len(starts)), np.diff(starts, append=t.num_rows))
    lists = t.column("sources").combine_chunks()
    sizes = np.diff(np.asarray(lists.offsets))
    coded = lists.flatten().dictionary_encode()
    names, code = coded.dictionary, np.asarray(coded.indices, np.int64)
    cell = np.repeat(group, sizes) * len(names) + code
    counts = np.asarray(t.column("counts").combine_chunks().flatten())
    order = np.argsort(cell, kind="stable")
    cells = cell[order]
    first = np.flatnonzero(np.diff(cells, prepend=-1))
    sums = np.add.reduceat(counts[order], first) if len(first) else counts[:0]
    of, source = np.divmod(cells[first], max(1, len(names)))
    at = pa.array(starts)
    return _batch(t.column("lang").combine_chunks().take(at), t.column("term").combine_chunks().take(at),
                  np.add.reduceat(np.asarray(t.column("docs").combine_chunks()), starts),
                  names.take(pa.array(source)), sums, np.bincount(of, minlength=len(starts)))


def merge(stripes: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """One stripe for each kept term, and one without term for each language."""

    def kept(t: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
        """The stripes of whole keys; rare terms go before anything is added up."""
        docs = np.add.reduceat(np.asarray(t.column("docs").combine_chunks()), starts)
        rows = np.repeat(docs >= min_docs, np.diff(starts, append=t.num_rows))
        t = t.filter(pc.or_(pa.array(rows), pc.is_null(t.column("term").combine_chunks())))
        return _added(t) if t.num_rows else _batch([], [], [], pa.array([], pa.string()), [], np.empty(0, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for b in batches:
            held.append(pa.Table.from_batches([b]).cast(STRIPES))
            n += b.num_rows
            if n < AT_ONCE:
                continue
            t = pa.concat_tables(held)
            starts = _starts(t)
            if len(starts) > 1:
                yield kept(t.slice(0, starts[-1]), starts[:-1])
            # the last key may go on: one stripe so far
            held = [pa.Table.from_batches([_added(t.slice(starts[-1]))])]
            n = 1
        if n:
            t = pa.concat_tables(held)
            yield kept(t, _starts(t))

    return (stripes.repartition("lang", "term").sortWithinPartitions("lang", "term")
            .mapInArrow(run, STRIPE))


def scaled(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """1 + floor(10^9 * counts / totals), by long division."""
    out, rest = np.divmod(counts, totals)
    for _ in range(SCALE_STEPS):
        more, rest = np.divmod(rest * SCALE_STEP, totals)
        out = out * SCALE_STEP + more
    return out + 1


def _emit(lang: str, sources: list[str], totals: np.ndarray, kept: int, stripes: pa.Table,
          top: int) -> Iterator[tuple]:
    """(source, part, item, value) of a chunk of one language's stripes."""
    place = {s: k for k, s in enumerate(sources)}
    sizes = np.diff(np.asarray(stripes.column("sources").combine_chunks().offsets))
    term = np.repeat(np.arange(len(sizes)), sizes)
    of = np.array([place[s] for s in stripes.column("sources").combine_chunks().flatten().to_pylist()])
    counts = np.zeros((len(sizes), len(sources)), np.int64)
    counts[term, of] = np.asarray(stripes.column("counts").combine_chunks().flatten())
    p = scaled(counts + SMOOTH, totals + SMOOTH * kept)
    for a, source in enumerate(sources):
        more = np.abs(p[:, a + 1:] - p[:, a:a + 1]).sum(axis=0)
        for other, value in zip(sources[a + 1:], more.tolist(), strict=True):
            yield source, "pair", other, value
            yield other, "pair", source, value
    q = scaled(counts.sum(axis=1) + SMOOTH, np.full(len(counts), totals.sum() + SMOOTH * kept))
    names = stripes.column("term").to_pylist()
    raw = np.array([n.encode() for n in names], object)
    for a, source in enumerate(sources):
        over = np.flatnonzero((counts[:, a] > 0) & (p[:, a] > q))
        value = p[over, a] - q[over]
        for k in sorted(range(len(over)), key=lambda i: (-value[i], raw[over[i]]))[:top]:
            yield source, "term", names[over[k]], int(value[k])


def divergences(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, dense: int = DENSE) -> DataFrame:
    """(lang, source, part, item, value, rank)."""
    merged = stored(merge(fold(docs), min_docs), "divergence_stripes")
    stripes = merged.filter("term IS NOT NULL")
    # one row for each language and source, with the language's sizes
    groups = merged.filter("term IS NULL").select("lang", F.explode("sources").alias("source"))
    sums = (stripes.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("x"))
            .groupBy("lang", F.col("x.sources").alias("source")).agg(F.sum("x.counts").alias("total")))
    terms = stripes.groupBy("lang").agg(F.count(F.lit(1)).alias("kept"))
    groups = groups.join(sums, ["lang", "source"], "left").join(terms, "lang", "left").select(
        "lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("kept", F.lit(0)).alias("kept"))
    groups = stored(groups, "divergence_groups")
    sizes = groups.groupBy("lang").agg(
        F.ceil(F.max("kept") * F.count(F.lit(1)) / F.lit(dense)).cast("bigint").alias("chunks"))
    chunk = F.pmod(F.xxhash64("term"), F.col("chunks"))
    stripes = stripes.join(sizes, "lang").withColumn("chunk", chunk)
    totals = groups.join(sizes.filter("chunks > 0"), "lang").withColumn(
        "chunk", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1)))

    def run(key, some: pa.Table, of: pa.Table) -> pa.Table:
        if not some.num_rows or not of.num_rows:
            rows = []
        else:
            of = of.sort_by("source")
            rows = list(_emit(key[0].as_py(), of.column("source").to_pylist(),
                              np.asarray(of.column("total").combine_chunks()), of.column("kept")[0].as_py(),
                              some, top))
        source, part, item, value = zip(*rows, strict=True) if rows else [()] * 4
        return pa.table([pa.array([key[0].as_py()] * len(rows), pa.string()), pa.array(source, pa.string()),
                         pa.array(part, pa.string()), pa.array(item, pa.string()), pa.array(value, pa.int64())],
                        names=["lang", "source", "part", "item", "value"])

    found = stored(stripes.groupBy("lang", "chunk").cogroup(renamed(totals).groupBy("lang", "chunk")).applyInArrow(
        run, "lang string, source string, part string, item string, value bigint"), "divergence_parts")
    # all pairs of a language's sources are the result; those without terms have 0
    other = groups.select("lang", F.col("source").alias("item"))
    zero = (groups.select("lang", "source").join(other, "lang").filter("source <> item")
            .select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("bigint").alias("value")))
    pairs = (found.filter("part = 'pair'").unionByName(zero)
             .groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value")))
    best = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = pairs.unionByName(found.filter("part = 'term'")).withColumn("rank", F.row_number().over(best))
    return ranked.filter((F.col("part") == "pair") | (F.col("rank") <= top))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergences(documents(spark, sf_dir))


ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS n, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         coalesce(text, '') AS text FROM documents),
words AS (
  SELECT n, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (
  SELECT lang, term, count(*) AS all_count FROM words GROUP BY lang, term HAVING count(DISTINCT n) >= 30),
langs AS (
  SELECT lang, count(*) AS v, sum(all_count)::BIGINT AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counted AS (
  SELECT lang, source, term, count(*) AS c FROM words GROUP BY lang, source, term),
cells AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c, l.v,
         sum(coalesce(c.c, 0)) OVER (PARTITION BY g.lang, g.source)::BIGINT AS n,
         1 + 1000000000 * (k.all_count + 5) // (l.n + 5 * l.v) AS q
  FROM groups g JOIN kept k ON g.lang = k.lang JOIN langs l ON g.lang = l.lang
  LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
shares AS (
  SELECT lang, source, term, c, q, 1 + 1000000000 * (c + 5) // (n + 5 * v) AS p FROM cells),
pairs AS (
  SELECT a.lang, a.source, b.source AS item,
         coalesce((SELECT sum(abs(x.p - y.p)) FROM shares x JOIN shares y
                   ON x.lang = y.lang AND x.term = y.term
                   WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source),
found AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, (p - q)::BIGINT FROM shares WHERE c > 0 AND p > q),
ranked AS (
  SELECT lang, source, part, item, value,
         row_number() OVER (PARTITION BY lang, source, part
                            ORDER BY value DESC, encode(item))::INTEGER AS rank
  FROM found)
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
