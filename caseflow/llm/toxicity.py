"""Operator 10: toxicity by a linear classifier over character n-grams whose
features are scaled by naive Bayes log-count ratios.

A feature says whether an n-gram (``SIZES`` characters of the lower-cased text)
occurs.  From a bounded sample of labelled rows (at most ``CLASS_ROWS`` of each
class, those whose id hashes lowest) Spark counts in how many texts of each
class an n-gram's hash occurs; its ratio is

    r = log((toxic + 1) / (toxic texts + 2)) - log((clean + 1) / (clean texts + 2)).

The ``FEATURE_COUNT`` n-grams whose ratio stands out most against its standard
error are kept, and a logistic regression with an L2 penalty is fitted to the
presences times r.  Its intercept is moved from the sample's class shares to
those of all training labels.  Every whole text is scored.

Defined results: a null text counts as empty; a text without known n-grams gets
the intercept's score; null labels aren't learned from.  If one class has no
training row, the score is the class share, and 0.5 without any training row.
An empty table gives an empty result.  Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.llm.common import documents, held_out, labels, ship_package, stored, whole_text
from caseflow.llm.hashing import WORD_MULTIPLIERS, mix
from caseflow.llm.quality import training_marks
from caseflow.llm.words import bounded

FOLDS, FOLD = 5, 0
SIZES = (4, 5, 6)
HASH_BITS = 20
CLASS_ROWS = 4_000
FEATURE_COUNT = 6_000
LEAST_TEXTS = 3
PENALTY = 2e-3
STEPS = 300


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-grams of a batch (0 where one would leave its text), a
    row for each size, and where each text starts."""
    gap = "\0" * max(SIZES)
    data = np.frombuffer((gap.join(texts) + gap).lower().encode("utf-32-le", "surrogatepass"),
                         np.uint32).astype(np.uint64)
    lower = [len(t.lower()) for t in texts]
    starts = np.cumsum([0] + [n + len(gap) for n in lower])
    out = np.zeros((len(SIZES), len(data)), np.uint32)
    for row, size in enumerate(SIZES):
        h = np.full(max(0, len(data) - size + 1), np.uint64(size))
        for k in range(size):
            h += data[k:k + len(h)] * WORD_MULTIPLIERS[k]
        out[row, :len(h)] = (mix(h) >> np.uint64(64 - HASH_BITS)).astype(np.uint32)
    for a, b in zip(starts[1:].tolist(), lower, strict=True):  # the gap and what reaches into it
        for row, size in enumerate(SIZES):
            out[row, max(a - len(gap) - size + 1, a - len(gap) - b):a] = 0
    return out, starts


class Linear:
    """Weights by n-gram hash; ``place`` has a feature's number plus one."""

    def __init__(self, place: np.ndarray, weights: np.ndarray, intercept: float):
        self.place, self.weights, self.intercept = place, weights, intercept

    def found(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(text, feature) of every known n-gram, once for each text."""
        hashes, starts = grams(texts)
        n = np.uint64(len(self.weights) + 1)
        keys = []
        for row in hashes:
            at = np.flatnonzero(self.place[row])
            text = np.searchsorted(starts, at, side="right") - 1
            keys.append(text.astype(np.uint64) * n + self.place[row[at]].astype(np.uint64))
        keys = np.unique(np.concatenate(keys))
        return (keys // n).astype(np.int64), (keys % n).astype(np.int64) - 1

    def scores(self, texts: list[str]) -> np.ndarray:
        text, feature = self.found(texts)
        z = self.intercept + np.bincount(text, self.weights[feature], minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def logistic(text: np.ndarray, feature: np.ndarray, value: np.ndarray, y: np.ndarray,
             count: int) -> tuple[np.ndarray, float]:
    """Weights and intercept that minimise the mean loss plus the penalty, by
    accelerated gradient steps."""
    n = len(y)

    def times(w: np.ndarray) -> np.ndarray:
        return np.bincount(text, value * w[feature], minlength=n)

    def back(g: np.ndarray) -> np.ndarray:
        return np.bincount(feature, value * g[text], minlength=count)

    v = np.ones(count)
    for _ in range(20):  # the largest curvature
        v = back(times(v))
        norm = np.linalg.norm(v)
        v = v / max(norm, 1e-12)
    step = 1 / (0.25 * (norm + n) / n + PENALTY)
    w, b = np.zeros(count), 0.0
    wy, by, t = w, b, 1.0
    for _ in range(STEPS):
        g = (1 / (1 + np.exp(-np.clip(times(wy) + by, -700, 700))) - y) / n
        w2, b2 = wy - step * (back(g) + PENALTY * wy), by - step * g.sum()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        wy, by = w2 + (t - 1) / t2 * (w2 - w), b2 + (t - 1) / t2 * (b2 - b)
        w, b, t = w2, b2, t2
    return w, b


def sample(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """(doc_id, text, label) of the training sample."""
    order = F.xxhash64(F.lit(10), "doc_id")
    chosen = [marks.filter(F.col("label") == k).orderBy(order, "doc_id").limit(CLASS_ROWS)
              for k in (0, 1)]
    # at most 2 * CLASS_ROWS ids are broadcast
    ids = chosen[0].union(chosen[1])
    return docs.join(F.broadcast(ids), "doc_id")


def fit(docs: DataFrame, marks: DataFrame) -> Linear:
    """Learn from (doc_id, text) and (doc_id, label)."""
    counts = {r["label"]: r["count"] for r in marks.groupBy("label").count().collect()}
    toxic, clean = counts.get(1, 0), counts.get(0, 0)
    none = np.zeros(1 << HASH_BITS, np.int16)
    if not toxic or not clean:
        share = toxic / (toxic + clean) if toxic + clean else 0.5
        return Linear(none, np.zeros(0), float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    rows = stored(sample(docs, marks), "toxic_sample")

    def presences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((2, 1 << HASH_BITS), np.int64)
        for whole in batches:
            for b in bounded(whole, "text", 1 << 20):
                hashes, starts = grams(b.column("text").to_pylist())
                for i, y in enumerate(b.column("label").to_pylist()):
                    n[y, np.unique(hashes[:, starts[i]:starts[i + 1]])] += 1
        n[:, 0] = 0  # stands for no n-gram
        at = np.flatnonzero(n.sum(axis=0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[0, at]), pa.array(n[1, at])],
                                         names=["h", "clean", "toxic"])

    size = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    if not n1 or not n0:  # labels without documents
        return Linear(none, np.zeros(0), float(np.log(toxic / clean)))
    ratio = (F.log((F.col("toxic") + 1) / F.lit(n1 + 2.0))
             - F.log((F.col("clean") + 1) / F.lit(n0 + 2.0)))
    error = F.sqrt(1 / (F.col("toxic") + 1) + 1 / (F.col("clean") + 1))
    best = (rows.select("text", "label").mapInArrow(presences, "h bigint, clean bigint, toxic bigint")
            .groupBy("h").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
            .filter(F.col("clean") + F.col("toxic") >= LEAST_TEXTS)
            .select("h", ratio.alias("r"), (F.abs(ratio) / error).alias("z"))
            .orderBy(F.desc("z"), "h").limit(FEATURE_COUNT).collect())
    place = none.copy()
    place[[r["h"] for r in best]] = np.arange(1, len(best) + 1)
    ratios = np.array([r["r"] for r in best])
    finder = Linear(place, ratios, 0.0)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in bounded(whole, "text", 1 << 20):
                text, feature = finder.found(b.column("text").to_pylist())
                ends = np.searchsorted(text, np.arange(b.num_rows + 1))
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()),
                                                 pa.array(feature.astype(np.int32)))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("label"), lists],
                                                 names=["doc_id", "label", "f"])

    # bounded: 2 * CLASS_ROWS rows of at most FEATURE_COUNT numbers
    got = rows.mapInArrow(known, "doc_id bigint, label int, f array<int>").orderBy("doc_id").toArrow()
    lists = got.column("f").combine_chunks()
    text = np.repeat(np.arange(got.num_rows), np.diff(np.asarray(lists.offsets)))
    feature = np.asarray(lists.flatten()).astype(np.int64)
    w, b = logistic(text, feature, ratios[feature], np.asarray(got.column("label")).astype(float),
                    len(best))
    b += np.log(toxic / clean) - np.log(n1 / n0)
    return Linear(place, w * ratios, b)


def score(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    model = spark.sparkContext.broadcast(fit(rows, training_marks(marks, "toxic", FOLDS, FOLD)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in bounded(whole, "text", 1 << 20):
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(model.value.scores(b.column("text").to_pylist()))],
                    names=["doc_id", "score"])

    scored = rows.mapInArrow(run, "doc_id bigint, score double")
    return scored.select("doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir), labels(spark, sf_dir))
