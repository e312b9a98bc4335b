"""Operator 6: quality by a regularised quadratic discriminant.

Each text gives a few statistics (lengths, shares of kinds of characters,
repetition), log- or logit-transformed.  All labelled training rows give each
class's mean and covariance: tasks add up sums and products, so the driver gets
two small matrices.  A class covariance is shrunk towards the pooled one
(``TO_POOLED``) and then towards a multiple of the unit matrix (``TO_UNIT``).
The score is the logistic function of the difference of the classes' log
densities and log shares; the Mahalanobis terms are solved with the Cholesky
factors, made once and sent with the model.

Defined results: a null text counts as empty and is scored as any other; rows
with a null label aren't learned from, and a row is learned once for each of
its labels.  If one class has no training row, the score is the class share (0
or 1), and 0.5 without any training row.  An empty table gives an empty result.
Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import functools
import operator
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.llm.common import documents, held_out, labels, ship_package, stored, whole_text
from caseflow.llm.words import bounded

FOLDS, FOLD = 3, 1
TO_POOLED = 0.1
TO_UNIT = 0.02
STATISTICS = "__quality_statistics"
FEATURES = ("words", "word_length", "upper", "digits", "full_stops", "commas", "marks", "symbols",
            "other_bytes", "vocabulary", "top_word", "repeats", "lines", "same_lines", "entropy",
            "pairs", "marked_words")
_KIND = np.zeros(256, np.int64)  # 0 other ASCII, then as below
for _k, _chars in enumerate(("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", ".", ",;:", "!?", "#$%&*+/<=>@\\^_`{|}~"), 1):
    _KIND[[ord(c) for c in _chars]] = _k
_KIND[128:] = 7


def statistics(text: str) -> np.ndarray:
    """Transformed statistics of one text, in the order of FEATURES."""
    raw = text.encode()
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    kinds = np.bincount(_KIND, weights=counts, minlength=8)
    n = len(raw)
    share = counts[counts > 0] / max(1, n)
    words = text.split()
    m = len(words)
    seen = Counter(words)
    pairs = len(set(zip(words, words[1:], strict=False)))
    same = sum(map(str.__eq__, words, words[1:]))
    marked = sum(1 for w in words if not w[-1].isalnum())
    lines = [x for x in text.split("\n") if x]

    def logit(part: float, of: int, usual: float, weight: int) -> float:
        """Log odds of a share, of short texts drawn towards a usual share."""
        return np.log((part + usual * weight) / (of - part + (1 - usual) * weight))

    return np.array([
        np.log1p(m), np.log((n + 180) / (m + 30)), logit(kinds[1], n, 0.03, 60),
        logit(kinds[2], n, 0.01, 60), logit(kinds[3], n, 0.02, 60), logit(kinds[4], n, 0.02, 60),
        logit(kinds[5], n, 0.003, 60), logit(kinds[6], n, 0.003, 60), logit(kinds[7], n, 0.03, 60),
        np.log(len(seen) + 10) / np.log(m + 10), logit(max(seen.values(), default=0), m + 1, 0.05, 20),
        logit(same, m, 0.01, 20), np.log1p(len(lines)),
        logit(len(lines) - len(set(lines)), len(lines), 0.02, 5),
        -(share * np.log(share)).sum() / np.log(min(n, 60) + 2), logit(pairs, m, 0.95, 20),
        logit(marked, m, 0.15, 10)])


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, x) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in bounded(whole, "text", 1 << 20):
                x = np.array([statistics(t) for t in b.column("text").to_pylist()])
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(x) + 1) * len(FEATURES), pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), lists], names=["doc_id", "x"])

    ship_package(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       whole_text().alias("text")).mapInArrow(run, "doc_id bigint, x array<double>")


class Discriminant:
    """Two Gaussian classes; ``sums`` has count, sum and sum of products by
    class."""

    def __init__(self, sums: dict[int, tuple[float, np.ndarray, np.ndarray]],
                 to_pooled: float = TO_POOLED, to_unit: float = TO_UNIT):
        total = sum(s[0] for s in sums.values())
        self.share = sums[1][0] / total if total else 0.5
        self.parts = None
        if min(s[0] for s in sums.values()) == 0:
            return
        d = len(FEATURES)
        mean = {k: s[1] / s[0] for k, s in sums.items()}
        scatter = {k: s[2] - s[0] * np.outer(mean[k], mean[k]) for k, s in sums.items()}
        pooled = sum(scatter.values()) / total
        self.scale = np.sqrt(np.maximum(np.diag(pooled), 1e-9))
        both = np.outer(self.scale, self.scale)
        self.parts = {}
        for k, s in sums.items():
            cov = ((1 - to_pooled) * scatter[k] / s[0] + to_pooled * pooled) / both
            cov = (1 - to_unit) * cov + to_unit * np.trace(cov) / d * np.eye(d)
            cov = cov + 1e-6 * np.eye(d)
            chol = np.linalg.cholesky(cov)
            const = np.log(s[0] / total) - np.log(np.diag(chol)).sum()
            self.parts[k] = (mean[k] / self.scale, np.linalg.inv(chol), const)

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.parts is None:
            return np.full(len(x), self.share)
        log = {k: const - 0.5 * (((x / self.scale - m) @ inv.T) ** 2).sum(axis=1)
               for k, (m, inv, const) in self.parts.items()}
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))


def fit(feats: DataFrame, marks: DataFrame) -> Discriminant:
    """Learn from (doc_id, x) and (doc_id, label)."""
    d = len(FEATURES)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = np.zeros((2, 1 + d + d * d))
        for b in batches:
            x = np.asarray(b.column("x").flatten()).reshape(-1, d)
            y = np.asarray(b.column("label"))
            for k in (0, 1):
                xk = x[y == k]
                acc[k] += np.concatenate([[len(xk)], xk.sum(axis=0), (xk.T @ xk).ravel()])
        pos = np.arange(acc.shape[1])
        for k in (0, 1):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(pos), k)), pa.array(pos),
                                              pa.array(acc[k])], names=["label", "pos", "s"])

    rows = feats.join(marks, "doc_id").select("x", F.col("label").cast("bigint").alias("label"))
    got = (rows.mapInArrow(sums, "label bigint, pos bigint, s double")
           .groupBy("label", "pos").agg(F.sum("s").alias("s")).collect())
    acc = np.zeros((2, 1 + d + d * d))
    for r in got:
        acc[r["label"], r["pos"]] = r["s"]
    return Discriminant({k: (a[0], a[1:1 + d], a[1 + d:].reshape(d, d)) for k, a in enumerate(acc)})


def training_marks(marks: DataFrame, column: str, folds: int, fold: int) -> DataFrame:
    """(doc_id, label) of the labelled rows outside the held-out fold."""
    ids = F.col("doc_id").cast("bigint")
    return (marks.filter(F.col(column).isin(0, 1) & ~held_out(ids, folds, fold))
            .select(ids.alias("doc_id"), F.col(column).cast("int").alias("label")))


def score(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    feats = stored(features(docs), "quality_features")
    model = fit(feats, training_marks(marks, "quality", FOLDS, FOLD))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.asarray(b.column("x").flatten()).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(model.scores(x))],
                                             names=["doc_id", "score"])

    scored = feats.mapInArrow(run, "doc_id bigint, score double")
    return scored.select("doc_id", held_out(F.col("doc_id"), FOLDS, FOLD).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def _rejects(x: Column, model: Discriminant) -> Column:
    """Whether a row with statistics ``x`` scores below 0.5."""
    if model.parts is None:
        return F.lit(bool(model.share < 0.5))

    def dot(row: np.ndarray) -> Column:
        return functools.reduce(operator.add, [F.get(x, k) * float(c) for k, c in enumerate(row) if c])

    logs = []
    for mean, inverse, const in (model.parts[k] for k in (0, 1)):
        # the factor's inverse times the scaled difference, squared and summed up
        terms = [dot(row / model.scale) - float(row @ mean) for row in inverse]
        logs.append(F.lit(float(const)) - functools.reduce(operator.add, [F.pow(t, 2) for t in terms]) * 0.5)
    return logs[1] < logs[0]


def keep_rows(docs: DataFrame, marks: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier doesn't reject.  Each text's
    statistics are taken once and written beside its row; the training rows'
    are read from there, and then all rows are scored by columns alone."""
    schema = T.StructType([*docs.schema.fields, T.StructField(STATISTICS, T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in bounded(whole, "text", 1 << 20):
                x = np.array([statistics(t or "") for t in b.column("text").to_pylist()])
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(x) + 1) * len(FEATURES), pa.int32()), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([*b.columns, lists], names=[*b.schema.names, STATISTICS])

    ship_package(docs.sparkSession)
    rows = stored(docs.mapInArrow(run, schema), "quality_rows")
    feats = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(STATISTICS).alias("x"))
    model = fit(feats, training_marks(marks, "quality", FOLDS, FOLD))
    return rows.filter(~_rejects(F.col(STATISTICS), model)).select(*docs.columns)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(documents(spark, sf_dir), labels(spark, sf_dir))
