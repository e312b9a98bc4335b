"""Sinks: idempotent replace and CTAS (S6, S7), lineage cuts."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession

from caseflow.session import ensure_checkpoint_dir


@contextmanager
def _session_conf(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A session setting for one write, unless the session has its own."""
    if key in spark.conf.getAll:
        yield
        return
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key)


class Versions:
    """A table under ``path`` that is replaced as a whole: each replace writes a
    new version and then swaps a one-line manifest, in one rename.  A reader
    gets the version that the manifest names, so it sees all old rows or all
    new ones; a replace that fails leaves the old version.  The version before
    the current one is kept for readers that have it open, older ones go."""

    MANIFEST = "_current"
    OPEN_FILES = 20

    def __init__(self, spark: SparkSession, path: str, fmt: str = "parquet"):
        self.spark, self.path, self.fmt = spark, path.rstrip("/"), fmt
        self._hadoop = spark._jvm.org.apache.hadoop
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._at().getFileSystem(self._conf)

    def _at(self, *parts: str):
        return self._hadoop.fs.Path("/".join([self.path, *parts]))

    def names(self) -> list[str]:
        """Names of the current version and the one before it; none: []."""
        at = self._at(self.MANIFEST)
        if not self._fs.exists(at):
            return []
        stream = self._fs.open(at)
        try:
            return stream.readUTF().split()
        finally:
            stream.close()

    def replace(self, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """Write ``df`` as the new version; returns a DataFrame reading it.
        Tasks write the rows where they are, without one more shuffle; files
        are as large as the plan's last partitions (a scan's splits, or what
        AQE coalesces), and rows of a large partition value go to several.  A
        task keeps a file open for each of up to OPEN_FILES partition values,
        so it need not sort; beyond that it sorts the rest."""
        new = f"v-{uuid.uuid4().hex[:12]}"
        w = df.write.format(self.fmt)
        if partition_by:
            w = w.partitionBy(*partition_by)
        with _session_conf(self.spark, "spark.sql.maxConcurrentOutputFileWriters", str(self.OPEN_FILES)):
            w.save(f"{self.path}/{new}")
        keep = [new, *self.names()[:1]]
        draft = self._at(f"_next-{new}")
        stream = self._fs.create(draft, True)
        try:
            stream.writeUTF(" ".join(keep))
        finally:
            stream.close()
        options = self.spark._sc._gateway.new_array(self._hadoop.fs.Options.Rename, 1)
        options[0] = self._hadoop.fs.Options.Rename.OVERWRITE
        self._hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf).rename(
            self._fs.makeQualified(draft), self._fs.makeQualified(self._at(self.MANIFEST)), options)
        for status in self._fs.listStatus(self._at()):
            name = status.getPath().getName()
            if name.startswith("v-") and name not in keep:
                self._fs.delete(status.getPath(), True)
        return self.read()

    def read(self) -> DataFrame:
        """The current version."""
        names = self.names()
        if not names:
            raise ValueError(f"{self.path} has no version yet")
        return self.spark.read.format(self.fmt).load(f"{self.path}/{names[0]}")


def materialize(df: DataFrame, path: str, partition_by: Sequence[str] = (),
                fmt: str = "parquet") -> DataFrame:
    """``DROP TABLE IF EXISTS t; SELECT ... INTO t``: replace the table at
    ``path`` and return a DataFrame reading it back (the written table cuts
    lineage, so a lost executor re-reads files instead of recomputing the
    query)."""
    return Versions(df.sparkSession, path, fmt).replace(df, partition_by)


def save_table(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite a catalog table (CTAS into the session catalog)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.saveAsTable(name)


def write_ordered(df: DataFrame, path: str, order: Sequence[Column | str], fmt: str = "parquet") -> None:
    """``ORDER BY`` of a result that may be large: rows are dealt into ranges
    of the order, each range is sorted by its own task and becomes a file, and
    files follow each other by part number."""
    df.orderBy(*order).write.format(fmt).save(path)


# (application id, key) -> (written path, column order): each derived table
# is built once per application and read back by every job that needs it.
_WRITTEN: dict[tuple[str, str], tuple[str, list[str]]] = {}


def built_once(spark: SparkSession, key: str, build: Callable[[], DataFrame],
               partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``build()`` once per application under the shared checkpoint
    folder (``spark.checkpoint.dir``) and return a scan of it.

    This is the ``SELECT ... INTO`` / load-once step of the source scripts:
    later jobs read files instead of re-deriving the table, and a lost
    executor re-reads files instead of recomputing the lineage.
    """
    k = (spark.sparkContext.applicationId, key)
    if k not in _WRITTEN:
        df = build()
        slug = re.sub(r"[^A-Za-z0-9_.-]+", "_", key)[-120:]
        path = f"{ensure_checkpoint_dir(spark)}/caseflow_tables/{slug}-{uuid.uuid4().hex[:8]}"
        materialize(df, path, partition_by)
        _WRITTEN[k] = (path, df.columns)
    path, cols = _WRITTEN[k]
    return Versions(spark, path).read().select(*cols)


# (application id, key) -> a DataFrame over files that its builder wrote
_KEPT: dict[tuple[str, str], DataFrame] = {}


def kept_once(spark: SparkSession, key: str, build: Callable[[], DataFrame]) -> DataFrame:
    """:func:`built_once` for a ``build`` that writes its rows itself and
    returns a scan of them, so that they are not written again."""
    k = (spark.sparkContext.applicationId, key)
    if k not in _KEPT:
        _KEPT[k] = build()
    return _KEPT[k]


def append(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """``INSERT INTO t VALUES ...``: append rows to the table at ``path``."""
    df.write.mode("append").format(fmt).save(path)
