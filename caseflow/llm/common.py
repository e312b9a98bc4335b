"""Helpers shared by the operators: input table, scratch tables, words."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseflow.session import ensure_checkpoint_dir

# A word is a run of characters other than space, \t, \n, \v, \f, \r.
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)
SHINGLE_WORDS = 5


_SHIPPED: set[str] = set()
_ARROW_BATCH = {"spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
                "spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application,
    and whole texts in Arrow batches of a few MB, where the session has no size
    of its own: a worker and its executor each hold a batch or two."""
    sc = spark.sparkContext
    own = spark.conf.getAll
    for key, size in _ARROW_BATCH.items():
        if key not in own:
            spark.conf.set(key, size)
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    top = Path(__file__).resolve().parents[1]
    file = Path(tempfile.mkdtemp(prefix="caseflow-")) / "caseflow_package.zip"
    with zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    sc.addPyFile(str(file))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def whole_text(col: str = "text") -> Column:
    """The whole text; a null text counts as the empty text."""
    return F.coalesce(F.col(col), F.lit(""))


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts the
    lineage, and a lost executor re-reads files instead of recomputing."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def renamed(df: DataFrame) -> DataFrame:
    """The same columns under new ids, to meet a frame of the same origin."""
    return df.toDF(*df.columns)


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """True where crc32 of the id in decimal text, mod ``folds``, is ``fold``
    (null id: false)."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == fold,
                      F.lit(False))
