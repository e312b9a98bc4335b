"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import re
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Settings that matter at any scale: adaptive re-planning at shuffle
# boundaries (partition coalescing, skew-join splitting, runtime broadcast
# conversion), UTC session time and the ANSI rules the jobs are written for.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "caseflow", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's base configuration.  The
    master and the number of shuffle partitions are the caller's or the
    cluster's (spark-submit, defaults file) unless they are given."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be shared storage configured by the
    operator; it is read from the session.  Only in local mode, where driver
    and executors are one process, an unset folder falls back to a private
    scratch folder; on any other master that is an error.
    """
    sc = spark.sparkContext
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not fallback and not re.match(r"local($|\[)", sc.master):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    path = fallback or tempfile.mkdtemp(prefix="caseflow-ckpt-")
    os.makedirs(path, exist_ok=True)
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once per application."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    top = Path(__file__).resolve().parent
    file = Path(tempfile.mkdtemp(prefix="caseflow-")) / "caseflow_package.zip"
    with zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    sc.addPyFile(str(file))
