"""Incremental dump loading with Structured Streaming.

Dump files that keep arriving in a folder (one file per export batch) are
read as a text stream; every micro-batch goes through the same
parser and routing as the batch loader and is appended to one parquet table per
declared table plus a quarantine table.  Progress is kept in a checkpoint beside the target
tables unless the caller names another folder: the same for every application
that loads into the target, so a restarted job (or one that lost executors)
resumes without re-loading or skipping files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from caseflow import schemas
from caseflow.sources.dump import QUARANTINE, Tables, dump_text, load_dump

BANK = {n: schemas.BY_NAME[n] for n in ("regions", "customer_nodes", "customer_transactions")}


def start_dump_stream(spark: SparkSession, source_dir: str, target_dir: str,
                      tables: Tables = BANK,
                      checkpoint: str | None = None, available_now: bool = False,
                      max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream; tables land in ``target_dir/<table>``.

    ``available_now=True`` processes what is in the folder and stops
    (catch-up runs and tests); otherwise it keeps polling.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    lines = dump_text(reader.load(source_dir))
    ckpt = checkpoint or f"{target_dir}/_checkpoint"

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        out = load_dump(batch, tables)
        for name, df in out.items():
            table = "quarantine" if name == QUARANTINE else name
            # idempotent per batch id: a replayed batch overwrites its own slice
            (df.write.mode("overwrite")
               .option("partitionOverwriteMode", "dynamic")
               .parquet(f"{target_dir}/{table}/batch_id={batch_id}"))

    w = lines.writeStream.foreachBatch(write_batch).option("checkpointLocation", ckpt)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()
