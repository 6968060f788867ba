"""A duplicate-key audit as a gate of a stream.

Each micro-batch is checked against itself and against the target before it is
written.  A batch without findings is appended; one with findings trips the
breaker: all of its rows go to the quarantine, the findings to the log, and nothing
to the target, so the target never holds a key twice.  Every folder is that of one
epoch and is overwritten when the epoch is repeated, so rows and findings are
there once.  The stream goes on with the next batch, or stops (``halt``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.operators.quality import AuditFailed
from tessera.session import broadcast_if_small
from tessera.streaming.ingest import _exists, stream_tag


def findings_of(batch: DataFrame, known: DataFrame | None, key: list[str]) -> DataFrame:
    """(key…, reason, count): keys that repeat in the batch, and keys that ``known`` holds."""
    counts = batch.groupBy(*key).agg(F.count(F.lit(1)).alias("count"))
    found = counts.where(F.col("count") > 1).select(*key, F.lit("repeated in the batch").alias("reason"), "count")
    if known is None:
        return found
    # the batch's keys, if checked small, probe the target where it lies
    there = known.select(*key).join(broadcast_if_small(counts.select(*key)), key, "left_semi").groupBy(*key).agg(F.count(F.lit(1)).alias("count"))
    return found.unionByName(there.select(*key, F.lit("in the target").alias("reason"), "count"))


def gate_batch(spark: SparkSession, batch: DataFrame, key: list[str], folders: dict[str, str], epoch: int, tag: str, halt: bool = False) -> bool:
    """Check one micro-batch and write it to ``target`` or ``quarantine`` (and ``findings``); True if it passed."""
    part = f"stream={tag}/batch_id={int(epoch)}"
    batch = batch.persist()
    try:
        known = None
        if _exists(spark, folders["target"]):
            known = spark.read.parquet(folders["target"]).where(~((F.col("stream") == tag) & (F.col("batch_id") == int(epoch))))
        findings_of(batch, known, key).write.mode("overwrite").parquet(f"{folders['findings']}/{part}")
        n = spark.read.parquet(f"{folders['findings']}/{part}").count()
        batch.write.mode("overwrite").parquet(f"{folders['quarantine' if n else 'target']}/{part}")
    finally:
        batch.unpersist()
    if n and halt:
        raise AuditFailed(f"batch {epoch}: {n} finding(s), rows are in the quarantine")
    return not n


def run_gate(spark: SparkSession, source_dir: str, schema: StructType, key: list[str], base: str, max_files_per_trigger: int | None = None, halt: bool = False) -> dict[str, str]:
    """Gate every file available now; returns the folders ``target``, ``quarantine``, ``findings``."""
    folders = {name: f"{base.rstrip('/')}/{name}" for name in ("target", "quarantine", "findings")}
    checkpoint = f"{base.rstrip('/')}/checkpoint"
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    tag = stream_tag(checkpoint)
    q = (reader.parquet(source_dir).writeStream
         .foreachBatch(lambda batch, epoch: gate_batch(batch.sparkSession, batch, key, folders, epoch, tag, halt) and None)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return folders
