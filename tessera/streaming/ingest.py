"""Incremental, idempotent ingest with Structured Streaming.

file source → ``foreachBatch``: one row per key, minus the keys the target
holds, written once.

Exactly-once: the checkpoint (offsets) makes a restarted query resume where
it stopped, and every micro-batch is written to its own
``stream=<query>/batch_id=<epoch>`` folder with overwrite, so a re-executed
epoch replaces its own output instead of appending twice.  Each write is one
job-level commit.

Which keys are known is read from the target, by probing its key column with
the batch's keys, not kept in streaming state: nothing grows with the number
of keys ever seen, and a late key that is new is never lost.

Copies of a key inside one micro-batch are reduced to the smallest row, so
the choice does not depend on the run; feed sources whose copies differ
through ``tables.insert_if_absent`` with an arrival column for first-writer
rules.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.operators.tables import one_per_key
from tessera.session import broadcast_if_small


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p)


def stream_tag(checkpoint: str) -> str:
    """Stable name of one streaming query (its checkpoint): restarts keep
    it, another query writing the same target gets its own."""
    return hashlib.sha1(checkpoint.rstrip("/").encode()).hexdigest()[:12]


def insert_batch(spark: SparkSession, batch: DataFrame, key: list[str], target: str, epoch_id: int, tag: str = "s") -> None:
    """One micro-batch: one row per key (the smallest row, so a re-executed
    epoch writes the same), minus keys already in the target, written
    idempotently under ``stream=<tag>/batch_id=<epoch>``."""
    rows = one_per_key(batch, key)
    if _exists(spark, target):
        # other epochs only: a re-executed epoch must not hide its own rows.
        # The batch's keys (checked small) probe the target's key column, so
        # the growing target is scanned, never shuffled; only the few keys
        # found there are then removed from the batch.
        rows = rows.persist()
        probe = broadcast_if_small(rows.select(*key))
        mine = (F.col("stream") == tag) & (F.col("batch_id") == int(epoch_id))
        have = (spark.read.parquet(target).where(~mine).select(*key)
                .join(probe, key, "left_semi"))
        fresh = rows.join(broadcast_if_small(have), key, "left_anti")
    else:
        fresh = rows
    fresh.write.mode("overwrite").parquet(f"{target.rstrip('/')}/stream={tag}/batch_id={int(epoch_id)}")
    rows.unpersist()


def run_dedup_ingest(spark: SparkSession, source_dir: str, schema: StructType, key: list[str], target: str,
                     checkpoint: str, max_files_per_trigger: int | None = None) -> None:
    """Process every file available now, then stop (``availableNow``).

    The target itself says which keys are known, so the query holds no state
    that grows with them, and a new key is kept however late it comes."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)
    tag = stream_tag(checkpoint)

    def each(batch: DataFrame, epoch_id: int) -> None:
        insert_batch(batch.sparkSession, batch, key, target, epoch_id, tag)

    q = (stream.writeStream.foreachBatch(each)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
