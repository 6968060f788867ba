"""Streaming ingest with keyed state that expires.

The state holds the keys that arrived within ``ttl_s``: their repeats are dropped without
a look at the target.  A key that is not in the state (new, or so long ago that its
state has expired) goes on to the batch write, which probes the target.  So no key is
lost or written twice however late it comes, and the state is bounded by the keys of
one ``ttl_s``, not by all keys ever seen.

The watermark runs on the time of arrival, not on a time in the rows: no row is ever
too late for it, where a watermark on event time would drop late rows unseen.  Of
copies that arrive in one batch any may be kept; feed sources whose copies differ
through ``tables.insert_if_absent`` with an arrival column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.streaming.ingest import insert_batch, stream_tag

ARRIVED = "_arrived_at"


def first_seen(stream: DataFrame, key: list[str], ttl_s: int) -> DataFrame:
    """The rows of ``stream`` whose key the state does not hold, one for each key."""
    timed = stream.withColumn(ARRIVED, F.current_timestamp()).withWatermark(ARRIVED, f"{int(ttl_s)} seconds")
    return timed.dropDuplicatesWithinWatermark(key).drop(ARRIVED)


def run_keyed_ingest(spark: SparkSession, source_dir: str, schema: StructType, key: list[str], target: str, checkpoint: str,
                     ttl_s: int = 3_600, max_files_per_trigger: int | None = None) -> list[int]:
    """Process every file available now; returns the number of keys in the state after each micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    tag = stream_tag(checkpoint)
    q = (first_seen(reader.parquet(source_dir), key, ttl_s).writeStream
         .foreachBatch(lambda batch, epoch: insert_batch(batch.sparkSession, batch, key, target, epoch, tag))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return [op["numRowsTotal"] for p in q.recentProgress for op in p["stateOperators"]]
