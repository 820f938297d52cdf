"""Bounded Structured Streaming runs of the load operators.

Each run takes what is new since the last one (``availableNow``) and stops; the
checkpoint folder carries the progress from run to run.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import as_list
from ..fs import ClusterFiles
from ..operators.merge import merge
from ..plans.targets import STREAM_STATE, VersionedDataset


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                files_per_batch: int | None = None, **options) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema).options(**options)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", int(files_per_batch))
    return reader.load(path)


def load_new_files(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Append the files that arrived since the last run to a Parquet dataset."""
    query = (stream.writeStream.format("parquet").option("path", target)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()


def upsert_stream(stream: DataFrame, target: VersionedDataset, primary_key, checkpoint: str,
                  strategy: str = "update_insert", update_key: str | None = None) -> None:
    """Merge every micro-batch into the target with the batch merge operator.

    The batch id is published with the merged data under the id of the query, as
    its checkpoint has it: a replayed batch is recognised and left out, and other
    streams or checkpoints on the same target count for themselves.
    """
    keys = as_list(primary_key)
    files = ClusterFiles(stream.sparkSession)

    def apply(batch: DataFrame, batch_id: int) -> None:
        query_id = json.loads(files.read_text(f"{checkpoint.rstrip('/')}/metadata"))["id"]
        mine = f"{STREAM_STATE}:{query_id}"
        done = target.state().get(mine)
        if done is not None and batch_id <= done:
            return
        state = {mine: batch_id}
        if not target.exists():
            empty = batch.limit(0)
            target.replace(merge(empty, batch, keys, strategy, update_key), state)
            return
        batch.persist()
        try:
            target.merge_in(batch, keys, lambda rows: merge(rows, batch, keys, strategy,
                                                            update_key), state)
        finally:
            batch.unpersist()

    query = (stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()


def dedupe_stream(stream: DataFrame, keys, update_key: str, delay: str) -> DataFrame:
    """First-seen row per key. State older than ``delay`` behind the newest
    ``update_key`` is dropped, which bounds it however long the stream runs."""
    timed = stream
    ntz = isinstance(stream.schema[update_key].dataType, T.TimestampNTZType)
    if ntz:
        timed = stream.withColumn("__event_time", F.col(update_key).cast("timestamp"))
    unique = timed.withWatermark("__event_time" if ntz else update_key, delay) \
        .dropDuplicatesWithinWatermark(as_list(keys))
    return unique.drop("__event_time") if ntz else unique
