"""Structured Streaming over document folders: each run takes what is new."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..plans.contract import Contract
from ..plans.fanout import load


def stream_shred(spark: SparkSession, path: str, schema: T.StructType, process: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, files_per_batch: int = 4) -> None:
    """Shred and map documents of new files and append the rows to `out`; ends when no new file is left.

    The checkpoint says which files are done; a batch that runs again overwrites its own folder, so nothing is doubled.
    """

    def batch(df: DataFrame, nth: int) -> None:
        process(df).write.mode("overwrite").parquet(f"{out}/batch={nth}")

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def stream_load(spark: SparkSession, path: str, schema: T.StructType, contract: Contract, out: str, checkpoint: str, session: str, files_per_batch: int = 4, retry_failed: bool = False) -> None:
    """Map documents of new files to all tables of a contract, and commit each micro-batch with its log; ends when no new file is left.

    A run is named by its batch and attempt. Documents that are in the log, of this stream or any other run, are left out, and
    of those with one id in a batch one is taken. So a batch that died before its log was written is mapped again under
    a new name, and what it had written is never seen; one that died after it finds nothing to do.
    """

    def batch(df: DataFrame, nth: int) -> None:
        load(df, contract, out, session, f"batch-{nth}-{uuid.uuid4().hex}", unique=False, retry_failed=retry_failed)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


@contextlib.contextmanager
def _on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams that start in here keep their state with RocksDB."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)


def stream_dedupe(
    spark: SparkSession, path: str, schema: T.StructType, out: str, checkpoint: str, id: str = "doc_id", files_per_batch: int = 1, event_time: str | None = None, late: str = "1 day",
) -> None:
    """Documents whose id hasn't been taken in an earlier batch, each once.

    Ids are state of the stream, dealt by a hash and kept on disk by RocksDB, so a batch costs what it has itself. A batch
    that runs again overwrites its own folder.

    Without `event_time` all ids are kept for good. With it, the state is bounded: an id is forgotten once the watermark,
    which is the latest event time of the batches before less `late`, has passed the time of its first row by `late`.
    So of rows with one id whose times are within `late` of one another, one comes out, in whatever order they come; one
    that is sent again later counts as new; and a row that is older than the watermark when it comes is dropped, as it
    can't be told any more whether its id was taken. Rows without an event time are dropped like those.
    """

    def batch(df: DataFrame, nth: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/batch={nth}")

    with _on_disk(spark):
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)
        once = stream.dropDuplicates([id]) if event_time is None else stream.filter(f"`{event_time}` is not null").withWatermark(event_time, late).dropDuplicatesWithinWatermark([id])
        once.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
