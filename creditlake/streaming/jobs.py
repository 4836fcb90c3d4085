"""Structured Streaming jobs: every one drains what is there and stops, or runs with another trigger."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.scalars import MONEY
from ..sources import versions
from .incremental import upsert


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", per_batch: int | None = None,
                pattern: str | None = None) -> DataFrame:
    """Files of a folder as a stream."""
    reader = spark.readStream.format(fmt).schema(schema)
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path)


def each_batch(stream: DataFrame, checkpoint: str, fn: Callable[[DataFrame, int], None], mode: str = "append",
               **trigger) -> StreamingQuery:
    return (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
            .foreachBatch(fn).trigger(**(trigger or {"availableNow": True})).start())


def run_of(batch: DataFrame) -> str:
    """The id of the stream that made this batch; it lasts as long as its checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def _upsert_batch(batch: DataFrame, path: str, key: Sequence[str], newest: str, ties: Sequence[str], buckets: int) -> None:
    """The upsert reads a batch twice; keep it, so that sources and state are run through once."""
    batch.persist()
    try:
        upsert(batch.sparkSession, path, batch, key, newest, ties, buckets)
    finally:
        batch.unpersist()


def ingest(stream: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Exactly-once append: a batch overwrites the folder of its own run and number, so a repeated batch replaces itself
    and one of a new checkpoint never replaces another."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/run_id={run_of(batch)}/batch_id={batch_id}")

    return each_batch(stream, checkpoint, write, **trigger)


def apply_changes(stream: DataFrame, path: str, checkpoint: str, key: Sequence[str], newest: str,
                  ties: Sequence[str] = (), buckets: int = 64, **trigger) -> StreamingQuery:
    """Change rows kept current per key."""

    def write(batch: DataFrame, batch_id: int) -> None:
        _upsert_batch(batch, path, key, newest, ties, buckets)

    return each_batch(stream, checkpoint, write, **trigger)


def append_telemetry(stream: DataFrame, path: str, checkpoint: str, timestamp: str, **trigger) -> StreamingQuery:
    """Rows as they arrive into a log partitioned by day; the file sink's own log makes it exactly-once."""
    return (stream.withColumn("log_date", F.to_date(timestamp)).writeStream.format("parquet").partitionBy("log_date")
            .option("checkpointLocation", checkpoint).option("path", path)
            .trigger(**(trigger or {"availableNow": True})).start())


def daily_series(stream: DataFrame, path: str, checkpoint: str, timestamp: str, kind: str, amount: str, **trigger) -> StreamingQuery:
    """Daily sums per kind, complete whenever a row arrives.

    Every batch writes its own sums, a row per day and kind that it holds, into a folder of its run and number. Nothing is
    kept as state, so no row is too late; ``read_daily_series`` adds the batches up. Readers see a run from the time on when
    ``publish_daily_series`` has shown that it caught up, and then every batch of it; a run on a new checkpoint, which reads the
    source anew, takes the place of the one before at once and not bit by bit.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        run = run_of(batch)
        sums = batch.groupBy(F.to_date(timestamp).alias("day"), kind).agg(F.sum(F.col(amount).cast(MONEY)).alias("part"))
        sums.write.mode("overwrite").parquet(f"{path}/run_id={run}/batch_id={batch_id}")
        spark = batch.sparkSession
        parts = versions.current(spark, path)
        folder = f"run_id={run}/batch_id={batch_id}"
        if folder not in parts.values() and any(f.startswith(f"run_id={run}/") for f in parts.values()):
            versions.publish(spark, path, parts | {str(batch_id): folder})

    return each_batch(stream, checkpoint, write, **trigger)


def publish_daily_series(query: StreamingQuery, spark: SparkSession, path: str, drains: bool = True) -> None:
    """Wait until the run has worked off what is there, and make it the series. One that stops at an error raises it and leaves the
    series as it was. A run that goes on (``drains`` False: another trigger than the default) is waited for until its source is empty."""
    query.awaitTermination() if drains else query.processAllAvailable()
    folder = f"run_id={query.id}"
    batches = versions.subfolders(spark, f"{path}/{folder}")
    versions.publish(spark, path, {b.rpartition("=")[2]: f"{folder}/{b}" for b in batches})


def read_daily_series(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Day, kind and total to two decimals, of the run published last."""
    folders = sorted(versions.current(spark, path).values())
    if not folders:
        raise ValueError(f"no series has been published at {path}")
    return spark.read.parquet(*[f"{path}/{f}" for f in folders]).groupBy("day", kind).agg(F.round(F.sum("part"), 2).alias("total"))
