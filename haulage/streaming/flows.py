"""Streaming forms: file arrival, event publication, requests with receipts and time waits.

Every flow is a plain transformation of a streaming frame; sources and sinks stay with the caller (files in tests,
a message topic in production).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

def _cycled(reader, per_cycle: int | None):
    reader = reader.option("latestFirst", "false")
    return reader if per_cycle is None else reader.option("maxFilesPerTrigger", str(per_cycle))


def arriving_files(spark: SparkSession, root: str, mask: str = "*", per_cycle: int | None = None) -> DataFrame:
    """New files below ``root``, oldest first, on request at most ``per_cycle`` per trigger; contents are not read."""
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    reader = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", mask).option("recursiveFileLookup", "true")
    objects = _cycled(reader, per_cycle).load(root)
    return objects.select("path", "modificationTime", "length")


def arriving_rows(spark: SparkSession, root: str, schema, mask: str = "*.parquet", per_cycle: int | None = None) -> DataFrame:
    """Rows of Parquet files arriving below ``root``."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", mask)
    return _cycled(reader, per_cycle).parquet(root)


def first_publications(events: DataFrame, key: list[str], at: str, horizon: str) -> DataFrame:
    """Each publication key once within the horizon; state older than the watermark is dropped."""
    return events.withWatermark(at, horizon).dropDuplicatesWithinWatermark(key)


def answered(requests: DataFrame, receipts: DataFrame, wait: str, lateness: str = "1 minute") -> DataFrame:
    """Requests ``(rq_uid, sent_at)`` with their receipt ``(rq_uid, received_at, code)`` inside ``wait``.

    A request without a receipt comes out with NULLs once the time is over.
    """
    left = requests.withWatermark("sent_at", lateness)
    right = receipts.withColumnRenamed("rq_uid", "_uid").withWatermark("received_at", lateness)
    inside = F.expr(f"rq_uid = _uid AND received_at >= sent_at AND received_at <= sent_at + INTERVAL {wait}")
    return left.join(right, inside, "leftOuter").drop("_uid").withColumn(
        "state", F.when(F.col("code").isNull(), "timeout").when(F.col("code") == 0, "confirmed").otherwise("failed"))


def due_in_batches(now: Callable[[], object], act: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body that hands the time waits that are due to ``act``."""
    from haulage.operators.loadings import due_waits

    def run(batch: DataFrame, epoch: int) -> None:
        act(due_waits(batch, now()), epoch)

    return run


def drain(stream: DataFrame, folder: str, name: str) -> DataFrame:
    """Run a stream over everything available, land it below ``folder`` and return the landed rows."""
    spark = stream.sparkSession
    target = f"{folder}/{name}"
    schema = stream.schema
    query = stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/{name}-checkpoint").option(
        "path", target).outputMode("append").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(schema).parquet(target)


def as_event_time(df: DataFrame, column: str) -> DataFrame:
    """Watermarks need ``timestamp``; the landed files hold ``timestamp_ntz``."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def apply_in_batches(target_path: Callable[[int], str], read_target: Callable[[], DataFrame], strategy: str, uk: list[str]):
    """A ``foreachBatch`` body that applies each micro-batch to a target and writes its next version."""
    from haulage.operators.apply import apply_batch

    def run(batch: DataFrame, epoch: int) -> None:
        apply_batch(read_target(), batch, strategy, uk).write.mode("overwrite").parquet(target_path(epoch))

    return run


def merge_in_batches(target) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` body that merges each micro-batch into a :class:`~haulage.sinks.keyed.KeyedTarget`; a micro-batch that
    comes again after a failure is not merged twice."""
    base = target.version()

    def run(batch: DataFrame, epoch: int) -> None:
        target.merge(batch, base + epoch + 1)

    return run
