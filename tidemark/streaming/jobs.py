"""Structured Streaming forms of the ingest path.

Every job runs what is available and stops. The checkpoint folder is the delivery record;
sinks are written so that a replayed batch changes nothing.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import signature
from ..plans.job import Context, Job
from ..sources.envelopes import read_envelopes
from ..sources.webhooks import CHAT_BODY, emoji_rows
from ..tables import files
from ..tables.store import TableStore
from .state import ROWS, OncePerPeriod, rocksdb, smallest_in_partition, smallest_in_task


def run_available(writer) -> list:
    """Run what is available; returns the progress of the batches."""
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query.recentProgress


def batch_name(checkpoint: str, batch_id: int) -> str:
    """Name of one batch of one stream; another checkpoint is another stream."""
    return f"{hashlib.sha1(checkpoint.encode()).hexdigest()[:12]}-{batch_id}"


def write_batch(df: DataFrame, target: str, batch: str) -> None:
    """One folder per batch, overwritten as a whole: a replay replaces it with the same rows."""
    df.write.mode("overwrite").parquet(f"{target}/batch={batch}")


def earlier_batches(spark: SparkSession, target: str, batch: str) -> DataFrame | None:
    """What other batches stored so far."""
    folders = [f"{target}/{c}" for c in files.children(spark, target) if c.startswith("batch=") and c != f"batch={batch}"]
    return spark.read.parquet(*folders) if folders else None


def read_batches(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(target).drop("batch")


def ingest_process(spark: SparkSession, raw: str, job: Job, context: Context, checkpoint: str,
                   directory: DataFrame | None = None, files_per_batch: int = 1000,
                   updated=None) -> None:
    """Transform every newly landed raw file and maintain the job's tables.

    `updated(names, batch_id)` is told which tables a batch changed. A batch that is repeated after
    a failure is recognised by the store.
    """
    envelopes = read_envelopes(spark, raw, job.payload, stream=True, maxFilesPerTrigger=files_per_batch)

    def handle(batch: DataFrame, batch_id: int) -> None:
        names = job.run(batch, context, directory, batch=batch_name(checkpoint, batch_id))
        if updated:
            updated(names, batch_id)

    run_available(envelopes.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint))


def _known_keys(spark: SparkSession, target: str, checkpoint: str, schema: T.StructType, keys: list[str]) -> DataFrame:
    """What state begins with: the stored keys for a checkpoint without a committed batch, none for one that has its own state."""
    stored = None
    if not files.has_data(spark, f"{checkpoint}/commits"):
        stored = earlier_batches(spark, target, batch_name(checkpoint, 0))
    if stored is None:
        return spark.createDataFrame([], T.StructType([schema[k] for k in keys]))
    return stored.select(*keys).distinct()


def dedupe_existing(stream: DataFrame, keys: list[str], target: str, checkpoint: str) -> list:
    """Append only rows whose key was never stored; of one key within a batch the smallest row. Returns the progress of the batches.

    The keys are the state of a streaming deduplication, so that a batch costs by its own rows, whatever the target holds. What other streams have
    stored is read once, when a checkpoint is begun, and passes the state first as rows that are not stored again. Null keys compare equal.
    """
    spark, columns = stream.sparkSession, stream.columns
    seed = f"{checkpoint}/seed"
    if not files.exists(spark, f"{seed}/_SUCCESS"):
        _known_keys(spark, target, checkpoint, stream.schema, keys).write.mode("overwrite").parquet(seed)
    known = spark.readStream.schema(T.StructType([stream.schema[k] for k in keys])).parquet(seed)
    kind = {f.name: f.dataType for f in stream.schema}
    known = known.select(F.lit(0).alias("_fresh"), *[F.col(f"`{c}`") if c in keys else F.lit(None).cast(kind[c]).alias(c) for c in columns])
    rows = smallest_in_task(known.union(stream.select(F.lit(1).alias("_fresh"), *[F.col(f"`{c}`") for c in columns])), keys).drop(ROWS)
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    first = smallest_in_partition(rows.repartition(width, *[F.col(f"`{k}`") for k in keys]), keys).dropDuplicates(keys)

    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(batch.filter("_fresh = 1").drop("_fresh"), target, batch_name(checkpoint, batch_id))

    with rocksdb(spark):
        return run_available(first.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint))


def emoji_events(stream: DataFrame, body: str) -> DataFrame:
    """Emoji rows of a stream of chat webhook bodies; stateless."""
    return emoji_rows(stream.select(F.from_json(F.col(body), CHAT_BODY).alias("b")))


def signed(stream: DataFrame, key: str, body: str = "body", timestamp: str = "timestamp",
           received: str = "signature") -> DataFrame:
    """Adds `valid`: whether the body carries the right chat signature."""
    expected = signature.chat_signature(timestamp, body, key)
    return stream.withColumn("valid", signature.matches(received, expected))


def split_signed(stream: DataFrame, accepted: str, rejected: str, checkpoint: str) -> None:
    """Write valid and invalid rows of a `signed` stream to two targets in one pass."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        name = batch_name(checkpoint, batch_id)
        try:
            write_batch(kept.filter("valid").drop("valid"), accepted, name)
            write_batch(kept.filter("NOT valid").drop("valid"), rejected, name)
        finally:
            kept.unpersist()

    run_available(stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint))


def append(stream: DataFrame, target: str, checkpoint: str) -> None:
    run_available(stream.writeStream.format("parquet").outputMode("append").option("path", target)
                  .option("checkpointLocation", checkpoint))


def late_periods(stream: DataFrame, period: str, ends: str, target: str, aside: str, checkpoint: str, delay: str = "28 days",
                 counts=None) -> list:
    """Store a period once, when it is closed, and never again. Returns the progress of the batches.

    A period closes `delay` after the time in its column `ends` (one for each period), by the watermark of the stream: the latest `ends` of all earlier
    batches. Until then its smallest row is state, of the rows for which the condition `counts` holds (null: not). Rows that
    come after it was stored are counted in `aside` as (period, late). A timer of the state closes a period; the target is
    read only by the first batch of a checkpoint, so that periods which another stream has stored stay as they are.
    """
    spark = stream.sparkSession
    # the watermark follows a column that ends here: rows behind it are to reach the state, not to be dropped before it
    timed = stream.withColumn("_time", F.col(ends).cast("timestamp")).withWatermark("_time", delay)
    wanted = (F.lit(True) if counts is None else counts) & F.col("_time").isNotNull()
    rows = timed.select(period, *[c for c in stream.columns if c != period], F.unix_millis("_time").alias("_closes"), wanted.alias("_counts"))
    known = _known_keys(spark, target, checkpoint, stream.schema, [period])
    kept = rows.drop("_counts").schema
    out = T.StructType([*kept, T.StructField("late", T.LongType())])
    decided = smallest_in_task(rows, [period], "_counts").groupBy(period).transformWithState(
        OncePerPeriod(kept, "_closes"), out, "Append", "EventTime", initialState=known.groupBy(period))

    def handle(batch: DataFrame, batch_id: int) -> None:
        name = batch_name(checkpoint, batch_id)
        both = batch.persist()
        try:
            write_batch(both.filter("late IS NULL").select(*stream.columns), target, name)
            write_batch(both.filter("late IS NOT NULL").select(period, "late"), aside, name)
        finally:
            both.unpersist()

    with rocksdb(spark):
        return run_available(decided.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint))


def refresh_reports(changes: DataFrame, store: TableStore, registry, run, now: str, checkpoint: str) -> list[str]:
    """Recompute the reports that read a changed table, for a stream of changed table names.

    `registry()` gives the current registry. Materialising replaces a report as a whole, so a
    replay leaves the same result. Returns the names of the reports that were refreshed.
    """
    from ..plans.registry import refresh
    done: list[str] = []

    def handle(batch: DataFrame, batch_id: int) -> None:
        _, names = refresh(store, registry(), batch.select("table").distinct(), run, now)
        done.extend(names)

    run_available(changes.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint))
    return sorted(set(done))
