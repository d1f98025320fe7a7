"""Incremental ingestion and event-time operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..sources.sinks import files_of


def ingest(spark: SparkSession, source: str, schema: StructType, target: str, key: str, checkpoint: str) -> StreamingQuery:
    """Appends what isn't held yet to the target and stops: running it twice leaves the same table.

    Files already read are known from the checkpoint; rows that come again in new files are dropped by key against the
    target. The first row of a key within a batch is the least one.
    """

    path, files = files_of(spark, target)

    def upsert(batch: DataFrame, _: int) -> None:
        own = batch.groupBy(key).agg(F.min(F.struct(*[c for c in batch.columns if c != key])).alias("_r")).select(key, "_r.*").select(*batch.columns)
        if files.exists(path(target)):
            own = own.join(spark.read.schema(schema).parquet(target).select(key), key, "left_anti")
        own.write.mode("append").parquet(target)

    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def tumbling(events: DataFrame, ts: str, width: str, *keys: str, late: str | None = None) -> DataFrame:
    """Counts and sums in windows of event time; in a stream, rows later than the watermark are dropped."""
    events = events.withWatermark(ts, late) if late else events
    out = events.groupBy(F.window(ts, width).alias("w"), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return out.select(F.col("w.start").alias("start"), *keys, "n", "total")


def sessions(events: DataFrame, ts: str, gap: str, *keys: str) -> DataFrame:
    """Runs of events of a key with gaps below the limit."""
    out = events.groupBy(F.session_window(ts, gap).alias("w"), *keys).agg(F.count("*").alias("n"))
    return out.select(*keys, F.col("w.start").alias("start"), "n")


def once(events: DataFrame, ts: str, late: str, *keys: str) -> DataFrame:
    """The first of rows with equal keys within the watermark."""
    return events.withWatermark(ts, late).dropDuplicatesWithinWatermark(list(keys))


def todo(known: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    return known.join(cache, key, "left_anti")


def throttle(per_minute: Column) -> Column:
    return F.try_divide(F.lit(60.0), per_minute.cast("double"))
