"""A resumable walk: which keys were met already, and where first, over runs that stop and start again."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..session import ship_package

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _in_batch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with the number of the batch that they came in, which a repeated try of it has too."""
    number = int(TaskContext.get().getLocalProperty("streaming.sql.batchId"))  # type: ignore[union-attr, arg-type]
    for rows in batches:
        yield rows.append_column("batch", pa.array([number] * rows.num_rows, pa.int64()))


def first_places(stream: DataFrame, key: str, place: str) -> DataFrame:
    """key, place, fresh for each key when it first comes and whenever it turns out to have an earlier place.

    Rows without a key or a place are left out; repeated rows and later places give nothing, in the same batch or in
    any later one. Works on a stream only, in update mode, which gives the keys that a batch has: those are new whose
    least place came in it. A key's state is four numbers.
    """
    ship_package(stream.sparkSession)
    kind = stream.schema[key].dataType.simpleString()
    rows = stream.select(F.col(key).alias("key"), F.col(place).cast("long").alias("place")).where("key IS NOT NULL AND place IS NOT NULL")
    numbered = rows.mapInArrow(_in_batch, f"key {kind}, place long, batch long")
    held = numbered.groupBy("key").agg(F.min(F.struct("place", "batch")).alias("least"), F.min("batch").alias("first"), F.max("batch").alias("last"))
    return held.where(F.col("least.batch") == F.col("last")).select("key", F.col("least.place").alias("place"), (F.col("first") == F.col("last")).alias("fresh"))


def walk(spark: SparkSession, source: str, schema: StructType, key: str, place: str, target: str, checkpoint: str) -> StreamingQuery:
    """Reads what has come into a folder since the last run, appends what is new to the target, and stops.

    Which files were read and what each key holds lie in the checkpoint, so a run that died is taken up where it was.
    A batch is written under its number and replaces what an earlier try of it wrote: the target's `batch=` folders hold
    each batch once. The earliest place of a key is the last one in its rows.
    """

    def put(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{target}/batch={number}")

    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    try:
        stream = spark.readStream.schema(schema).parquet(source)
        out = first_places(stream, key, place).writeStream.foreachBatch(put).outputMode("update")
        return out.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
