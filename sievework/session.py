"""Session helpers shared by every query, test and benchmark."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_PACKAGE = Path(__file__).resolve().parent
_shipped: set[str] = set()


def local_session(name: str = "sievework", cores: str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for one machine: adaptive execution, UTC, Arrow."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once for each application.

    Python workers import the code that their functions refer to; on a cluster
    they don't share the driver's working folder.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    where = Path(tempfile.mkdtemp(prefix="sievework-")) / "sievework_code.zip"
    with zipfile.ZipFile(where, "w", zipfile.ZIP_DEFLATED) as z:
        for path in sorted(_PACKAGE.rglob("*.py")):
            z.write(path, path.relative_to(_PACKAGE.parent).as_posix())
    context.addPyFile(str(where))
    _shipped.add(context.applicationId)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Keep the cluster's spark.checkpoint.dir; set a local folder only where none is set."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named and not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(named or os.path.join(tempfile.gettempdir(), "sievework-checkpoints"))


#: Bytes from which and up to which a table in few files is dealt out.
SPREAD_FROM, SPREAD_TO = 1 << 20, 1 << 30


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the tables under a data folder.

    A small table in fewer files than there are cores is dealt out to all of them, as a file of one row group is read by
    one task; a large one, or one in many files, is read as it lies, without a shuffle.
    """
    where = f"{sf_dir}/{name}.parquet"
    read = spark.read.parquet(where)
    cores = spark.sparkContext.defaultParallelism
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(where)
    held = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(path)
    if held.getFileCount() < cores and SPREAD_FROM <= held.getLength() < SPREAD_TO:
        return read.repartition(cores)
    return read


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stash(df: DataFrame) -> DataFrame:
    """The rows as a table written beside the checkpoints: it cuts lineage as checkpoint() does, in compressed columns.

    The files lie in the folder that all executors share and go when the application ends. What was shuffled for them goes
    once they are written, as nothing reads it again.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    context = spark.sparkContext
    where = f"{context._jsc.sc().getCheckpointDir().get()}/table-{uuid.uuid4().hex}"
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(where)
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)
    path = context._jvm.org.apache.hadoop.fs.Path(where)
    path.getFileSystem(context._jsc.hadoopConfiguration()).deleteOnExit(path)
    return spark.read.schema(df.schema).parquet(where)


#: Bytes that a broadcast side may hold, as measured by the length of its rows written as JSON.
BROADCAST_BYTES = 64 << 20


def fits(held: DataFrame, most: int, most_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the rows are no more than the bound, nor their bytes; rows should be written already, as they are read for this."""
    size = held.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*(F.col(f"`{c}`") for c in held.columns))))), F.lit(0)).alias("bytes")).first()
    return size["n"] <= most and size["bytes"] <= most_bytes


def small_side(df: DataFrame, most: int) -> DataFrame:
    """The rows, written and measured; broadcast if they and their bytes are within the bounds, else joined as Spark plans it."""
    held = stash(df)
    return F.broadcast(held) if fits(held, most) else held
