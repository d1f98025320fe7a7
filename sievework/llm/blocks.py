"""Arrow helpers: whole texts in, bounded blocks through, rows out."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from ..session import ship_package

#: Characters that one block of texts holds, except where a single text is longer.
BLOCK_CHARS = 1 << 20


def blocks(texts: list[str], limit: int = BLOCK_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of consecutive texts of limit characters or one text; every text is in one range."""
    at, held = 0, 0
    for i, text in enumerate(texts):
        if held and held + len(text) > limit:
            yield at, i
            at, held = i, 0
        held += len(text) + 1
    if at < len(texts):
        yield at, len(texts)


#: Rows and bytes that one Arrow batch holds at most; a longer text is a batch of its own. What a session sets lower stays.
BATCH_ROWS, BATCH_BYTES = 1_000, 4 << 20


def bound_batches(spark: SparkSession) -> None:
    """Keep Arrow batches small: a Python worker holds a batch's texts, what becomes of them, and copies in transit."""
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(name, None)
        if now is None or not now.isdigit() or not 0 < int(now) <= most:
            spark.conf.set(name, str(most))


def map_blocks(df: DataFrame, make: Callable[[], Callable[..., list[Any]]], schema: str, text_at: int | None = 1) -> DataFrame:
    """Send rows to Python in Arrow batches and cut them into blocks by the length of one text column.

    make() runs once in each task and gives work(*columns as lists) -> columns as lists (or Arrow arrays).
    The text column's nulls arrive as empty texts. text_at None: batches stay whole.
    """
    ship_package(df.sparkSession)
    bound_batches(df.sparkSession)
    parsed = _parse_datatype_string(schema)
    assert isinstance(parsed, StructType)
    target = to_arrow_schema(parsed)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns]
            ranges: Iterable[tuple[int, int]] = [(0, batch.num_rows)] if batch.num_rows else []
            if text_at is not None:
                columns[text_at] = [t or "" for t in columns[text_at]]
                ranges = blocks(columns[text_at])
            for a, b in ranges:
                out = work(*(c[a:b] for c in columns))
                yield pa.RecordBatch.from_arrays([x.cast(f.type) if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(out, target, strict=True)], schema=target)

    return df.mapInArrow(run, parsed)


def unused(name: str, columns: list[str]) -> str:
    """The name, lengthened until no column has it."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name
