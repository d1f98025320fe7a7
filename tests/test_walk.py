"""The resumable walk: runs over a growing folder give what one run over all of it gives."""

import random
import time

import pytest
from pyspark.errors import StreamingQueryException

from sievework.operators import quality
from sievework.plans import walks
from sievework.streaming.walk import walk

SCHEMA = "k string, place int, v double"


def _put(spark, where, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(where)


def _run(spark, tmp, name="w"):
    schema = spark.createDataFrame([], SCHEMA).schema
    walk(spark, str(tmp / "in"), schema, "k", "place", str(tmp / name), str(tmp / f"{name}-check")).awaitTermination()
    read = spark.read.schema("key string, place long, fresh boolean, batch int").parquet(str(tmp / name))
    return sorted(tuple(r) for r in read.collect())


def test_repeats_are_suppressed_across_runs(spark, tmp_path):
    where = str(tmp_path / "in")
    _put(spark, where, [("a", 5, 1.0), ("a", 7, 1.0), ("a", 5, 1.0), ("b", 3, None), (None, 1, 1.0), ("c", None, 1.0), ("", 0, 0.0)])
    first = [("", 0, True, 0), ("a", 5, True, 0), ("b", 3, True, 0)]
    assert _run(spark, tmp_path) == first
    assert _run(spark, tmp_path) == first  # nothing came, nothing is told
    _put(spark, where, [("a", 5, 1.0), ("b", 2, 1.0), ("b", 9, 1.0), ("c", 4, 1.0)])
    assert _run(spark, tmp_path) == [*first[:2], ("b", 2, False, 1), first[2], ("c", 4, True, 1)]


def test_runs_in_parts_end_where_one_run_ends(spark, tmp_path):
    rng = random.Random(4)
    where = str(tmp_path / "in")
    for _ in range(3):  # one key holds a third of all rows
        _put(spark, where, [(rng.choice(["hot", *map(str, range(400))]) if rng.random() < 0.66 else "hot", rng.randrange(1000), 0.0) for _ in range(3000)])
        parts = _run(spark, tmp_path, "parts")
    whole = _run(spark, tmp_path, "whole")
    least: dict[str, int] = {}
    for key, place, _, _ in parts:
        least[key] = min(place, least.get(key, place))
    assert least == {key: place for key, place, _, _ in whole}
    assert sum(fresh for _, _, fresh, _ in parts) == len(whole) == len(least) and all(fresh for _, _, fresh, _ in whole)


def test_many_keys_are_held_without_a_call_for_each(spark, tmp_path):
    """Thirty thousand new keys, and again with earlier, later and equal places: a call for each key took minutes."""
    where, schema = str(tmp_path / "in"), spark.createDataFrame([], SCHEMA).schema
    rows = spark.range(60_000).selectExpr("cast(id % 30000 as string) AS k", "cast(id % 30000 AS int) AS place", "0D AS v")
    began = time.time()
    for n, more in enumerate((rows, rows.selectExpr("k", "place + cast(k AS int) % 3 - 1 AS place", "v"))):
        more.coalesce(1).write.mode("append").parquet(where)
        walk(spark, where, schema, "k", "place", str(tmp_path / "w"), str(tmp_path / "w-check")).awaitTermination()
        told = spark.read.schema("key string, place long, fresh boolean").parquet(f"{tmp_path}/w/batch={n}")
        assert told.selectExpr("count(*)", "count_if(fresh)", "count_if(place = key - 1 + int(fresh))").first() == ((30_000, 30_000, 30_000), (10_000, 0, 10_000))[n]
    assert time.time() - began < 40


def test_a_batch_tried_again_replaces_what_it_wrote(spark, tmp_path):
    where = str(tmp_path / "in")
    _put(spark, where, [("a", 5, 1.0)])
    schema = spark.createDataFrame([], SCHEMA).schema
    target = tmp_path / "w"
    target.write_text("in the way")  # the first try fails where it writes
    with pytest.raises(StreamingQueryException):
        walk(spark, where, schema, "k", "place", str(target), str(tmp_path / "w-check")).awaitTermination()
    target.unlink()
    assert _run(spark, tmp_path) == [("a", 5, True, 0)]


def test_guards_pass_other_failures_on(spark):
    assert walks._refused(lambda: quality.require_empty(spark.range(1), "rows"))
    with pytest.raises(ZeroDivisionError):
        walks._refused(lambda: 1 // 0)
