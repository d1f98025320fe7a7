import json

import pytest
from pyspark.sql import functions as F

from sievework.sources import readers, sinks
from sievework.streaming import incremental


def test_readers(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d/a.txt").write_text("one\ntwo", encoding="utf-8")
    (tmp_path / "d/b.md").write_text("no", encoding="utf-8")
    assert readers.whole_texts(spark, str(tmp_path / "d")).collect() == [("a", "one\ntwo")]
    (tmp_path / "r.jsonl").write_text('{"_comment": "head"}\n\n{"a": 1, "b": ["x"]}\n', encoding="utf-8")
    assert readers.json_lines(spark, str(tmp_path / "r.jsonl"), "a int, b array<string>").collect() == [(1, ["x"])]
    (tmp_path / "bad.jsonl").write_text('{"a": \n', encoding="utf-8")
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.json_lines(spark, str(tmp_path / "bad.jsonl"), "a int").collect()
    (tmp_path / "r.json").write_text('[{"a": 1},\n {"a": 2}]', encoding="utf-8")
    assert readers.json_array(spark, str(tmp_path / "r.json"), "a int").count() == 2
    (tmp_path / "t.tsv").write_text("# note\nform\ttag\nrose\tfloral\n", encoding="utf-8")
    assert readers.tsv(spark, str(tmp_path / "t.tsv"), "form string, tag string", comment="#").collect() == [("rose", "floral")]


def test_nested_sources(spark):
    page = {"Annotations": [{"Name": "n", "SourceName": "S", "Data": [{"Value": {"StringWithMarkup": [{"String": "sweet"}, {"String": "green"}]}}]}, {"Name": "m", "SourceName": "T", "Data": []}]}
    schema = "struct<Annotations: array<struct<Name: string, SourceName: string, Data: array<struct<Value: struct<StringWithMarkup: array<struct<String: string>>>>>>>>"
    pages = spark.createDataFrame([(json.dumps(page),)], "j string").select(F.from_json("j", schema).alias("p")).select("p.*")
    assert [tuple(r) for r in readers.annotations(pages).collect()] == [("n", "S", "sweet"), ("n", "S", "green"), ("m", "T", None)]
    assert readers.annotations(pages, ["T"]).count() == 1
    xml = '<ops:r xmlns:ops="u"><ops:biblio-search total-result-count="7"><document-id><doc-number>1</doc-number></document-id><document-id><doc-number>1</doc-number></document-id></ops:biblio-search></ops:r>'
    total, ids = readers.search_response("x")
    row = spark.createDataFrame([(xml,)], "x string").select(total.alias("t"), ids.alias("i")).first()
    assert (row.t, row.i) == (7, ["1"])
    values = [('{"StringWithMarkup": [{"String": "a"}, {"String": "b"}]}', "a b"), ('{"Number": [1.5], "Unit": "g"}', "1.5 g"), ("{}", "")]
    kind = "struct<StringWithMarkup: array<struct<String: string>>, Number: array<double>, Unit: string>"
    df = spark.createDataFrame(values, "j string, want string").select("want", readers.value_text(F.from_json("j", kind)).alias("got"))
    assert all(r.got == r.want for r in df.collect())


def test_split_ranges(spark):
    rows = spark.createDataFrame([(u,) for u in [1] * 5 + [2] * 2 + [6]], "u int")
    got = sorted(tuple(r) for r in readers.split_ranges(rows, "u", 0, 8, 4).collect())
    assert got == [(0, 1, 0, "empty"), (1, 2, 5, "failed"), (2, 4, 2, "ok"), (4, 8, 1, "ok")]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(2, "b\tc", None), (1, "a", "x")], "k int, t string, u string")
    sinks.write_tsv(df, str(tmp_path / "out"), ["k"])
    part = next((tmp_path / "out").glob("part-*")).read_text()
    assert part == "k\tt\tu\n1\ta\tx\n2\tb c\t\n"
    with pytest.raises(Exception, match="(?i)exists"):
        sinks.write_tsv(df, str(tmp_path / "out"), ["k"])
    sinks.write_json(df, str(tmp_path / "json"))
    assert spark.read.json(str(tmp_path / "json")).count() == 2
    assert sinks.write_version(df, str(tmp_path / "v")).endswith("v=1") and sinks.write_version(df, str(tmp_path / "v")).endswith("v=2")
    manifest = sinks.write_manifest(spark, str(tmp_path / "out"), {"rows": 2})
    assert manifest["counts"] == {"rows": 2} and any(k.startswith("part-") for k in manifest["sha256"])
    sinks.planned(df, str(tmp_path / "dry"))
    assert not (tmp_path / "dry").exists()
    page = sinks.embed_json(spark.createDataFrame([("</script>",)], "t string"), "<script>__DATA__</script>")
    assert page.count("</script>") == 1


def test_ingesting_twice_changes_nothing(spark, tmp_path):
    schema = "k int, v string"
    source, target, checkpoint = (str(tmp_path / x) for x in ("in", "table", "check"))
    make = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
    make([(1, "a"), (1, "b"), (2, "c")])
    parsed = spark.createDataFrame([], schema).schema
    for _ in range(2):
        incremental.ingest(spark, source, parsed, target, "k", checkpoint).awaitTermination()
    make([(2, "z"), (3, "d")])
    incremental.ingest(spark, source, parsed, target, "k", checkpoint).awaitTermination()
    assert sorted(tuple(r) for r in spark.read.parquet(target).collect()) == [(1, "a"), (2, "c"), (3, "d")]


def test_stream_windows(spark, tmp_path):
    rows = [(i, f"2024-01-01 00:{i % 60:02d}:00", 1.0) for i in range(90)]
    spark.createDataFrame(rows, "k int, ts string, value double").withColumn("ts", F.to_timestamp("ts")).write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema("k int, ts timestamp, value double").parquet(str(tmp_path / "e"))
    query = incremental.tumbling(stream, "ts", "10 minutes", late="5 minutes").writeStream.outputMode("complete").format("memory").queryName("windows").start()
    query.processAllAvailable()
    query.stop()
    assert spark.sql("SELECT sum(n) AS n, count(*) AS w FROM windows").first() == (90, 6)


def test_edited_lines_leave_the_others_alone(spark):
    from sievework.sources.sinks import edited_lines

    lines = ['{"_comment":"x"}', '{"id":"1","v":"a  b","n":1.50}', "", '{"id":"2","v":"é"}', "not json", '{"id":"3","n":1}']
    df = spark.createDataFrame(list(enumerate(lines)), "n int, line string")
    edits = lambda *rows: spark.createDataFrame(rows, "id string, changes string")
    got = [r.line for r in edited_lines(df, edits(("2", '{"v": "ü", "w": [1]}')), ["id"]).orderBy("n").collect()]
    assert got == [*lines[:3], '{"id":"2","v":"ü","w":[1]}', *lines[4:]]
    with pytest.raises(ValueError, match="several edits"):
        edited_lines(df, edits(("2", "{}"), ("2", "{}")), ["id"])
    with pytest.raises(ValueError, match="known style"):
        edited_lines(df.where("n = 1"), edits(("9", "{}")), ["id"])


def test_of_two_writers_one_is_refused_and_readers_see_whole_versions(spark, tmp_path):
    root = str(tmp_path / "log")
    rows = lambda *ids: spark.createDataFrame([(i,) for i in ids], "i int")
    read = lambda **how: sorted(r.i for r in sinks.read_version(spark, root, **how).collect())
    assert sinks.latest_version(spark, root) == 0
    sinks.write_version(rows(1), root, base=0)
    sinks.write_version(rows(1, 2), root, base=1)
    with pytest.raises(sinks.VersionConflict):
        sinks.write_version(rows(1, 3), root, base=1)
    assert read() == [1, 2] and read(version=1) == [1] and sinks.latest_version(spark, root) == 2
    assert not sinks._claim(spark, root, 2, 1)
    # one writer dies between its number and its rows: readers stay with the last whole version, writers go on
    assert sinks._claim(spark, root, 3, 2)
    assert read() == [1, 2]
    assert sinks.write_version(rows(4), root).endswith("v=4") and read() == [4]
    assert [p.name for p in (tmp_path / "log").iterdir() if p.name.startswith(".part")] == []
    with pytest.raises(FileNotFoundError):
        sinks.read_version(spark, root, 9)


def test_writers_at_once_get_numbers_of_their_own(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    root = str(tmp_path / "many")
    with ThreadPoolExecutor(4) as pool:
        made = list(pool.map(lambda i: sinks.write_version(spark.createDataFrame([(i,)], "i int"), root), range(6)))
    assert sorted(m.rsplit("=", 1)[1] for m in made) == list("123456")
    assert sorted(sinks.read_version(spark, root, n).first().i for n in range(1, 7)) == list(range(6))
