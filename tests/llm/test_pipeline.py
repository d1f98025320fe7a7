"""Each stage on small documents beside a plain version of what it must do, and run() beside the stages."""

import re

import public_tokenizers
import pytest
import tiktoken
from test_decontamination import brute as contaminated
from test_secrets import brute as base_secrets
from test_simhash import kept_by_brute_force

pytest.importorskip("corpus_pipeline")
import corpus_pipeline  # noqa: E402

from sievework.llm import secrets  # noqa: E402
from sievework.llm import toxicity as toxic  # noqa: E402

SF = "/root/testdata/sf0.001"
COLUMNS = list(corpus_pipeline.COLUMNS)


@pytest.fixture(scope="module")
def stages(spark):
    """Rows before and after each stage."""
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = stage(spark, docs, SF)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        out.append((name, before, docs.collect(), docs.columns))
    return out


def test_stages(spark, stages):
    assert [s[0] for s in stages] == ["toxicity", "near_duplicates", "decontamination", "secrets", "bpe"]
    assert all(s[3] == COLUMNS for s in stages[:-1])

    _, before, after, _ = stages[0]
    docs, labels = spark.createDataFrame(before), spark.read.parquet(f"{SF}/labels.parquet")
    score = toxic.fit(docs, labels).scorer()
    assert sorted(r.doc_id for r in after) == sorted(r.doc_id for r in before if score(r.text) < 0.5)
    known = {r.doc_id: r.toxic for r in labels.collect()}
    kept = {r.doc_id for r in after}
    clean = [d for d, y in known.items() if y == 0]
    assert sum(d in kept for d in clean) / len(clean) > 0.95

    _, before, after, _ = stages[1]
    # Of long texts similarity is estimated, so what is near to the bound may go either way.
    rows = [(r.doc_id, r.text) for r in before]
    some, most = ({min(d for d, _ in g) for g in kept_by_brute_force(rows, least=x).values()} for x in (0.72, 0.88))
    assert some <= {r.doc_id for r in after} <= most and len(after) == len({r.doc_id for r in after}) < len(before)

    _, before, after, _ = stages[2]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert sorted(r.doc_id for r in after) == sorted(d for d, *_, bad in contaminated([(r.doc_id, r.text) for r in before], items) if not bad)

    _, before, after, _ = stages[3]
    now = {r.doc_id: r.text for r in after}
    assert len(now) == len(before)
    for r in before:
        spans = base_secrets(r.text)
        if not spans:
            assert now[r.doc_id] == r.text or secrets.MARK in now[r.doc_id]
        else:
            assert not base_secrets(re.sub(re.escape(secrets.MARK), " ", now[r.doc_id])) and secrets.MARK in now[r.doc_id]

    _, before, after, columns = stages[4]
    ranks = {__import__("base64").b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in before}
    assert columns == [*COLUMNS, "n_tokens", "ids", "round_trip"] and len(after) == len(before)
    assert all(r.n_tokens == len(own.encode_ordinary(texts[r.doc_id])) and r.round_trip for r in after)


def test_run_is_the_stages(spark, stages):
    got = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, bytes(r.ids)) for r in got) == sorted((r.doc_id, bytes(r.ids)) for r in stages[-1][2])


def test_odd_rows(spark, tmp_path):
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "text of no one", "en", "s", 14), (5, "word " * 20000, "en", "s", 100000)]
    docs = spark.createDataFrame(rows, schema)
    for some in (docs, docs.limit(0)):
        d = str(tmp_path / f"t{some.count()}")
        some.write.parquet(f"{d}/documents.parquet")
        for t in ("labels", "benchmark"):
            spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(f"{d}/{t}.parquet")
        out = corpus_pipeline.run(spark, d).collect()
        assert len(out) == (3 if some is docs else 0)
        if out:
            assert sorted((r.doc_id for r in out), key=repr) == [1, 5, None]
