"""The queries op3 to op8, digests and all, beside plain versions over a whole small table."""

import base64
import hashlib
import zlib
from array import array

import public_tokenizers
import pytest
import tiktoken
from test_secrets import brute as base_secrets
from test_simhash import brute as groups
from tokenizers import Tokenizer

from sievework.llm import quality, queries, secrets, toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def rows(spark, query):
    return {r.doc_id: r for r in query(spark, SF).collect()}


def test_bpe(spark, docs):
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = rows(spark, queries.op3_bpe)
    assert got.keys() == docs.keys()
    for d, r in got.items():
        ids = own.encode_ordinary(docs[d].text or "")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(array("I", ids).tobytes()), sha((docs[d].text or "").encode()))


def test_secrets(spark, docs):
    got, order = rows(spark, queries.op4_secrets), [r.kind for r in secrets.RULES]
    assert got.keys() == docs.keys()
    for d, r in got.items():
        base = base_secrets(docs[d].text)
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == kind for k, _, _ in base) for kind in ("assign", "access", "hex"))
        assert r.base_sha256 == sha(listed)
        every = [(int(a), order.index(k), int(b)) for k, a, b in (x.split(":") for x in r.spans.split(",") if x)]
        assert every == sorted(every) and {x for x in listed.split(",") if x} <= set(r.spans.split(","))


def test_simhash(spark, docs):
    got = rows(spark, queries.op5_simhash)
    assert sorted((d, int(r.fingerprint, 16), r.component_id) for d, r in got.items()) == sorted(groups(docs.values()))
    assert all(len(r.fingerprint) == 16 and r.fingerprint == r.fingerprint.lower() for r in got.values())


def test_counts(spark, docs):
    library, got = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), rows(spark, queries.op6_token_counts)
    for d, r in got.items():
        n = len(library.encode(docs[d].text or "", add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len((docs[d].text or "").encode()), n, n > 512)


@pytest.mark.parametrize(("query", "module", "least"), [(queries.op7_toxicity, toxicity, 0.5), (queries.op8_quality, quality, 0.3)])
def test_classifiers(spark, docs, query, module, least):
    got = rows(spark, query)
    model = module.fit(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    for d, r in got.items():
        text = docs[d].text or ""
        score = model.scorer()(text) if module is toxicity else float(model.score(__import__("numpy").array([quality.describe(text)]))[0])
        assert abs(r.score - score) < 1e-12 and r.predicted == int(r.score >= least)
        assert r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0)
