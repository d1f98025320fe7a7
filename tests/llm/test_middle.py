import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from sievework.llm import middle, queries
from sievework.llm.automata import Grouped, Tree, compile_automaton, prefixes

STARTS = {"char": r"(?s).", "word": r"[^\x20\x09-\x0D]+", "line": r"[^\n]*\n|[^\n]+"}
HARD = ["", "a", "<P", "<P>", "x<<P>", "<S<M", "é<€😀P>", "a<P" + "b" * 70 + "<M>", "one two  three\n\nfour\t", "\n", "😀" * 50, "<" * 40 + "P>" + "z" * 33, "mid <S" + ">" * 30, " " * 45]


def brute(doc_id, text, unit="char"):
    """n, form, prefix, middle, suffix, output."""
    text = text or ""
    starts = [m.start() for m in re.finditer(STARTS[unit], text)]
    n = len(starts)
    digest = hashlib.sha256(("1:" + ("" if doc_id is None else str(doc_id))).encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(([*starts, len(text)][x % (n + 1)] for x in h[:2]))
    if not text or any(m in text for m in middle.MARKS) or h[2] % 100 >= 90:
        return n, "plain", None, None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    return (n, "spm", p, m, s, f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else (n, "psm", p, m, s, f"<P>{p}<S>{s}<M>{m}")


def given():
    pick = random.Random(3)
    texts = HARD + ["".join(pick.choice("ab <PSM>é\n😀") for _ in range(pick.randrange(200))) for _ in range(120)]
    rows = [(i, t) for i, t in enumerate(texts)]
    return [*rows, *rows[5:9], (None, "no id <P and " * 9), (None, None), (7, None), (7, "other text of the same id")]


@pytest.mark.parametrize("unit", ["char", "word", "line"])
@pytest.mark.parametrize("chunk", [24, 1 << 16])
def test_every_text_is_cut_where_a_plain_count_says(spark, unit, chunk):
    rows = given()
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, n int, form string").repartition(3)
    out = middle.transform(docs, unit=unit, chunk=chunk).withColumn("back", middle.restore(F.col("output"), F.col("form")))
    key = lambda r: repr(r)
    kept = out.collect()
    got = [(r.doc_id, r.n, r.form, r.prefix, r.middle, r.suffix, r.output) for r in kept]
    assert sorted(got, key=key) == sorted([(i, *brute(i, t, unit)) for i, t in rows], key=key)
    assert all(r.back == (r.output if r.form == "plain" else r.prefix + r.middle + r.suffix) for r in kept)
    assert {r.form for r in kept} == {"plain", "psm", "spm"}


def test_an_empty_table_gives_no_rows(spark):
    assert middle.transform(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_composition_in_any_order(spark):
    """Chunks of any size compose to the same sums as one walk, and marks over their borders count."""
    import numpy as np

    of = compile_automaton("word", ("<P>", "<PAD>", "aab"))
    grouped, pick = Grouped(of), random.Random(5)
    for _ in range(40):
        text = "".join(pick.choice("aab <P>AD") for _ in range(pick.randrange(1, 90))).encode()
        size = pick.randrange(1, 17)
        parts = [text[i : i + size] for i in range(0, len(text), size)]
        tree = Tree(grouped, np.frombuffer(text, np.uint8), np.cumsum([len(p) for p in parts]))
        whole = prefixes(tree.roots)
        assert int(whole.mark[-1, 0]) == sum(len(re.findall(f"(?={m})", text.decode())) for m in ("<P>", "<PAD>", "aab"))
        assert int(whole.unit[-1, 0]) == len(text.split())


def test_query_on_whole_texts(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for r in queries.op11_fill_in_middle(spark, "/root/testdata/sf0.001").collect():
        n, form, p, m, _, out = brute(r.doc_id, docs[r.doc_id])
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, None if p is None else len(p), None if m is None else len(m))
        assert (r.output_sha256, r.restored_sha256) == (sha(out), sha(docs[r.doc_id]))
