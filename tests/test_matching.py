import random
import re
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from sievework.functions import text as T
from sievework.operators import dictionary, spelling


def by_alternation(text, names, loose):
    body = "|".join(re.escape(n) for n in sorted({n for n in names if n and n.strip()}, key=lambda n: (-len(n), n)))
    pattern = rf"(?<![A-Za-z0-9])({body})(?![A-Za-z0-9])" if loose else rf"\b({body})\b"
    return [(m.start(), m.end(), m[0].lower()) for m in re.finditer(pattern, text or "", re.I)]


@pytest.mark.parametrize("loose", [False, True])
@pytest.mark.parametrize("most", [1000, 0])
def test_mentions_as_by_one_alternation(spark, loose, most):
    pick = random.Random(4)
    piece = lambda n: "".join(pick.choice("aAbé1_ (-") for _ in range(n))
    names = [piece(pick.randrange(1, 6)) for _ in range(60)] + ["a b", "a b a", "b", "(1-a)", "é", None, "", "  "]
    texts = [piece(pick.randrange(80)) for _ in range(60)] + ["", None, "A B a b A", "x(1-A)y (1-a)", "aéa É"]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(3, texts[3], "again"), (None, "a b", "none")]
    df = spark.createDataFrame(rows, "id long, text string, name string").repartition(3)
    given = spark.createDataFrame([(n, 1) for n in names], "n string, id int")
    got = sorted(((r.id, r.name_, r.start, r.end, r.found) for r in dictionary.find_names(df.withColumnRenamed("name", "name_"), "text", ["id", "name_"], given, "n", loose, most=most).withColumnRenamed("name", "found").collect()), key=repr)
    assert got == sorted([(i, x, *m) for i, t, x in rows for m in by_alternation(t, names, loose)], key=repr)


def test_no_names_and_no_texts(spark):
    texts, names = spark.createDataFrame([(1, "a b")], "id long, text string"), spark.createDataFrame([("a",)], "n string")
    for most in (0, 10):
        assert dictionary.find_names(texts, "text", ["id"], names.where("false"), "n", most=most).collect() == []
        assert dictionary.find_names(texts.where("false"), "text", ["id"], names, "n", most=most).collect() == []


def test_names_met_by_neighbouring_tokens(spark):
    """Each text has all tokens and few of the pairs: names are filed under pairs, so a text meets few of them."""
    words = [f"w{n}" for n in range(60)]
    names = spark.createDataFrame([(f"{a} {b}",) for a in words for b in words], "name string")
    texts = spark.createDataFrame([(str(n), " ".join(words[n:] + words[:n])) for n in range(40)], "digest string, text string")
    met = dictionary._filed(names, texts, False).select(F.size("names").alias("n")).collect()
    assert [r.n for r in met] == [59] * 40


def test_a_pair_of_two_documents_one_of_which_has_no_id(spark, tmp_path):
    from sievework.plans import matching

    for name, rows, schema in (("documents", [(1, "a b. c d"), (None, "A b; e f. e f"), (2, "c d"), (2, "x y"), (2, "x y"), (None, "n n"), (None, "n n")], "doc_id long, text string"), ("part", [("p q",)], "p_name string")):
        spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert sorted(r.name for r in matching.repeated_pairs(spark, str(tmp_path)).collect()) == ["a b", "c d", "p q"]


@pytest.mark.parametrize(("least", "letters"), [(0.9, "abcdefgh"), (0.86, "ab")])
def test_near_spellings_as_by_all_pairs(spark, least, letters):
    pick = random.Random(2)
    base = ["".join(pick.choice(letters) for _ in range(pick.choice([1, 2, 3, 7, 12, 20, 31]))) for _ in range(40)]
    words = list(base)
    for _ in range(160):
        w = list(pick.choice(base))
        for _ in range(pick.randrange(3)):
            at = pick.randrange(len(w) + 1)
            w[at : at + pick.randrange(2)] = pick.choice(letters) * pick.randrange(2)
        words.append("".join(w))
    df = spark.createDataFrame([(w, 1) for w in [*words, None]], "w string, name int")
    pairs = [(a, b) for a in set(words) for b in set(words) if a < b]
    near = {(a, b): SequenceMatcher(None, a, b).ratio() for a, b in pairs}
    got = {(r.a, r.b): r.score for r in spelling.near_spellings(df, "w", least).collect()}
    assert got == {p: s for p, s in near.items() if s >= least} and got

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, old = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
        return row[-1]

    close = {p for p in pairs if edits(*p) <= int((1 - least) * max(map(len, p)) + 1e-9)}
    assert {(r.a, r.b) for r in spelling.near_spellings(df, "w", least, edits=True).collect()} == close


@pytest.mark.parametrize("edits", [False, True])
def test_long_names_and_names_of_many_rests(spark, edits):
    """Lengths that meet by rests, by pairs of letters, and one of each kind."""
    pick = random.Random(7)
    words = []
    for n in (10, 17, 18, 22, 29, 33, 60, 95, 101, 110, 130):
        w = "".join(pick.choice("abcdefghijklmnop") for _ in range(n))
        words += [w, w[1:], w[: n // 3] + "z" + w[n // 3 + 1 :], w + "yz", w + "y" * (n // 8), w + "y" * (n // 5)]
    got = {(r.a, r.b): r.score for r in spelling.near_spellings(spark.createDataFrame([(w,) for w in words], "w string"), "w", 0.9, edits).collect()}
    pairs = [(a, b) for a in set(words) for b in set(words) if a < b]
    if edits:
        made = spark.createDataFrame(pairs, "a string, b string").withColumn("e", F.levenshtein("a", "b")).collect()
        assert set(got) == {(r.a, r.b) for r in made if r.e <= int(0.1 * max(len(r.a), len(r.b)) + 1e-9)} and got
    else:
        near = {(a, b): SequenceMatcher(None, a, b, autojunk=True).ratio() for a, b in pairs}
        assert got == {p: s for p, s in near.items() if s >= 0.9} and got


def test_names_that_share_all_but_a_few_letters_meet_few_others(spark):
    """Names of one stem share nearly all their pairs of letters; they meet only where no more than an edit lies between."""
    names = spark.createDataFrame([(f"1argeringbrand{n:05}",) for n in range(0, 100_000, 37)], "name string")
    met = spelling._by_rests(names, 0.95, True).distinct()
    every = [r[0] for r in names.collect()]
    assert met.count() < len(every) * 20


def test_near_names_of_parts(spark):
    """The query over the whole small table beside all pairs."""
    from sievework.plans import matching

    sf = "/root/testdata/sf0.001"
    names = sorted({r.name for r in spark.read.parquet(f"{sf}/part.parquet").select(T.squash(F.concat("p_name", "p_brand", F.col("p_size").cast("string"))).alias("name")).collect()})
    every = {(a, b): r for i, a in enumerate(names) for b in names[i + 1 :] if (r := SequenceMatcher(None, a, b).ratio()) >= 0.9}
    assert {(r.a, r.b): r.score for r in matching.near_names(spark, sf).collect()} == every
