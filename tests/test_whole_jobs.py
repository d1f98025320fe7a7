"""Queries on small tables that the given ones have no case of."""

import time

from compare import differences, duck
from sievework.plans import plans


def test_short_and_quoted_benchmark_texts(spark, tmp_path):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu".split()
    texts = [" ".join(words[:n]) for n in range(1, 13)] + ["zeta  eta\ntheta", "amm", "a b", "nowhere at all", "", None, "beta gamma"]
    items = [(f"i{n}", t) for n, t in enumerate(texts)]
    docs = [" ".join(words), f"He said \"{' '.join(words[:8])}.\" Then", f"({' '.join(words[:3])})", "xalpha betax", "gamma delta", "zeta eta thetas", "extra b", "", None, " ".join(words[:10]) + ", and more " * 20]
    for name, rows, schema in (("benchmark", items, "item_id string, text string"), ("documents", list(enumerate(docs)), "doc_id long, text string")):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}")
        next((tmp_path / name).glob("*.parquet")).rename(tmp_path / f"{name}.parquet")
    query, sql = plans()["benchmark_contamination"]
    got, want = query(spark, str(tmp_path)).toPandas(), duck(str(tmp_path)).execute(sql).df()
    assert len(want) > 15 and differences(got, want) == ""


def test_suspect_terms_of_any_length(spark):
    whole, long = (plans()[n][0](spark, "/root/testdata/sf0.001").collect() for n in ("suspect_terms", "copy_factor_top_sentence"))
    assert set(long) == {r for r in whole if len(r.w) > 14} and len(whole) > len(long)


def test_map_has_every_user(spark, tmp_path):
    """User n has n // 2 clicks and as many views: pairs of users have one profile, and some round to the same one."""
    events = [(n, kind) for n in range(2, 40) for kind in ("click", "view") for _ in range(n // 2)]
    spark.createDataFrame(events, "user_id long, event_type string").coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    rows = plans()["tsne_map"][0](spark, str(tmp_path)).collect()
    assert sorted(r.user_id for r in rows) == list(range(2, 40))
    assert len({(r.x, r.y) for r in rows}) == len({round((n // 2) ** 0.5) for n in range(2, 40)})


def test_borders_beside_accented_letters(spark, tmp_path):
    """A word that goes on with an accented letter ends before it, as in SQL."""
    texts = ["Testü den, sich.", "Testß als der der", "tests of all", "odor test é", "panel é mixture"]
    docs = [(n, f"A. {texts[n % len(texts)]} B. {texts[n % len(texts)]}", "de", "s") for n in range(150)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents")
    next((tmp_path / "documents").glob("*.parquet")).rename(tmp_path / "documents.parquet")
    query, sql = plans()["smell_rule_reasons"]
    assert differences(query(spark, str(tmp_path)).toPandas(), duck(str(tmp_path)).execute(sql).df()) == ""


def test_attribution_checks_of_every_kind(spark):
    rows = plans()["attribution_checks"][0](spark, "/root/testdata/sf0.001").collect()
    assert {c.split(":")[0] for r in rows for c in r.checks.split()} == {"GLUED", "NEGATED", "COUNTERFACT", "COMPOSITION", "PHYSICAL", "CLASS", "NEARER"}


def written(spark, where, name, rows, schema):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{where}/{name}")
    next((where / name).glob("*.parquet")).rename(where / f"{name}.parquet")


def beside_sql(spark, where, name):
    query, sql = plans()[name]
    return differences(query(spark, str(where)).toPandas(), duck(str(where)).execute(sql).df())


def test_many_mentions_in_a_text_and_no_text(spark, tmp_path):
    """What the text is cut into is made once and not for each mention."""
    written(spark, tmp_path, "documents", [(1, "Tion aé " * 3000), (2, None), (3, ""), (4, "tiontion"), (5, "none")], "doc_id long, text string")
    began = time.time()
    assert beside_sql(spark, tmp_path, "mention_places") == "" and time.time() - began < 30


def test_routes_make_no_pairs_of_copies(spark, tmp_path):
    """Sixty thousand parts of one name would meet as hundreds of millions of pairs."""
    rows = [(n, "red bolt" if n % 60 else f"{n} Ab-c lo") for n in range(60_000)] + [(None, "red bolt"), (60_001, None), (60_003, "red bolt"), (60_003, "Red-Bolt")]
    written(spark, tmp_path, "part", rows, "p_partkey long, p_name string")
    began = time.time()
    assert beside_sql(spark, tmp_path, "multi_route_match") == "" and time.time() - began < 60


def test_vocabularies_of_repeated_and_missing_ids(spark, tmp_path):
    """Documents without an id are no documents, for all that their words count; those of one id are one."""
    word = lambda n: "".join(chr(97 + int(c)) for c in str(n))
    rows = [(None if n % 9 == 0 else n // 2, f"The {word(n)} frog; A {word(n % 19)} toad. The frog; Some copied line", "en", "s") for n in range(76)]
    written(spark, tmp_path, "documents", rows, "doc_id long, text string, lang string, source string")
    for name in ("two_threshold_admission", "suspect_terms", "content_terms", "term_doc_freq", "exact_dup_collapse"):
        assert beside_sql(spark, tmp_path, name) == "", name


def test_a_long_text_behind_its_last_head(spark, tmp_path):
    """From every letter behind the last head another was looked for, before."""
    rows = [(1, "Geld und gut; mit THE hat with " + "x" * 300_000, "de", "s"), (2, None, "de", "s"), (3, "no head", "de", "s"), (4, "a and of the b and c", "de", "s")]
    written(spark, tmp_path, "documents", rows, "doc_id long, text string, lang string, source string")
    began = time.time()
    assert beside_sql(spark, tmp_path, "head_clauses") == "" and time.time() - began < 30


def test_nearest_vectors_of_every_kind(spark, tmp_path):
    """Copies, near copies, and vectors that are null, zero, short, empty or hold a null or no number, beside all pairs multiplied one by one."""
    import random

    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from sievework.functions import identifiers as N
    from sievework.operators import features as X

    pick = random.Random(3)
    some = [[pick.gauss(0, 1) for _ in range(8)] for _ in range(400)]
    odd = [None, [], [0.0] * 8, [1.0], [1.0] * 7 + [None], [float("nan")] * 8, [float("inf")] + [1.0] * 7, [1.0, 2.0]]
    near = [[x + pick.choice((0, 1e-9)) for x in some[0]] for _ in range(60)]
    vectors = [*some, *[some[1]] * 200, *near, *odd, *odd]
    pick.shuffle(vectors)
    rows = [*((n, v, 0) for n, v in enumerate(vectors)), (None, some[2], 0), (50, some[1], 0), (650, None, 0), (700, odd[5], 0)]
    written(spark, tmp_path, "embeddings", rows, "vec_id long, embedding array<double>, label int")
    unit = spark.read.parquet(f"{tmp_path}/embeddings.parquet").select("vec_id", X.unit("embedding").alias("v"))
    pairs = unit.where("vec_id % 50 = 0").select(F.col("vec_id").alias("query_id"), F.col("v").alias("q")).join(unit, F.col("vec_id") != F.col("query_id"))
    ranked = pairs.withColumn("score", F.round(N.dot("q", "v"), 9)).withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")))
    want = ranked.where("rank <= 3").select("query_id", "rank", "vec_id", F.round("score", 6).alias("score"))
    got = plans()["cosine_topk"][0](spark, str(tmp_path))
    assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_nearest_vectors_are_not_multiplied_one_by_one(spark, tmp_path):
    """Four hundred queries by twenty thousand rows are eight million pairs."""
    spark.range(20_000).selectExpr("id AS vec_id", "transform(sequence(1, 64), i -> sin(id * i)) AS embedding", "0 AS label").write.parquet(f"{tmp_path}/embeddings.parquet")
    plan = plans()["cosine_topk"][0](spark, str(tmp_path))
    began = time.time()
    assert len(plan.collect()) == 1200 and time.time() - began < 20


def test_names_of_two_words_are_not_sent_to_texts(spark, tmp_path, monkeypatch):
    """Nearly every two words are a name; before, each text got its names as strings."""
    import random

    from sievework.operators import dictionary

    monkeypatch.setattr(dictionary, "_filed", None)
    pick = random.Random(6)
    words = [f"w{n}" for n in range(60)]
    odd = ["a b", "A b; e f. e f", "c  d c d", "É a, \u00c9 a", "x_y 1 x_y 1", None, "", " ", "p q p q r", "(p q)", "p\nq", "red bolt red"]
    rows = [(n, " ".join(pick.choices(words, k=200))) for n in range(100)] + [(200 + n if n else None, t) for n, t in enumerate(odd * 2)] + [(300, "only here only here")]
    written(spark, tmp_path, "documents", rows, "doc_id long, text string")
    written(spark, tmp_path, "part", [("P q",), ("red bolt",), (None,)], "p_name string")
    assert beside_sql(spark, tmp_path, "name_mentions") == ""


def test_what_is_repeated_is_as_the_table_of_it(spark, tmp_path, monkeypatch):
    """Names found beside the mentions, or made a table first; of one word and of three too; in one block and in many."""
    from sievework.operators import dictionary
    from sievework.plans import matching

    texts = ["a b. c d a", "A b; e f. e f", "c d e", "x y x y z", "x y", "bolt of red, nut", "a_b c a_b c", "Éa b", "éa b éa b"]
    rows = [(i, texts[(i * i + j) % len(texts)]) for i in range(5) for j in range(3)] + [(None, "n n"), (None, "n n"), (7, "n n nut")]
    written(spark, tmp_path, "documents", rows, "doc_id long, text string")
    written(spark, tmp_path, "part", [("nut",), ("Bolt of red",), ("y z",)], "p_name string")
    docs, part = (spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in ("documents", "part"))
    want = sorted(map(repr, dictionary.find_names(docs, "text", ["doc_id"], matching.repeated_pairs(spark, str(tmp_path)), "name").collect()))
    for chars in (dictionary.BLOCK_CHARS, 20):
        monkeypatch.setattr(dictionary, "BLOCK_CHARS", chars)
        assert sorted(map(repr, dictionary.find_names(docs, "text", ["doc_id"], part, "p_name", repeated="doc_id").collect())) == want and len(want) > 20


def test_repeated_pairs_are_not_made_a_table(spark, tmp_path, monkeypatch):
    """They are counted where texts meet names; before, all of them were strings that were shuffled, written and filed."""
    from sievework.plans import matching

    monkeypatch.setattr(matching, "repeated_pairs", None)
    texts = ["a b. c d a", "A b; e f. e f", "c d e", "x y x y z", "x y, p q", None, "", "e f e f e f"]
    written(spark, tmp_path, "documents", [(n or None, t) for n, t in enumerate(texts)], "doc_id long, text string")
    written(spark, tmp_path, "part", [("P q",), (None,)], "p_name string")
    assert beside_sql(spark, tmp_path, "dictionary_mentions") == ""
