import hashlib
import re

from pyspark.sql import functions as F

from sievework.functions import identifiers as N
from sievework.functions import text as T


def value(spark, column, **inputs):
    row = spark.range(1).select(*(F.lit(v).alias(k) if v is not None else F.lit(None).cast("string").alias(k) for k, v in inputs.items()))
    return row.select(column.alias("out")).first()["out"]


def cases():
    return [
        (T.norm_text("x"), "  a &amp;amp; b &#39;c&#39;\n\t d ", "a &amp; b 'c' d"),
        (T.norm_text("x"), None, None),
        (T.collapse("x"), " a b ", "a b"),
        (T.name_key("x"), " Rose  OXIDE ", "rose oxide"),
        (T.clean_field("x"), None, ""),
        (T.sentences("x"), "Dry 0.02 mm. A b; (c) d. e", ["Dry 0.02 mm.", "A b;", "(c) d. e"]),
        (T.sentences("x"), "", [""]),
        (T.loose_sentences("x"), "a. b; c", ["a.", "b;", "c"]),
        (T.line_sentences("x"), "Hola. ¿Que?\n\n  Dos!", ["Hola.", "¿Que?", "Dos!"]),
        (T.clauses("x"), "sweet, and green; but sour", ["sweet", "and green", "but sour"]),
        (T.has_entity("x"), "a &#x41; b", True),
        (T.has_inner_entity("x"), "ben&#122;ene", True),
        (T.find_all(F.lit("ab"), "x"), "ABxxab ab.", [0, 4, 7]),
        (T.find_all(F.lit("("), "x"), "a(b(", [1, 3]),
        (T.stem_hits(F.lit("flowery"), "x"), "a flowe note", 1),
        (T.squash("x"), "Iso-lO", "1s010"),
        (T.loose_key("x"), "α-Ionone É", "alphaiononeé"),
        (T.product_variants("x"), "Auralva (IFF) 10% in DPG aka Sun extra", ["Auralva", "IFF", "Sun extra", "Sun"]),
        (T.name_variants("x"), "Hedione® (MDJ)", ["Hedione (MDJ)", "Hedione", "MDJ"]),
        (T.repaired("x", T.FORMATTING)[0], "2 - methyl hexan", "2-methyl hexan"),
        (T.repaired("x", ["L1", "L4", "R1"])[0], "[l] bicyc1o rnethyl", "[1] bicyclo methyl"),
        (T.repaired("x", ["L1"])[0], "l-carvone (l) -l-", "l-carvone (l) -1-"),
        (T.repaired("x", ["L1", "R1"])[1], "rnethyl", ["R1"]),
        (T.plausible("x"), "1-ab", False),
        (T.slug("x"), " Odor, of X! ", "odor-of-x"),
        (T.ellipsis("x", 4), "abcdef", "abc…"),
        (T.balanced("x"), "a(b]", False),
        (T.clean_name("x"), "Example 3: rose oxide (ROX)", "rose oxide"),
        (T.letter_key("x"), "12-(beta)", "beta)"),
        (T.content_words("x", ["the"]), "The -green- 123 ab leaf", ["green", "leaf"]),
        (T.before_head("x", ["note", "odor"]), "a sweet, green note here", ["sweet, green "]),
        (T.after_head("x", ["note"]), "with a note of rose and musk.", ["rose and musk"]),
        (T.suppressed("x", r"(?i)\b(green|blue)\b", ["liquid"]), "green liquid, Blue note", ["blue"]),
        (T.contains_all("x", F.lit(" ROSE oxide ")), "the oxide of roses", True),
        (T.contains_all("x", F.lit("")), "anything", True),
        (T.mentions("x", T.vocabulary_pattern(["b", "a b", "é"])), "x A b, b É", ["a b", "b", "é"]),
        (T.mentions("x", T.vocabulary_pattern(["(e)-2", "10"], loose=True)), "an (E)-2 x10 10", ["(e)-2", "10"]),
        (T.html_to_text("x"), "<p>a<script>x</script>&nbsp;b</p><b>c</b>", "a b c"),
        (T.html_to_text("x", True), "<p>a</p><p>b  c</p>", "a\nb c"),
        (N.padded_application("x"), "US2001001711A1", "US20010001711A1"),
        (N.padded_application("x"), "US10064905B1", "US10064905B1"),
        (N.canonical("x"), "US-007501144B2", "US7501144B2"),
        (N.registry_number_ok("x"), "200-001-8", True),
        (N.registry_number_ok("x"), "200-001-9", False),
        (N.registry_number_ok("x"), "abc", False),
        (N.word_count("x"), "  a  b ", 2),
        (N.word_count("x"), " ", 0),
        (N.code_list("x"), "78-70-6 (racemic); 1-2, ", ["78-70-6", "1-2"]),
        (N.evidence_id(F.lit("a"), "x"), "b", hashlib.sha1(b"a|b").hexdigest()[:12]),
        (N.gap_seconds("x"), "x search=green:30 y", 2.0),
    ]


def test_scalars(spark):
    bad = [(n, got, want) for n, (column, given, want) in enumerate(cases()) if (got := value(spark, column, x=given)) != want]
    assert not bad


def test_positions(spark):
    text = "Ünder 😀 rose. Then rose"
    assert value(spark, T.offset("x", F.lit("rose")), x=text) == text.index("rose")
    assert value(spark, T.offset("x", F.lit("none")), x=text) is None
    assert value(spark, T.sentence_at("x", F.lit(18)), x="First one. Second is here. Third") == "second is here"
    assert value(spark, T.context("x", F.lit(4), F.lit(1), 2), x="abcdefg") == "bcdef"
    spans = F.array(*(F.struct(F.lit(a).alias("start"), F.lit(b).alias("stop")) for a, b in ((3, 5), (0, 2), (0, 4), (5, 6))))
    assert [tuple(r) for r in value(spark, T.highlight(spans), x="")] == [(0, 4), (5, 6)]


def test_python_backed(spark):
    assert value(spark, T.decode_all_entities(F.col("x")), x="&eacute;&#8211;&amp;") == "é–&"
    assert value(spark, T.nfc(F.col("x")), x="é") == "é"
    assert value(spark, T.ring_brackets(F.col("x")), x="bicyclo[3.l.O] [l]") == "bicyclo[3.1.0] [l]"
    assert [tuple(r) for r in value(spark, T.segments(F.col("x")), x="See No. 12 at 0.5. Then; end")] == [(0, 19), (19, 28)]
    assert [tuple(r) for r in value(spark, T.segments(F.col("x")), x="E. g. U.S. Pat. 5. 6 is. A")] == [(0, 25), (25, 26)]
    assert [tuple(r) for r in value(spark, T.spans_of(F.lit("ß.e"), F.col("x")), x="İß.E ß.e ßxe")] == [(1, 4), (5, 8)]
    assert value(spark, T.similarity(F.col("x"), F.lit("abcd")), x="abcx") == 0.75
    got = value(spark, T.repaired_span(F.col("x"), F.lit("the (rose) oxide")), x="(rose")
    assert (got["span"], got["how"]) == ("(rose)", "bracket restored")
    assert value(spark, N.smiles_formula(F.col("x"))["formula"], x="COc1cc(C=O)ccc1O") == "C8H8O3"
    assert value(spark, N.smiles_formula(F.col("x"))["formula"], x="not a molecule") is None


def test_ranks_and_keys(spark):
    ids = ["US10517323B2", "US7501144B2", "US20010001711A1", "zz"]
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    assert [r.id for r in df.orderBy(N.publication_rank("id")).collect()] == ["US7501144B2", "US10517323B2", "US20010001711A1", "zz"]
    keys = [r.k and tuple(r.k) for r in df.select(N.publication_key("id").alias("k")).collect()]
    assert keys == [("grant", 10517323), ("grant", 7501144), ("application", 20010001711), None]


def test_normalising_twice_changes_nothing(spark):
    texts = ["a  b", " x\n", "plain", "", " "]
    df = spark.createDataFrame([(t,) for t in texts], "x string").select(T.collapse("x").alias("y")).select("y", T.collapse("y").alias("z"))
    assert all(r.y == r.z for r in df.collect())
    assert [r.y for r in df.collect()] == [re.sub(r"\s+", " ", t).strip() for t in texts]
