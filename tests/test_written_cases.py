"""Functions on names, spans and sentences written for the purpose; the queries apply them to tables."""

from pyspark.sql import functions as F

from sievework.functions import text as T
from sievework.operators import predicates as P

#: A misread name, its repair, and the rules that changed it.
REPAIRS = (
    ("rnethyl l-methyl", "methyl 1-methyl", "L1,R1"),
    ("2a hexan", "2a-hexan", "W2"),
    ("2 - methyl hexan", "2-methyl hexan", "W1"),
    ("[l] bicyc1o", "[1] bicyclo", "L1,L4"),
    ("l-carvone", "l-carvone", ""),
    ("2–3′-diol", "2-3'-diol", "U1"),
    ("(lh)-inden", "(1H)-inden", "H1"),
    ("4l-ol", "41-ol", "L3"),
    ("ionone", "ionone", ""),
)
#: A name with a ring, and the same with digits between the brackets.
RINGS = (("bicyclo[2.2.l]heptan", "bicyclo[2.2.1]heptan"), ("spiro[4.S]decan", "spiro[4.S]decan"), ("spiro (4.I)decan", "spiro (4.1)decan"), ("[l] ionone", "[l] ionone"), ("bicyclo[l.l.l]x", "bicyclo[l.l.l]x"), ("cyclo[1O.2]x", "cyclo[10.2]x"))
#: A span, its sentence, what becomes of the span, and how.
SPANS = (
    ("rose oxide", "the rose oxide is sweet", "rose oxide", "unchanged"),
    ("Example 3: rose oxide", "the rose oxide is sweet", "rose oxide", "label"),
    ("(rose", "the (rose) oxide", "(rose)", "bracket restored"),
    ("3-(rose oxide", "a 3-(rose oxide] b", None, "unbalanced"),
    ("rose oxide)", "the rose oxide) is sweet", "rose oxide", "orphan trimmed"),
    ("iris", "the rose oxide is sweet", None, "not verbatim"),
)
#: A captured name, and what is kept of it.
CLEANED = (("Example 3: rose oxide (ROX)", "rose oxide"), ("rose oxide, i.e. a pyran", "rose oxide"), ("compound of formula (IV)", None), ("3-hexenol (Z)", "3-hexenol (Z)"), ("hexenol (E,Z) x", "hexenol (E,Z) x"), ("plain", "plain"))
#: Two strings, and twice the characters of matching blocks over all characters.
ALIKE = (("abcd", "bcde", 0.75), ("rose", "rose", 1.0), ("rose", "lily", 0.0), ("hedione", "hedion", 12 / 13), ("ab", "", 0.0))
#: A sentence, a name, and whether all its mentions stand behind a comparison.
COMPARED = (
    ("It has a note reminiscent of rose.", "rose", True),
    ("Rose is stronger than rose.", "rose", False),
    ("It is stronger than musk; a rose is near.", "rose", False),
    ("It was used in place of Rose oil.", "rose", True),
    ("Nothing here", "rose", False),
)

#: sentence, names, descriptors, names of others, and the checks that apply.
ATTRIBUTIONS = (
    ("Ambrol has body and strength. Citral gives a minty freshness.", ["Ambrol"], ["minty", "body"], ["Citral"], ["GLUED:minty", "NEARER:minty"]),
    ("Ambrol of Pat. No. 3 and by approx. 0.5. 6 parts is minty", ["Ambrol"], ["minty"], [], []),
    ("Ambrol is devoid of any minty note and is not, however, green", ["Ambrol"], ["minty", "green"], [], ["NEGATED:minty"]),
    ("If ambrol instead of citral is taken the blend is fresh", ["ambrol"], ["fresh"], ["citral"], ["COUNTERFACT", "NEARER:fresh"]),
    ("Had ambrol been used it would have a woody note", ["ambrol"], ["woody"], [], ["COUNTERFACT"]),
    ("Ambrol lifts this floral essential oil composition", ["Ambrol"], ["floral"], [], ["COMPOSITION:floral"]),
    ("Ambrol is an oily liquid, a green liquid and a waxy solid", ["Ambrol"], ["oily", "green", "waxy"], [], ["PHYSICAL:oily", "PHYSICAL:waxy"]),
    ("Ambrol is like aromatic hydrocarbons and has aromatic charm", ["Ambrol"], ["aromatic"], [], ["CLASS:aromatic"]),
    ("Ambrol shows freshness and mintier notes", ["Ambrol"], ["fresh", "minty"], [], []),
    ("Ambrol is floral whereas citral is fresh", ["Ambrol"], ["floral", "fresh"], ["citral"], ["NEARER:fresh"]),
    ("Nothing is said here", [], ["green"], [], []),
)
#: sentence, names, whether a decision on them is taken back.
REVERSALS = (
    ("It causes the tobacco to have a sweet note", ["ambrol"], True),
    ("It lends body to the soup and more", [], True),
    ("7 and 8-acetyl ambrol are both woody", ["ambrol"], True),
    ("The ketone is woody", ["Z-methyl ambrol"], True),
    ("The ketone is woody", ["ambrol", "4-alkyl ambrol"], True),
    ("The ketone is woody", ["EZ-methyl ambrol", "alkylated ambrol"], False),
    ("The soupy note is woody", ["ambrol"], False),
)




def rows(spark, fields, cases):
    return spark.createDataFrame([(n, *c) for n, c in enumerate(cases)], f"id int, {fields}")


def answers(df, *columns):
    return [tuple(r)[1:] for r in df.select("id", *columns).orderBy("id").collect()]


def test_names(spark):
    name, rules = T.repaired("x", [r for r, *_ in T.REPAIRS])
    assert answers(rows(spark, "x string, y string, r string", REPAIRS), name, F.array_join(rules, ",")) == [c[1:] for c in REPAIRS]
    assert answers(rows(spark, "x string, y string", RINGS), T.ring_brackets("x")) == [c[1:] for c in RINGS]
    assert answers(rows(spark, "x string, y string", CLEANED), T.clean_name("x")) == [c[1:] for c in CLEANED]
    got = answers(rows(spark, "a string, b string, y double", ALIKE), T.similarity("a", "b"))
    assert all(abs(g[0] - c[2]) < 1e-12 for g, c in zip(got, ALIKE, strict=True))


def test_spans(spark):
    df = rows(spark, "span string, s string, y string, h string", SPANS).withColumn("r", T.repaired_span("span", "s"))
    assert answers(df, "r.span", "r.how") == [c[2:] for c in SPANS]


def test_sentences(spark):
    assert answers(rows(spark, "s string, name string, y boolean", COMPARED), P.only_compared("s", "name")) == [c[2:] for c in COMPARED]
    df = rows(spark, "s string, names array<string>, words array<string>, others array<string>, expected array<string>", ATTRIBUTIONS)
    others = F.flatten(F.transform("others", lambda n: T.spans_of(n, "s")))
    assert answers(df, P.attribution_checks("s", "names", "words", others)) == [(c[4],) for c in ATTRIBUTIONS]
    assert answers(rows(spark, "s string, names array<string>, expected boolean", REVERSALS), P.taken_back("s", "names")) == [c[2:] for c in REVERSALS]
