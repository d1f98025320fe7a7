"""Names, spans, identifiers, pages and files that no other query covers."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import identifiers as N
from ..functions import text as T
from ..operators import joins as J
from ..operators import predicates as P
from ..operators import evaluation as E
from ..session import ship_package, stash, table
from ..sources import readers, sinks
from .base import SENTENCES_SQL, TOKENS_SQL, VOCABULARY, VOCABULARY_SQL, Plans, sentences, sql_has, tokens, vocabulary
from .fields import _folder

_MOLECULES = (
    ("CCO", 3, 2, 1, 0, 0, 0, 1, 1, 0, 20, 1.0),
    ("c1ccccc1", 6, 6, 0, 0, 0, 0, 0, 0, 1, 30, 0.0),
    ("CC(=O)O", 4, 2, 2, 0, 0, 0, 2, 1, 0, 24, 0.5),
    ("COc1cc(C=O)ccc1O", 11, 8, 3, 0, 0, 0, 3, 1, 1, 58, 0.125),
    ("CC(C)=CCCC(C)=CC=O", 11, 10, 1, 0, 0, 0, 1, 0, 0, 62, 0.5),
    ("C1CC1N", 4, 3, 0, 1, 0, 0, 1, 1, 1, 24, 1.0),
    ("[Na+].[Cl-]", *(None,) * 11),
    ("FC(F)(F)Cl", 5, 1, 0, 0, 0, 4, 4, 0, 0, 32, 1.0),
    ("O=S(=O)(O)O", 5, 0, 4, 0, 1, 0, 5, 2, 0, 32, 0.0),
)


def _cases(spark: SparkSession, fields: str, rows: tuple) -> DataFrame:
    ship_package(spark)
    return spark.createDataFrame([(n, *r) for n, r in enumerate(rows)], f"id int, {fields}")


def _values(rows: tuple, names: str) -> str:
    plain = lambda v: "NULL" if v is None else str(v) if isinstance(v, (bool, float, int)) else "'" + v.replace("'", "''") + "'"
    return "(VALUES " + ", ".join(f"({n}, {', '.join(map(plain, r))})" for n, r in enumerate(rows)) + f") v(id, {names})"


def molecule_numbers(spark: SparkSession, d: str) -> DataFrame:
    """Descriptors of the molecules of parts that need no cheminformatics library."""
    ship_package(spark)
    known = F.array(*(F.lit(m[0]) for m in _MOLECULES))
    rows = table(spark, d, "part").select(F.get(known, (F.col("p_partkey") % len(_MOLECULES)).cast("int")).alias("smiles")).groupBy("smiles").agg(F.count("*").alias("n"))
    return rows.select("smiles", "n", N.smiles_descriptors("smiles").alias("m")).select("smiles", "n", "m.*")


def sentence_around(spark: SparkSession, d: str) -> DataFrame:
    """The sentence around the middle of each document."""
    at = F.greatest(F.lit(1), F.floor(F.length("text") / 2).cast("int"))
    return table(spark, d, "documents").select("doc_id", T.sentence_at("text", at).alias("s")).select("doc_id", F.md5("s").alias("digest"), F.length("s").cast("long").alias("chars"))


def highlighted(spark: SparkSession, d: str) -> DataFrame:
    """Of four intervals for each part those that are marked."""
    k = F.col("p_partkey").cast("int")
    span = lambda a, n: F.struct(a.alias("start"), (a + n).alias("stop"))
    spans = F.array(span(k % 7, 3), span(k % 5, 6), span(k % 11, 2), span(k % 3 + 8, 4))
    marks = F.transform(T.highlight(spans), lambda m: F.concat_ws("-", m["start"].cast("string"), m["stop"].cast("string")))
    return table(spark, d, "part").select("p_partkey", F.array_join(marks, ",").alias("marks"))


def name_forms(spark: SparkSession, d: str) -> DataFrame:
    """Forms of the names of parts, and those of them that may be searched for."""
    name = F.concat(F.col("p_name"), F.when(F.col("p_partkey") % 2 == 0, "®").otherwise(""), F.lit(" ("), F.col("p_brand"), F.lit(")"))
    forms = T.name_variants(name)
    more = F.concat(F.array(F.upper("p_name"), F.lit("CHEMBL 123456"), F.lit("musk"), F.lit("Perfume Oil")), forms)
    return table(spark, d, "part").select("p_partkey", F.array_join(forms, "|").alias("forms"), F.array_join(T.searchable(more, ["perfume oil"]), "|").alias("searchable"))


def bracket_balance(spark: SparkSession, d: str) -> DataFrame:
    """Documents by language whose brackets balance."""
    return table(spark, d, "documents").groupBy("lang").agg(F.count_if(T.balanced("text")).alias("balanced"), F.count("*").alias("n"))


def composed_text(spark: SparkSession, d: str) -> DataFrame:
    """Texts in Unicode's composed form, with a decomposed letter put before them."""
    return table(spark, d, "documents").select("doc_id", F.md5(T.nfc(F.concat(F.lit("éö"), "text"))).alias("digest"))


def label_keys(spark: SparkSession, d: str) -> DataFrame:
    """Sort keys of labels that begin with locants."""
    label = F.concat(F.lit("2-(E)-"), (F.col("p_partkey") % 9).cast("string"), F.lit("-"), "p_type")
    return table(spark, d, "part").select("p_partkey", T.letter_key(F.when(F.col("p_partkey") % 4 == 0, F.lit("12-ab")).otherwise(label)).alias("key"))


def publication_order(spark: SparkSession, d: str) -> DataFrame:
    """Grants first, then by number: the parts of the rank of constructed publications."""
    kind = F.when(F.col("o_orderkey") % 3 == 0, "A1").when(F.col("o_orderkey") % 3 == 1, "B2").otherwise("B1")
    name = F.when(F.col("o_orderkey") % 10 == 0, F.lit("zz")).otherwise(F.concat(F.lit("US"), (F.col("o_orderkey") * 7919 % 20000000).cast("string"), kind))
    return table(spark, d, "orders").select("o_orderkey", N.publication_rank(name).alias("r")).select("o_orderkey", "r.later", "r.number", "r.id")


def identifier_lists(spark: SparkSession, d: str) -> DataFrame:
    """Registry numbers among synonyms, and a list of codes without what stands in brackets."""
    number = F.concat((F.col("p_partkey") % 90 + 10).cast("string"), F.lit("-"), F.lpad((F.col("p_partkey") % 50).cast("string"), 2, "0"), F.lit("-7"))
    names = F.array(F.col("p_name"), number, F.lit("78-70-6"), number, F.col("p_brand"))
    codes = F.concat(number, F.lit(" (racemic); 1-2 ,, "), "p_brand")
    return table(spark, d, "part").select("p_partkey", F.array_join(N.identifiers(names, r"^\d{2,7}-\d\d-\d$"), "|").alias("numbers"), F.array_join(N.code_list(codes), "|").alias("codes"))


def stamps(spark: SparkSession, d: str) -> DataFrame:
    """Dates of orders as UTC stamps, and the hours that fetching the rest takes."""
    return table(spark, d, "orders").select("o_orderkey", N.utc_stamp("o_orderdate").alias("stamp"), F.round(N.hours_left("o_orderkey", 4.0), 6).alias("hours"))


def renamed_map_keys(spark: SparkSession, d: str) -> DataFrame:
    pairs = F.create_map(F.lit("brand"), F.col("p_brand"), F.lit("type"), F.col("p_type"))
    entries = F.array_sort(F.transform(F.map_entries(N.renamed_keys(pairs, {"brand": "maker"})), lambda e: F.concat_ws("=", e["key"], e["value"])))
    return table(spark, d, "part").select("p_partkey", F.array_join(entries, ";").alias("entries"))


def held_for_review(spark: SparkSession, d: str) -> DataFrame:
    """Reasons to hold a sentence; some got a citation or a name of a mixture."""
    cited = F.when(F.col("doc_id") % 3 == 0, " (Smith, 1990) (EPA 2001)").when(F.col("doc_id") % 3 == 1, " (NTP, 1999)").otherwise("")
    name = F.when(F.col("pos") % 4 == 0, "rose solution").otherwise("rose oxide")
    rows = sentences(spark, d).select("doc_id", P.hold_reasons("s", name, F.concat("s", cited)).alias("reasons"))
    return rows.groupBy("reasons").agg(F.count("*").alias("n")).select(F.md5("reasons").alias("digest"), (F.length("reasons") > 0).alias("held"), "n")


def search_answers(spark: SparkSession, d: str) -> DataFrame:
    """Totals and distinct ids of XML answers, one for each customer."""
    part = lambda x: F.concat(F.lit("<document-id><doc-number>"), x, F.lit("</doc-number></document-id>"))
    key, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    xml = F.concat(F.lit('<ops:r xmlns:ops="u"><ops:biblio-search total-result-count="'), key, F.lit('">'), part(key), part(nation), part(key), F.lit("</ops:biblio-search></ops:r>"))
    total, ids = readers.search_response("x")
    return table(spark, d, "customer").select("c_custkey", xml.alias("x")).select("c_custkey", total.alias("total"), F.array_join(ids, ",").alias("ids"))


def value_texts(spark: SparkSession, d: str) -> DataFrame:
    """Strings of a value, else its number and unit, else nothing."""
    kind = "struct<StringWithMarkup: array<struct<String: string>>, Number: array<double>, Unit: string>"
    strings = F.to_json(F.struct(F.array(F.struct(F.col("p_brand").alias("String")), F.struct(F.col("p_type").alias("String"))).alias("StringWithMarkup")))
    numbers = F.concat(F.lit('{"Number": ['), F.col("p_size").cast("string"), F.lit('.5], "Unit": "g"}'))
    raw = F.when(F.col("p_partkey") % 3 == 0, strings).when(F.col("p_partkey") % 3 == 1, numbers).otherwise("{}")
    return table(spark, d, "part").select("p_partkey", readers.value_text(F.from_json(raw, kind)).alias("value"))


def page_lines(spark: SparkSession, d: str) -> DataFrame:
    """Texts of pages with block ends as line ends."""
    out = table(spark, d, "pages").select("page_id", T.html_to_text("html", blocks_to_lines=True).alias("t"))
    return out.select("page_id", F.size(F.split("t", "\n")).cast("long").alias("lines"), F.md5("t").alias("digest"))


def decoded_arrays(spark: SparkSession, d: str) -> DataFrame:
    """Lines of pages decoded together with the page; how many members the page doesn't hold after that, which must be none."""
    rows = table(spark, d, "pages").select("page_id", T.decode_entities("html").alias("t"), F.transform(F.split("html", "\n"), T.decode_entities).alias("lines"))
    lost = F.size(F.filter("lines", lambda m: ~F.contains(F.col("t"), m)))
    return rows.select("page_id", F.md5(F.array_join("lines", "|")).alias("digest"), lost.cast("long").alias("lost"))


def embedded_array(spark: SparkSession, d: str) -> DataFrame:
    """Regions embedded as JSON into a page, and read back from it as a JSON array."""
    rows = table(spark, d, "region").select("r_regionkey", F.concat(F.lit("</"), "r_name").alias("r_name")).orderBy("r_regionkey")
    where, page = f"{_folder(spark)}/page.json", sinks.embed_json(rows, "__DATA__")
    sinks.put_text(spark, where, page)
    return readers.json_array(spark, where, rows.schema).withColumn("escaped", F.lit("</" not in page))


def text_files(spark: SparkSession, d: str) -> DataFrame:
    """Notes on regions, one text file each, and a file of another kind; read as whole texts."""
    where = _folder(spark)
    for r in table(spark, d, "region").collect():
        sinks.put_text(spark, f"{where}/region-{r['r_regionkey']}.txt", f"{r['r_name']}\nsecond line\n")
    sinks.put_text(spark, f"{where}/notes.md", "not a text")
    return readers.whole_texts(spark, where)


def versions(spark: SparkSession, d: str) -> DataFrame:
    """Two versions of a table: all suppliers, then those with even keys."""
    where, rows = _folder(spark), table(spark, d, "supplier").select("s_suppkey", "s_nationkey")
    for part in (rows, rows.where(F.col("s_suppkey") % 2 == 0)):
        sinks.write_version(part, where)
    return spark.read.parquet(where).groupBy("v").agg(F.count("*").alias("n"))


def manifest_sums(spark: SparkSession, d: str) -> DataFrame:
    """The count and the sum that a manifest gives for one file of regions."""
    where = _folder(spark)
    sinks.write_json(table(spark, d, "region").select("r_regionkey", "r_name").repartition(1).sortWithinPartitions("r_regionkey"), where)
    told = sinks.write_manifest(spark, where, {"regions": 5})
    held = json.loads(spark.read.text(f"{where}/manifest.json", wholetext=True).first()["value"])
    return spark.createDataFrame([(held["counts"]["regions"], s) for s in told["sha256"].values()], "regions bigint, sum string")


def prefix_years(spark: SparkSession, d: str) -> DataFrame:
    """Prefixes of customers, by three years and then by one where there are too many orders."""
    rows = table(spark, d, "orders").select(F.substring(F.col("o_custkey").cast("string"), 1, 1).alias("p"), F.year("o_orderdate").alias("y"))
    return readers.split_years(rows, "p", "y", 1100, 1992)


def proposals(spark: SparkSession, d: str) -> DataFrame:
    """How far proposals agree: overall, when they reject, and in the names of what both approve."""
    docs = table(spark, d, "documents").select("doc_id", "lang", "source", (F.length("text") % 3 > 0).alias("got"))
    rows = docs.join(table(spark, d, "labels").where(F.col("quality").isNotNull()).select("doc_id", (F.col("quality") == 1).alias("want")), "doc_id")
    theirs = F.when(F.col("doc_id") % 5 == 0, F.array("lang")).otherwise(F.array(F.upper("source"), "lang", "source"))
    return E.agreement(rows, "want", "got", F.array("lang", "source"), theirs)


def crossing_terms(spark: SparkSession, d: str) -> DataFrame:
    """Words without a tag, the tags they look like, and whether a tag would reach the bar with them."""
    words = stash(tokens(spark, d).select("w", "doc_id").distinct())
    held = words.join(F.broadcast(vocabulary(spark)), F.col("w") == F.col("form"), "left")
    forms, tagged = held.where(F.col("tag").isNull()).select("w", "doc_id"), held.where(F.col("tag").isNotNull()).select("tag", "doc_id").distinct()
    return J.would_cross(forms, "w", tagged, "tag", "doc_id", 150).where(F.col("uses") >= 2)


def hit_summary(spark: SparkSession, d: str) -> DataFrame:
    """For each source: sentences, documents, those without a comparison, review states, frequent tags and the first example."""
    state = table(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 1, "approve").when(F.col("quality") == 0, "reject").otherwise("undecided").alias("state"))
    hits = sentences(spark, d).where(F.length("s") > 60).join(state, "doc_id", "left").withColumn("compared", F.rlike("s", F.lit(r"(?i)\bthan\b|similar to")))
    tag_of = F.create_map(*(F.lit(x) for form, tag in VOCABULARY.items() if " " not in form for x in (form, tag)))
    words = F.array_distinct(F.array_compact(F.transform(F.split(F.lower("s"), "[^a-z]+"), lambda w: F.try_element_at(tag_of, w))))
    out = J.hit_summary(hits.withColumn("tags", words), "source", "doc_id", "pos", "s", "compared", "state", "tags")
    return out.withColumn("example", F.md5("example"))


def _strip(x: str) -> str:
    for tag in ("script", "style", "pre"):
        x = f"regexp_replace({x}, '(?is)<{tag}\\b[^>]*>.*?</{tag}>', ' ', 'g')"
    return x


def _decode(x: str) -> str:
    for a, b in T.NAMED_ENTITIES.items():
        x = f"replace({x}, '{a}', '{b.replace("'", "''")}')"
    return x


_LINES = f"regexp_replace({_strip('html')}, '(?i)</?(p|div|br|li|ul|ol|tr|td|h[1-6]|section|article)\\b[^>]*>', chr(10), 'g')"
_LINES = _decode(f"regexp_replace({_LINES}, '<[^>]+>', ' ', 'g')")
_LINES = rf"regexp_replace(regexp_replace(regexp_replace({_LINES}, '[ \t\r\f]+', ' ', 'g'), ' ?\n[\n ]*', chr(10), 'g'), '^\s+|\s+$', '', 'g')"
_NUMBER = "(p_partkey % 90 + 10)::VARCHAR || '-' || lpad((p_partkey % 50)::VARCHAR, 2, '0') || '-7'"
_CITES = r"list_filter(regexp_extract_all(c, '\(([^()]*\b(?:19|20)\d\d)\)', 1), lambda x: NOT regexp_matches(x, '\b(USCG|NTP|EPA|NIOSH|OSHA|NOAA|DOT|CDC|NLM|HSDB)\b'))"
_FORMS = ", ".join(f"'{f}'" for f in VOCABULARY)
PLANS: Plans = {
    "molecule_numbers": (molecule_numbers, f"SELECT smiles, count(*) AS n, {', '.join(f'any_value({x})::BIGINT AS {x}' for x in N.DESCRIPTORS)}, any_value(fraction_csp3)::DOUBLE AS fraction_csp3 FROM part JOIN {_values(_MOLECULES, ', '.join(('smiles', *N.DESCRIPTORS, 'fraction_csp3')))} ON id = p_partkey % {len(_MOLECULES)} GROUP BY smiles"),
    "sentence_around": (
        sentence_around,
        r"WITH a AS (SELECT doc_id, text, greatest(1, length(text) // 2) AS m FROM documents), b AS (SELECT *, substr(text, 1, m - 1) AS b, substr(text, m, 400) AS t FROM a), "
        r"c AS (SELECT *, strpos(reverse(b), ' .') AS p, strpos(t, '. ') AS q FROM b), e AS (SELECT *, CASE WHEN p = 0 THEN 0 ELSE length(b) - p + 1 END AS f, CASE WHEN q = 0 THEN m + 399 ELSE m + q - 2 END AS l FROM c), "
        r"g AS (SELECT doc_id, substr(lower(trim(regexp_replace(substr(text, f + 1, l - f), '\s+', ' ', 'g'))), 1, 400) AS s FROM e) SELECT doc_id, md5(s) AS digest, length(s)::BIGINT AS chars FROM g",
    ),
    "highlighted": (
        highlighted,
        "WITH RECURSIVE x AS (SELECT p_partkey AS k, unnest([[k % 7, k % 7 + 3], [k % 5, k % 5 + 6], [k % 11, k % 11 + 2], [k % 3 + 8, k % 3 + 12]]) AS x FROM part), o AS (SELECT k, x[1] AS a, x[2] AS b, row_number() OVER (PARTITION BY k ORDER BY x[1], x[2] DESC) AS i FROM x), "
        "g AS (SELECT p_partkey AS k, 0 AS i, -1 AS at, '' AS m FROM part UNION ALL SELECT g.k, g.i + 1, CASE WHEN o.a >= g.at THEN o.b ELSE g.at END, CASE WHEN o.a >= g.at THEN g.m || ',' || o.a || '-' || o.b ELSE g.m END FROM g JOIN o ON o.k = g.k AND o.i = g.i + 1) SELECT k AS p_partkey, m[2:] AS marks FROM g WHERE i = 4",
    ),
    "name_forms": (
        name_forms,
        r"WITH f AS (SELECT p_partkey, p_name, [trim(p_name || ' (' || p_brand || ')'), trim(p_name), trim(p_brand)] AS f FROM part), u AS (SELECT *, list_filter(f, lambda x, i: x <> '' AND list_position(f, x) = i) AS g FROM f), "
        r"m AS (SELECT *, list_filter([upper(p_name), 'CHEMBL 123456', 'musk', 'Perfume Oil'] || g, lambda x: length(regexp_replace(x, '[^A-Za-z]', '', 'g')) >= 6 AND lower(x) <> 'perfume oil' AND NOT regexp_matches(x, '^(?i:CHEMBL|SCHEMBL|DTXSID|UNII|CAS)[-: ]?\w*\d')) AS m FROM u), "
        r"l AS (SELECT *, list_transform(m, lambda x: lower(x)) AS l FROM m) SELECT p_partkey, array_to_string(g, '|') AS forms, array_to_string(list_filter(m, lambda x, i: list_position(l, lower(x)) = i), '|') AS searchable FROM l",
    ),
    "bracket_balance": (bracket_balance, "WITH b AS (SELECT lang, " + " AND ".join(f"length(replace(text, '{a}', '')) = length(replace(text, '{b}', ''))" for a, b in ("()", "[]")) + " AS b FROM documents) SELECT lang, count(*) FILTER (b) AS balanced, count(*) AS n FROM b GROUP BY lang"),
    "composed_text": (composed_text, "SELECT doc_id, md5(nfc_normalize('e' || chr(769) || 'o' || chr(776) || text)) AS digest FROM documents"),
    "label_keys": (label_keys, "WITH l AS (SELECT p_partkey, lower(CASE WHEN p_partkey % 4 = 0 THEN '12-ab' ELSE '2-(E)-' || p_partkey % 9 || '-' || p_type END) AS l FROM part) SELECT p_partkey, CASE WHEN regexp_matches(l, '[a-z]{3}') THEN regexp_extract(l, '[a-z]{3}.*$') ELSE l END AS key FROM l"),
    "publication_order": (publication_order, "WITH x AS (SELECT o_orderkey, o_orderkey * 7919 % 20000000 AS n, ['A1', 'B2', 'B1'][o_orderkey % 3 + 1] AS k, o_orderkey % 10 = 0 AS z FROM orders) SELECT o_orderkey, z OR k = 'A1' AS later, CASE WHEN z THEN 1000000000000 ELSE n END::BIGINT AS number, CASE WHEN z THEN 'zz' ELSE 'US' || n || k END AS id FROM x"),
    "identifier_lists": (identifier_lists, f"SELECT p_partkey, {_NUMBER} || '|78-70-6' AS numbers, {_NUMBER} || '|1-2|' || p_brand AS codes FROM part"),
    "stamps": (stamps, "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS stamp, round(o_orderkey * 4.0::DOUBLE / 2 / 3600, 6) AS hours FROM orders"),
    "renamed_map_keys": (renamed_map_keys, "SELECT p_partkey, 'maker=' || p_brand || ';type=' || p_type AS entries FROM part"),
    "held_for_review": (
        held_for_review,
        rf"WITH {SENTENCES_SQL}, c AS (SELECT s, pos, s || CASE doc_id % 3 WHEN 0 THEN ' (Smith, 1990) (EPA 2001)' WHEN 1 THEN ' (NTP, 1999)' ELSE '' END AS c FROM s), f AS (SELECT s, pos, {_CITES} AS f FROM c), "
        f"r AS (SELECT array_to_string(list_filter([CASE WHEN {sql_has('s', '(no|not|without|odou?rless|devoid)')} THEN 'negation in clause' END, CASE WHEN pos % 4 = 0 THEN 'mixture or class name' END, CASE WHEN len(f) > 0 THEN 'citation: ' || array_to_string(f, '; ') END], lambda x: x IS NOT NULL), '; ') AS r FROM f) "
        "SELECT md5(r) AS digest, length(r) > 0 AS held, count(*) AS n FROM r GROUP BY r",
    ),
    "search_answers": (search_answers, "SELECT c_custkey, c_custkey::BIGINT AS total, CASE WHEN c_custkey = c_nationkey THEN c_custkey::VARCHAR ELSE c_custkey || ',' || c_nationkey END AS ids FROM customer"),
    "value_texts": (value_texts, "SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN p_brand || ' ' || p_type WHEN 1 THEN p_size || '.5 g' ELSE '' END AS value FROM part"),
    "page_lines": (page_lines, f"WITH t AS (SELECT page_id, {_LINES} AS t FROM pages) SELECT page_id, len(string_split(t, chr(10)))::BIGINT AS lines, md5(t) AS digest FROM t"),
    "decoded_arrays": (decoded_arrays, f"SELECT page_id, md5(array_to_string(list_transform(string_split(html, chr(10)), lambda x: {_decode('x')}), '|')) AS digest, 0::BIGINT AS lost FROM pages"),
    "embedded_array": (embedded_array, "SELECT r_regionkey, '</' || r_name AS r_name, true AS escaped FROM region"),
    "text_files": (text_files, "SELECT 'region-' || r_regionkey AS doc_id, r_name || chr(10) || 'second line' || chr(10) AS text FROM region"),
    "versions": (versions, "SELECT 1 AS v, count(*) AS n FROM supplier UNION ALL SELECT 2, count(*) FROM supplier WHERE s_suppkey % 2 = 0"),
    "manifest_sums": (manifest_sums, """SELECT 5::BIGINT AS regions, sha256(string_agg('{"r_regionkey":' || r_regionkey || ',"r_name":"' || r_name || '"}' || chr(10), '' ORDER BY r_regionkey)) AS sum FROM region"""),
    "prefix_years": (
        prefix_years,
        "WITH o AS (SELECT (o_custkey::VARCHAR)[1:1] AS p, year(o_orderdate)::INTEGER AS y FROM orders), c AS (SELECT p, y, y - (y - 1992) % 3 AS b, count(*) OVER (PARTITION BY p) AS t, count(*) OVER (PARTITION BY p, b) AS w FROM o), "
        "k AS (SELECT p AS prefix, CASE WHEN t < 1100 THEN NULL WHEN w < 1100 THEN b ELSE y END AS from_year, CASE WHEN t < 1100 THEN NULL WHEN w < 1100 THEN b + 2 ELSE y END AS to_year FROM c) SELECT prefix, from_year, to_year, count(*) AS n, CASE WHEN count(*) < 1100 THEN 'ok' ELSE 'failed' END AS status FROM k GROUP BY 1, 2, 3",
    ),
    "proposal_agreement": (
        proposals,
        "WITH r AS (SELECT doc_id, length(text) % 3 > 0 AS got, quality = 1 AS want, lang <> source AND doc_id % 5 = 0 AS other FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL) SELECT count(*) AS n, count(*) FILTER (got = want) AS agreed, count(*) FILTER (NOT got) AS rejected, "
        "round((count(*) FILTER (NOT got AND NOT want))::DOUBLE / greatest(count(*) FILTER (NOT got), 1), 6) AS reject_precision, count(*) FILTER (got AND want) AS approved, count(*) FILTER (got AND want AND NOT other) AS same_names FROM r",
    ),
    "crossing_terms": (
        crossing_terms,
        f"WITH {TOKENS_SQL}, d AS (SELECT DISTINCT w, doc_id FROM tok), f AS (SELECT w, doc_id FROM d WHERE w NOT IN ({_FORMS})), g AS (SELECT DISTINCT tag, doc_id FROM d JOIN {VOCABULARY_SQL} ON w = form), h AS (SELECT tag, count(*) AS have FROM g GROUP BY tag), u AS (SELECT w, count(*) AS uses FROM f GROUP BY w), "
        "c AS (SELECT w, uses, tag, have, row_number() OVER (PARTITION BY w ORDER BY tag) AS i FROM u JOIN h ON contains(tag, w[1:5]) OR contains(w, tag[1:5])), n AS (SELECT c.w, c.tag, count(*) AS fresh FROM c JOIN f ON c.w = f.w WHERE i <= 2 AND NOT EXISTS (SELECT 1 FROM g WHERE g.tag = c.tag AND g.doc_id = f.doc_id) GROUP BY 1, 2) "
        "SELECT c.w, uses, c.tag, have, have + coalesce(fresh, 0) AS after, have < 150 AND have + coalesce(fresh, 0) >= 150 AS crosses FROM c LEFT JOIN n ON c.w = n.w AND c.tag = n.tag WHERE i <= 2 AND uses >= 2",
    ),
    "hit_summary": (
        hit_summary,
        rf"WITH {SENTENCES_SQL}, h AS (SELECT s.*, regexp_matches(s, '(?i)\bthan\b|similar to') AS c, CASE quality WHEN 1 THEN 'approve' WHEN 0 THEN 'reject' ELSE 'undecided' END AS state FROM s LEFT JOIN labels USING (doc_id) WHERE length(s) > 60), "
        f"a AS (SELECT source, count(*) AS sentences, count(DISTINCT doc_id) AS docs, count(*) FILTER (NOT c) AS plain_sentences, count(DISTINCT doc_id) FILTER (NOT c) AS plain_docs, min_by(s[1:220], (doc_id, pos)) FILTER (NOT c) AS example FROM h GROUP BY source), "
        "b AS (SELECT source, string_agg(state || ':' || n, ';' ORDER BY state) AS states FROM (SELECT source, state, count(*) AS n FROM h GROUP BY 1, 2) GROUP BY source), "
        rf"w AS (SELECT source, unnest(list_distinct(list_filter(string_split_regex(lower(s), '[^a-z]+'), lambda x: x <> ''))) AS w, doc_id, pos FROM h WHERE NOT c), t AS (SELECT source, tag, count(DISTINCT (doc_id, pos)) AS n FROM w JOIN {VOCABULARY_SQL} ON w = form GROUP BY 1, 2), "
        "r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, tag) AS i FROM t), k AS (SELECT source, string_agg(tag || ' ' || n, ', ' ORDER BY i) AS tags FROM r WHERE i <= 8 GROUP BY source) "
        "SELECT a.source, sentences, docs, plain_sentences, plain_docs, states, coalesce(tags, '') AS tags, md5(example) AS example FROM a JOIN b USING (source) LEFT JOIN k USING (source)",
    ),
}
