"""The operators on the star schema, each with its DuckDB form.

Regions, nations and customers stand for countries, states and sites; suppliers and parts for further labels; orders
and line items for assignments and components; events for log rows; conversations for activities.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions import text as X
from orrery.operators import graph, matching, patterns, reconcile, shapes, tables, triples
from orrery.operators.triples import RDF, RDFS, XSD, iri, lit

D, T = "https://example.org/data/", "https://example.org/term#"
AUTHORITY = "https://sws.geonames.org/"
Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str) -> Callable[[Query], Query]:
    """Registers a query with its DuckDB form."""

    def add(f: Query) -> Query:
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# -- scalar functions ---------------------------------------------------------------------------------------------

# a cell that is empty in three ways, by event number
_CELL = "CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '  ' WHEN 2 THEN ' NaN ' ELSE event_type END"


@query(f"""
    SELECT 'event_type' AS "column", count(*) FILTER (WHERE event_type IS NULL OR trim(event_type) = '' OR lower(trim(event_type)) = 'nan') AS "empty", count(*) FILTER (WHERE trim(event_type) <> '') AS filled FROM events
    UNION ALL SELECT 'cell', count(*) FILTER (WHERE c IS NULL OR trim(c) = '' OR lower(trim(c)) = 'nan'), count(*) FILTER (WHERE trim(c) <> '') FROM (SELECT {_CELL} AS c FROM events)""")
def norm_empty(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_type", F.expr(_CELL).alias("cell"))
    return tables.empties(e, e.columns).join(tables.filled_counts(e).drop("total"), "column")


_RAW = "concat('ca. ', CASE WHEN c_custkey % 4 = 0 THEN '-' ELSE '' END, CAST(c_custkey AS VARCHAR), ',5 m')"


@query(f"""
    SELECT c_custkey, replace(nullif(regexp_extract({_RAW}, '[-+]?[0-9]+(?:[.,][0-9]+)?', 0), ''), ',', '.') AS "decimal",
           CAST(trunc(TRY_CAST(replace(concat(CAST(c_custkey AS VARCHAR), ',7'), ',', '.') AS DOUBLE)) AS BIGINT) AS "integer",
           CAST(NULL AS BIGINT) AS no_integer FROM customer""")
def lex_parse(spark, sf_dir):
    c = read(spark, sf_dir, "customer")
    raw = F.concat(F.lit("ca. "), F.when(F.col("c_custkey") % 4 == 0, "-").otherwise(""), F.col("c_custkey").cast("string"), F.lit(",5 m"))
    return c.select("c_custkey", X.lex_decimal(raw).alias("decimal"), X.lex_integer(F.concat(F.col("c_custkey").cast("string"), F.lit(",7"))).alias("integer"), X.lex_integer("c_name").alias("no_integer"))


@query(f"SELECT n_name, '{D}nation_' || substr(md5(n_name), 1, 8) AS node, '{AUTHORITY}' || n_nationkey AS ext FROM nation")
def hash_uri(spark, sf_dir):
    n = read(spark, sf_dir, "nation")
    return n.select("n_name", X.minted(D, "nation", "n_name").alias("node"), F.concat(F.lit(AUTHORITY), F.col("n_nationkey").cast("string")).alias("ext"))


@query("""
    SELECT band, count(*) AS n FROM (SELECT CASE WHEN l_linenumber = 7 THEN 'dubious' WHEN m = 0 THEN 'high' WHEN m < 500 THEN 'medium' ELSE 'low' END AS band
    FROM (SELECT l_linenumber, (CAST(l_quantity AS BIGINT) - 1) * 20 AS m FROM lineitem)) GROUP BY band""")
def band_case(spark, sf_dir):
    m = ((F.col("l_quantity").cast("bigint") - 1) * 20).cast("string")
    return read(spark, sf_dir, "lineitem").groupBy(X.band(m, F.col("l_linenumber") != 7).alias("band")).agg(F.count("*").alias("n"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 'POINT(' || (c_custkey % 7) || '.5 ' || c_nationkey || ')' END AS wkt FROM customer")
def wkt_points(spark, sf_dir):
    k = F.col("c_custkey") % 7
    x = F.when(k == 0, "0,0").otherwise(F.concat(k.cast("string"), F.lit(",5")))
    y = F.when(k == 0, "0").otherwise(F.col("c_nationkey").cast("string"))
    return read(spark, sf_dir, "customer").select("c_custkey", X.wkt_point(x, y).alias("wkt"))


@query("""
    SELECT s_name, CASE WHEN s_suppkey % 2 = 0 THEN ['Supplier bei ' || s_nationkey, 'Supplier'] ELSE ['Ort (' || s_suppkey || ')', 'Ort'] END AS variants,
           strftime(TIMESTAMP '2024-03-01 10:20:30', '%Y-%m-%dT%H-%M-%SZ') AS stamp FROM supplier""")
def label_variants(spark, sf_dir):
    s = read(spark, sf_dir, "supplier")
    label = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("Supplier bei "), F.col("s_nationkey").cast("string"))).otherwise(F.concat(F.lit("Ort ("), F.col("s_suppkey").cast("string"), F.lit(")")))
    return s.select("s_name", X.variants(label, "Altstadt").alias("variants"), X.run_stamp(F.lit("2024-03-01 10:20:30").cast("timestamp")).alias("stamp"))


# -- lookups and merges -------------------------------------------------------------------------------------------

SEGMENTS = {"AUTOMOBILE": "Q1", "BUILDING": "Q2", "FURNITURE": "Q3", "MACHINERY": None}
_SEGMENTS = "(VALUES ('AUTOMOBILE', 'Q1'), ('BUILDING', 'Q2'), ('FURNITURE', 'Q3'), ('MACHINERY', NULL)) AS m(k, v)"
_CURRENT = "CASE c_custkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'Q2' ELSE NULL END"
_STATUS = f"""(SELECT c_custkey, trim(c_mktsegment) AS k, CASE WHEN v IS NULL THEN 'noop' WHEN coalesce(trim({_CURRENT}), '') IN ('', 'nan') THEN 'filled' WHEN {_CURRENT} = v THEN 'confirmed' ELSE 'overwritten' END AS s,
    m.k IS NOT NULL AS hit FROM customer LEFT JOIN {_SEGMENTS} ON trim(c_mktsegment) = m.k)"""


def _looked_up(spark, sf_dir) -> DataFrame:
    c = read(spark, sf_dir, "customer").withColumn("qid", F.when(F.col("c_custkey") % 3 == 0, "").when(F.col("c_custkey") % 3 == 1, "Q2"))
    return tables.lookup(c, "c_mktsegment", "qid", SEGMENTS)


@query(f"SELECT 'qid' AS target, count(*) FILTER (WHERE s = 'filled') AS filled, count(*) FILTER (WHERE s = 'confirmed') AS confirmed, count(*) FILTER (WHERE s = 'overwritten') AS overwritten, count(*) FILTER (WHERE NOT hit) + count(*) FILTER (WHERE s = 'overwritten') AS missing FROM {_STATUS}")
def dict_lookup_status(spark, sf_dir):
    return tables.status_counts(_looked_up(spark, sf_dir), "qid")


@query(f"""SELECT c_custkey + 2 AS line, 'c_mktsegment' AS "column", k AS value, CASE WHEN s = 'overwritten' THEN 'conflict' ELSE 'not in mapping' END AS message FROM {_STATUS} WHERE s = 'overwritten' OR NOT hit""")
def dict_misses(spark, sf_dir):
    return tables.misses(_looked_up(spark, sf_dir), "c_mktsegment", "qid", "c_custkey")


@query("""
    WITH v AS (SELECT s_suppkey, 'Landkreis ' || s_name AS raw, trim(regexp_replace('Landkreis ' || s_name, '^landkreis\\s+', '', 'i')) AS n FROM supplier),
    a AS (SELECT s_suppkey, raw, CASE WHEN lower(n) = 'supplier#000000001' THEN 'First' ELSE n END AS name FROM v)
    SELECT s_suppkey, name, CASE WHEN lower(name) = 'first' THEN 'Q7' END AS qid FROM a""")
def alias_override(spark, sf_dir):
    s = read(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("Landkreis "), "s_name").alias("raw"))
    named = matching.aliased(s, "raw", [r"landkreis\s+"], {"supplier#000000001": "First"})
    overrides = spark.createDataFrame([("first", "Q7", "First")], "key string, qid string, label string")
    hits = matching.overridden(named, overrides).select("raw", "qid")
    return named.join(hits, "raw", "left").select("s_suppkey", "name", "qid")


@query("""
    SELECT trim(CAST(c.c_custkey AS VARCHAR)) AS c_custkey, c_name, n_orders, spent, c_nationkey FROM customer c
    LEFT JOIN (SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS spent FROM orders GROUP BY o_custkey) o ON c.c_custkey = o.o_custkey""")
def left_merge(spark, sf_dir):
    o = read(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count("*").alias("n_orders"), F.round(F.sum("o_totalprice"), 2).alias("spent"))
    c = read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    merged = tables.merge(c, o, "c_custkey", ["n_orders", "spent", "absent"], "o_custkey")
    return tables.placed(merged, {"C_NAME": ["n_orders", "spent"]})


# -- matching -----------------------------------------------------------------------------------------------------

_LABELS = "(SELECT p_partkey AS ord, 'Q' || p_partkey AS item, p_name AS label, CASE WHEN p_partkey % 3 = 0 THEN 'rdfs:label' ELSE 'skos:altLabel' END AS label_type, CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS VARCHAR) ELSE '' END AS geonames, p_brand AS scope FROM part)"


def _labels(spark, sf_dir) -> DataFrame:
    p = read(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("ord"), F.concat(F.lit("Q"), F.col("p_partkey").cast("string")).alias("item"), F.col("p_name").alias("label"), F.when(F.col("p_partkey") % 3 == 0, "rdfs:label").otherwise("skos:altLabel").alias("label_type"), F.when(F.col("p_size") % 2 == 0, F.col("p_size").cast("string")).otherwise("").alias("geonames"), F.col("p_brand").alias("scope"))


@query(f"""
    SELECT lower(trim(label)) AS key, arg_min(item, ord) AS qid, arg_min(geonames, ord) FILTER (WHERE geonames <> '') AS geonames, min(ord) AS ord,
           coalesce(arg_max(label, ord) FILTER (WHERE label_type = 'rdfs:label'), arg_min(label, ord)) AS label,
           CASE WHEN bool_or(label_type = 'rdfs:label') THEN 'rdfs:label' ELSE arg_min(label_type, ord) END AS source FROM {_LABELS} GROUP BY 1""")
def index_merge(spark, sf_dir):
    return matching.label_index(_labels(spark, sf_dir)).select("key", "qid", "geonames", "ord", "label", "source")


def _lcs(a: str, b: str) -> str:
    """LCS length in DuckDB: the same fold over letters."""
    row = f"list_reduce(list_concat([[0]], list_transform(range(1, length({b}) + 1), lambda j: [CAST(j AS INTEGER)])), lambda now, j: list_append(now, CAST(CASE WHEN substr({b}, j[1], 1) = substr({a}, CAST(x[1] AS BIGINT), 1) THEN prev[j[1]] + 1 ELSE greatest(prev[j[1] + 1], now[-1]) END AS INTEGER)))"
    return f"list_reduce(list_concat([list_transform(range(0, length({b}) + 1), lambda z: 0)], list_transform(range(1, length({a}) + 1), lambda i: [CAST(i AS INTEGER)])), lambda prev, x: {row})[-1]"


_SORTED = "array_to_string(list_sort(list_filter(regexp_split_to_array({}, '\\s+'), lambda t: t <> '')), ' ')"
# a label with its words the other way round, the last of them without its last letter
_SWAPPED = "(SELECT DISTINCT split_part(p_name, ' ', 2) || ' ' || left(split_part(p_name, ' ', 1), -1) AS raw FROM part)"


def _best(values: str, index: str, scope: str, threshold: float) -> str:
    """(raw, scope, qid, score): the best candidate by ratio, then order."""
    on = f"v.{scope} = i.{scope}" if scope else "TRUE"
    s = f"v.{scope}, " if scope else ""
    a, b = _SORTED.format("lower(trim(v.raw))"), _SORTED.format("i.key")
    return f"""
        SELECT raw, {scope + ', ' if scope else ''}CASE WHEN score >= {threshold} THEN qid END AS qid, score FROM (
            SELECT v.raw, {s}i.qid, r.score, row_number() OVER (PARTITION BY v.raw{', v.' + scope if scope else ''} ORDER BY r.score DESC, i.ord, i.key DESC) AS n
            FROM {values} v JOIN {index} i ON {on}, LATERAL (SELECT CASE WHEN {a} = {b} THEN 1.0 ELSE round(2.0 * {_lcs(a, b)} / (length({a}) + length({b})), 4) END AS score) r) WHERE n = 1"""


_INDEX = f"(SELECT lower(trim(label)) AS key, arg_min(item, ord) AS qid, min(ord) AS ord FROM {_LABELS} GROUP BY 1)"


def _named(values: DataFrame) -> DataFrame:
    return values.withColumns({"name": F.col("raw"), "note": F.lit("")})


@query("SELECT raw, CASE WHEN score >= 0.85 THEN qid END AS qid, score FROM (" + _best(_SWAPPED, _INDEX, "", 0.0).replace("CASE WHEN score >= 0.0 THEN qid END AS qid", "qid") + ")")
def fuzzy_best(spark, sf_dir):
    words = F.split("p_name", " ")
    terms = read(spark, sf_dir, "part").select(F.concat_ws(" ", words[1], F.expr("left(split(p_name, ' ')[0], length(split(p_name, ' ')[0]) - 1)")).alias("raw")).distinct()
    return matching.best_match(_named(terms), matching.label_index(_labels(spark, sf_dir)), [], 0.85).select("raw", "qid", F.col("score").cast("double").alias("score"))


_SCOPED = "(SELECT DISTINCT s_name AS raw, s_nationkey AS scope FROM supplier)"
_CUSTOMERS = "(SELECT lower(trim(c_name)) AS key, 'Q' || min(c_custkey) AS qid, min(c_custkey) AS ord, c_nationkey AS scope FROM customer GROUP BY c_name, c_nationkey)"


def _scoped(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    values = _named(read(spark, sf_dir, "supplier").select(F.col("s_name").alias("raw"), F.col("s_nationkey").alias("scope")).distinct())
    named = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ord"), F.concat(F.lit("Q"), F.col("c_custkey").cast("string")).alias("item"), F.col("c_name").alias("label"), F.lit("rdfs:label").alias("label_type"), F.col("c_nationkey").alias("scope"))
    return values, matching.label_index(named, "scope")


@query(f"SELECT v.raw, v.scope, b.qid, b.score FROM {_SCOPED} v LEFT JOIN ({_best(_SCOPED, _CUSTOMERS, 'scope', 0.7)}) b ON v.raw = b.raw AND v.scope = b.scope")
def fuzzy_scoped(spark, sf_dir):
    values, index = _scoped(spark, sf_dir)
    return matching.best_match(values, index, ["scope"], 0.7).select("raw", "scope", "qid", F.col("score").cast("double").alias("score"))


@query("""
    WITH v AS (SELECT n_name || ' bei Region' AS raw, r_name AS scope, n_name AS short FROM nation JOIN region ON n_regionkey = r_regionkey)
    SELECT raw, scope, 'nation_' || short AS qid, round(2.0 * length(short) / (length(short) + length(raw)), 4) AS score FROM v""")
def transitive_fallback(spark, sf_dir):
    """Labels that only a shorter variant finds, somewhere below their scope."""
    n = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    item = F.concat(F.lit("nation_"), "n_name")
    parts = n.select(item.alias("item"), F.concat(F.lit("mid_"), "r_name").alias("parent")).unionByName(n.select(F.concat(F.lit("mid_"), "r_name").alias("item"), F.col("r_name").alias("parent")).distinct())
    values = _named(n.select(F.concat("n_name", F.lit(" bei Region")).alias("raw"), F.col("r_name").alias("scope")))
    labels = n.select(item.alias("item"), F.col("n_name").alias("label"))
    return matching.transitive_match(values, labels, parts, "scope", "Altstadt").select("raw", "scope", "qid", X.indel_ratio("raw", "match_label").alias("score"))


@query(f"""
    WITH best AS ({_best(_SCOPED, _CUSTOMERS, "scope", 0.7)}),
    v AS (SELECT raw, scope FROM {_SCOPED} UNION ALL SELECT raw || ' bei ' || n_name, scope FROM {_SCOPED} s JOIN nation ON scope = n_nationkey),
    tried AS ({_best("(SELECT raw || ' bei ' || n_name AS raw, scope FROM " + _SCOPED + " s JOIN nation ON scope = n_nationkey)", _CUSTOMERS, "scope", 0.7)}),
    first AS (SELECT raw, scope, qid FROM best WHERE qid IS NOT NULL UNION ALL SELECT raw, scope, qid FROM tried WHERE qid IS NOT NULL),
    parts AS (SELECT raw, scope, 'S' || min(CAST(s_suppkey AS VARCHAR)) AS qid FROM (SELECT raw, scope, regexp_replace(raw, ' bei .*$', '') AS short FROM v) JOIN supplier ON s_name = short AND s_nationkey = scope GROUP BY 1, 2)
    SELECT v.raw, v.scope, coalesce(f.qid, p.qid) AS qid, CASE WHEN f.qid IS NOT NULL THEN 'stage 1' WHEN p.qid IS NOT NULL THEN 'stage 2' ELSE 'none' END AS stage
    FROM v LEFT JOIN first f ON v.raw = f.raw AND v.scope = f.scope LEFT JOIN parts p ON v.raw = p.raw AND v.scope = p.scope""")
def two_stage_fallback(spark, sf_dir):
    """Suppliers' names, plain and with the place that they lie at, first among the customers of their nation, then by label anywhere below it."""
    values, index = (t.withColumn("scope", F.col("scope").cast("string")) for t in _scoped(spark, sf_dir))
    n = read(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("string").alias("scope"), "n_name")
    at = values.join(n, "scope").withColumn("raw", F.concat("raw", F.lit(" bei "), "n_name")).withColumn("name", F.col("raw")).select(*values.columns)
    s = read(spark, sf_dir, "supplier")
    item, half = F.concat(F.lit("S"), F.col("s_suppkey").cast("string")), F.concat(F.lit("half"), (F.col("s_suppkey") % 2).cast("string"), F.lit("/"), F.col("s_nationkey").cast("string"))
    parts = s.select(item.alias("item"), half.alias("parent")).unionByName(s.select(half.alias("item"), F.col("s_nationkey").cast("string").alias("parent")).distinct())
    found = matching.two_stage(values.unionByName(at), index, s.select(item.alias("item"), F.col("s_name").alias("label")), parts, "scope", 0.7, "Altstadt")
    stage = F.when(F.col("qid").isNull(), "none").when(F.col("qid").startswith("S"), "stage 2").otherwise("stage 1")
    return found.select("raw", F.col("scope").cast("int").alias("scope"), "qid", stage.alias("stage"))


# -- triples ------------------------------------------------------------------------------------------------------


def _node(prefix: str, c: Column | str) -> Column:
    return X.minted(D, prefix, c)


def star_graph(spark: SparkSession, sf_dir: str) -> triples.Graph:
    """Regions, nations, customers and suppliers as a graph. Facts about places and kinds come from their own small tables, each row once."""
    own = lambda s, p, o: (p, iri(s, p, o))
    said = lambda s, p, o, *rest, **more: (p, lit(s, p, o, *rest, **more))
    n = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    nation, region = _node("nation", "n_name"), _node("region", "r_name")
    ext = F.concat(F.lit(AUTHORITY), F.col("n_nationkey").cast("string"))
    places = [own(nation, f"{RDF}type", f"{T}Nation"), said(nation, f"{RDFS}label", F.col("n_name"), "de"), own(nation, f"{T}inRegion", region), own(nation, f"{T}hasExternalIdentifier", ext), own(region, f"{RDF}type", f"{T}Region"), said(region, f"{RDFS}label", F.col("r_name"), "de")]
    names = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customers, suppliers = read(spark, sf_dir, "customer"), read(spark, sf_dir, "supplier")
    c = customers.join(names, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "c_name", "c_acctbal", "c_mktsegment", "n_name")
    site = F.concat(F.lit(f"{D}site_"), F.col("c_custkey").cast("string"))
    kind = _node("kind", "c_mktsegment")
    sites = [
        own(site, f"{RDF}type", f"{T}Site"),
        said(site, f"{T}hasId", F.col("c_custkey").cast("string"), dt=f"{XSD}integer"),
        said(site, f"{RDFS}label", F.col("c_name"), "de"),
        own(site, f"{T}inNation", nation),
        own(site, f"{T}hasKind", kind),
        said(F.when(F.col("c_acctbal") < 0, site), f"{T}certaintyDesc", "uncertain", "en"),
    ]
    kinds = [own(kind, f"{RDF}type", f"{T}Kind"), said(kind, f"{RDFS}label", F.col("c_mktsegment"), "de")]
    k = customers.join(names, F.col("c_nationkey") == F.col("n_nationkey")).select("c_mktsegment").distinct()
    s = suppliers.join(names, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "s_name", "n_name")
    other = F.concat(F.lit(f"{D}supplier_"), F.col("s_suppkey").cast("string"))
    others = [own(other, f"{RDF}type", f"{T}Supplier"), said(other, f"{RDFS}label", F.col("s_name"), "de"), own(other, f"{T}inNation", nation)]
    wide = lambda df, facts, rows: (triples.spread(df, len(facts), rows), facts, rows)
    return triples.Graph((n, places), wide(c, sites, customers.count()), (k, kinds), wide(s, others, suppliers.count()))


def star_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star_graph(spark, sf_dir).of()


def _sql_node(prefix: str, c: str) -> str:
    return f"'{D}{prefix}_' || substr(md5({c}), 1, 8)"


_N = "(SELECT * FROM nation JOIN region ON n_regionkey = r_regionkey)"
_C = "(SELECT * FROM customer JOIN nation ON c_nationkey = n_nationkey)"
_S = "(SELECT * FROM supplier JOIN nation ON s_nationkey = n_nationkey)"
_SITE, _OTHER = f"'{D}site_' || c_custkey", f"'{D}supplier_' || s_suppkey"
_FACTS = [
    (_N, _sql_node("nation", "n_name"), f"{RDF}type", f"'{T}Nation'", "iri", None, None),
    (_N, _sql_node("nation", "n_name"), f"{RDFS}label", "n_name", "lit", None, "de"),
    (_N, _sql_node("nation", "n_name"), f"{T}inRegion", _sql_node("region", "r_name"), "iri", None, None),
    (_N, _sql_node("nation", "n_name"), f"{T}hasExternalIdentifier", f"'{AUTHORITY}' || n_nationkey", "iri", None, None),
    (_N, _sql_node("region", "r_name"), f"{RDF}type", f"'{T}Region'", "iri", None, None),
    (_N, _sql_node("region", "r_name"), f"{RDFS}label", "r_name", "lit", None, "de"),
    (_C, _SITE, f"{RDF}type", f"'{T}Site'", "iri", None, None),
    (_C, _SITE, f"{T}hasId", "CAST(c_custkey AS VARCHAR)", "lit", f"{XSD}integer", None),
    (_C, _SITE, f"{RDFS}label", "c_name", "lit", None, "de"),
    (_C, _SITE, f"{T}inNation", _sql_node("nation", "n_name"), "iri", None, None),
    (_C, _SITE, f"{T}hasKind", _sql_node("kind", "c_mktsegment"), "iri", None, None),
    (_C, _sql_node("kind", "c_mktsegment"), f"{RDF}type", f"'{T}Kind'", "iri", None, None),
    (_C, _sql_node("kind", "c_mktsegment"), f"{RDFS}label", "c_mktsegment", "lit", None, "de"),
    ("(SELECT * FROM customer WHERE c_acctbal < 0)", _SITE, f"{T}certaintyDesc", "'uncertain'", "lit", None, "en"),
    (_S, _OTHER, f"{RDF}type", f"'{T}Supplier'", "iri", None, None),
    (_S, _OTHER, f"{RDFS}label", "s_name", "lit", None, "de"),
    (_S, _OTHER, f"{T}inNation", _sql_node("nation", "n_name"), "iri", None, None),
]
_text = lambda x: "CAST(NULL AS VARCHAR)" if x is None else f"'{x}'"
TRIPLES = " UNION ".join(f"SELECT {s} AS s, '{p}' AS p, {o} AS o, '{k}' AS o_kind, {_text(dt)} AS o_dt, {_text(lang)} AS o_lang FROM {src}" for src, s, p, o, k, dt, lang in _FACTS)


@query(TRIPLES)
def build_triples(spark, sf_dir):
    return star_triples(spark, sf_dir)


@query(f"SELECT p, count(*) AS n FROM ({TRIPLES}) WHERE s IN (SELECT s FROM ({TRIPLES}) WHERE p = '{RDF}type' AND o = '{T}Site') GROUP BY p")
def predicate_counts(spark, sf_dir):
    return triples.predicate_counts(star_triples(spark, sf_dir), [f"{T}Site"])


_SCHEMA = [(f"{T}{c}", f"{RDFS}subClassOf", f"{T}{p}", "iri", None, None) for c, p in (("Site", "Place"), ("Nation", "Place"), ("Region", "Place"), ("Place", "Thing"), ("Supplier", "Agent"), ("Kind", "Concept"))]


@query(f"SELECT * FROM ({TRIPLES}) UNION SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(_text, r)) + ')' for r in _SCHEMA)}) UNION SELECT * FROM ({TRIPLES}) WHERE o_kind = 'lit'")
def graph_union(spark, sf_dir):
    t = star_triples(spark, sf_dir)
    return triples.union(t, spark.createDataFrame(_SCHEMA, triples.SCHEMA), t.where("o_kind = 'lit'"))


@query(f"SELECT DISTINCT w AS label, {_sql_node('part', 'w')} AS node FROM (SELECT unnest(string_split(replace(p_name, ' ', '|'), '|')) AS w FROM part) WHERE trim(w) <> ''")
def compound_split(spark, sf_dir):
    parts = read(spark, sf_dir, "part").select(F.explode(X.split_list(F.replace("p_name", F.lit(" "), F.lit("|")))).alias("label")).distinct()
    return parts.select("label", _node("part", "label").alias("node"))


@query(f"SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN {_sql_node('part', chr(39).join(['s_name || ', '?_uncertain_', ' || s_suppkey']))} ELSE {_sql_node('part', 's_name')} END AS node FROM supplier")
def uncertain_salt(spark, sf_dir):
    label = F.when(F.col("s_acctbal") < 0, F.concat("s_name", F.lit("?"))).otherwise(F.col("s_name"))
    salted = F.when(X.uncertain(label), F.concat(label, F.lit("_uncertain_"), F.col("s_suppkey").cast("string"))).otherwise(label)
    return read(spark, sf_dir, "supplier").select("s_suppkey", _node("part", salted).alias("node"))


@query(f"SELECT s_suppkey, '{AUTHORITY}' || s_nationkey AS ext, 'geonames' AS kind FROM supplier UNION ALL SELECT s_suppkey, 'http://vocab.getty.edu/tgn/' || s_suppkey, 'tgn' FROM supplier WHERE s_suppkey % 2 = 0")
def ext_id_unpivot(spark, sf_dir):
    s = read(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit(AUTHORITY), F.col("s_nationkey").cast("string")).alias("geonames"), F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.lit("http://vocab.getty.edu/tgn/"), F.col("s_suppkey").cast("string"))).alias("tgn"))
    return s.unpivot("s_suppkey", ["geonames", "tgn"], "kind", "ext").where("ext is not null")


# -- graph patterns -----------------------------------------------------------------------------------------------


def _p(name: str, ns: str = T) -> str:
    return f"{ns}{name}"


@query(f"SELECT {_SITE} AS site, CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer")
def q_sites(spark, sf_dir):
    t = star_graph(spark, sf_dir)
    return patterns.property_table(t, f"{T}Site", {"id": _p("hasId"), "name": f"{RDFS}label"}).withColumnRenamed("s", "site").orderBy(F.col("id").cast("bigint"))


@query(f"SELECT {_SITE} AS site, c_name AS name FROM customer WHERE c_mktsegment = 'BUILDING'")
def q_kind_exact(spark, sf_dir):
    t = star_graph(spark, sf_dir)
    kind = patterns.match(t, f"{RDFS}label", "kind", None, (F.col("o") == "BUILDING") & (F.col("o_lang") == "de"))
    return patterns.joined(patterns.match(t, _p("hasKind"), "site", "kind"), kind, patterns.match(t, f"{RDFS}label", "site", "name")).select("site", "name")


@query(f"SELECT {_SITE} AS site, c_name AS name, CASE WHEN c_acctbal < 0 THEN 'uncertain' END AS certainty FROM customer WHERE starts_with(c_mktsegment, 'BUILD')")
def q_optional(spark, sf_dir):
    t = star_graph(spark, sf_dir)
    kind = patterns.match(t, f"{RDFS}label", "kind", None, F.col("o").startswith("BUILD"))
    found = patterns.joined(patterns.match(t, _p("hasKind"), "site", "kind"), kind, patterns.match(t, f"{RDFS}label", "site", "name"))
    return patterns.optional(found, patterns.match(t, _p("certaintyDesc"), "site", "certainty")).select("site", "name", "certainty")


@query(f"SELECT {_SITE} AS site, c_name AS name, n_name AS nation FROM {_C} JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'EUROPE'")
def q_chain(spark, sf_dir):
    t = star_graph(spark, sf_dir)
    region = patterns.match(t, f"{RDFS}label", "region", None, F.col("o") == "EUROPE")
    places = patterns.joined(patterns.match(t, _p("inRegion"), "n", "region"), region, patterns.match(t, f"{RDFS}label", "n", "nation"))
    return patterns.joined(patterns.match(t, _p("inNation"), "site", "n"), places, patterns.of_class(t, f"{T}Site", "site"), patterns.match(t, f"{RDFS}label", "site", "name")).select("site", "name", "nation").orderBy("nation", "name")


@query(f"SELECT {_SITE} AS site, n_name AS nation, '{AUTHORITY}' || n_nationkey AS id FROM {_C}")
def q_ext_prefix(spark, sf_dir):
    t = star_graph(spark, sf_dir)
    ids = patterns.match(t, _p("hasExternalIdentifier"), "n", "id", F.col("o").startswith(AUTHORITY))
    return patterns.joined(patterns.match(t, _p("inNation"), "site", "n"), patterns.of_class(t, f"{T}Site", "site"), ids, patterns.match(t, f"{RDFS}label", "n", "nation")).select("site", "nation", "id")


@query(f"SELECT {_SITE} AS site, c_custkey AS id FROM customer WHERE c_custkey > 100")
def q_range(spark, sf_dir):
    number = F.col("o").try_cast("bigint")
    found = patterns.match(star_graph(spark, sf_dir), _p("hasId"), "site", "o", (F.col("o_dt") == f"{XSD}integer") & (number > 100))
    return found.select("site", F.col("o").cast("bigint").alias("id")).orderBy("id")


@query(f"SELECT {_SITE} AS site FROM {_C} WHERE n_nationkey = 3")
def q_by_identifier(spark, sf_dir):
    t = star_graph(spark, sf_dir)
    place = patterns.match(t, _p("hasExternalIdentifier"), "n", None, F.col("o") == f"{AUTHORITY}3")
    return patterns.joined(patterns.match(t, _p("inNation"), "site", "n"), place, patterns.of_class(t, f"{T}Site", "site")).select("site")


@query(f"SELECT s, o, 'inNation' AS tag FROM ({TRIPLES}) WHERE p = '{T}inNation' UNION ALL SELECT s, o, 'inRegion' FROM ({TRIPLES}) WHERE p = '{T}inRegion' UNION ALL SELECT s, o, 'hasKind' FROM ({TRIPLES}) WHERE p = '{T}hasKind'")
def q_union_tag(spark, sf_dir):
    t = star_graph(spark, sf_dir)
    return t.of(*(_p(x) for x in ("inNation", "inRegion", "hasKind"))).select("s", "o", F.substring_index("p", "#", -1).alias("tag"))


@query(f"SELECT n_name AS nation, c_mktsegment AS kind, count(*) AS n FROM {_C} GROUP BY 1, 2")
def q_crosstab(spark, sf_dir):
    t = star_graph(spark, sf_dir)
    found = patterns.joined(patterns.match(t, _p("inNation"), "site", "a"), patterns.match(t, _p("hasKind"), "site", "b"), patterns.match(t, f"{RDFS}label", "a", "nation"), patterns.match(t, f"{RDFS}label", "b", "kind"))
    return found.groupBy("nation", "kind").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "nation", "kind")


@query(f"SELECT s, p AS property, o AS value FROM ({TRIPLES}) WHERE contains(lower(o), '_1') AND s IN (SELECT s FROM ({TRIPLES}) WHERE p = '{RDF}type' AND o = '{T}Nation')")
def q_contains(spark, sf_dir):
    return patterns.Cookbook(star_triples(spark, sf_dir)).mentions("_1", f"{T}Nation").select("s", "property", "value")


@query(f"SELECT {_SITE} AS site FROM customer WHERE c_acctbal >= 0")
def q_minus(spark, sf_dir):
    t = star_graph(spark, sf_dir)
    return patterns.minus(patterns.of_class(t, f"{T}Site", "site"), patterns.match(t, _p("certaintyDesc"), "site", None))


# -- closures and roots -------------------------------------------------------------------------------------------

_EDGES = "(SELECT 'c' || c_custkey AS child, 'n' || c_nationkey AS parent FROM customer UNION SELECT 'n' || n_nationkey, 'r' || n_regionkey FROM nation UNION SELECT 'r' || r_regionkey, 'world' FROM region)"


def _edges(spark, sf_dir) -> DataFrame:
    of = lambda t, a, x, b, y: read(spark, sf_dir, t).select(F.concat(F.lit(a), F.col(x).cast("string")).alias("child"), (F.concat(F.lit(b), F.col(y).cast("string")) if y else F.lit(b)).alias("parent"))
    return of("customer", "c", "c_custkey", "n", "c_nationkey").unionByName(of("nation", "n", "n_nationkey", "r", "n_regionkey")).unionByName(of("region", "r", "r_regionkey", "world", None))


@query(f"WITH RECURSIVE e AS (SELECT * FROM {_EDGES}), up AS (SELECT child AS node, parent AS ancestor, 1 AS depth FROM e UNION SELECT node, parent, depth + 1 FROM up JOIN e ON ancestor = child) SELECT * FROM up")
def closure_ancestors(spark, sf_dir):
    return graph.closure(_edges(spark, sf_dir))


@query(f"WITH RECURSIVE e AS (SELECT * FROM {_EDGES}), up AS (SELECT child AS node, parent AS ancestor, 1 AS depth FROM e UNION SELECT node, parent, depth + 1 FROM up JOIN e ON ancestor = child) SELECT node, arg_min(ancestor, depth) AS ancestor, min(depth) AS depth FROM up WHERE starts_with(ancestor, 'r') GROUP BY node")
def nearest_anchor(spark, sf_dir):
    return graph.nearest(_edges(spark, sf_dir), ["r"])


@query(f"SELECT e1.child AS node, e1.child || '>' || e1.parent || coalesce('>' || e2.parent, '') || coalesce('>' || e3.parent, '') AS path FROM {_EDGES} e1 LEFT JOIN {_EDGES} e2 ON e1.parent = e2.child LEFT JOIN {_EDGES} e3 ON e2.parent = e3.child")
def anchor_chain(spark, sf_dir):
    return graph.chain(_edges(spark, sf_dir), ["r"]).select("node", F.array_join("path", ">").alias("path"))


_ACTS = "(SELECT conv_id || '/' || turn AS activity, lpad(CAST(conv_id AS VARCHAR), 9, '0') AS started, turn FROM conversations)"


@query(f"SELECT activity, started FROM {_ACTS} WHERE turn = (SELECT min(turn) FROM conversations) OR FALSE ORDER BY started, activity LIMIT 1")
def root_activity(spark, sf_dir):
    c = read(spark, sf_dir, "conversations")
    name = lambda t: F.concat(F.col("conv_id").cast("string"), F.lit("/"), t.cast("string"))
    acts = c.select(name(F.col("turn")).alias("activity"), F.lpad(F.col("conv_id").cast("string"), 9, "0").alias("started"))
    first = c.agg(F.min("turn").alias("first")).first()["first"]
    informed = c.where(F.col("turn") > F.lit(first)).select(name(F.col("turn")).alias("s"))
    return graph.root(acts, informed)


# -- constraints and reconciliation -------------------------------------------------------------------------------


@query("SELECT l_orderkey, count(*) AS n FROM lineitem WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND o_orderstatus = 'F') GROUP BY l_orderkey")
def shape_class(spark, sf_dir):
    """Line items whose order is not of the class of finished ones."""
    li = read(spark, sf_dir, "lineitem").select("l_orderkey")
    finished = read(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("l_orderkey"))
    return li.groupBy("l_orderkey").agg(F.count("*").alias("n")).join(finished, "l_orderkey", "left_anti")


_CONSTRAINTS = [(f"{T}Site", _p("inNation"), "class", f"{T}Nation", "Warning"), (f"{T}Site", _p("hasId"), "datatype", f"{XSD}string", "Warning"), (f"{T}Site", _p("certaintyDesc"), "minCount", "1", "Violation"), (f"{T}Supplier", _p("inNation"), "class", f"{T}Region", "Warning"), (f"{T}Nation", f"{RDFS}label", "maxCount", "0", "Violation")]


def _violations(spark, sf_dir) -> DataFrame:
    return shapes.validate("data", graph.stored(star_triples(spark, sf_dir)), spark.createDataFrame(_CONSTRAINTS, shapes.CONSTRAINTS), spark.createDataFrame(_SCHEMA, triples.SCHEMA), "subclass")


_VIOLATIONS = f"""(
    SELECT {_SITE} AS focus, '{T}hasId' AS path, 'datatype' AS kind, 'Warning' AS severity FROM customer
    UNION ALL SELECT {_SITE}, '{T}certaintyDesc', 'minCount', 'Violation' FROM customer WHERE c_acctbal >= 0
    UNION ALL SELECT {_OTHER}, '{T}inNation', 'class', 'Warning' FROM supplier
    UNION ALL SELECT {_sql_node('nation', 'n_name')}, '{RDFS}label', 'maxCount', 'Violation' FROM nation)"""


@query(f"SELECT * FROM {_VIOLATIONS}")
def shape_violations(spark, sf_dir):
    return _violations(spark, sf_dir).select("focus", "path", "kind", "severity")


@query("SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey HAVING count(*) > 6 OR count(*) < 2")
def shape_cardinality(spark, sf_dir):
    return read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n")).where("n > 6 or n < 2")


@query("SELECT event_id, props FROM events WHERE TRY_CAST(regexp_extract(props, '-?[0-9]+', 0) AS INTEGER) IS NULL OR CAST(regexp_extract(props, '-?[0-9]+', 0) AS INTEGER) > 90")
def shape_datatype(spark, sf_dir):
    n = F.regexp_extract("props", "-?[0-9]+", 0).try_cast("int")
    return read(spark, sf_dir, "events").where(n.isNull() | (n > 90)).select("event_id", "props")


@query(f"SELECT 'data' AS graph, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict, count(*) AS n FROM {_VIOLATIONS}")
def validation_summary(spark, sf_dir):
    c = shapes.conforms(_violations(spark, sf_dir))
    return c.select(F.lit("data").alias("graph"), shapes.verdict(F.lit(True), F.col("conforms"), F.col("n")).alias("verdict"), "n")


@query(f"SELECT * FROM {_VIOLATIONS} ORDER BY focus, path, kind LIMIT 10")
def top_results(spark, sf_dir):
    return shapes.top_results(_violations(spark, sf_dir)).select("focus", "path", "kind", "severity")


@query("""
    SELECT 'c_name' AS "column", 'literal_on_site' AS kind, count(*) AS expected, count(*) AS found, 'PASS' AS status FROM customer
    UNION ALL SELECT 'c_custkey', 'literal_on_site', count(*), 0, CASE WHEN count(*) = 0 THEN 'PASS' ELSE 'FAIL' END FROM customer
    UNION ALL SELECT 'c_mktsegment', 'skip', count(*), NULL, 'PASS' FROM customer
    UNION ALL SELECT 'c_acctbal', NULL, count(*), NULL, 'WARN' FROM customer
    UNION ALL SELECT 'c_nationkey', 'ext_id_on_admin', (SELECT count(DISTINCT n_name) FROM customer JOIN nation ON c_nationkey = n_nationkey), (SELECT count(*) FROM nation), CASE WHEN (SELECT count(DISTINCT n_name) FROM customer JOIN nation ON c_nationkey = n_nationkey) = (SELECT count(*) FROM nation) THEN 'PASS' ELSE 'FAIL' END
    UNION ALL SELECT 'nation', 'node_link_per_site', count(*), count(*), 'PASS' FROM customer""")
def completeness(spark, sf_dir):
    n = read(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("nation"))
    c = read(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey")).drop("n_nationkey")
    c = c.select(*(F.col(x).cast("string").alias(x) for x in c.columns))
    e = [("c_name", "literal_on_site", f"{RDFS}label"), ("c_custkey", "literal_on_site", _p("nowhere")), ("c_mktsegment", "skip", ""), ("c_nationkey", "ext_id_on_admin", f"nation|{AUTHORITY}"), ("nation", "node_link_per_site", _p("inNation"))]
    expected = spark.createDataFrame(e, reconcile.EXPECTATIONS)
    return reconcile.completeness(c, star_triples(spark, sf_dir), expected, {"literal_on_site": [f"{T}Site"], "node_link_per_site": [f"{T}Site"]})


@query(f"""
    WITH u AS (SELECT DISTINCT o AS name FROM ({TRIPLES}) WHERE p = '{RDF}type'), d AS (SELECT unnest(['{T}Site', '{T}Nation', '{T}Place']) AS name)
    SELECT name, CASE WHEN name IN (SELECT name FROM d) THEN 'both' ELSE 'undeclared' END AS status FROM u UNION ALL SELECT name, 'unused' FROM d WHERE name NOT IN (SELECT name FROM u)""")
def used_vs_declared(spark, sf_dir):
    used, _ = reconcile.vocabulary_use(star_triples(spark, sf_dir), T)
    return reconcile.used_and_declared(used, spark.createDataFrame([(f"{T}{x}",) for x in ("Site", "Nation", "Place")], "name string"))


@query(f"""
    WITH RECURSIVE e AS (SELECT DISTINCT child, parent FROM {_EDGES}), up AS (SELECT child AS "class", parent AS ancestor FROM e UNION SELECT "class", parent FROM up JOIN e ON ancestor = child),
    said AS (SELECT 'n' || n_nationkey AS "class", unnest(['r' || n_regionkey, CASE WHEN n_nationkey % 2 = 0 THEN 'world' ELSE 'elsewhere' END]) AS ancestor FROM nation)
    SELECT coalesce(s."class", u."class") AS "class", coalesce(s.ancestor, u.ancestor) AS ancestor, CASE WHEN s."class" IS NULL THEN 'computed' WHEN u."class" IS NULL THEN 'documented' ELSE 'both' END AS side,
        CASE WHEN s."class" IS NOT NULL AND u."class" IS NOT NULL THEN 'PASS' WHEN coalesce(s."class", u."class") SIMILAR TO '[rc].*' THEN 'FAIL' ELSE 'WARN' END AS status
    FROM said s FULL JOIN up u ON s."class" = u."class" AND s.ancestor = u.ancestor""")
def doc_drift(spark, sf_dir):
    n = read(spark, sf_dir, "nation")
    cell = F.concat(F.lit("**`r"), F.col("n_regionkey").cast("string"), F.lit("`** (+1) → "), F.when(F.col("n_nationkey") % 2 == 0, "world").otherwise("elsewhere"))
    said = reconcile.documented(n.select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("class"), cell.alias("cell")))
    computed = graph.closure(_edges(spark, sf_dir)).select(F.col("node").alias("class"), "ancestor")
    return reconcile.drift(said, computed)


@query("""
    SELECT 'nation' AS level, r_name, count(*) AS n, count(*) FILTER (WHERE c_acctbal >= 0) AS matched, count(*) FILTER (WHERE c_acctbal < 0) AS unmatched, count(*) FILTER (WHERE c_custkey % 2 = 0) AS geonames
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name)""")
def coverage_rollup(spark, sf_dir):
    n = read(spark, sf_dir, "nation").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", "r_name")
    c = read(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return tables.coverage(c, "nation", F.col("c_acctbal") >= 0, "r_name", {"geonames": F.col("c_custkey") % 2 == 0})


@query("SELECT 'SUPPLIER' AS level, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_acctbal END AS score, s_name AS value FROM supplier ORDER BY score NULLS FIRST, value LIMIT 20")
def report_sorted(spark, sf_dir):
    s = read(spark, sf_dir, "supplier").select(F.lit("SUPPLIER").alias("level"), F.when(F.col("s_suppkey") % 3 != 0, F.col("s_acctbal")).alias("score"), F.col("s_name").alias("value"))
    return tables.report_order(s).limit(20)


@query("SELECT o_custkey AS raw, o_orderkey AS first_order FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders) WHERE n = 1")
def first_per_value(spark, sf_dir):
    o = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("raw"), "o_orderkey", "o_orderdate")
    return matching.once(o, "raw", "o_orderdate", "o_orderkey").select("raw", F.col("o_orderkey").alias("first_order"))
