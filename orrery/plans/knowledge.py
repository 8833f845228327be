"""Queries of entailment, audits and searches over the star schema's graph, each with its DuckDB form."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from orrery.operators import audit, entailment, graph, matching, shapes, substring, triples
from orrery.operators.triples import RDF, RDFS
from orrery.plans.star import TRIPLES, T, _p, query, read, star_triples
from orrery.sources import remote
from orrery.sources.graphstore import GraphStore
from orrery.sources.write import shared

# -- entailment ---------------------------------------------------------------------------------------------------

#: Hierarchies of properties and classes with ends, as (subject, predicate, object).
_RULES = [
    ("inNation", entailment.SUB_PROPERTY, "inPlace"), ("inRegion", entailment.SUB_PROPERTY, "inPlace"), ("inPlace", entailment.SUB_PROPERTY, "located"),
    ("located", entailment.DOMAIN, "Located"), ("inPlace", entailment.RANGE, "Place"), ("hasId", entailment.SUB_PROPERTY, "identifier"), ("identifier", entailment.RANGE, "Identifier"),
    ("Nation", entailment.SUB_CLASS, "Area"), ("Area", entailment.SUB_CLASS, "Place"), ("Place", entailment.SUB_CLASS, "Thing"), ("Site", entailment.SUB_CLASS, "Located"),
]
_ONTOLOGY = [(f"{T}{s}", p, f"{T}{o}", "iri", None, None) for s, p, o in _RULES]
_KIND = {entailment.SUB_PROPERTY: "property", entailment.SUB_CLASS: "class", entailment.DOMAIN: "domain", entailment.RANGE: "range"}
_ENTAILED = f"""
    WITH RECURSIVE rules(rule, key, target) AS (VALUES {', '.join(f"('{_KIND[p]}', '{T}{s}', '{T}{o}')" for s, p, o in _RULES)}),
    said(s, p, o, o_kind, o_dt, o_lang) AS (SELECT s, p, o, o_kind, o_dt, o_lang FROM ({TRIPLES}) UNION ALL VALUES {', '.join(f"('{s}', '{p}', '{o}', 'iri', NULL, NULL)" for s, p, o, *_ in _ONTOLOGY)}),
    known AS (SELECT * FROM said UNION
        SELECT CASE rule WHEN 'range' THEN o ELSE s END, CASE WHEN rule IN ('domain', 'range') THEN '{RDF}type' WHEN p IN ('{entailment.SUB_CLASS}', '{entailment.SUB_PROPERTY}') OR rule = 'class' THEN p ELSE target END,
               CASE WHEN rule = 'property' AND p <> '{entailment.SUB_PROPERTY}' THEN o ELSE target END, CASE WHEN rule = 'property' AND p <> '{entailment.SUB_PROPERTY}' THEN o_kind ELSE 'iri' END,
               CASE WHEN rule = 'property' AND p <> '{entailment.SUB_PROPERTY}' THEN o_dt END, CASE WHEN rule = 'property' AND p <> '{entailment.SUB_PROPERTY}' THEN o_lang END
        FROM known JOIN rules ON (rule IN ('property', 'domain') AND p = key) OR (rule = 'range' AND p = key AND o_kind <> 'lit')
            OR (rule = 'class' AND p IN ('{RDF}type', '{entailment.SUB_CLASS}') AND o = key) OR (rule = 'property' AND p = '{entailment.SUB_PROPERTY}' AND o = key))"""


def _ontology(spark):
    return spark.createDataFrame(_ONTOLOGY, triples.SCHEMA)


@query(f"{_ENTAILED} SELECT * FROM known")
def rdfs_entailed(spark, sf_dir):
    return entailment.entailed(star_triples(spark, sf_dir), _ontology(spark))


@query(f"{_ENTAILED} SELECT DISTINCT s, o AS class FROM known WHERE p = '{RDF}type'")
def rdfs_types(spark, sf_dir):
    return shapes.inferred(star_triples(spark, sf_dir), _ontology(spark), "rdfs")


# a place of a place: every site is located once by its nation, every nation by its region; suppliers are not of class Located by statement
_RDFS_CONSTRAINTS = [
    (f"{T}Located", _p("located"), "maxCount", "0", "Violation"), (f"{T}Place", _p("identifier"), "minCount", "1", "Violation"),
    (f"{T}Located", _p("inPlace"), "class", f"{T}Region", "Warning"), (f"{T}Site", _p("identifier"), "datatype", "urn:none", "Warning"),
]


@query(f"""
    {_ENTAILED}, types AS (SELECT DISTINCT s, o AS class FROM known WHERE p = '{RDF}type')
    SELECT DISTINCT k.s AS focus, '{T}located' AS path, 'maxCount' AS kind FROM known k JOIN types t ON k.s = t.s AND t.class = '{T}Located' WHERE p = '{T}located'
    UNION ALL SELECT s, '{T}identifier', 'minCount' FROM types t WHERE class = '{T}Place' AND NOT EXISTS (SELECT 1 FROM known k WHERE k.s = t.s AND k.p = '{T}identifier')
    UNION ALL SELECT DISTINCT k.s, '{T}inPlace', 'class' FROM known k JOIN types t ON k.s = t.s AND t.class = '{T}Located' WHERE p = '{T}inPlace' AND k.o NOT IN (SELECT s FROM types WHERE class = '{T}Region')
    UNION ALL SELECT DISTINCT k.s, '{T}identifier', 'datatype' FROM known k JOIN types t ON k.s = t.s AND t.class = '{T}Site' WHERE p = '{T}identifier'""")
def shape_rdfs(spark, sf_dir):
    """Constraints that only hold or fail by what is entailed."""
    found = shapes.validate("data", star_triples(spark, sf_dir), spark.createDataFrame(_RDFS_CONSTRAINTS, shapes.CONSTRAINTS), _ontology(spark), "rdfs")
    return found.select("focus", "path", "kind").distinct()


# -- closures from wanted nodes -----------------------------------------------------------------------------------


@query("""
    WITH RECURSIVE e AS (SELECT DISTINCT conv_id || '/' || turn AS child, conv_id || '/' || (turn - 1) AS parent FROM conversations WHERE turn > 0),
    up AS (SELECT child AS node, parent AS ancestor, 1 AS depth FROM e WHERE child IN (SELECT conv_id || '/' || max(turn) FROM conversations GROUP BY conv_id) UNION SELECT node, parent, depth + 1 FROM up JOIN e ON ancestor = child)
    SELECT * FROM up""")
def thread_ancestors(spark, sf_dir):
    """All turns before the last one of each conversation, from those last turns only."""
    c = read(spark, sf_dir, "conversations").where("conv_id is not null and turn is not null")
    name = lambda turn: F.concat(F.col("conv_id").cast("string"), F.lit("/"), turn.cast("string"))
    edges = c.where("turn > 0").select(name(F.col("turn")).alias("child"), name(F.col("turn") - 1).alias("parent"))
    last = c.groupBy("conv_id").agg(F.max("turn").alias("turn")).select(name(F.col("turn")).alias("node"))
    return graph.closure(edges, last)


# -- audit --------------------------------------------------------------------------------------------------------

# what must not be told of customers: a phrase that is in no fact, names that are, and numbers that a published column holds too
_AUDITED = "SELECT c_custkey, 'balance ' || c_acctbal AS remark, CASE WHEN c_custkey % 10 = 0 THEN ' ' || c_name || ' ' WHEN c_custkey % 10 = 1 THEN 'nan' ELSE 'nobody ' || c_custkey END AS owner, CAST(c_nationkey AS VARCHAR) AS number, CAST(c_custkey AS VARCHAR) AS id, n_name AS nation FROM customer JOIN nation ON c_nationkey = n_nationkey"
_LITERALS = f"SELECT DISTINCT trim(o) AS o, count(*) AS n FROM ({TRIPLES}) WHERE o_kind = 'lit' GROUP BY 1"


def _audited(spark, sf_dir):
    n = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    c = read(spark, sf_dir, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    key = F.col("c_custkey").cast("string")
    owner = F.when(F.col("c_custkey") % 10 == 0, F.concat(F.lit(" "), "c_name", F.lit(" "))).when(F.col("c_custkey") % 10 == 1, "nan").otherwise(F.concat(F.lit("nobody "), key))
    return c.select("c_custkey", F.concat(F.lit("balance "), F.col("c_acctbal").cast("string")).alias("remark"), owner.alias("owner"), F.col("c_nationkey").cast("string").alias("number"), key.alias("id"), F.col("n_name").alias("nation"))


@query(f"""
    WITH a AS ({_AUDITED}), l AS ({_LITERALS}),
    c AS (SELECT 'owner' AS "column", trim(owner) AS value FROM a UNION ALL SELECT 'number', number FROM a UNION ALL SELECT 'nation', nation FROM a)
    SELECT "column", value, count(*) AS cells, any_value(n) AS triples FROM c JOIN l ON value = o WHERE value NOT IN ('', 'nan') AND value NOT IN (SELECT id FROM a) GROUP BY 1, 2""")
def audit_leaks(spark, sf_dir):
    """Cells of columns that must not reach the graph and are literals of it, but for what the published identifiers hold too."""
    return audit.leaks(_audited(spark, sf_dir), star_triples(spark, sf_dir), ["remark", "owner", "number", "nation"], ["id"])


@query(f"""
    WITH a AS ({_AUDITED}), l AS ({_LITERALS}),
    c AS (SELECT 'owner' AS "column", trim(owner) AS value FROM a UNION ALL SELECT 'number', number FROM a UNION ALL SELECT 'nation', nation FROM a UNION ALL SELECT 'remark', remark FROM a),
    f AS (SELECT "column", count(*) AS filled, count(*) FILTER (WHERE value IN (SELECT o FROM l) AND value NOT IN (SELECT id FROM a)) AS leaked FROM c WHERE value NOT IN ('', 'nan') GROUP BY 1)
    SELECT "column", filled, leaked, CASE WHEN leaked = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM f""")
def audit_status(spark, sf_dir):
    return audit.status(_audited(spark, sf_dir), star_triples(spark, sf_dir), ["remark", "owner", "number", "nation"], ["id"])


# -- stored graphs and indexes ------------------------------------------------------------------------------------


@query(f"SELECT a.s, a.o AS nation, b.o AS name FROM ({TRIPLES}) a JOIN ({TRIPLES}) b ON a.s = b.s WHERE a.p = '{T}inNation' AND b.p = '{RDFS}label'")
def stored_pattern(spark, sf_dir):
    """Two patterns of one subject over the graph as it is stored by predicate, after it was appended twice."""
    store = GraphStore(spark, f"graph_{uuid.uuid4().hex}", 8)
    made = star_triples(spark, sf_dir)
    store.append(made.where(F.col("p") != f"{RDFS}label"))
    store.append(made)
    return store.join_on_subject(f"{T}inNation", f"{RDFS}label").toDF("s", "nation", "name")


@query(f"SELECT s, p, o FROM ({TRIPLES}) WHERE o_kind = 'lit' AND contains(lower(o), 'r#00000001')")
def literal_search(spark, sf_dir):
    """Statements whose literal holds a text, found by trigrams."""
    made = graph.stored(star_triples(spark, sf_dir))
    return substring.SubstringIndex(made).statements(made, "R#00000001").select("s", "p", "o")


# -- a remote source ----------------------------------------------------------------------------------------------


@query("""
    SELECT lower(trim(c_name)) AS key, c_nationkey || '/' || c_mktsegment AS scope, 'Q' || min(c_custkey) AS qid, arg_min(c_name, c_custkey) AS label
    FROM customer WHERE c_nationkey IN (SELECT s_nationkey FROM supplier) GROUP BY 1, 2""")
def remote_index(spark, sf_dir):
    """The label index of the scopes that suppliers need, from a service that is asked a batch of scopes at a time; files stand for it."""
    schema = "item string, label string, label_type string, scope string, ord long"
    scope = F.concat(F.col("c_nationkey").cast("string"), F.lit("/"), "c_mktsegment")
    c = read(spark, sf_dir, "customer").withColumn("scope", scope)
    mirror = shared(spark, "mirror")
    c.select(F.concat(F.lit("Q"), F.col("c_custkey").cast("string")).alias("item"), F.col("c_name").alias("label"), F.lit("rdfs:label").alias("label_type"), "scope", F.col("c_custkey").cast("long").alias("ord")).write.parquet(mirror)
    nations = read(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("c_nationkey")).distinct()
    wanted = c.join(nations, "c_nationkey", "left_semi").select("scope").distinct()
    rows = remote.fetched(wanted, remote.file_transport(mirror, "scope", [x.split()[0] for x in schema.split(", ")]), schema, pause=0.0)
    return matching.label_index(rows, "scope").select("key", "scope", "qid", "label")
