"""Queries of the builders, constraints, indexes, sources and sinks: star tables in the columns of the site catalogue, each query with its DuckDB form."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.operators import matching, patterns, reconcile, shapes, tables, triples
from orrery.operators.triples import OWL, RDF, RDFS, SCHEMA, XSD, Names
from orrery.plans import runs, star
from orrery.plans.star import TRIPLES, query
from orrery.plans.star import read as table
from orrery.sources import read, write

NAMES = Names()
COMPOUNDS = {"Siedlung und Grab": [("Siedlung", "Q486972"), ("Grab", "Q173387")]}
LAND_BY_QID = {"Q0": "AFRICA"}

# -- builders -----------------------------------------------------------------------------------------------------

#: The catalogue's columns from customers, nations and regions; SQL that both engines read alike.
CELLS = {
    "FID": "CASE WHEN c_custkey % 50 = 49 THEN ' nan ' ELSE CAST(c_custkey AS STRING) END",
    "fst_id": "CAST(c_custkey % 10 AS STRING)",
    "katalognr": "CASE WHEN c_custkey % 4 = 0 THEN '' ELSE CAST(1000 + c_custkey AS STRING) END",
    "fst_name": "c_name",
    "gemeinde": "concat(c_mktsegment, ' ', CAST(c_nationkey AS STRING))",
    "kreis": "concat('Kreis ', CAST(c_nationkey AS STRING))",
    "bundesland": "n_name",
    "land": "CASE WHEN n_regionkey = 0 THEN '' ELSE r_name END",
    "LAND_QID": "concat('Q', CAST(n_regionkey AS STRING))",
    "BUNDESLAND_TGN": "CAST(7000 + n_nationkey AS STRING)",
    "KREIS_GeoNames": "CASE WHEN n_nationkey % 2 = 0 THEN CAST(n_nationkey AS STRING) END",
    "KREIS_matchReason": "CASE WHEN n_nationkey % 3 = 0 THEN 'Exact match' END",
    "GEMEINDE_OSM_Relation": "CAST(90 + n_nationkey AS STRING)",
    "GEMEINDE_IDAI": "CAST(60 + n_nationkey AS STRING)",
    "kultur": "CASE WHEN c_custkey % 6 = 0 THEN NULL WHEN c_custkey % 6 = 1 THEN concat(c_mktsegment, '?') ELSE c_mktsegment END",
    "perio.do": "CASE WHEN c_custkey % 6 = 2 THEN 'http://n2t.net/ark' END",
    "entdeckung": "CASE WHEN c_custkey % 3 = 0 THEN 'Ausgrabung' WHEN c_custkey % 3 = 1 THEN 'Fund' END",
    "QID_entdeckung": "CASE WHEN c_custkey % 3 = 0 THEN 'Q959782' END",
    "publikation_arch": "CASE WHEN c_custkey % 2 = 0 THEN concat('Band ', CAST(c_custkey % 8 AS STRING)) END",
    "QID_publikation": "CASE WHEN c_custkey % 4 = 0 THEN concat('Q9', CAST(c_custkey % 8 AS STRING)) END",
    "fundstellenart": "CASE c_custkey % 4 WHEN 0 THEN 'Siedlung und Grab' WHEN 1 THEN 'Grab?' WHEN 2 THEN 'Siedlung' ELSE ' ' END",
    "QID_fundstellenart": "CASE WHEN c_custkey % 4 < 3 THEN 'Q5' END",
    "genauigkeit_m": "CASE c_custkey % 5 WHEN 0 THEN '0' WHEN 1 THEN 'ca. 49,5 m' WHEN 2 THEN '500' WHEN 3 THEN '' ELSE 'x' END",
    "wgs84_x": "CASE WHEN c_custkey % 7 = 0 THEN '0,0' ELSE concat(CAST(c_custkey % 7 AS STRING), ',5') END",
    "wgs84_y": "CASE WHEN c_custkey % 7 = 0 THEN '0' ELSE CAST(c_nationkey AS STRING) END",
    "methode": "CASE WHEN c_custkey % 2 = 0 THEN 'Karte' ELSE 'Text' END",
    "quellen_typ": "CASE WHEN c_custkey % 3 = 0 THEN 'Druck' END",
    "methodenbeschr": "CASE WHEN c_custkey % 9 = 0 THEN 'nach Karte' END",
    "quelle_georef": "CASE WHEN c_custkey % 2 = 1 THEN 'Quelle' END",
    "QID_quelle_georef": "CASE WHEN c_custkey % 5 = 1 THEN 'Q77' END",
    "dating_start": "CASE WHEN c_custkey % 10 = 3 THEN 'x' ELSE concat('-', CAST(4000 + c_custkey % 100 AS STRING), ',7') END",
    "dating_end": "'-3900'",
    "dating_certainty_start": "CASE WHEN c_custkey % 2 = 0 THEN 'a' END",
    "dating_certainty_end": "'b'",
    "dating_certainty_range": "' '",
    "dating_method": "CASE WHEN c_custkey % 4 = 1 THEN 'Q173412' END",
    "dating_perio.do": "CASE WHEN c_custkey % 3 = 1 THEN 'http://p' END",
    "dating_perio.do_match": "CASE WHEN c_custkey % 6 = 1 THEN 'closeMatch' WHEN c_custkey % 6 = 4 THEN 'odd' END",
    "sherd": "CASE WHEN c_custkey % 25 = 0 THEN concat('Q1', CAST(c_custkey % 3 AS STRING), '| Q2|') END",
}


def sites(spark, sf_dir) -> DataFrame:
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    customers = table(spark, sf_dir, "customer")
    c = triples.spread(customers, triples.SITE_FACTS, customers.count()).join(n, F.col("c_nationkey") == F.col("n_nationkey"))
    return c.select(*(F.expr(x).cast("string").alias(name) for name, x in CELLS.items()))


def _site_sql() -> str:
    """The facts of the catalogue, said in SQL: a row of (subject, predicate, object, kind, datatype, language) each; nulls are no facts."""
    t, pl, d, a = NAMES.term, NAMES.place, NAMES.data, NAMES.authorities
    cells = ", ".join(f'nullif(nullif(trim(CAST({x.replace("STRING", "VARCHAR")} AS VARCHAR)), \'\'), \'nan\') AS "{n}"' for n, x in CELLS.items())
    own = lambda suffix="": f"'{d}site_' || fid || '{suffix}'"
    node = lambda prefix, x: f"'{d}{prefix}_' || substr(md5({x}), 1, 8)"
    only = lambda x, when: f"CASE WHEN {when} THEN {x} END"
    text = lambda x: f"'{x}'"
    facts: list[tuple] = []

    def iri(s, p, o):
        facts.append((s, text(p) if "||" not in p else p, o, "iri", None, None))

    def lit(s, p, o, lang=None, dt=None):
        facts.append((s, text(p), o, "lit", dt, lang))

    def typed(s, kind, label, preferred=True):
        iri(s, f"{RDF}type", text(kind))
        lit(s, f"{RDFS}label", label, "de")
        if preferred:
            lit(s, f"{triples.SKOS}prefLabel", label, "de")

    def ext(s, authority, ident):
        o = f"'{a[authority]}' || {ident}"
        iri(only(s, f"{ident} IS NOT NULL"), f"{t}hasExternalIdentifier", o)
        iri(only(o, f"({s}) IS NOT NULL"), f"{t}hasExternalIdentifierType", text(NAMES.kind(authority)))

    land = """coalesce(land, CASE "LAND_QID" WHEN 'Q0' THEN 'AFRICA' END)"""
    levels = {"land": ("Land", land), "bundesland": ("Bundesland", "bundesland"), "kreis": ("Kreis", "kreis"), "gemeinde": ("Gemeinde", "gemeinde")}
    before = None
    for column, (kind, label) in levels.items():
        s = node(column, label)
        typed(s, f"{t}{kind}", label)
        if before:
            iri(s, f"{t}in{before[0]}", node(before[1], before[2]))
        before = kind, column, label
    for column, authority, ident in (("land", "wikidata", '"LAND_QID"'), ("bundesland", "tgn", '"BUNDESLAND_TGN"'), ("kreis", "geonames", '"KREIS_GeoNames"'), ("gemeinde", "osm", '"GEMEINDE_OSM_Relation"'), ("gemeinde", "idai", '"GEMEINDE_IDAI"')):
        ext(node(column, levels[column][1]), authority, ident)
    lit(node("kreis", "kreis"), f"{t}wikidataMatchDescription", '"KREIS_matchReason"')

    iri(own(), f"{RDF}type", text(f"{t}Fundstelle"))
    for p in (f"{t}hatFID", f"{triples.DCTERMS}identifier"):
        lit(own(), p, "fid", dt=f"{XSD}integer")
    for p, column, lang in ((f"{t}hatFundstellenID", "fst_id", None), (f"{t}hatKatalognummer", "katalognr", None), (f"{RDFS}label", "fst_name", "de"), (f"{triples.SKOS}prefLabel", "fst_name", "de")):
        lit(own(), p, column, lang)
    iri(own(), f"{t}inGemeinde", node("gemeinde", "gemeinde"))
    metres = "replace(nullif(regexp_extract(genauigkeit_m, '[-+]?[0-9]+([.,][0-9]+)?', 0), ''), ',', '.')"
    lit(own(), f"{t}hatGenauigkeit", metres, dt=f"{XSD}decimal")
    iri(own(), f"{pl}hasLocationType", text(f"{NAMES.item}{NAMES.location_type}"))
    high, medium, low, dubious = NAMES.certainty
    m = f"CAST({metres} AS DOUBLE)"
    iri(own(), f"{pl}certaintyLevel", f"'{NAMES.item}' || CASE WHEN CAST(fid AS BIGINT) % 7 = 0 THEN '{dubious}' WHEN {m} IS NULL THEN '{medium}' WHEN {m} = 0 THEN '{high}' WHEN {m} < 500 THEN '{medium}' ELSE '{low}' END")

    k = "CAST(fid AS BIGINT)"
    for label, qid, salt, when in (("'Siedlung'", "'Q486972'", "", f"{k} % 4 = 0"), ("'Grab'", "'Q173387'", "", f"{k} % 4 = 0"), ("'Grab?'", "'Q5'", " || '_uncertain_' || fid", f"{k} % 4 = 1"), ("'Siedlung'", "'Q5'", "", f"{k} % 4 = 2")):
        s = only(node("fundstellenart", label + salt), when)
        typed(s, f"{t}FundstellenartType", label)
        ext(s, "wikidata", qid)
        iri(own(), f"{t}hatFundstellenart", s)
        if salt:
            lit(s, f"{pl}certaintyDesc", text("uncertain"), "en")

    event, kind = only(own("_discovery"), "entdeckung IS NOT NULL"), only(node("entdeckungsart", "entdeckung"), '"QID_entdeckung" IS NOT NULL')
    typed(event, f"{t}Entdeckung", "entdeckung", False)
    iri(own(), f"{t}wurdeEntdecktDurch", event)
    typed(kind, f"{t}EntdeckungsartType", "entdeckung")
    ext(kind, "wikidata", '"QID_entdeckung"')
    iri(event, f"{t}hatEntdeckungsart", kind)

    pub = node("pub", "publikation_arch")
    typed(pub, f"{t}Publikation", "publikation_arch", False)
    ext(pub, "wikidata", '"QID_publikation"')
    iri(own(), f"{t}hatPublikation", pub)

    there = "kultur IS NOT NULL"
    culture, assigned, dating = node("kultur", "kultur"), only(own("_culture"), there), only(own("_dating"), there)
    typed(culture, f"{t}Kulturgruppe", "kultur", False)
    iri(culture, f"{t}hasExternalIdentifier", '"perio.do"')
    iri(only('"perio.do"', there), f"{t}hasExternalIdentifierType", text(NAMES.kind("periodo")))
    iri(assigned, f"{RDF}type", text(f"{t}KulturelleZuordnung"))
    iri(assigned, f"{t}hatKulturgruppe", culture)
    lit(only(assigned, "contains(kultur, '?')"), f"{pl}certaintyDesc", text("uncertain"), "en")
    iri(own(), f"{t}hatKulturelleZuordnung", assigned)
    iri(dating, f"{RDF}type", text(f"{t}Datierung"))
    iri(assigned, f"{t}hatDatierung", dating)
    lit(dating, f"{t}datierungStart", "CAST(CAST(trunc(TRY_CAST(replace(dating_start, ',', '.') AS DOUBLE)) AS BIGINT) AS VARCHAR)", dt=f"{XSD}integer")
    lit(dating, f"{t}datierungEnd", "dating_end", dt=f"{XSD}integer")
    lit(dating, f"{t}datierungSicherheitStart", "dating_certainty_start")
    lit(dating, f"{t}datierungSicherheitEnd", "dating_certainty_end")
    method = only(node("datmethode", "dating_method"), there)
    iri(method, f"{RDF}type", text(f"{t}DatierungsMethodeType"))
    ext(method, "wikidata", "dating_method")
    iri(dating, f"{t}datierungMethode", method)
    iri(dating, f"""'{triples.SKOS}' || CASE WHEN "dating_perio.do_match" = 'closeMatch' THEN 'closeMatch' ELSE 'relatedMatch' END""", '"dating_perio.do"')

    for q in ("""trim(split_part(sherd, '|', 1))""", """nullif(trim(split_part(sherd, '|', 2)), '')"""):
        s = node("sherd", q)
        iri(s, f"{RDF}type", text(f"{t}Scherbe"))
        ext(s, "wikidata", q)
        iri(own(), f"{t}hatScherbe", s)

    activity, geometry = own("_activity"), only(own("_geom"), f"{k} % 7 <> 0")
    iri(activity, f"{RDF}type", text(f"{t}GeoreferenzierungsAktivitaet"))
    lit(activity, f"{RDFS}label", "'Georeferenzierung von Fundstelle ' || fid", "de")
    lit(activity, f"{pl}hasReference", "quelle_georef")
    iri(activity, f"{pl}hasReference", f"""'{a["wikidata"]}' || "QID_quelle_georef\"""")
    typed(node("methode", "methode"), f"{pl}MethodType", "methode", False)
    iri(activity, f"{pl}methodUsed", node("methode", "methode"))
    typed(node("quellentyp", "quellen_typ"), f"{pl}SourceType", "quellen_typ", False)
    for p in ("hasSourceType", "hasSourceTypeDetail"):
        iri(activity, f"{pl}{p}", node("quellentyp", "quellen_typ"))
    lit(activity, f"{pl}activityDesc", "methodenbeschr")
    iri(activity, f"{pl}georeferencingBy", text(NAMES.agent))
    iri(activity, f"{triples.PROV}wasAssociatedWith", text(NAMES.agent))
    iri(own(), f"{t}wurdeGeoreferenziertDurch", activity)
    iri(geometry, f"{RDF}type", text(f"{triples.SF}Point"))
    lit(geometry, f"{triples.GEO}asWKT", "'POINT(' || replace(wgs84_x, ',', '.') || ' ' || wgs84_y || ')'", dt=f"{triples.GEO}wktLiteral")
    iri(geometry, f"{pl}hasPointType", text(f"{NAMES.item}{NAMES.point_type}"))
    iri(own(), f"{triples.GEO}hasGeometry", geometry)
    iri(own(), f"{pl}representativeGeometry", geometry)

    q = lambda x: "CAST(NULL AS VARCHAR)" if x is None else f"'{x}'"
    rows = " UNION ".join(f"SELECT {s} AS s, {p} AS p, {o} AS o, '{kind}' AS o_kind, {q(dt)} AS o_dt, {q(lang)} AS o_lang FROM r" for s, p, o, kind, dt, lang in facts)
    agent = " UNION ".join(f"SELECT '{NAMES.agent}', '{p}', '{o}', '{kind}', {q(None)}, {q(None)}" for p, o, kind in ((f"{RDF}type", f"{triples.FOAF}Person", "iri"), (f"{RDFS}label", NAMES.agent_name, "lit"), (f"{triples.SKOS}prefLabel", NAMES.agent_name, "lit")))
    return f"""WITH cells AS (SELECT {cells} FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
        r AS (SELECT *, "FID" AS fid FROM cells WHERE "FID" IS NOT NULL)
        SELECT * FROM ({rows}) WHERE s IS NOT NULL AND o IS NOT NULL UNION {agent}"""


def _site_statements(spark, sf_dir) -> DataFrame:
    return triples.together(triples.site_statements(sites(spark, sf_dir), NAMES, COMPOUNDS, LAND_BY_QID), triples.constant_triples(spark, NAMES))


@query(_site_sql())
def site_facts(spark, sf_dir):
    return _site_statements(spark, sf_dir).dropDuplicates()


@query("""
    SELECT fid, 'INFO' AS level, "column", message FROM (
        SELECT nullif(trim(CASE WHEN c_custkey % 50 = 49 THEN ' nan ' ELSE CAST(c_custkey AS VARCHAR) END), 'nan') AS fid, c_custkey AS k, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey) c,
    LATERAL (SELECT unnest([{'column': 'land', 'message': 'label from QID', 'ok': n_regionkey = 0}, {'column': 'fundstellenart', 'message': 'split into components', 'ok': k % 4 = 0}, {'column': 'fundstellenart', 'message': 'marked as uncertain', 'ok': k % 4 = 1}, {'column': 'dating_perio.do_match', 'message': 'relatedMatch by default', 'ok': FALSE}], recursive := true)) WHERE ok
    UNION ALL SELECT NULL, 'WARNING', 'FID', 'row without an FID skipped' FROM customer WHERE c_custkey % 50 = 49""")
def site_log(spark, sf_dir):
    return triples.row_log(sites(spark, sf_dir), COMPOUNDS)


@query(f"SELECT DISTINCT p FROM ({_site_sql()}) x WHERE starts_with(s, '{NAMES.data}site_')")
def site_predicates(spark, sf_dir):
    return _site_statements(spark, sf_dir).where(F.col("s").startswith(f"{NAMES.data}site_")).select("p").distinct()


_EXT = ("tgn", "idai")


@query(" UNION ".join(f"SELECT 'urn:s' || s_suppkey AS s, '{NAMES.term}hasExternalIdentifier' AS p, '{NAMES.authorities[a]}' || s_nationkey AS o FROM supplier UNION SELECT '{NAMES.authorities[a]}' || s_nationkey, '{NAMES.term}hasExternalIdentifierType', '{NAMES.kind(a)}' FROM supplier" for a in _EXT))
def external_ids(spark, sf_dir):
    s = table(spark, sf_dir, "supplier")
    node = F.concat(F.lit("urn:s"), F.col("s_suppkey").cast("string"))
    return triples.emitted(s, [x for a in _EXT for x in triples.external(NAMES, node, a, F.col("s_nationkey").cast("string"))]).select("s", "p", "o")


# -- runs ---------------------------------------------------------------------------------------------------------

_AT = datetime(2024, 3, 1, 10, 20, 30, tzinfo=timezone.utc)
_RUN = f"{NAMES.data}pipeline_run_2024-03-01T10-20-30Z"


def _run_sql() -> str:
    agent, upstream = f"{NAMES.data}build_py", "urn:made-before"
    val = lambda s, p, o, dt=None, lang=None: (s, p, o, "lit", dt and f"{XSD}{dt}", lang)
    ref = lambda s, p, o: (s, p, o, "iri", None, None)
    prov = triples.PROV
    facts = [
        ref(agent, f"{RDF}type", f"{prov}SoftwareAgent"), ref(agent, f"{RDF}type", f"{prov}Plan"), val(agent, f"{RDFS}label", "build.py"), ref(agent, f"{prov}atLocation", "file:///opt/a%20b/build.py"),
        ref(_RUN, f"{RDF}type", f"{prov}Activity"), val(_RUN, f"{RDFS}label", "Pipeline run 2024-03-01T10-20-30Z", lang="en"), val(_RUN, f"{prov}startedAtTime", "2024-03-01T10:20:30Z", "dateTime"), val(_RUN, f"{prov}endedAtTime", "2024-03-01T10:20:30Z", "dateTime"),
        ref(_RUN, f"{prov}wasAssociatedWith", "urn:person"), ref(_RUN, f"{prov}wasAssociatedWith", agent), ref(_RUN, f"{prov}used", "file:///opt/in.csv"), ref(_RUN, f"{prov}used", "file:///opt/o.ttl"), ref(_RUN, f"{prov}used", upstream), ref(_RUN, f"{prov}wasInformedBy", "urn:run-before"),
        *(x for n, label in (("data_ttl", "data"), ("bundle_ttl", "data and ontology")) for x in (ref(f"{NAMES.data}{n}", f"{RDF}type", f"{prov}Entity"), val(f"{NAMES.data}{n}", f"{RDFS}label", label, lang="en"), ref(f"{NAMES.data}{n}", f"{prov}atLocation", f"file:///opt/{n}"), ref(f"{NAMES.data}{n}", f"{prov}wasGeneratedBy", _RUN), ref(f"{NAMES.data}{n}", f"{prov}wasDerivedFrom", upstream))),
    ]
    q = lambda x: "NULL" if x is None else f"'{x}'"
    counted = f"SELECT '{_RUN}', '{NAMES.data}rowCount', CAST(count(*) AS VARCHAR), 'lit', '{XSD}integer', NULL FROM customer UNION ALL SELECT '{_RUN}', '{NAMES.data}dataTripleCount', CAST(count(*) AS VARCHAR), 'lit', '{XSD}integer', NULL FROM ({TRIPLES})"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(q, f)) + ')' for f in facts)}) AS t(s, p, o, o_kind, o_dt, o_lang) UNION ALL {counted}"


@query(_run_sql())
def run_provenance(spark, sf_dir):
    outputs = [runs.Output("data_ttl", "data", "/opt/data_ttl"), runs.Output("bundle_ttl", "data and ontology", "/opt/bundle_ttl")]
    return runs.provenance(spark, NAMES, _AT, _AT, "/opt/in.csv", outputs, table(spark, sf_dir, "customer").count(), star.star_triples(spark, sf_dir).count(), ("urn:run-before", "urn:made-before"), script="/opt/a b/build.py", ontology="/opt/o.ttl", persons=["urn:person"])


_STAGES = [runs.Stage("literature", print, ("/w/sites.csv",), ("/w/lit.csv",)), runs.Stage("geo", print, ("/w/ref.csv",), ("/w/mapped.csv",)), runs.Stage("merge", print, ("/w/lit.csv", "/w/mapped.csv"), ("/w/out.csv",))]
_RESULTS = {"literature": runs.Result("ok", 1.0), "geo": runs.Result("skipped", 0.0), "merge": runs.Result("ok", 2.0)}


_MANIFEST_CELL = "CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 = 1 THEN '  ' ELSE event_type END"


def _manifest_sql() -> str:
    d, prov, run = NAMES.data, triples.PROV, f"{NAMES.data}enrichment_run_2024-03-01T10-20-30Z"
    label = lambda s, x, lang=None: (s, f"{RDFS}label", x, "lit", None, lang)
    ref = lambda s, p, o: (s, p if "/" in p else f"{prov}{p}", o, "iri", None, None)
    kind = lambda s, *of: [ref(s, f"{RDF}type", f"{prov}{x}") for x in of]
    facts = [*kind(run, "Activity"), label(run, "Enrichment run 2024-03-01T10-20-30Z", "en"), ref(run, "used", f"{d}sites_csv"), ref(run, "used", f"{d}ref_csv")]
    facts += [(run, f"{prov}{p}", "2024-03-01T10:20:30Z", "lit", f"{XSD}dateTime", None) for p in ("startedAtTime", "endedAtTime")]
    for name, note, used in (("literature", "", ["sites"]), ("geo", " (skipped)", ["mapped"]), ("merge", "", ["lit", "mapped"])):
        node, agent = f"{run}_{name}", f"{d}{name}_py"
        facts += [*kind(node, "Activity"), label(node, f"Stage {name}{note}", "en"), ref(node, "wasInformedBy", run), ref(node, "wasAssociatedWith", agent), *(ref(node, "used", f"{d}{x}_csv") for x in used)]
        facts += [*kind(agent, "SoftwareAgent", "Plan"), label(agent, f"{name}.py"), ref(agent, "atLocation", f"file:///w/{name}.py")]
    for x in ("sites", "ref", "lit", "mapped", "out"):
        facts += [*kind(f"{d}{x}_csv", "Entity"), label(f"{d}{x}_csv", f"{x}.csv"), ref(f"{d}{x}_csv", "atLocation", f"file:///w/{x}.csv")]
    facts += [ref(f"{d}lit_csv", "wasGeneratedBy", f"{run}_literature"), ref(f"{d}lit_csv", "wasDerivedFrom", f"{d}sites_csv"), ref(f"{d}out_csv", "wasGeneratedBy", f"{run}_merge"), *(ref(f"{d}out_csv", "wasDerivedFrom", f"{d}{x}_csv") for x in ("lit", "mapped"))]
    q = lambda x: "NULL" if x is None else f"'{x}'"
    said = f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(q, f)) + ')' for f in facts)}) AS t(s, p, o, o_kind, o_dt, o_lang)"
    count = lambda file, name, what, source: f" UNION ALL SELECT '{d}{file}_csv', '{d}{name}', CAST({what} AS VARCHAR), 'lit', '{XSD}integer', NULL FROM {source}"
    filled = lambda c: f"count(*) FILTER (WHERE {c} IS NOT NULL AND trim({c}) <> '' AND lower(trim({c})) <> 'nan')"
    events = f"(SELECT event_type, {_MANIFEST_CELL} AS note FROM events)"
    for file, source, columns in (("sites", "customer", ["c_name", "c_mktsegment"]), ("out", events, ["event_type", "note"])):
        said += count(file, "rowCount", "count(*)", source) + "".join(count(file, f"filled_{c}", filled(c), source) for c in columns)
    return said


@query(_manifest_sql())
def run_manifest(spark, sf_dir):
    """A run whose first input holds the customers and whose output the events, with their rows and filled cells."""
    held = {"/w/sites.csv": table(spark, sf_dir, "customer").select("c_name", "c_mktsegment"), "/w/out.csv": table(spark, sf_dir, "events").select("event_type", F.expr(_MANIFEST_CELL).alias("note"))}
    return runs.manifest(spark, NAMES, _STAGES, _RESULTS, _AT, _AT, {s.name: f"/w/{s.name}.py" for s in _STAGES}, held)


# -- sources and sinks --------------------------------------------------------------------------------------------

_ODD = [("C:\\new", None), ('say "x"\\', "de"), ("a\tb\nc\r", None), ("\\u0041 ü", None)]


@query("SELECT CAST(c_custkey AS VARCHAR) AS id, 'a, \"' || c_name || '\"' AS name, CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 3 = 1 THEN 'NA' ELSE c_mktsegment END AS segment FROM customer")
def csv_round_trip(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    segment = F.when(F.col("c_custkey") % 3 == 1, "NA").when(F.col("c_custkey") % 3 == 2, F.col("c_mktsegment"))
    path = write.shared(spark, "csv")
    write.csv(c.select(F.col("c_custkey").alias("id"), F.concat(F.lit('a, "'), "c_name", F.lit('"')).alias("name"), segment.alias("segment")), path)
    return read.csv(spark, path, na=False, required=("id", "name"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS id, nullif(CASE WHEN c_custkey % 3 = 0 THEN '' WHEN c_custkey % 3 = 1 THEN 'NA' ELSE c_mktsegment END, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE 'NA' END) AS segment FROM customer")
def csv_missing_cells(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    path = write.shared(spark, "csv")
    write.csv(c.select(F.col("c_custkey").alias("id"), F.when(F.col("c_custkey") % 3 == 1, "NA").when(F.col("c_custkey") % 3 == 2, F.col("c_mktsegment")).alias("segment")), path)
    return read.csv(spark, path)


_sql_text = lambda x: "NULL" if x is None else "'" + x.replace("\t", "' || chr(9) || '").replace("\n", "' || chr(10) || '").replace("\r", "' || chr(13) || '") + "'"
_ODD_SQL = ", ".join(f"('urn:odd', 'urn:p', {_sql_text(x)}, 'lit', NULL, {_sql_text(lang)})" for x, lang in _ODD)


def _odd(spark) -> DataFrame:
    return spark.createDataFrame([("urn:odd", "urn:p", x, "lit", None, lang) for x, lang in _ODD], SCHEMA)


@query(f"SELECT * FROM ({TRIPLES}) UNION ALL SELECT * FROM (VALUES {_ODD_SQL}) AS v(s, p, o, o_kind, o_dt, o_lang)")
def ntriples_round_trip(spark, sf_dir):
    path = write.shared(spark, "nt")
    write.ntriples(star.star_triples(spark, sf_dir).unionByName(_odd(spark)), path)
    return read.ntriples(spark, path)


@query(f"SELECT * FROM ({TRIPLES}) UNION ALL SELECT * FROM (VALUES {_ODD_SQL}) AS v(s, p, o, o_kind, o_dt, o_lang)")
def turtle_round_trip(spark, sf_dir):
    path = write.shared(spark, "ttl")
    write.turtle(star.star_triples(spark, sf_dir).unionByName(_odd(spark)), path)
    return read.turtle(spark, path)


_PREFIXES = {"d": star.D, "t": star.T, "rdf": RDF, "rdfs": RDFS, "xsd": XSD}


@query(f"SELECT * FROM ({TRIPLES}) UNION ALL SELECT * FROM (VALUES {_ODD_SQL}) AS v(s, p, o, o_kind, o_dt, o_lang)")
def turtle_prefixed(spark, sf_dir):
    """Written in parts with prefixes, read again by statements."""
    path = write.shared(spark, "ttl")
    write.turtle(star.star_triples(spark, sf_dir).unionByName(_odd(spark)), path, _PREFIXES)
    return read.turtle(spark, path)


# -- constraints and indexes --------------------------------------------------------------------------------------

_NS = "urn:o#"
_PROPERTIES = f"(SELECT '{_NS}p' || n_nationkey AS path, n_nationkey % 2 = 0 AS is_object, CASE WHEN n_nationkey % 7 <> 0 THEN '{_NS}C' || n_regionkey END AS domain, CASE WHEN n_nationkey % 2 = 0 THEN '{_NS}C' || ((n_regionkey + 1) % 5) ELSE '{XSD}integer' END AS rng FROM nation)"


def _ontology(spark, sf_dir) -> DataFrame:
    own = lambda c: F.concat(F.lit(_NS), c)
    name = lambda prefix, c: own(F.concat(F.lit(prefix), c.cast("string")))
    k, r = F.col("n_nationkey"), F.col("n_regionkey")
    p, even = name("p", k), k % 2 == 0
    kinds = triples.emitted(table(spark, sf_dir, "region"), [triples.iri(name("C", F.col("r_regionkey")), f"{RDF}type", f"{OWL}Class")])
    facts = [triples.iri(p, f"{RDF}type", F.when(even, f"{OWL}ObjectProperty").otherwise(f"{OWL}DatatypeProperty")), triples.iri(F.when(k % 7 != 0, p), f"{RDFS}domain", name("C", r)), triples.iri(p, f"{RDFS}range", F.when(even, name("C", (r + 1) % 5)).otherwise(f"{XSD}integer"))]
    return triples.union(kinds, triples.emitted(table(spark, sf_dir, "nation"), facts))


@query(f"""
    SELECT '{_NS}C' || r_regionkey AS shape, NULL AS path, 'targetClass' AS kind, '{_NS}C' || r_regionkey AS value, 'Info' AS severity FROM region
    UNION ALL SELECT domain, path, CASE WHEN is_object THEN 'class' ELSE 'datatype' END, rng, 'Warning' FROM {_PROPERTIES} WHERE domain IS NOT NULL
    UNION ALL SELECT '{_NS}C0', '{_NS}id', kind, value, 'Violation' FROM (VALUES ('minCount', '1'), ('maxCount', '1'), ('datatype', '{XSD}integer')) AS v(kind, value)""")
def shapes_generated(spark, sf_dir):
    return shapes.generated(_ontology(spark, sf_dir), _NS, [(f"{_NS}C0", f"{_NS}id", f"{XSD}integer")])


@query("""
    SELECT 'c' || c_custkey AS "class", 1 AS anchors, 'PASS' AS status FROM customer UNION ALL SELECT 'n' || n_nationkey, 1, 'PASS' FROM nation UNION ALL SELECT 'r' || r_regionkey, 0, 'FAIL' FROM region""")
def anchored(spark, sf_dir):
    edges = star._edges(spark, sf_dir)
    return reconcile.anchored(edges.select(F.col("child").alias("class")).distinct(), edges, "r")


def _classed(spark, sf_dir) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return star._labels(spark, sf_dir).join(p.select(F.concat(F.lit("Q"), F.col("p_partkey").cast("string")).alias("item"), F.col("p_type").alias("class"), F.when(F.col("p_size") % 3 == 0, "pl").otherwise("de").alias("lang"), (F.col("p_retailprice") > 1000).alias("ended")), "item")


@query("SELECT DISTINCT 'Q' || p_partkey AS item, p_name AS label, CASE WHEN p_partkey % 3 = 0 THEN 'rdfs:label' ELSE 'skos:altLabel' END AS label_type, CASE WHEN p_size % 2 = 0 THEN CAST(p_size AS VARCHAR) ELSE '' END AS geonames FROM part WHERE p_type IN ('SMALL', 'ECONOMY') AND p_size % 3 <> 0")
def level_index(spark, sf_dir):
    return patterns.level_index(_classed(spark, sf_dir), ["SMALL", "ECONOMY"], ["de"])


@query("SELECT 'Q' || p_partkey AS item, p_name AS label FROM part WHERE NOT p_retailprice > 1000 AND length(p_name) > CASE WHEN p_partkey % 3 = 0 THEN 8 ELSE 9 END AND p_type = 'SMALL'")
def index_candidates(spark, sf_dir):
    return matching.candidates(_classed(spark, sf_dir), ["de", "pl"], {"rdfs:label": 8, "skos:altLabel": 9}, ["SMALL"]).select("item", "label")


@query("""
    WITH known AS (SELECT DISTINCT c_nationkey || '/' || c_mktsegment AS k FROM customer WHERE c_mktsegment <> 'BUILDING' OR c_nationkey % 3 = 0),
    v AS (SELECT s_name AS raw, s_nationkey || '/' || CASE WHEN s_suppkey % 2 = 0 THEN 'BUILDING' ELSE 'MACHINERY' END AS narrow, r_name AS wider FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
    SELECT raw, CASE WHEN narrow IN (SELECT k FROM known) THEN narrow ELSE wider END AS scope FROM v""")
def widened(spark, sf_dir):
    """Suppliers of a nation and kind, searched for in the region where no customer of the index has both."""
    n = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    key = lambda nation, kind: F.concat(F.col(nation).cast("string"), F.lit("/"), kind)
    kind = F.when(F.col("s_suppkey") % 2 == 0, "BUILDING").otherwise("MACHINERY")
    values = table(spark, sf_dir, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_name").alias("raw"), key("s_nationkey", kind).alias("scope"), F.col("r_name").alias("wider"))
    index = table(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING' or c_nationkey % 3 = 0").select(key("c_nationkey", F.col("c_mktsegment")).alias("scope"))
    return matching.widened(values, index, "scope", "wider").select("raw", "scope")


@query("SELECT * FROM orders ORDER BY o_custkey, o_orderkey LIMIT 10")
def first_rows(spark, sf_dir):
    return tables.first_rows(table(spark, sf_dir, "orders"), ["o_custkey", "o_orderkey"], 10)
