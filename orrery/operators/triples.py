"""Rows to triples: declarative facts, one projection and one explode a table, deduplicated once.

A triple is (s, p, o, o_kind, o_dt, o_lang); `o` is the lexical form and all six columns are its identity.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.functions.text import band, hash8, lex_decimal, lex_integer, match_predicate, maybe, minted, norm, split_list, uncertain, wkt_point

SCHEMA = "s string, p string, o string, o_kind string, o_dt string, o_lang string"
COLUMNS = ("s", "p", "o", "o_kind", "o_dt", "o_lang")

# Public namespaces.
RDF = "http://www.w3.org/1999/02/22-rdf-syntax-ns#"
RDFS = "http://www.w3.org/2000/01/rdf-schema#"
SKOS = "http://www.w3.org/2004/02/skos/core#"
DCTERMS = "http://purl.org/dc/terms/"
XSD = "http://www.w3.org/2001/XMLSchema#"
PROV = "http://www.w3.org/ns/prov#"
GEO = "http://www.opengis.net/ont/geosparql#"
SF = "http://www.opengis.net/ont/sf#"
OWL = "http://www.w3.org/2002/07/owl#"
SH = "http://www.w3.org/ns/shacl#"
FOAF = "http://xmlns.com/foaf/0.1/"


@dataclass(frozen=True)
class Names:
    """The namespaces and fixed nodes of a deployment."""

    data: str = "https://example.org/data/"
    term: str = "https://example.org/term#"
    place: str = "https://example.org/place#"
    item: str = "https://example.org/item/"
    agent: str = "https://example.org/agent"
    agent_name: str = "Agent"
    authorities: dict[str, str] = field(default_factory=lambda: {"tgn": "http://vocab.getty.edu/tgn/", "idai": "https://gazetteer.dainst.org/place/", "osm": "https://www.openstreetmap.org/relation/", "geonames": "https://sws.geonames.org/", "wikidata": "https://www.wikidata.org/entity/"})
    kinds: dict[str, str] = field(default_factory=lambda: {"tgn": "TGN", "idai": "iDAI", "osm": "OSM", "geonames": "GeoNames", "wikidata": "Wikidata", "periodo": "PerioDo"})
    # fixed values: items of the place vocabulary
    location_type: str = "Q80"
    point_type: str = "Q126"
    certainty: tuple[str, str, str, str] = ("Q23", "Q15", "Q24", "Q113")

    def kind(self, authority: str) -> str:
        return f"{self.term}ExternalIdentifier_{self.kinds[authority]}"


def iri(s: Column, p: Column | str, o: Column | str) -> Column:
    return _fact(s, p, o, "iri")


def lit(s: Column, p: Column | str, o: Column | str, lang: str | None = None, dt: str | None = None) -> Column:
    return _fact(s, p, o, "lit", dt, lang)


def _fact(s: Column, p: Column | str, o: Column | str, kind: str, dt: str | None = None, lang: str | None = None) -> Column:
    """A triple, null where its subject or object is: a condition is a null."""
    of = lambda c: F.lit(c) if isinstance(c, str) or c is None else c
    s, o = of(s), of(o)
    whole = F.struct(s.alias("s"), of(p).alias("p"), o.alias("o"), F.lit(kind).alias("o_kind"), F.lit(dt).cast("string").alias("o_dt"), F.lit(lang).cast("string").alias("o_lang"))
    return F.when(s.isNotNull() & o.isNotNull(), whole)


#: Facts that a task makes before they are combined.
FACTS = 500_000


def spread(df: DataFrame, facts: int, rows: int | None = None) -> DataFrame:
    """`df` over so many tasks that none makes many more than FACTS facts: files hold rows in a few large groups, and what a task combines is held in memory."""
    parts = -(-(df.count() if rows is None else rows) * facts // FACTS)
    return df.repartition(parts, *(F.col(f"`{c}`") for c in df.columns)) if parts > 1 else df


#: Rows that a task sorts, joins or combines at once.
HELD = 200_000


def tasks(rows: int) -> int:
    """How many tasks hold so many rows, HELD each."""
    return max(1, -(-rows // HELD))


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """`df`, of about `rows` rows, by its keys over so many tasks that none holds many more than HELD; as it is, if that is one task.

    Left alone, tasks join until each reads tens of megabytes; facts are alike, so these are packed many times over and unfold to gigabytes.
    """
    return df.repartition(tasks(rows), *keys) if tasks(rows) > 1 else df


def made(df: DataFrame, facts: list[Column], *arrays: Column) -> DataFrame:
    """All facts of all rows as they come; `arrays` are further columns of fact lists. One scan, one explode."""
    every = F.array_compact(F.array(*facts))
    for a in arrays:
        every = F.concat(every, F.coalesce(F.array_compact(a), F.array().cast(f"array<struct<{SCHEMA.replace(' string', ':string')}>>")))
    return df.select(F.inline(every)).toDF(*COLUMNS)


def emitted(df: DataFrame, facts: list[Column], *arrays: Column) -> DataFrame:
    """All facts of all rows, each once: one shuffle more."""
    return made(df, facts, *arrays).dropDuplicates()


def together(*graphs: DataFrame) -> DataFrame:
    out = graphs[0]
    for g in graphs[1:]:
        out = out.unionByName(g)
    return out


def union(*graphs: DataFrame) -> DataFrame:
    return together(*graphs).dropDuplicates()


class Graph:
    """Facts of tables that become triples only where they are asked for: a pattern with a predicate reads the tables that state it and nothing else."""

    def __init__(self, *parts: tuple[DataFrame, list[tuple[str, Column]]] | tuple[DataFrame, list[tuple[str, Column]], int]):
        self.parts = [(df, facts, *(rows or (0,))) for df, facts, *rows in parts]

    def of(self, *predicates: str) -> DataFrame:
        """The triples with one of the predicates, or all, by subject; a part may tell about how many rows it has."""
        found = [(df, [fact for p, fact in facts if not predicates or p in predicates], rows) for df, facts, rows in self.parts]
        n = sum(rows * len(facts) for _, facts, rows in found)
        return dealt(together(*(made(df, facts) for df, facts, _ in found if facts)), n, "s").dropDuplicates()


def typed(node: Column, kind: str, label: Column, preferred: bool = True, lang: str = "de") -> list[Column]:
    out = [iri(node, f"{RDF}type", kind), lit(F.when(node.isNotNull(), node), f"{RDFS}label", label, lang)]
    return out + [lit(node, f"{SKOS}prefLabel", label, lang)] if preferred else out


def external(names: Names, node: Column, authority: str, ident: Column) -> list[Column]:
    """The node's identifier in an authority and that identifier's kind."""
    return linked(names, node, authority, norm(ident))


def linked(names: Names, node: Column, authority: str, ident: Column) -> list[Column]:
    """`external` of a clean identifier."""
    ext = F.when(node.isNotNull(), F.concat(F.lit(names.authorities[authority]), ident))
    return [iri(node, f"{names.term}hasExternalIdentifier", ext), iri(ext, f"{names.term}hasExternalIdentifierType", names.kind(authority))]


LEVEL_CELLS = ("QID", "TGN", "IDAI", "OSM_Relation", "GeoNames", "matchReason")
LEVELS = (("land", "Land", "LAND"), ("bundesland", "Bundesland", "BUNDESLAND"), ("kreis", "Kreis", "KREIS"), ("gemeinde", "Gemeinde", "GEMEINDE"))


def admin_facts(df: DataFrame, names: Names, land_by_qid: dict[str, str]) -> tuple[list[Column], dict[str, Column]]:
    """Facts of the four administrative levels and their nodes from clean cells; an empty country falls back on the name of its QID."""
    nodes, facts, above = {}, [], None
    for column, kind, prefix in LEVELS:
        label = maybe(df, column)
        qid = maybe(df, f"{prefix}_QID")
        if column == "land":
            table = F.create_map(*[F.lit(x) for kv in land_by_qid.items() for x in kv]) if land_by_qid else F.lit(None).cast("map<string,string>")
            label = F.coalesce(label, table[qid])
        node = F.when(label.isNotNull(), minted(names.data, column, label))
        facts += typed(node, f"{names.term}{kind}", label)
        for authority, suffix in (("tgn", "TGN"), ("idai", "IDAI"), ("osm", "OSM_Relation"), ("geonames", "GeoNames"), ("wikidata", "QID")):
            facts += linked(names, node, authority, maybe(df, f"{prefix}_{suffix}"))
        facts.append(lit(node, f"{names.term}wikidataMatchDescription", maybe(df, f"{prefix}_matchReason")))
        if above:
            facts.append(iri(node, f"{names.term}in{above[1]}", nodes[above[0]]))
        nodes[column], above = node, (column, kind)
    return facts, nodes


#: The cells that a site's facts come from, and about how many facts a row says.
SITE_COLUMNS = (
    "FID", "fst_id", "fst_name", "katalognr", *(c for column, _, prefix in LEVELS for c in (column, *(f"{prefix}_{x}" for x in LEVEL_CELLS))), "genauigkeit_m", "wgs84_x", "wgs84_y", "fundstellenart", "QID_fundstellenart",
    "entdeckung", "QID_entdeckung", "publikation_arch", "QID_publikation", "kultur", "perio.do", "dating_method", "dating_start", "dating_end", "dating_certainty_start", "dating_certainty_end", "dating_certainty_range",
    "dating_perio.do", "dating_perio.do_match", "sherd", "methode", "quellen_typ", "methodenbeschr", "quelle_georef", "QID_quelle_georef",
)
SITE_FACTS = 60


def site_triples(df: DataFrame, names: Names = Names(), compounds: dict[str, list[tuple[str, str]]] | None = None, land_by_qid: dict[str, str] | None = None) -> DataFrame:
    """The facts of `site_statements`, each once."""
    return site_statements(df, names, compounds, land_by_qid).dropDuplicates()


def site_statements(df: DataFrame, names: Names = Names(), compounds: dict[str, list[tuple[str, str]]] | None = None, land_by_qid: dict[str, str] | None = None) -> DataFrame:
    """Every fact of every row with an identifier: places, site, types, discovery, publication, culture, dating, sherds, georeferencing.

    Identity is by label, so places of one name are one node. Rows without an FID give nothing. Cells are cleaned once and
    dealt over tasks; nodes that sites share are described from the distinct cells that say so, and each group of facts is a
    projection of its own, small enough for the JVM to compile.
    """
    t, pl, d = names.term, names.place, names.data
    g = lambda c: norm(maybe(df, c))
    cleaned = df.select(*(g(c).alias(c) for c in SITE_COLUMNS if c in df.columns)).where("FID is not null")
    df = spread(cleaned, SITE_FACTS)
    fid, g = F.col("FID"), lambda c: maybe(df, c)
    parts: list[tuple[DataFrame, list[Column], list[Column]]] = []

    def shared(columns: list[str], facts: list[Column], *arrays: Column) -> None:
        """Facts that only these cells say: one row for each combination."""
        if there := [c for c in columns if c in df.columns]:
            parts.append((df.select(*(F.col(f"`{c}`") for c in there)).distinct(), facts, [*arrays]))

    def each(facts: list[Column], *arrays: Column) -> None:
        parts.append((df, facts, [*arrays]))

    own = lambda suffix: F.concat(F.lit(f"{d}site_"), fid, F.lit(suffix))
    when = lambda c, x: F.when(c, x)
    site = own("")
    facts, nodes = admin_facts(df, names, land_by_qid or {})
    shared([c for column, _, prefix in LEVELS for c in (column, *(f"{prefix}_{x}" for x in LEVEL_CELLS))], facts)

    wkt = wkt_point(maybe(df, "wgs84_x"), maybe(df, "wgs84_y"))
    name, number = g("fst_name"), F.coalesce(lex_integer(fid).cast("string"), fid)
    each([
        iri(site, f"{RDF}type", f"{t}Fundstelle"),
        lit(site, f"{t}hatFID", number, dt=f"{XSD}integer"),
        lit(site, f"{DCTERMS}identifier", number, dt=f"{XSD}integer"),
        lit(site, f"{t}hatFundstellenID", g("fst_id")),
        lit(site, f"{t}hatKatalognummer", g("katalognr")),
        lit(site, f"{RDFS}label", name, "de"),
        lit(site, f"{SKOS}prefLabel", name, "de"),
        iri(site, f"{t}inGemeinde", nodes["gemeinde"]),
        lit(site, f"{t}hatGenauigkeit", lex_decimal(maybe(df, "genauigkeit_m")), dt=f"{XSD}decimal"),
        iri(site, f"{pl}hasLocationType", f"{names.item}{names.location_type}"),
        iri(site, f"{pl}certaintyLevel", F.concat(F.lit(names.item), band(maybe(df, "genauigkeit_m"), wkt.isNotNull(), *names.certainty))),
    ])

    # site types: compounds are several shared nodes, uncertain ones a node of the site
    label, qid = g("fundstellenart"), g("QID_fundstellenart")
    compounds = compounds or {}
    named = F.array(F.struct(label.alias("label"), qid.alias("qid")))
    if compounds:
        table = F.create_map(*[x for k, v in compounds.items() for x in (F.lit(k), F.array(*(F.struct(F.lit(a).alias("label"), F.lit(b).alias("qid")) for a, b in v)))])
        named = F.coalesce(table[label], named)
    doubtful = uncertain(label) & ~label.isin(*compounds) if compounds else uncertain(label)

    def type_facts(x: Column) -> Column:
        text = F.when(doubtful, F.concat(x["label"], F.lit("_uncertain_"), fid)).otherwise(x["label"])
        node = F.when(x["label"].isNotNull(), minted(d, "fundstellenart", text))
        return F.array(*typed(node, f"{t}FundstellenartType", x["label"]), *linked(names, node, "wikidata", x["qid"]), iri(site, f"{t}hatFundstellenart", node), lit(F.when(doubtful, node), f"{pl}certaintyDesc", "uncertain", "en"))

    each([], F.flatten(F.transform(named, type_facts)))

    found, found_qid = g("entdeckung"), g("QID_entdeckung")
    event, event_type = when(found.isNotNull(), own("_discovery")), when(found.isNotNull() & found_qid.isNotNull(), minted(d, "entdeckungsart", found))
    each([*typed(event, f"{t}Entdeckung", found, preferred=False), iri(site, f"{t}wurdeEntdecktDurch", event), iri(event, f"{t}hatEntdeckungsart", event_type)])
    shared(["entdeckung", "QID_entdeckung"], [*typed(event_type, f"{t}EntdeckungsartType", found), *linked(names, event_type, "wikidata", found_qid)])

    pub = g("publikation_arch")
    pub_node = when(pub.isNotNull(), minted(d, "pub", pub))
    shared(["publikation_arch", "QID_publikation"], [*typed(pub_node, f"{t}Publikation", pub, preferred=False), *linked(names, pub_node, "wikidata", g("QID_publikation"))])

    culture = g("kultur")
    culture_node, assigned = when(culture.isNotNull(), minted(d, "kultur", culture)), when(culture.isNotNull(), own("_culture"))
    period = when(culture.isNotNull(), g("perio.do"))
    shared(["kultur", "perio.do"], [*typed(culture_node, f"{t}Kulturgruppe", culture, preferred=False), iri(culture_node, f"{t}hasExternalIdentifier", period), iri(period, f"{t}hasExternalIdentifierType", names.kind("periodo"))])
    each([
        iri(site, f"{t}hatPublikation", pub_node),
        iri(assigned, f"{RDF}type", f"{t}KulturelleZuordnung"),
        iri(assigned, f"{t}hatKulturgruppe", culture_node),
        lit(when(uncertain(culture), assigned), f"{pl}certaintyDesc", "uncertain", "en"),
        iri(site, f"{t}hatKulturelleZuordnung", assigned),
    ])

    dating, method = when(culture.isNotNull(), own("_dating")), g("dating_method")
    method_node = when(culture.isNotNull() & method.isNotNull(), minted(d, "datmethode", method))
    facts = [iri(dating, f"{RDF}type", f"{t}Datierung"), iri(assigned, f"{t}hatDatierung", dating), iri(dating, f"{t}datierungMethode", method_node)]
    facts += [lit(dating, f"{t}datierung{n}", lex_integer(maybe(df, c)).cast("string"), dt=f"{XSD}integer") for c, n in (("dating_start", "Start"), ("dating_end", "End"))]
    facts += [lit(dating, f"{t}datierungSicherheit{n}", g(f"dating_certainty_{c}")) for c, n in (("start", "Start"), ("end", "End"), ("range", "Range"))]
    facts.append(iri(dating, match_predicate(F.coalesce(g("dating_perio.do_match"), F.lit("")), SKOS), g("dating_perio.do")))
    each(facts)
    shared(["kultur", "dating_method"], [iri(method_node, f"{RDF}type", f"{t}DatierungsMethodeType"), *linked(names, method_node, "wikidata", method)])

    def sherd_facts(q: Column) -> Column:
        node = F.concat(F.lit(f"{d}sherd_"), hash8(q))
        return F.array(iri(node, f"{RDF}type", f"{t}Scherbe"), *linked(names, node, "wikidata", q), iri(site, f"{t}hatScherbe", node))

    each([], F.flatten(F.transform(split_list(g("sherd")), sherd_facts)))

    activity, geometry = own("_activity"), when(wkt.isNotNull(), own("_geom"))
    used, source = g("methode"), g("quellen_typ")
    used_node, source_node = when(used.isNotNull(), minted(d, "methode", used)), when(source.isNotNull(), minted(d, "quellentyp", source))
    reference = g("QID_quelle_georef")
    each([
        iri(activity, f"{RDF}type", f"{t}GeoreferenzierungsAktivitaet"),
        lit(activity, f"{RDFS}label", F.concat(F.lit("Georeferenzierung von Fundstelle "), fid), "de"),
        lit(activity, f"{pl}hasReference", g("quelle_georef")),
        iri(activity, f"{pl}hasReference", when(reference.isNotNull(), F.concat(F.lit(names.authorities["wikidata"]), reference))),
        iri(activity, f"{pl}methodUsed", used_node),
        iri(activity, f"{pl}hasSourceType", source_node),
        iri(activity, f"{pl}hasSourceTypeDetail", source_node),
        lit(activity, f"{pl}activityDesc", g("methodenbeschr")),
        iri(activity, f"{pl}georeferencingBy", names.agent),
        iri(activity, f"{PROV}wasAssociatedWith", names.agent),
        iri(site, f"{t}wurdeGeoreferenziertDurch", activity),
    ])
    shared(["methode"], typed(used_node, f"{pl}MethodType", used, preferred=False))
    shared(["quellen_typ"], typed(source_node, f"{pl}SourceType", source, preferred=False))
    each([
        iri(geometry, f"{RDF}type", f"{SF}Point"),
        lit(geometry, f"{GEO}asWKT", wkt, dt=f"{GEO}wktLiteral"),
        iri(geometry, f"{pl}hasPointType", f"{names.item}{names.point_type}"),
        iri(site, f"{GEO}hasGeometry", geometry),
        iri(site, f"{pl}representativeGeometry", geometry),
    ])
    return together(*(made(rows, facts, *arrays) for rows, facts, arrays in parts))


def row_log(df: DataFrame, compounds: dict[str, list] | None = None) -> DataFrame:
    """(fid, level, column, message): what the builders note about rows."""
    g = lambda c: norm(maybe(df, c))
    label = g("fundstellenart")
    split = label.isin(*(compounds or {"": 0}))
    notes = [
        (g("FID").isNull(), "WARNING", "FID", "row without an FID skipped"),
        (g("land").isNull() & g("LAND_QID").isNotNull(), "INFO", "land", "label from QID"),
        (split, "INFO", "fundstellenart", "split into components"),
        (uncertain(label) & ~split, "INFO", "fundstellenart", "marked as uncertain"),
        (g("dating_perio.do").isNotNull() & g("dating_perio.do_match").isNull(), "INFO", "dating_perio.do_match", "relatedMatch by default"),
    ]
    rows = F.array_compact(F.array(*(F.when(F.coalesce(c, F.lit(False)), F.struct(F.lit(a).alias("level"), F.lit(b).alias("column"), F.lit(m).alias("message"))) for c, a, b, m in notes)))
    return df.select(g("FID").alias("fid"), F.inline(rows))


def constant_triples(spark: SparkSession, names: Names = Names()) -> DataFrame:
    a, n = names.agent, names.agent_name
    return spark.createDataFrame([(a, f"{RDF}type", f"{FOAF}Person", "iri", None, None), (a, f"{RDFS}label", n, "lit", None, None), (a, f"{SKOS}prefLabel", n, "lit", None, None)], SCHEMA)


def predicate_counts(triples: DataFrame, classes: list[str] | None = None) -> DataFrame:
    """(p, n): triples of each predicate, of subjects of the given classes if any."""
    if classes:
        subjects = triples.where((F.col("p") == f"{RDF}type") & F.col("o").isin(*classes)).select("s").distinct()
        triples = triples.join(subjects, "s", "left_semi")
    return triples.groupBy("p").agg(F.count("*").alias("n"))
