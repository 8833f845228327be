"""Graph-pattern queries over a triple table: the relational form of each language feature, and the cookbook."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.operators.triples import RDF, RDFS, SKOS, Graph, Names
from orrery.sources.graphstore import GraphStore


def match(triples: DataFrame | Graph | GraphStore, p: str | list[str] | None, s: str = "s", o: str | None = "o", where: Column | None = None, more: dict[str, str] | None = None) -> DataFrame:
    """One pattern as a table of its variables: the subject as `s`, the object as `o` (None: not wanted); `more` names further columns."""
    if isinstance(triples, (Graph, GraphStore)):
        triples = triples.of(*([p] if isinstance(p, str) else p or []))
    elif p is not None:
        triples = triples.where(F.col("p").isin(*p) if isinstance(p, list) else F.col("p") == p)
    if where is not None:
        triples = triples.where(where)
    return triples.select(F.col("s").alias(s), *([F.col("o").alias(o)] if o else []), *(F.col(k).alias(v) for k, v in (more or {}).items()))


def joined(first: DataFrame, *others: DataFrame) -> DataFrame:
    """A basic graph pattern: joins on the variables that the tables share."""
    for other in others:
        shared = [c for c in other.columns if c in first.columns]
        first = first.join(other, shared)
    return first


def optional(first: DataFrame, other: DataFrame) -> DataFrame:
    return first.join(other, [c for c in other.columns if c in first.columns], "left")


def minus(first: DataFrame, other: DataFrame) -> DataFrame:
    return first.join(other, [c for c in other.columns if c in first.columns], "left_anti")


def of_class(triples: DataFrame | Graph | GraphStore, kind: str, s: str = "s") -> DataFrame:
    return match(triples, f"{RDF}type", s, None, F.col("o") == kind)


def property_table(triples: DataFrame | Graph | GraphStore, kind: str, properties: dict[str, str]) -> DataFrame:
    """One row a subject of a class with a column a property (the least value): chains of self-joins become one aggregation."""
    if isinstance(triples, (Graph, GraphStore)):
        triples = triples.of(f"{RDF}type", *properties.values())
    wanted = F.col("p").isin(f"{RDF}type", *properties.values())
    cells = [F.min(F.when(F.col("p") == p, F.col("o"))).alias(c) for c, p in properties.items()]
    is_kind = F.max(F.when((F.col("p") == f"{RDF}type") & (F.col("o") == kind), 1)).alias("_is")
    return triples.where(wanted).groupBy("s").agg(is_kind, *cells).where("_is = 1").drop("_is")


class Cookbook:
    """The documented queries over the triples of one deployment."""

    def __init__(self, triples: DataFrame, names: Names = Names()):
        self.t, self.names = triples, names

    def term(self, name: str) -> str:
        return self.names.term + name

    def sites(self) -> DataFrame:
        return joined(of_class(self.t, self.term("Fundstelle"), "site"), match(self.t, self.term("hatFID"), "site", "fid"), match(self.t, f"{RDFS}label", "site", "name")).orderBy(F.col("fid").try_cast("bigint"), "fid", "name")

    def of_culture(self, culture: str, with_uncertain: bool = False) -> DataFrame:
        """Sites of a culture by its exact German label, or of all labels that begin so with their certainty."""
        label = F.col("o").startswith(culture) if with_uncertain else (F.col("o") == culture)
        groups = match(self.t, f"{RDFS}label", "culture", "culture_name", label & (F.col("o_lang") == "de"))
        found = joined(match(self.t, self.term("hatKulturelleZuordnung"), "site", "assignment"), match(self.t, self.term("hatKulturgruppe"), "assignment", "culture"), groups, match(self.t, f"{RDFS}label", "site", "name"))
        if with_uncertain:
            found = optional(found, match(self.t, f"{self.names.place}certaintyDesc", "assignment", "certainty"))
        return found.drop("assignment", "culture").orderBy("name", "site")

    def in_state(self, state: str) -> DataFrame:
        chain = [match(self.t, self.term(p), a, b) for p, a, b in (("inGemeinde", "site", "gemeinde"), ("inKreis", "gemeinde", "kreis"), ("inBundesland", "kreis", "bundesland"))]
        label = match(self.t, f"{RDFS}label", "bundesland", None, F.col("o") == state)
        found = joined(*chain, label, match(self.t, f"{RDFS}label", "kreis", "kreis_name"), match(self.t, f"{RDFS}label", "site", "name"))
        return found.select("site", "name", "kreis_name").orderBy("kreis_name", "name", "site")

    def types_with_ids(self, authority: str = "wikidata") -> DataFrame:
        ids = match(self.t, self.term("hasExternalIdentifier"), "type", "id", F.col("o").startswith(self.names.authorities[authority]))
        return joined(match(self.t, self.term("hatFundstellenart"), "site", "type"), ids, match(self.t, f"{RDFS}label", "type", "type_name"))

    def later_than(self, year: int, predicate: str = "datierungStart") -> DataFrame:
        """Numeric comparison of typed literals; others drop out."""
        start = F.col("o").try_cast("bigint")
        number = F.col("o_dt").endswith("#integer") & (start > year)
        return joined(match(self.t, self.term("hatKulturelleZuordnung"), "site", "a"), match(self.t, self.term("hatDatierung"), "a", "dating"), match(self.t, self.term(predicate), "dating", "start", number)).select("site", F.col("start").cast("bigint").alias("start")).orderBy("start", "site")

    def dated_by(self, identifier: str) -> DataFrame:
        method = match(self.t, self.term("hasExternalIdentifier"), "method", None, F.col("o") == identifier)
        return joined(match(self.t, self.term("hatKulturelleZuordnung"), "site", "a"), match(self.t, self.term("hatDatierung"), "a", "dating"), match(self.t, self.term("datierungMethode"), "dating", "method"), method, match(self.t, f"{RDFS}label", "site", "name")).select("site", "name")

    def period_matches(self) -> DataFrame:
        """A union of three predicates with a tag: one scan."""
        tag = F.substring_index("p", "#", -1)
        found = self.t.where(F.col("p").isin(*(f"{SKOS}{x}Match" for x in ("exact", "close", "related")))).select(F.col("s").alias("dating"), F.col("o").alias("period"), tag.alias("level"))
        return joined(found, match(self.t, self.term("hatDatierung"), "a", "dating"), match(self.t, self.term("hatKulturelleZuordnung"), "site", "a")).select("site", "period", "level")

    def cultures_by_type(self) -> DataFrame:
        """Sites by culture and type; a compound site counts once for each component."""
        found = joined(match(self.t, self.term("hatKulturelleZuordnung"), "site", "a"), match(self.t, self.term("hatKulturgruppe"), "a", "culture"), match(self.t, f"{RDFS}label", "culture", "culture_name"), match(self.t, self.term("hatFundstellenart"), "site", "type"), match(self.t, f"{RDFS}label", "type", "type_name"))
        return found.groupBy("culture_name", "type_name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "culture_name", "type_name")

    def mentions(self, text: str, kind: str | None = None) -> DataFrame:
        """Any predicate whose value has a text, without case; one row a matching triple."""
        hit = match(self.t, None, "s", "value", F.lower("o").contains(text.lower()), {"p": "property"})
        return joined(hit, of_class(self.t, kind, "s")) if kind else hit


def level_index(labels: DataFrame, classes: list[str], langs: list[str]) -> DataFrame:
    """Distinct labels and alternative labels of some classes with their optional identifiers."""
    own = labels.where(F.col("class").isin(*classes) & F.col("lang").isin(*langs))
    return own.select("item", "label", "label_type", *(c for c in ("geonames", "tgn", "idai", "osm_relation") if c in labels.columns)).distinct()
