"""Constraints from an ontology and their evaluation: plain tables in, a table of violations out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.operators.entailment import SENT, entailed
from orrery.operators.graph import closure, stored
from orrery.operators.triples import OWL, RDF, RDFS, SCHEMA, XSD, dealt

CONSTRAINTS = "shape string, path string, kind string, value string, severity string"
VIOLATIONS = "graph string, focus string, path string, kind string, severity string, message string"


def classes(ontology: DataFrame, namespace: str) -> DataFrame:
    return ontology.where((F.col("p") == f"{RDF}type") & (F.col("o") == f"{OWL}Class") & F.col("s").startswith(namespace)).select(F.col("s").alias("class")).distinct()


def properties(ontology: DataFrame, namespace: str) -> DataFrame:
    """(property, kind, domain, range): domains and ranges are the smallest of several."""
    kinds = ontology.where((F.col("p") == f"{RDF}type") & F.col("o").isin(f"{OWL}ObjectProperty", f"{OWL}DatatypeProperty") & F.col("s").startswith(namespace)).groupBy("s").agg(F.min("o").alias("kind"))
    ends = ontology.where(F.col("p").isin(f"{RDFS}domain", f"{RDFS}range")).groupBy("s").agg(*(F.min(F.when(F.col("p") == f"{RDFS}{e}", F.col("o"))).alias(e) for e in ("domain", "range")))
    return kinds.join(ends, "s", "left").select(F.col("s").alias("property"), "kind", "domain", "range")


def generated(ontology: DataFrame, namespace: str, required: list[tuple[str, str, str]] = ()) -> DataFrame:
    """The constraints: class and datatype ones (Warning) from domains and ranges; `required` (class, property, datatype) are exactly one (Violation).

    Properties without a domain or a range give none, nor object properties whose domain is owl:Thing.
    """
    spark = ontology.sparkSession
    p = properties(ontology, namespace).where("domain is not null and range is not null")
    thing = F.col("domain") == f"{OWL}Thing"
    is_object = F.col("kind") == f"{OWL}ObjectProperty"
    soft = p.where(~(is_object & thing)).select(F.col("domain").alias("shape"), F.col("property").alias("path"), F.when(is_object, "class").otherwise("datatype").alias("kind"), F.col("range").alias("value"), F.lit("Warning").alias("severity"))
    shapes = classes(ontology, namespace).select(F.col("class").alias("shape"), F.lit(None).cast("string").alias("path"), F.lit("targetClass").alias("kind"), F.col("class").alias("value"), F.lit("Info").alias("severity"))
    hard = [(c, path, kind, value, "Violation") for c, path, dt in required for kind, value in (("minCount", "1"), ("maxCount", "1"), ("datatype", dt))]
    return shapes.unionByName(soft).unionByName(spark.createDataFrame(hard, CONSTRAINTS))


def inferred(data: DataFrame, ontology: DataFrame, mode: str = "rdfs") -> DataFrame:
    """(s, class): the types that a graph states ('none'), with their superclasses ('subclass'), or all that RDF Schema entails ('rdfs')."""
    if mode == "rdfs":
        data = entailed(data, ontology)
    types = data.where(F.col("p") == f"{RDF}type").select("s", F.col("o").alias("class"))
    if mode == "subclass":
        up = closure(ontology.where(F.col("p") == f"{RDFS}subClassOf").select(F.col("s").alias("child"), F.col("o").alias("parent")))
        types = types.unionByName(types.join(up, types["class"] == up["node"]).select("s", F.col("ancestor").alias("class")))
    return dealt(types, types.count(), "s", "class").distinct()


def validate(graph: str, data: DataFrame, constraints: DataFrame, ontology: DataFrame, inference: str = "rdfs") -> DataFrame:
    """The violations of a graph, one row each: object of a wrong class, literal of a wrong datatype, too few or too many values.

    With inference "rdfs" the graph that is validated is the one that RDF Schema entails from data and ontology, with the
    values that super-properties take; else the data as they are.
    """
    if inference == "rdfs":
        data, inference = entailed(data, ontology), "none"
    types = stored(inferred(data, ontology, inference))
    c = stored(constraints.where("kind <> 'targetClass'").distinct())
    few = c.count() <= SENT
    sent = lambda df: F.broadcast(df) if few else df
    values = data.select(F.col("s").alias("focus"), F.col("p").alias("path"), "o", "o_kind", "o_dt", "o_lang", F.lit(True).alias("there"))

    def met(kinds: str) -> DataFrame:
        """The targets of some kinds of constraints with each of their values, or with none."""
        own = c.where(kinds)
        due = types.join(sent(own), F.col("class") == F.col("shape")).select(F.col("s").alias("focus"), "path", "kind", "value", "severity")
        held = values.join(sent(own.select("path").distinct()), "path", "left_semi")
        n = due.count() + held.count()
        return dealt(due, n, "focus", "path").distinct().join(dealt(held, n, "focus", "path").hint("merge"), ["focus", "path"], "left")

    def found(df: DataFrame, message: Column) -> DataFrame:
        return df.select(F.lit(graph).alias("graph"), "focus", "path", "kind", "severity", message.alias("message"))

    # the objects are looked up once each, however many subjects share one
    of_class = met("kind = 'class'").where("there").select("focus", "path", "kind", "value", "severity", "o").distinct()
    named = types.join(sent(c.where("kind = 'class'").select(F.col("value").alias("class")).distinct()), "class", "left_semi")
    wrong = of_class.select("o", "value").distinct().join(named.select(F.col("s").alias("o"), F.col("class").alias("value")), ["o", "value"], "left_anti").alias("w")
    of_class = of_class.alias("x").join(wrong, F.col("x.o").eqNullSafe(F.col("w.o")) & F.col("x.value").eqNullSafe(F.col("w.value")), "left_semi")
    plain = F.when(F.col("o_lang").isNotNull(), f"{RDF}langString").otherwise(F.coalesce("o_dt", F.lit(f"{XSD}string")))
    is_bad = (F.col("o_kind") != "lit") | (plain != F.col("value"))
    judged = met("kind in ('datatype', 'minCount', 'maxCount')").groupBy("focus", "path", "kind", "value", "severity").agg(F.count("there").alias("n"), F.bool_or(F.col("there") & is_bad).alias("bad"))
    limit = F.when(F.col("kind") != "datatype", F.col("value").cast("int"))
    broken = F.when(F.col("kind") == "datatype", F.col("bad")).when(F.col("kind") == "minCount", F.col("n") < limit).otherwise(F.col("n") > limit)
    said = F.when(F.col("kind") == "datatype", "value is not of datatype ").when(F.col("kind") == "minCount", "fewer than ").otherwise("more than ")
    return found(of_class, F.concat("o", F.lit(" is not of class "), "value")).unionByName(found(judged.where(broken), F.concat(said, "value")))


def conforms(violations: DataFrame) -> DataFrame:
    """(graph, conforms, n): one row; any result, warnings too, means no."""
    return violations.agg(F.first("graph").alias("graph"), (F.count("*") == 0).alias("conforms"), F.count("*").alias("n"))


def verdict(there: Column, ok: Column, n: Column) -> Column:
    """PASS, WARN or FAIL of a validation report; a missing one is WARN."""
    return F.when(~there, "WARN").when(ok & (n == 0), "PASS").when(n == 0, "WARN").otherwise("FAIL")


def top_results(violations: DataFrame, n: int = 10) -> DataFrame:
    return violations.orderBy("focus", "path", "kind", "message").limit(n)


def as_triples(constraints: DataFrame, base: str) -> DataFrame:
    """The constraints as a graph of shapes."""
    from orrery.operators.triples import SH

    shape = F.concat(F.lit(base), F.substring_index(F.regexp_replace("shape", ".*[#/]", ""), "/", -1), F.lit("Shape"))
    node = F.concat(F.lit("_:b"), F.substring(F.md5(F.concat_ws("|", "shape", "path")), 1, 12))
    row = lambda s, p, o, kind, dt=None: F.struct(s.alias("s"), F.lit(p).alias("p"), o.alias("o"), F.lit(kind).alias("o_kind"), F.lit(dt).cast("string").alias("o_dt"), F.lit(None).cast("string").alias("o_lang"))
    target = F.col("kind") == "targetClass"
    own = F.array(row(shape, f"{RDF}type", F.lit(f"{SH}NodeShape"), "iri"), row(shape, f"{SH}targetClass", F.col("shape"), "iri"))
    path = F.array(
        row(shape, f"{SH}property", node, "bnode"),
        row(node, f"{SH}path", F.col("path"), "iri"),
        row(node, f"{SH}severity", F.concat(F.lit(SH), F.col("severity")), "iri"),
    )
    count = F.col("kind").isin("minCount", "maxCount")
    value = F.struct(node.alias("s"), F.concat(F.lit(SH), F.col("kind")).alias("p"), F.col("value").alias("o"), F.when(count, "lit").otherwise("iri").alias("o_kind"), F.when(count, f"{XSD}integer").alias("o_dt"), F.lit(None).cast("string").alias("o_lang"))
    return constraints.select(F.inline(F.when(target, own).otherwise(F.concat(path, F.array(value))))).toDF(*(c.split()[0] for c in SCHEMA.split(", "))).distinct()
