"""RDFS entailment of a graph: domains, ranges, sub-properties and sub-classes to a fixpoint.

The rules are those of RDF Schema that say something about named terms: a property's domain types its subjects and its
range its objects that are no literals; a statement holds for each super-property, and a type for each super-class; both
hierarchies are transitive. Rules may themselves be entailed (a sub-property of rdfs:subClassOf makes sub-classes, one of
rdf:type makes types). Axioms that hold in every graph, such as that everything is an rdfs:Resource, are left out.

Evaluation is semi-naive. A round applies all rules to the last round's new triples, and new rules to the older ones, and
keeps what is not known yet. Since new rules join with new rules, hierarchies close in the logarithm of their depth. A round
writes only its new triples; the given graph is read again only for rules that a round has found, and for the predicates that
rules can state. Rules are broadcast up to SENT rows, else joined by shuffle. What a round entails is counted, then dealt to tasks by
that number.

A triple's identity is all six columns. Predicates are IRIs, so a sub-property of a blank node gives nothing, nor does
a literal as class or property. Cycles end, as nothing new is left. An empty graph gives an empty one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.operators.graph import stored
from orrery.operators.triples import COLUMNS, RDF, RDFS, dealt, tasks

TYPE, SUB_CLASS, SUB_PROPERTY, DOMAIN, RANGE = f"{RDF}type", f"{RDFS}subClassOf", f"{RDFS}subPropertyOf", f"{RDFS}domain", f"{RDFS}range"
#: Rules and predicates that are sent to every executor; more are joined by shuffle.
SENT = 200_000


def rules(triples: DataFrame) -> DataFrame:
    """(rule, key, role, to): what a triple with `key` in its predicate ('p') or object ('o') role entails."""
    stated = triples.where(F.col("p").isin(SUB_CLASS, SUB_PROPERTY, DOMAIN, RANGE) & (F.col("o_kind") == "iri") & ~F.col("s").startswith("_:"))
    rule = F.when(F.col("p") == SUB_CLASS, "class").when(F.col("p") == SUB_PROPERTY, "property").when(F.col("p") == DOMAIN, "domain").otherwise("range")
    return stated.select(rule.alias("rule"), F.col("s").alias("key"), F.col("o").alias("to")).where("key <> to or rule in ('domain', 'range')").distinct()


def applied(triples: DataFrame, by: DataFrame, few: bool = False) -> DataFrame:
    """What one application of the rules entails, with a hash of the triple that does (`premise`); `few` rules are broadcast."""
    sent = F.broadcast if few else lambda df: df
    own = [F.col(c) for c in COLUMNS]
    none, premise = F.lit(None).cast("string"), F.xxhash64("s", "o").alias("premise")

    def made(s: Column, p: Column, o: Column, kind: Column, *rest: Column) -> list[Column]:
        return [c.alias(name) for c, name in zip((s, p, o, kind, *(rest or (none, none))), COLUMNS)]

    said = by.where("rule <> 'class'")
    by_predicate = triples.join(sent(said), triples["p"] == said["key"]).where("rule <> 'range' or o_kind <> 'lit'")
    is_property = F.col("rule") == "property"
    by_predicate = by_predicate.select(
        *made(
            F.when(F.col("rule") == "range", F.col("o")).otherwise(F.col("s")), F.when(is_property, F.col("to")).otherwise(F.lit(TYPE)),
            F.when(is_property, F.col("o")).otherwise(F.col("to")), F.when(is_property, F.col("o_kind")).otherwise("iri"), F.when(is_property, F.col("o_dt")), F.when(is_property, F.col("o_lang")),
        ),
        premise,
    )
    # a type or sub-class goes up the classes, a sub-property up the properties
    up = by.where("rule in ('class', 'property')")
    climbs = triples.where(F.col("p").isin(TYPE, SUB_CLASS, SUB_PROPERTY) & (F.col("o_kind") != "lit")).withColumn("kind", F.when(F.col("p") == SUB_PROPERTY, "property").otherwise("class"))
    climbed = climbs.join(sent(up), (climbs["o"] == up["key"]) & (climbs["kind"] == up["rule"])).select(*made(own[0], own[1], F.col("to"), F.lit("iri")), premise)
    return by_predicate.unionByName(climbed)


def entailed(*graphs: DataFrame) -> DataFrame:
    """The triples of all graphs and everything that the rules make of them, each once."""
    raw = stored(reduce(DataFrame.unionByName, graphs).select(*COLUMNS))
    given = stored(dealt(raw, raw.count(), *COLUMNS).distinct())
    known, new, held = given, given, None
    fresh = stored(rules(given))
    n_fresh = n_rules = fresh.count()
    while True:
        every, few = fresh if held is None else held.unionByName(fresh), n_rules <= SENT
        step = applied(new, every, few)
        if held is not None and n_fresh:
            step = step.unionByName(applied(known, fresh, few))
        n = step.count()
        if not n:
            return known
        # only these predicates can be stated by a rule, so only their triples can be known already
        stated = every.where("rule = 'property'").select(F.col("to").alias("p")).union(step.sparkSession.createDataFrame([(TYPE,), (SUB_CLASS,), (SUB_PROPERTY,)], "p string")).distinct()
        there = known.join(F.broadcast(stated) if few else stated, "p", "left_semi").select(*COLUMNS)
        # a triple that very many entail is thinned out by parts of them, before it meets what is known
        once = dealt(step.select(*COLUMNS, F.pmod("premise", F.lit(tasks(n))).alias("part")), n, *COLUMNS, "part").distinct()
        both = once.select(*COLUMNS, F.lit(False).alias("old")).unionByName(there.withColumn("old", F.lit(True)))
        new = stored(dealt(both, n + there.count(), *COLUMNS).groupBy(*COLUMNS).agg(F.bool_or("old").alias("old")).where("not old").select(*COLUMNS))
        if new.isEmpty():
            return known
        known, held = known.unionByName(new), every
        fresh = stored(rules(new).join(held, ["rule", "key", "to"], "left_anti").select("rule", "key", "to"))
        n_fresh = fresh.count()
        n_rules += n_fresh
