"""RDFS entailment against a plain fixpoint."""

import random

import pytest

from orrery.operators import entailment as E
from orrery.operators import shapes
from orrery.operators.triples import SCHEMA, XSD

X = "urn:x:"


def iri(s, p, o):
    return (X + s, p if ":" in p else X + p, o if ":" in o else X + o, "iri", None, None)


def lit(s, p, text, dt=None, lang=None):
    return (X + s, X + p, text, "lit", dt, lang)


def plain(given):
    known = set(given)
    while True:
        new = set()
        for a in known:
            if a[1] not in (E.SUB_CLASS, E.SUB_PROPERTY, E.DOMAIN, E.RANGE) or a[3] != "iri" or a[0].startswith("_:"):
                continue
            for t in known:
                if a[1] == E.SUB_PROPERTY and t[1] == a[0]:
                    new.add((t[0], a[2], *t[2:]))
                if a[1] == E.DOMAIN and t[1] == a[0]:
                    new.add((t[0], E.TYPE, a[2], "iri", None, None))
                if a[1] == E.RANGE and t[1] == a[0] and t[3] != "lit":
                    new.add((t[2], E.TYPE, a[2], "iri", None, None))
                up = t[3] != "lit" and t[2] == a[0] and a[0] != a[2]
                if up and (a[1] == E.SUB_CLASS and t[1] in (E.TYPE, E.SUB_CLASS) or a[1] == E.SUB_PROPERTY == t[1]):
                    new.add((t[0], t[1], a[2], "iri", None, None))
        if new <= known:
            return sorted(known, key=repr)
        known |= new


def got(spark, *graphs):
    return sorted(map(tuple, E.entailed(*(spark.createDataFrame(g, SCHEMA) for g in graphs)).collect()), key=repr)


@pytest.mark.parametrize("sent", [0, 200_000])
def test_hierarchies(spark, monkeypatch, sent):
    monkeypatch.setattr(E, "SENT", sent)
    data = [iri("a", "inCity", "c"), lit("a", "name", "A", lang="de"), lit("a", "size", "3", XSD + "integer"), iri("c", E.TYPE, "City"), ("_:b", X + "inCity", X + "c", "iri", None, None), (X + "a", X + "inCity", "_:b", "bnode", None, None)]
    onto = [iri("inCity", E.SUB_PROPERTY, "inPlace"), iri("inPlace", E.SUB_PROPERTY, "located"), iri("located", E.DOMAIN, "Thing"), iri("inPlace", E.RANGE, "Place"), iri("name", E.RANGE, "Name"), iri("City", E.SUB_CLASS, "Area"), iri("Area", E.SUB_CLASS, "Place"), iri("Place", E.SUB_CLASS, "Area"), iri("size", E.SUB_PROPERTY, "measure"), iri("size", E.SUB_PROPERTY, "size")]
    found = got(spark, data, onto + onto)
    assert found == plain(data + onto)
    assert iri("a", "located", "c") in found and iri("a", E.TYPE, "Thing") in found and iri("c", E.TYPE, "Place") in found


def test_rules_that_are_entailed(spark):
    onto = [iri("kindOf", E.SUB_PROPERTY, E.SUB_CLASS), iri("isA", E.SUB_PROPERTY, E.TYPE), iri("Dog", "kindOf", "Animal"), iri("narrower", E.SUB_PROPERTY, E.SUB_PROPERTY), iri("bites", "narrower", "touches"), iri("touches", E.RANGE, "Solid")]
    data = [iri("rex", "isA", "Dog"), iri("rex", "bites", "stone")]
    found = got(spark, data, onto)
    assert found == plain(data + onto) and iri("rex", E.TYPE, "Animal") in found and iri("stone", E.TYPE, "Solid") in found


@pytest.mark.parametrize("seed", range(1))
def test_random_graphs(spark, seed):
    rng = random.Random(seed)
    of = lambda k, n: f"{k}{rng.randrange(n)}"
    given = [iri(of("n", 6), of("p", 6), of("n", 6)) for _ in range(12)] + [iri(of("n", 6), E.TYPE, of("C", 7)) for _ in range(4)]
    given += [iri(of("C", 7), E.SUB_CLASS, of("C", 7)) for _ in range(8)] + [iri(of("p", 6), E.SUB_PROPERTY, of("p", 6)) for _ in range(6)]
    given += [iri(of("p", 6), rng.choice([E.DOMAIN, E.RANGE]), of("C", 7)) for _ in range(3)] + [lit(of("n", 6), of("p", 6), "text")]
    assert got(spark, given) == plain(given)


def test_deep_hierarchy_in_few_rounds(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(E, "applied", lambda *a, keep=E.applied: rounds.append(1) or keep(*a))
    onto = [iri(f"C{i}", E.SUB_CLASS, f"C{i + 1}") for i in range(20)]
    assert len(got(spark, onto)) == 21 * 20 // 2 and len(rounds) <= 12


def test_empty(spark):
    assert got(spark, []) == []
    assert got(spark, [iri("a", "p", "b")]) == [iri("a", "p", "b")]


def test_validation_sees_super_properties(spark):
    data = spark.createDataFrame([iri("a", E.TYPE, "Site"), iri("a", "inCity", "c"), iri("b", E.TYPE, "Site")], SCHEMA)
    onto = spark.createDataFrame([iri("inCity", E.SUB_PROPERTY, "inPlace")], SCHEMA)
    rules = spark.createDataFrame([(X + "Site", X + "inPlace", "minCount", "1", "Violation")], shapes.CONSTRAINTS)
    focus = lambda mode: sorted(r["focus"] for r in shapes.validate("g", data, rules, onto, mode).collect())
    assert focus("rdfs") == [X + "b"] and focus("subclass") == [X + "a", X + "b"]
