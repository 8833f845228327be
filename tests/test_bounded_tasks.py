"""Steps that hold a part of a graph deal it out by its number of rows, with the same results."""

from pyspark.sql import functions as F

from orrery.operators import entailment, graph, shapes, substring, triples
from orrery.operators.triples import RDF, RDFS, SCHEMA, XSD

X = "http://x#"


def rows(spark, facts):
    return spark.createDataFrame([(*(f"{X}{t}" if not t.startswith("http") else t for t in f[:2]), f[2] if len(f) > 3 else f"{X}{f[2]}", "lit" if len(f) > 3 else "iri", f[3] if len(f) > 3 else None, None) for f in facts], SCHEMA)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_validation(spark, monkeypatch):
    """A class that two shapes name is counted once; one object of many subjects is looked up once; facts of other predicates stay out."""
    monkeypatch.setattr(triples, "HELD", 20)
    facts = [(f"n{k}", f"{RDF}type", "Nation") for k in range(2)]
    for i in range(60):
        facts += [(f"s{i}", f"{RDF}type", "Site"), (f"s{i}", "inNation", f"n{i % 3}"), (f"s{i}", "note", f"note {i}", None)]
        facts += [(f"s{i}", "id", str(j), f"{XSD}integer") for j in range(i % 3)]
    c = [(s, "id", kind, "1") for s in ("Site", "Place") for kind in ("minCount", "maxCount")] + [("Site", "inNation", "class", "Nation"), ("Place", "id", "datatype", f"{XSD}string"), ("Site", "nowhere", "minCount", "1")]
    c = spark.createDataFrame([(X + s, X + p, kind, v if v[0] in "1h" else X + v, "Warning") for s, p, kind, v in c], shapes.CONSTRAINTS)
    found = shapes.validate("g", rows(spark, facts), c, rows(spark, [("Site", f"{RDFS}subClassOf", "Place")]), "subclass")
    assert plan(found).count("REPARTITION_BY_NUM") >= 4
    got = sorted((r.focus[len(X) :], r.path[len(X) :], r.kind, r.message.split(" ")[0][len(X) :] if r.kind == "class" else "") for r in found.collect())
    want = [(f"s{i}", "inNation", "class", "n2") for i in range(2, 60, 3)] + [(f"s{i}", "id", "datatype", "") for i in range(60) if i % 3]
    want += [(f"s{i}", "id", "minCount", "") for i in range(0, 60, 3)] + [(f"s{i}", "id", "maxCount", "") for i in range(2, 60, 3)] + [(f"s{i}", "nowhere", "minCount", "") for i in range(60)]
    assert got == sorted(want)


def test_graph(spark, monkeypatch):
    """A graph's facts are dealt by subject, so what is asked of subjects needs no shuffle of facts more."""
    monkeypatch.setattr(triples, "HELD", 20)
    t = spark.range(100).selectExpr("cast(id % 50 as string) as s", "cast(id % 25 as string) as o")
    fact = triples.iri(F.concat(F.lit(X), "s"), X + "p", F.concat(F.lit(X), "o"))
    kind = triples.iri(F.concat(F.lit(X), "s"), f"{RDF}type", F.when(F.col("s").cast("int") < 10, X + "Low").otherwise(X + "High"))
    g = triples.Graph((t, [(X + "p", fact), (f"{RDF}type", kind)], 100))
    assert plan(g.of()).count("REPARTITION_BY_NUM") == 1 and g.of().count() == 100 and g.of(X + "p").count() == 50
    counts = triples.predicate_counts(g.of(), [X + "Low"])
    assert "Exchange hashpartitioning(s#" not in "".join(x for x in plan(counts).splitlines(True) if "ENSURE_REQUIREMENTS" in x)
    assert {tuple(r) for r in counts.collect()} == {(X + "p", 10), (f"{RDF}type", 10)}


def widths(monkeypatch, module):
    """The numbers of rows that each task writes of every table that a module stores."""
    found = []

    def kept(df, keep=graph.stored):
        out = keep(df)
        found.append([r["count"] for r in out.groupBy(F.input_file_name()).count().collect()])
        return out

    monkeypatch.setattr(module, "stored", kept)
    return found


def test_substring_index(spark, monkeypatch):
    """Literals and postings lie in tasks of a bounded number of rows; texts that differ by case and a literal of most statements are found whole."""
    monkeypatch.setattr(triples, "HELD", 200)
    facts = [(f"s{i}", "id", f"Item#{i:04d}", None) for i in range(300)] + [(f"s{i}", "id", f"ITEM#{i:04d}", None) for i in range(50)] + [(f"s{i}", "state", "item#00 is open", None) for i in range(500)]
    made, found = rows(spark, facts), widths(monkeypatch, substring)
    index = substring.SubstringIndex(made)
    assert all(max(sizes) < 600 for sizes in found[:2]) and len(found[1]) >= 10
    assert sorted((r.s[len(X) :], r.o) for r in index.statements(made, "ITEM#00").collect()) == sorted((f[0], f[2]) for f in facts if f[2].lower().startswith("item#00"))
    search = plan(index.statements(made, "ITEM#00"))
    assert search.count("REPARTITION_BY_NUM") == 2 and "ENSURE_REQUIREMENTS" in search and "SortMergeJoin" not in search


def test_entailment(spark, monkeypatch):
    """Given and found triples lie in tasks of a bounded number of rows, one object of all statements is typed once, and what is known isn't found again."""
    monkeypatch.setattr(triples, "HELD", 100)
    data = [(f"s{i}", "in", "hub") for i in range(600)] + [("hub", f"{RDF}type", "Place")] + [(f"s{i}", "within", "hub") for i in range(300)]
    onto = [("in", entailment.SUB_PROPERTY, "within"), ("within", entailment.RANGE, "Place"), ("within", entailment.DOMAIN, "Thing"), ("Place", entailment.SUB_CLASS, "Thing")]
    onto = [(s, p, f"{X}{o}") for s, p, o in onto]
    onto = spark.createDataFrame([(X + s, p, o, "iri", None, None) for s, p, o in onto], SCHEMA)
    found = widths(monkeypatch, entailment)
    got = [tuple(r) for r in entailment.entailed(rows(spark, data), onto, onto).select("s", "p", "o").collect()]
    want = {(X + f"s{i}", X + p, X + "hub") for i in range(600) for p in ("in", "within")} | {(X + f"s{i}", f"{RDF}type", X + "Thing") for i in range(600)}
    want |= {(X + "hub", f"{RDF}type", X + c) for c in ("Place", "Thing")} | {(r.s, r.p, r.o) for r in onto.collect()}
    assert len(got) == len(set(got)) and set(got) == want
    # of the tables after the first, as it comes, none has a task with many rows
    assert max(map(len, found[1:])) >= 8 and all(max(sizes, default=0) < 250 for sizes in found[1:])
