import numpy as np
import pytest
from pyspark.sql import functions as F

from orrery.functions import lcs
from orrery.functions import text as text_functions
from orrery.operators import graph, matching, patterns, reconcile, shapes, tables, triples
from orrery.operators.triples import OWL, RDF, RDFS, SCHEMA, XSD, Names
from orrery.plans import runs
from orrery.sources import read, write
from orrery.streaming import builders

NAMES = Names()
D, T = NAMES.data, NAMES.term
COMPOUNDS = {"Siedlung und Grab": [("Siedlung", "Q486972"), ("Grab", "Q173387")]}
# the documented example row, with its place names, types and dating
FRIESACK = {
    "FID": "33", "fst_id": "129", "katalognr": "12485", "fst_name": "Friesack 4", "gemeinde": "Friesack", "kreis": "Havelland", "bundesland": "Brandenburg", "land": "Deutschland",
    "kultur": "FBG", "entdeckung": "Ausgrabung", "QID_entdeckung": "Q959782", "publikation_arch": "Wetzel/Beran 2023", "QID_publikation": "Q139304633", "fundstellenart": "Siedlung", "QID_fundstellenart": "Q486972",
    "genauigkeit_m": "0", "wgs84_x": "12,54", "wgs84_y": "52,75", "methode": "Übernahme aus externer Datenbank", "quellen_typ": "Strukturen des Landesdenkmalamts", "methodenbeschr": "Text", "quelle_georef": "Quelle",
    "dating_start": "-4550", "dating_end": "-3900", "dating_certainty_start": "a", "dating_certainty_end": "b", "dating_certainty_range": "c", "dating_method": "Q173412", "dating_perio.do": "http://n2t.net/x", "dating_perio.do_match": "closeMatch",
    "LAND_QID": "Q183", "LAND_matchReason": "Exact", "sherd": "",
}


def rows(spark, *records):
    names = list(dict.fromkeys(k for r in records for k in r))
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in records], ", ".join(f"`{n}` string" for n in names))


def facts(df):
    return {(r.s, r.p, r.o) for r in df.collect()}


def test_example_row(spark):
    got = triples.site_triples(rows(spark, FRIESACK), NAMES, COMPOUNDS)
    assert got.count() == got.distinct().count()
    f = facts(got)
    site = f"{D}site_33"
    for p, o in ((f"{T}hatFID", "33"), (f"{T}inGemeinde", f"{D}gemeinde_ef3c98d9"), (f"{T}hatFundstellenart", f"{D}fundstellenart_1972902b"), (f"{T}hatPublikation", f"{D}pub_c54b495e"), (f"{NAMES.place}certaintyLevel", f"{NAMES.item}Q23")):
        assert (site, p, o) in f
    assert (f"{D}gemeinde_ef3c98d9", f"{T}inKreis", f"{D}kreis_d4d0a03b") in f and (f"{D}bundesland_2ddb2d82", f"{T}inLand", f"{D}land_3c2f8b8c") in f
    assert (f"{D}site_33_discovery", f"{T}hatEntdeckungsart", f"{D}entdeckungsart_1f56a08c") in f
    assert (f"{D}site_33_dating", f"{T}datierungStart", "-4550") in f and (f"{D}site_33_dating", f"{triples.SKOS}closeMatch", "http://n2t.net/x") in f
    assert (f"{D}site_33_geom", f"{triples.GEO}asWKT", "POINT(12.54 52.75)") in f
    assert ("https://www.wikidata.org/entity/Q183", f"{T}hasExternalIdentifierType", f"{T}ExternalIdentifier_Wikidata") in f


def test_special_rows(spark):
    own = [
        {"FID": "54", "fundstellenart": "Grab?", "QID_fundstellenart": "Q173387", "wgs84_x": "0", "wgs84_y": "0,0"},
        {"FID": "81", "kultur": "SBK?", "dating_perio.do": "http://p", "entdeckung": "Fund"},
        {"FID": "80", "sherd": "Q139477253| Q139477652|"},
        {"FID": "571", "land": "", "LAND_QID": "Q183"},
        {"FID": "9", "fundstellenart": "Siedlung und Grab"},
        {"FID": " nan "},
    ]
    df = rows(spark, *own)
    f = facts(triples.site_triples(df, NAMES, COMPOUNDS, {"Q183": "Deutschland"}))
    assert (f"{D}fundstellenart_e5b4c377", f"{NAMES.place}certaintyDesc", "uncertain") in f
    assert (f"{D}site_54", f"{NAMES.place}certaintyLevel", f"{NAMES.item}Q113") in f and not any(s == f"{D}site_54_geom" for s, _, _ in f)
    assert (f"{D}site_81_culture", f"{T}hatKulturgruppe", f"{D}kultur_7a001224") in f and (f"{D}site_81_culture", f"{NAMES.place}certaintyDesc", "uncertain") in f
    assert (f"{D}site_81_dating", f"{triples.SKOS}relatedMatch", "http://p") in f
    assert (f"{D}site_81_discovery", f"{RDF}type", f"{T}Entdeckung") in f and not any(p == f"{T}hatEntdeckungsart" for _, p, _ in f)
    assert sum(p == f"{T}hatScherbe" for _, p, _ in f) == 2
    assert (f"{D}land_3c2f8b8c", f"{RDFS}label", "Deutschland") in f
    assert {o for s, p, o in f if s == f"{D}site_9" and p == f"{T}hatFundstellenart"} == {f"{D}fundstellenart_1972902b", f"{D}fundstellenart_b635ceb0"}
    assert not any("nan" in s for s, _, _ in f)
    log = {(r.fid, r.message) for r in triples.row_log(df, COMPOUNDS).collect()}
    assert {("54", "marked as uncertain"), ("571", "label from QID"), ("9", "split into components"), (None, "row without an FID skipped"), ("81", "relatedMatch by default")} <= log


def test_facts_are_made_in_tasks_of_bounded_size(spark, monkeypatch):
    """However few groups of rows a file has: the facts of one are not all combined in one task."""
    df = spark.range(1, 401, 1, 1).selectExpr("cast(id as string) AS FID", "concat('x', id % 3) AS gemeinde", "cast(id % 7 as string) AS kultur")
    whole = {tuple(r) for r in triples.site_triples(df, NAMES, COMPOUNDS).collect()}
    monkeypatch.setattr(triples, "FACTS", 3000)
    made = triples.site_statements(df, NAMES, COMPOUNDS)
    sizes = [len(p) for p in made.rdd.glom().collect()]
    assert max(sizes) < 2000 and sum(n > 0 for n in sizes) > 8 and {tuple(r) for r in made.collect()} == whole
    assert sum(r.o == f"{NAMES.term}Gemeinde" for r in made.collect()) == 3


def test_cookbook(spark):
    df = rows(spark, FRIESACK, FRIESACK | {"FID": "34", "kultur": "FBG?", "fst_name": "B"})
    c = patterns.Cookbook(triples.site_triples(df, NAMES, COMPOUNDS).cache(), NAMES)
    assert [r.fid for r in c.sites().collect()] == ["33", "34"]
    assert [r.name for r in c.of_culture("FBG").collect()] == ["Friesack 4"]
    assert [(r.name, r.certainty) for r in c.of_culture("FBG", True).collect()] == [("B", "uncertain"), ("Friesack 4", None)]
    assert c.in_state("Brandenburg").count() == 2 and c.types_with_ids().count() == 2
    assert c.later_than(-4600).count() == 2 and c.later_than(-4000).count() == 0
    assert c.dated_by("https://www.wikidata.org/entity/Q173412").count() == 2
    assert {r.level for r in c.period_matches().collect()} == {"closeMatch"}
    assert {(r.culture_name, r.n) for r in c.cultures_by_type().collect()} == {("FBG", 1), ("FBG?", 1)}
    assert c.mentions("datenbank").count() == 1


def test_merge_and_placing(spark):
    left = spark.createDataFrame([("1 ", "a"), (None, "b"), ("3", "c")], "FID string, land string")
    right = spark.createDataFrame([("1", "x"), ("1", "y"), (None, "z")], "k string, LAND_QID string")
    out = tables.merge(left, right, "FID", ["LAND_QID", "LAND_TGN"], "k")
    assert sorted(map(tuple, out.collect()), key=str) == [("1", "a", "x"), ("1", "a", "y"), ("3", "c", None), ("nan", "b", "z")]
    assert tables.placed(out.withColumn("z", F.lit(1)), {"LAND": ["LAND_QID"], "none": ["z"]}).columns == ["FID", "land", "LAND_QID", "z"]
    assert tables.absent(right, ["LAND_QID", "LAND_TGN"]) == ["LAND_TGN"]


def test_matching(spark):
    labels = spark.createDataFrame([(1, "Q1", "Harz", "rdfs:label", "S", ""), (2, "Q2", "harz ", "skos:altLabel", "S", "77"), (3, "Q3", "Havelland", "skos:altLabel", "S", None)], "ord long, item string, label string, label_type string, scope string, geonames string")
    index = matching.label_index(labels, "scope")
    assert {(r.key, r.qid, r.label, r.geonames) for r in index.collect()} == {("harz", "Q1", "Harz", "77"), ("havelland", "Q3", "Havelland", None)}
    raw = spark.createDataFrame([("Landkreis Harz", "S"), ("Havelnad", "S"), ("zzz", "S"), ("Harz", "none")], "raw string, scope string")
    named = matching.aliased(raw, "raw", [r"landkreis\s+"], {})
    got = {(r.raw, r.scope): r for r in matching.best_match(named, index, ["scope"], 0.8).collect()}
    assert got["Landkreis Harz", "S"].qid == "Q1" and "normalised: removed 'Landkreis'" in got["Landkreis Harz", "S"].reason
    assert got["Havelnad", "S"].qid == "Q3" and got["Havelnad", "S"].reason.startswith("Fuzzy match")
    assert got["zzz", "S"].qid is None and "below threshold" in got["zzz", "S"].reason
    assert got["Harz", "none"].reason == "No candidates in index"
    out = matching.appended(raw.withColumnRenamed("raw", "KREIS").drop("scope"), "KREIS", matching.best_match(named.where("scope = 'S'"), index, ["scope"], 0.85))
    assert {r.KREIS: r.KREIS_reason for r in out.collect()}["Harz"] == "Not processed"


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = _next(row, x, b)
    return row[-1]


def _next(row, x, b):
    out = [0]
    for j, y in enumerate(b):
        out.append(row[j] + 1 if x == y else max(row[j + 1], out[-1]))
    return out


def test_lcs():
    import random

    rng = random.Random(1)
    say = lambda n: "".join(rng.choices("abcé😀 ", k=n))
    a, b = ([say(rng.choice([0, 1, 5, 20, 63, 64, 65, 90])) for _ in range(150)] for _ in range(2))
    want = [plain_lcs(x, y) for x, y in zip(a, b)]
    assert lcs.lengths(a, b).tolist() == want == [lcs.length(x, y) for x, y in zip(a, b)]
    for x in a[:9]:
        assert lcs.Block(b).lengths(x, np.arange(len(b))).tolist() == [plain_lcs(x, y) for y in b]
    assert lcs.lengths([], []).tolist() == []
    assert lcs.points([6, 0, 1], [14, 0, 32]).tolist() == [8571, 10000, 625]


def test_matching_without_a_scope(spark, monkeypatch):
    """An index of any size, in blocks; the best over all of them, ties by order."""
    labels = spark.range(20_000).select(F.col("id").alias("ord"), F.concat(F.lit("Q"), F.col("id").cast("string")).alias("item"), F.concat(F.lit("place "), F.col("id").cast("string")).alias("label"), F.lit("rdfs:label").alias("label_type"))
    index = matching.label_index(labels)
    values = spark.createDataFrame([("place 19999x",), ("77 PLACE",), ("zzz",), ("place 1234a",)], "raw string").withColumns({"name": F.col("raw"), "note": F.lit("")})
    got = {r.raw: (r.qid, r.score) for r in matching.best_match(values, index, [], 0.85).collect()}
    assert got["place 19999x"] == ("Q19999", 0.9565) and got["77 PLACE"] == ("Q77", 1.0) and got["zzz"][0] is None
    assert got["place 1234a"] == ("Q1234", 0.9524)
    monkeypatch.setattr(matching, "SMALL_INDEX", 10)
    scoped = matching.best_match(values.withColumn("s", F.lit(1)), index.withColumn("s", F.lit(1)), ["s"], 0.85)
    assert {r.raw: (r.qid, r.score) for r in scoped.collect()} == got
    assert matching.best_match(values, index.limit(0), [], 0.85).where("reason = 'No candidates in index'").count() == 4


def test_results_of_a_value_in_two_scopes(spark):
    df = spark.createDataFrame([("A", "x"), ("A", "y"), ("B", "x")], "town string, state string")
    results = spark.createDataFrame([("A", "x", "Q1"), ("A", "y", "Q2")], "raw string, scope string, qid string").withColumn("reason", F.lit("r"))
    out = matching.appended(df, "town", results, {"state": "scope"})
    assert {(r.town, r.state, r.town_qid, r.town_reason) for r in out.collect()} == {("A", "x", "Q1", "r"), ("A", "y", "Q2", "r"), ("B", "x", None, "Not processed")}
    assert [r.town_qid for r in matching.appended(df, "town", results).orderBy("town", "state").collect()] == ["Q1", "Q1", None]


def test_long_chain(spark):
    e = spark.createDataFrame([(f"n{i}", f"n{i + 1}") for i in range(70)], "child string, parent string")
    got = {(r.ancestor, r.depth) for r in graph.closure(e).where("node = 'n0'").collect()}
    assert got == {(f"n{i}", i) for i in range(1, 71)}


def test_graph(spark):
    e = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "crm1"), ("x", "b"), ("d", None)], "child string, parent string")
    got = {(r.node, r.ancestor) for r in graph.closure(e).collect()}
    assert {(n, m) for n in "abc" for m in "abc"} <= got and ("x", "crm1") in got and ("d", None) not in got
    assert {r.node: r.path for r in graph.chain(e, ["crm"]).collect()}["x"] == ["x", "crm1"]
    acts = spark.createDataFrame([("p", "2020"), ("q", None), ("r", "2019")], "activity string, started string")
    informed = spark.createDataFrame([("r", "x")], "s string, o string")
    assert graph.root(acts, informed).first().activity == "p"


def test_shapes(spark):
    ns = "http://o#"
    onto = [(f"{ns}A", f"{RDF}type", f"{OWL}Class"), (f"{ns}B", f"{RDF}type", f"{OWL}Class"), (f"{ns}B", f"{RDFS}subClassOf", f"{ns}A"), (f"{ns}p", f"{RDF}type", f"{OWL}ObjectProperty"), (f"{ns}p", f"{RDFS}domain", f"{ns}A"), (f"{ns}p", f"{RDFS}range", f"{ns}B"), (f"{ns}n", f"{RDF}type", f"{OWL}DatatypeProperty"), (f"{ns}n", f"{RDFS}domain", f"{ns}A"), (f"{ns}n", f"{RDFS}range", f"{XSD}integer"), (f"{ns}q", f"{RDF}type", f"{OWL}ObjectProperty"), (f"{ns}q", f"{RDFS}domain", f"{OWL}Thing"), (f"{ns}q", f"{RDFS}range", f"{ns}B")]
    onto = spark.createDataFrame([(*t, "iri", None, None) for t in onto], SCHEMA)
    c = shapes.generated(onto, ns, [(f"{ns}A", f"{ns}id", f"{XSD}integer")])
    assert {(r.path, r.kind) for r in c.where("kind in ('class', 'datatype') and severity = 'Warning'").collect()} == {(f"{ns}p", "class"), (f"{ns}n", "datatype")}
    data = [("x", f"{RDF}type", f"{ns}B", "iri", None), ("x", f"{ns}p", "y", "iri", None), ("x", f"{ns}n", "5", "lit", None), ("x", f"{ns}id", "1", "lit", f"{XSD}integer"), ("x", f"{ns}id", "2", "lit", f"{XSD}integer"), ("z", f"{RDF}type", f"{ns}A", "iri", None)]
    data = spark.createDataFrame([(*t, None) for t in data], SCHEMA)
    kinds = lambda mode: {(r.focus, r.kind) for r in shapes.validate("g", data, c, onto, mode).collect()}
    assert kinds("subclass") == {("x", "class"), ("x", "datatype"), ("x", "maxCount"), ("z", "minCount")}
    assert ("x", "class") not in kinds("rdfs")
    assert ("x", "datatype") not in kinds("none")
    assert shapes.as_triples(c, "http://s/").count() > 8


def test_reconcile(spark):
    said = reconcile.documented(spark.createDataFrame([("A", "`b` → **c**"), ("X", "y")], "class string, cell string"))
    computed = spark.createDataFrame([("A", "b"), ("A", "d")], "class string, ancestor string")
    assert {(r["class"], r.ancestor): r.status for r in reconcile.drift(said, computed).collect()} == {("A", "b"): "PASS", ("A", "c"): "WARN", ("A", "d"): "WARN", ("X", "y"): "FAIL"}
    names = spark.createDataFrame([("a",), ("q",)], "class string")
    edges = spark.createDataFrame([("a", "crm:E1")], "child string, parent string")
    assert {r["class"]: r.status for r in reconcile.anchored(names, edges, "crm:").collect()} == {"a": "PASS", "q": "FAIL"}


def unlabelled(t):
    """Triples whose blank nodes go by the order of their labels: what a copy under new labels keeps."""
    found = [tuple(r) for r in t.collect()]
    names = {x: i for i, x in enumerate(sorted({x for r in found for x in (r[0], r[2]) if x.startswith("_:")}))}
    return {tuple(names.get(x, x) for x in r) for r in found}


def test_escapes_and_blank_nodes(spark, tmp_path):
    odd = ["C:\\new", "a\\", '\\"', "tab\t\\t", "line\nbreak\r", "\\\\n", "ü €", "\\u0041"]
    t = spark.createDataFrame([(f"http://e/{i}", "http://e/p", x, "lit", None, None) for i, x in enumerate(odd)], SCHEMA)
    write.ntriples(t, str(tmp_path / "nt"))
    assert {r.s: r.o for r in read.ntriples(spark, str(tmp_path / "nt")).collect()} == {f"http://e/{i}": x for i, x in enumerate(odd)}
    (tmp_path / "u.nt").write_text('# c\n\n<http://e/\\u00e9> <http://e/p> "\\u0041\\U0001F600 \\\\u0041 \\u005Cn" . # end\n', encoding="utf-8")
    assert [tuple(r)[:3] for r in read.ntriples(spark, str(tmp_path / "u.nt")).collect()] == [("http://e/é", "http://e/p", "A😀 \\u0041 \\n")]
    (tmp_path / "bad.nt").write_text("<a> <b> .\n", encoding="utf-8")
    with pytest.raises(Exception, match="not a triple"):
        read.ntriples(spark, str(tmp_path / "bad.nt")).collect()
    (tmp_path / "two").mkdir()
    for n in "ab":
        (tmp_path / "two" / f"{n}.ttl").write_text(f'@base <http://h/x/> .\n@prefix : <y#> .\n:s :p [ :q "{n}" ], _:z . <r> :n 1e5, .5, 2 .', encoding="utf-8")
    rows = read.turtle(spark, str(tmp_path / "two")).collect()
    assert len({r.s for r in rows if r.o_kind == "lit" and r.s.startswith("_:")}) == 2 and len({r.o for r in rows if r.o_kind == "bnode"}) == 4
    assert {(r.o, r.o_dt) for r in rows if r.s == "http://h/x/r"} == {("1e5", f"{XSD}double"), (".5", f"{XSD}decimal"), ("2", f"{XSD}integer")}
    assert {r.p for r in rows if r.s == "http://h/x/y#s"} == {"http://h/x/y#p"}, rows
    with pytest.raises(ValueError):
        read.parse_turtle("<a> <b> ยง .")


def test_edges(spark, tmp_path):
    text = '@prefix e: <http://e/> .\ne:a a e:T ; e:p "x\\"y\\n"@de , 5, 1.5, true, "z"^^e:d ; e:q [ e:r e:b ] , ( e:c "d" ) . # end\n'
    (tmp_path / "g.ttl").write_text(text, encoding="utf-8")
    t = read.turtle(spark, str(tmp_path / "g.ttl"))
    assert t.count() == 13
    write.ntriples(t, str(tmp_path / "nt"))
    assert {tuple(r) for r in read.ntriples(spark, str(tmp_path / "nt")).collect()} == {tuple(r) for r in t.collect()}
    write.turtle_file(t, str(tmp_path / "back.ttl"), {"e": "http://e/"})
    assert unlabelled(read.turtle(spark, str(tmp_path / "back.ttl"))) == unlabelled(t)
    df = spark.createDataFrame([("1", 'a "q"\nb', None)], "FID string, x string, y string")
    write.csv_file(df, str(tmp_path / "t.csv"), bom=True)
    back = read.csv(spark, str(tmp_path / "t.csv"), na=False, line_breaks=True)
    assert back.columns == ["FID", "x", "y"] and tuple(back.first()) == ("1", 'a "q"\nb', "")
    with pytest.raises(ValueError):
        read.csv(spark, str(tmp_path / "t.csv"), required=("LAND",))
    (tmp_path / "d.md").write_text("# A\n| x | y |\n|---|---|\n| no | no |\n## Chains\n\n| class | chain | up |\n|--|--|--|\n| `C` | z | a → b |\n\n## Next\n| q | r |\n", encoding="utf-8")
    assert [tuple(r) for r in read.markdown_table(spark, str(tmp_path / "d.md"), "Chains").collect()] == [("C", "a → b")]


def test_runs(tmp_path):
    done = []
    stage = lambda n, i=(), o=(): runs.Stage(n, lambda: (done.append(n), [open(p, "w").close() for p in o]), i, o)
    a, b, c = (str(tmp_path / x) for x in "abc")
    stages = [stage("literature", (), (a,)), stage("geo", (), (b,)), stage("merge", (a, b), (c,))]
    with pytest.raises(FileNotFoundError):
        runs.execute(stages, "merge")
    assert {k: v[0] for k, v in runs.execute(stages, "full").items()} == dict.fromkeys(runs.ALL, "ok")
    assert runs.execute(stages, "geo")["literature"][0] == "skipped" and done == ["literature", "geo", "merge", "geo", "merge"]
    assert write.duration(83.4) == "1m 23.4s"
    calls = iter([TimeoutError(), [1]])

    def call():
        x = next(calls)
        if isinstance(x, Exception):
            raise x
        return x

    assert read.retried(call, sleep=lambda s: None) == [1]


def test_regrouped(spark):
    df = spark.createDataFrame([(1, 2, 3, 4, 5, 6)], "KREIS_QID int, x int, LAND int, FID int, KREIS int, LAND_TGN int")
    assert tables.regrouped(df, "FID", ["LAND", "KREIS", "GEMEINDE"], ["QID", "TGN"]).columns == ["FID", "LAND", "LAND_TGN", "KREIS", "KREIS_QID", "x"]


def test_small_sources_and_sinks(spark, tmp_path):
    df = spark.range(5).select(F.col("id").cast("string").alias("id"), F.lit("a|b").alias("x"))
    assert [r.id for r in read.limited(df, 2, "id").collect()] == ["0", "1"] and read.limited(df, None) is df
    assert read.file_uri("/a b/ü.csv") == "file:///a%20b/%C3%BC.csv" and read.file_info(str(tmp_path / "no")) == (False, None)
    assert read.git_info(str(tmp_path)) == {"commit": None, "branch": None, "dirty": None}
    text, ok = write.report("T", [("one", True, df.limit(1)), ("two", False, df.limit(0))], str(tmp_path / "r.md"))
    assert not ok and "- two: FAIL" in text and "| 0 | a\\|b |" in text and (tmp_path / "r.md").read_text(encoding="utf-8") == text
    assert runs.ending(ok, True) == 1 and runs.ending(ok, False) == runs.ending(True, True) == 0
    assert write.stanza("e:a", [("a", "e:T"), ("e:p", write.turtle_text('x "y"\n'))]) == 'e:a\n    a e:T ;\n    e:p "x \\"y\\"\\n" .\n'
    classes = spark.createDataFrame([("http://o#B", "abstract"), ("http://o#A", None)], "class string, stereotype string")
    edges = spark.createDataFrame([("http://o#B", "http://o#A")], "child string, parent string")
    links = spark.createDataFrame([("http://o#A", "http://o#has", "http://o#B")], "domain string, property string, range string")
    assert write.class_diagram(classes, edges, links).split("\n") == ["classDiagram", "    class A", "    class B { <<abstract>> }", "    A <|-- B", "    A --> B : has", ""]
    log = write.logger("orrery-test", str(tmp_path / "log"))
    log.info("said")
    assert (tmp_path / "log").read_text(encoding="utf-8").endswith("INFO said\n")
    stamp = spark.sql("select timestamp '2024-01-02 03:04:05' as t").select(text_functions.iso_stamp("t")).first()[0]
    assert stamp == "2024-01-02T03:04:05Z"
    t = spark.createDataFrame([("a", "p", "o", "iri", None, None), ("b", "p", "o", "iri", None, None)], SCHEMA)
    assert [r.s for r in runs.extract(t, ["b"]).collect()] == ["b"]


def test_windowed_counts(spark, tmp_path):
    from datetime import datetime, timedelta, timezone

    start = datetime(2024, 1, 1, tzinfo=timezone.utc)
    src = str(tmp_path / "in")
    spark.createDataFrame([("a", start + timedelta(minutes=m)) for m in (0, 1, 6, 60)], "k string, ts timestamp").write.parquet(src)
    counts = builders.windowed_counts(spark.readStream.schema("k string, ts timestamp").parquet(src), "ts", "k")
    builders.drained(counts, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert sorted(r.n for r in spark.read.parquet(str(tmp_path / "out")).collect())[-2:] == [1, 2]


def test_provenance_and_stream(spark, tmp_path):
    from datetime import datetime, timezone

    now = datetime(2024, 1, 2, 3, 4, 5, tzinfo=timezone.utc)
    p = runs.provenance(spark, NAMES, now, now, "/in/s.csv", [runs.Output("o", "out", "/out/o.ttl")], 5, 9, git={"commit": "c0", "dirty": False})
    f = facts(p)
    run = f"{D}pipeline_run_2024-01-02T03-04-05Z"
    assert (run, f"{D}dataTripleCount", "9") in f and (f"{D}git_c0", f"{T}dirty", "false") in f
    assert (f"{D}o", f"{triples.PROV}wasDerivedFrom", "file:///in/s.csv") in f
    assert runs.upstream(p, "s.csv")[0] == run
    src = str(tmp_path / "in")
    spark.createDataFrame([(1, "a", now), (1, "a", now), (2, "b", now)], "id long, n string, ts timestamp").write.parquet(src)
    stream = spark.readStream.schema("id long, n string, ts timestamp").parquet(src)
    out = builders.fact_stream(stream, lambda df: [triples.lit(F.col("id").cast("string"), "p", F.col("n"))], "ts")
    builders.drained(out, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
