"""Turtle cut at statements against whole files, and the prefixed sink."""

from pyspark.sql import functions as F

from orrery.operators.triples import SCHEMA, XSD
from orrery.sources import read, write

HEAD = "@prefix e: <http://e/> .\n@prefix x: <http://x#> .\n"
FILES = {
    "plain.ttl": HEAD + "e:a e:p e:b, \"one. two\"@de ;\n  x:q 5.\ne:c a e:K ;\n e:r [ e:s 1 ] , ( e:t 2.5 ) .\n# a comment.\n_:n e:p _:n .\ne:d e:p _:n .\n[] e:p 1 .\n[] e:p 1 .\n",
    "long.ttl": HEAD + 'e:l e:p """A line.\ne:x e:y e:z .\nlast""" .\ne:m e:p "m" .\n',
    "single.ttl": HEAD + "e:s e:p '''A 'quoted' line.\nnext''' .\n",
    "tricky.ttl": HEAD + 'e:u e:p """x.\n" .\n""" .\n',
    "comment.ttl": HEAD + "e:v e:p # a fact.\n e:w .\n",
    "base.ttl": "@base <http://base/> .\n<a> <p> <b> .\n",
    "changed.ttl": "@prefix e: <http://e/> .\ne:a e:p 1 .\n@prefix e: <http://other/> .\ne:a e:p 1 .\n",
    "sparql.ttl": "PREFIX e: <http://e/>\ne:sp e:p true .",
    "none.ttl": "<urn:a> <urn:p> \"x\"^^<urn:t> .\n\n\n",
    "crlf.ttl": "@prefix e: <http://e/> .\r\ne:k e:p e:q .\r\n",
    "empty.ttl": "",
}


def named(rows):
    """Triples with blank nodes all alike."""
    return sorted(repr(tuple("_:" if isinstance(x, str) and x.startswith("_:") else x for x in r)) for r in rows)


def test_pieces_and_whole_files(spark, tmp_path):
    for name, text in FILES.items():
        (tmp_path / name).write_text(text, encoding="utf-8", newline="")
    want = [t for text in FILES.values() for t in read.parse_turtle(text)]
    got = read.turtle(spark, str(tmp_path)).collect()
    assert named(got) == named(want)
    assert len({r["s"] for r in got if r["s"].startswith("_:") and r["o"] == "1" and r["p"] == "http://e/p"}) == 2  # two nodes without a label
    heads = {r["whole"] for r in read.turtle_heads(spark, str(tmp_path / "plain.ttl")).collect()}
    assert heads == {True}
    whole = [n for n in FILES if [r["whole"] for r in read.turtle_heads(spark, str(tmp_path / n)).collect()] == [False]]
    assert whole == ["long.ttl", "single.ttl", "tricky.ttl", "comment.ttl", "base.ttl", "changed.ttl"]


def test_one_file_by_many_tasks(spark, tmp_path):
    n = 30_000
    (tmp_path / "large.ttl").write_text(HEAD + "".join(f"e:s{i} e:p e:o{i % 7} ;\n    x:n {i} .\n" for i in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")
    try:
        assert read._pieces(spark, str(tmp_path)).rdd.getNumPartitions() > 5
        got = read.turtle(spark, str(tmp_path))
        assert got.count() == 2 * n and got.where("p = 'http://x#n'").agg(F.sum(F.col("o").cast("long"))).first()[0] == n * (n - 1) // 2
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_prefixed_parts(spark, tmp_path):
    rows = [("http://e/a", "http://e/p", f"http://e/o{i}", "iri", None, None) for i in range(30)] + [("http://e/a b%20", "http://x#q", 'say "x" ^^<http://e/y>', "lit", None, None), ("urn:z", "http://e/p", "5", "lit", f"{XSD}integer", None), ("http://e/", "http://e/p/q", "t\n.\n", "lit", None, "de")]
    rows += [(f"http://e/s{i}", "http://x#q", str(i), "lit", None, None) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write.turtle(df, str(tmp_path / "out"), {"e": "http://e/", "x": "http://x#", "xsd": XSD})
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    texts = [p.read_text() for p in (tmp_path / "out").glob("part-*") if p.stat().st_size]
    assert len(texts) > 1 and all(t.startswith("@prefix e: <http://e/> .\n") for t in texts) and any("\ne:a e:p e:o0 ;" in t for t in texts) and any('"5"^^xsd:integer' in t for t in texts)
    assert sorted(map(repr, map(tuple, read.turtle(spark, str(tmp_path / "out")).collect()))) == sorted(repr(r) for r in rows)
