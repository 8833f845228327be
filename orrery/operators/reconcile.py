"""Reconciling a source table with its graph, an ontology with its use, and documentation with both."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.functions.text import document_tokens, is_empty
from orrery.operators.graph import closure
from orrery.operators.tables import filled_counts
from orrery.operators.triples import RDF, predicate_counts

EXPECTATIONS = "column string, kind string, target string"


def completeness(source: DataFrame, triples: DataFrame, expectations: DataFrame, classes: dict[str, list[str]]) -> DataFrame:
    """(column, kind, expected, found, status) for every column of the source.

    `expectations` tells each column's kind: a predicate on the sites or on their datings ('literal_on_site',
    'literal_on_dating', 'node_link_per_site'; classes names the subjects), identifiers of places
    ('ext_id_on_admin'; target is `label column|namespace`), or one that always passes ('audit_only',
    'match_description_in_rdf', 'skip'). Unknown columns warn.
    """
    spark = source.sparkSession
    filled = filled_counts(source).select("column", F.col("filled").alias("filled"))
    table = filled.join(expectations, "column", "left")
    counts = None
    for kind, own in classes.items():
        one = predicate_counts(triples, own).select(F.lit(kind).alias("kind"), F.col("p").alias("target"), F.col("n").alias("in_graph"))
        counts = one if counts is None else counts.unionByName(one)
    admin = [(r["column"], *r["target"].split("|")) for r in expectations.where("kind = 'ext_id_on_admin'").collect() if r["column"] in source.columns]
    cells = [F.count_distinct(F.when(~is_empty(F.col(f"`{c}`")) & ~is_empty(F.col(f"`{label}`")), F.col(f"`{label}`"))).alias(f"_{i}") for i, (c, label, _) in enumerate(admin)]
    ids = triples.where(F.col("p").endswith("hasExternalIdentifier"))
    nodes = [F.count_distinct(F.when(F.col("o").startswith(ns), F.when(F.contains(F.col("s"), F.lit(f"/{label}_")), F.col("s")))).alias(f"_{i}") for i, (_, label, ns) in enumerate(admin)]
    if admin:
        stacked = f"stack({len(admin)}, {', '.join(f'{c!r}, _{i}' for i, (c, *_) in enumerate(admin))}) as (column, %s)"
        want, have = source.agg(*cells).selectExpr(stacked % "distinct_labels"), ids.agg(*nodes).selectExpr(stacked % "nodes")
    else:
        want, have = (spark.createDataFrame([], f"column string, {c} long") for c in ("distinct_labels", "nodes"))
    out = table.join(counts, ["kind", "target"], "left") if counts is not None else table.withColumn("in_graph", F.lit(None).cast("long"))
    out = out.join(want, "column", "left").join(have, "column", "left")
    is_admin = F.col("kind") == "ext_id_on_admin"
    expected = F.when(is_admin, F.col("distinct_labels")).otherwise(F.col("filled"))
    found = F.when(is_admin, F.col("nodes")).otherwise(F.coalesce("in_graph", F.lit(0)))
    always = F.col("kind").isin("audit_only", "match_description_in_rdf", "skip")
    status = F.when(F.col("kind").isNull(), "WARN").when(always | (expected == found), "PASS").otherwise("FAIL")
    return out.select("column", "kind", expected.alias("expected"), F.when(~always, found).alias("found"), status.alias("status"))


def used_and_declared(used: DataFrame, declared: DataFrame) -> DataFrame:
    """(name, status) of two one-column tables: both, undeclared (fails) or unused (for information)."""
    u, d = used.toDF("name").distinct(), declared.toDF("name").distinct()
    tagged = lambda df, s: df.withColumn("status", F.lit(s))
    return tagged(u.intersect(d), "both").unionByName(tagged(u.exceptAll(d), "undeclared")).unionByName(tagged(d.exceptAll(u), "unused"))


def vocabulary_use(triples: DataFrame, namespace: str) -> tuple[DataFrame, DataFrame]:
    """(classes, properties) of a namespace that a graph uses."""
    own = lambda c: F.col(c).startswith(namespace)
    return triples.where((F.col("p") == f"{RDF}type") & own("o")).select(F.col("o").alias("name")).distinct(), triples.where(own("p")).select(F.col("p").alias("name")).distinct()


def anchored(names: DataFrame, edges: DataFrame, prefix: str) -> DataFrame:
    """(class, anchors, status): whether each class has an ancestor in a namespace."""
    up = closure(edges).where(F.col("ancestor").startswith(prefix)).groupBy("node").agg(F.count("*").alias("anchors"))
    out = names.join(up, names["class"] == up["node"], "left")
    return out.select("class", F.coalesce("anchors", F.lit(0)).alias("anchors"), F.when(F.col("anchors") > 0, "PASS").otherwise("FAIL").alias("status"))


def documented(rows: DataFrame) -> DataFrame:
    """(class, ancestor) of documentation rows (class, cell)."""
    return rows.select("class", F.explode(document_tokens("cell")).alias("ancestor")).distinct()


def drift(said: DataFrame, computed: DataFrame) -> DataFrame:
    """(class, ancestor, status): in both, or only documented, or only computed; a class that one side lacks fails, other differences warn."""
    a, b = said.withColumn("_a", F.lit(True)), computed.withColumn("_b", F.lit(True))
    names = said.select("class").distinct().withColumn("_ca", F.lit(True)).join(computed.select("class").distinct().withColumn("_cb", F.lit(True)), "class", "full_outer")
    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    whole = F.col("_ca").isNull() | F.col("_cb").isNull()
    side = F.when(both, "both").when(F.col("_a").isNotNull(), "documented").otherwise("computed")
    return a.join(b, ["class", "ancestor"], "full_outer").join(names, "class").select("class", "ancestor", side.alias("side"), F.when(both, "PASS").when(whole, "FAIL").otherwise("WARN").alias("status"))
