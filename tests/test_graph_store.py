"""The graph stored by predicate, and the index of its literals."""

import uuid

import pytest

from orrery.operators import patterns, substring
from orrery.operators.triples import SCHEMA
from orrery.sources.graphstore import GraphStore

ROWS = [(f"urn:s{i}", p, o, "lit", None, lang) for i in range(300) for p, o, lang in (("urn:label", f"Label {i}", "de"), ("urn:kind", f"kind{i % 3}", None), ("urn:n", str(i), None))] + [("urn:s1", "urn:label", "Label 1", "lit", None, None), ("urn:s2", "urn:to", "urn:s1", "iri", None, None)]


@pytest.fixture
def store(spark):
    return GraphStore(spark, f"graph_{uuid.uuid4().hex}", 4)


def test_append_is_idempotent(spark, store):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert store.append(df.where("p <> 'urn:n'").union(df.where("p = 'urn:kind'"))) == 602
    assert store.append(df) == 300 and store.append(df) == 0
    assert sorted(map(repr, map(tuple, store.of().collect()))) == sorted(map(repr, ROWS))
    assert store.append(spark.createDataFrame([("urn:new", "urn:other", "x", "lit", None, None)], SCHEMA)) == 1 and store.of("urn:other").count() == 1


def test_pruned_and_without_exchange(spark, store):
    store.append(spark.createDataFrame(ROWS, SCHEMA))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        both = store.join_on_subject("urn:label", "urn:kind")
        assert both.count() == 301
        plan = both._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan and plan.count("PartitionFilters: [isnotnull(p") == 2
        table = patterns.joined(patterns.match(store, "urn:label", "x", "name"), patterns.match(store, "urn:kind", "x", "kind"))
        assert table.count() == 301 and "Exchange" not in table._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_empty_graph(spark, store):
    assert store.append(spark.createDataFrame([], SCHEMA)) == 0 and store.of().count() == 0
    assert store.append(spark.createDataFrame(ROWS, SCHEMA)) == len(ROWS)


def test_substrings(spark, monkeypatch):
    texts = ["Straße am See", "straßburg", "", "ab", "abc", "xabcx", "ABC", "a.c", "日本語の文章", "語の", "\U0001f600 smile \U0001f600\U0001f601x", None, "x" * 50_000 + "needle", "aaa", "aaaa"]
    df = spark.createDataFrame([("urn:s", "urn:p", t, "lit", None, None) for t in texts] + [("urn:s", "urn:p", "urn:abc", "iri", None, None)], SCHEMA)
    index = substring.SubstringIndex(df)
    for text in ("abc", "ABC", "b", "", "straß", "see", "本語の", "needle", "zzz", "a.c", "aaa", "\U0001f600\U0001f601x", "abcd", "e am s"):
        want = sorted(t for t in texts if t is not None and text.lower() in t.lower())
        assert sorted(r["o"] for r in index.statements(df, text).collect()) == want, text
    assert index.rarest("ab") == [] and "zzz" in index.rarest("xabzzz")
