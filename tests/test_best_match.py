"""The pruned best match against all comparisons."""

import random

import pytest
from pyspark.sql import functions as F

from orrery.functions import lcs
from orrery.operators import matching


def ratio(a, b):
    a, b = (" ".join(sorted(t.split())) for t in (a, b))
    rows = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            rows[j + 1], last = last + 1 if x == y else max(rows[j], rows[j + 1]), rows[j + 1]
    total = len(a) + len(b)
    return 10_000 if not total else (40_000 * rows[-1] + total) // (2 * total)


def plain(values, labels):
    out = []
    for raw, scope in values:
        found = [(ratio(raw.lower().strip(), k), -o, k) for k, o, s in labels if s == scope]
        best = max(found, default=(None, None, None))
        out.append((raw, scope, best[2], best[0]))
    return sorted(out, key=repr)


def index(spark, labels):
    df = spark.createDataFrame([(k, f"Q{o}", k, "rdfs:label", o, s) for k, o, s in labels], "key string, qid string, label string, source string, ord long, scope string")
    return df


def got(spark, values, labels, scope=("scope",)):
    df = spark.createDataFrame([(r, r, "", s) for r, s in values], "raw string, name string, note string, scope string")
    found = matching.best_match(df, index(spark, labels), list(scope), 0.0)
    return sorted(((r["raw"], r["scope"] if scope else "", r["match_label"], None if r["score"] is None else round(r["score"] * 10_000)) for r in found.collect()), key=repr)


def words(rng, n):
    letters = "abcdefghijklmnopqrstuvwxyzäöü -"
    return ["".join(rng.choices(letters, k=rng.choice([1, 2, 3, 5, 8, 13, 21]))).strip() for _ in range(n)]


@pytest.mark.parametrize("small", [True, False])
def test_scopes(spark, monkeypatch, small):
    if small:
        for name, n in (("BLOCK", 16), ("VALUES", 4), ("SMALL_INDEX", 10)):
            monkeypatch.setattr(matching, name, n)
    rng = random.Random(8)
    labels = list({(k, s): (k, i, s) for i, k in enumerate(words(rng, 260)) for s in [rng.choice("AAAB")]}.values()) + [("x" * 150 + "y", 900, "A"), ("x" * 150 + "z", 899, "A"), ("", 901, "B")]
    values = [(v, rng.choice("AABC")) for v in words(rng, 60)] + [("x" * 150, "A"), ("", "B"), ("b a", "A"), ("a b", "A")]
    values = list(dict.fromkeys(values))
    assert got(spark, values, labels) == plain(values, labels)
    one, all_ = [(v, "") for v in dict.fromkeys(v for v, _ in values[:20])], [(k, o, "") for k, o in {k: o for k, o, _ in labels}.items()]
    assert got(spark, one, all_, ()) == plain(one, all_)


def test_few_comparisons_in_a_hot_scope(spark):
    rng = random.Random(9)
    labels = [(f"{w} {i}", i, "A" if i % 3 else "B") for i, w in enumerate(words(rng, 3000))]
    values = [(k[:-1] + "x", s) for k, _, s in rng.sample(labels, 60)]
    asked = spark.createDataFrame(values, "_query string, scope string").distinct().withColumn("_a", F.col("_query"))
    found = matching.searched(asked, index(spark, labels).withColumn("_b", F.col("key")), ["scope"])
    every = sum(s == t for _, s in values for _, _, t in labels)
    assert found.agg(F.sum("compared")).first()[0] < 0.2 * every


def test_labels_of_one_length_reach_tasks_once(spark, monkeypatch):
    """Not once for each group of values: what a batch of rows holds is bounded by the labels."""
    monkeypatch.setattr(matching, "BLOCK", 64)
    monkeypatch.setattr(matching, "VALUES", 4)
    rng = random.Random(10)
    labels = [(f"customer#{i:09d}", n, "A") for n, i in enumerate(rng.sample(range(10**6), 600))]
    asked = spark.createDataFrame([(f"supplier#{i:09d}", "A") for i in rng.sample(range(10**6), 40)], "_query string, scope string").withColumn("_a", F.col("_query"))
    sent, kept = [], type(asked).mapInArrow

    def seen(df, *args, **more):
        sent.append(df.agg(F.sum(F.greatest(F.size("labels"), F.lit(0)))).first()[0])
        return kept(df, *args, **more)

    monkeypatch.setattr(type(asked), "mapInArrow", seen)
    found = matching.searched(asked, index(spark, labels).withColumn("_b", F.col("key")), ["scope"])
    assert found.select("_query").distinct().count() == 40 and sent and max(sent) <= 600


def test_bounds():
    rng = random.Random(1)
    block = lcs.Block(words(rng, 50) + ["", "a" * 200])
    for text in words(rng, 20) + ["", "a" * 300]:
        import numpy as np

        at = np.arange(len(block.texts))
        assert (block.lengths(text, at) <= block.bounds(lcs.histogram([text])[0])).all()


def test_few_comparisons_of_numbers(spark):
    """Labels of one length that differ in digits only, where letter classes exclude next to nothing: beginnings are compared once for all labels that have them."""
    rng = random.Random(11)
    labels = [(f"customer#{i:09d}", i, "A") for i in rng.sample(range(150_000), 6000)]
    asked = spark.createDataFrame([(f"supplier#{i:09d}", "A") for i in rng.sample(range(10_000), 40)], "_query string, scope string").withColumn("_a", F.col("_query"))
    found = matching.searched(asked, index(spark, labels).withColumn("_b", F.col("key")), ["scope"])
    assert found.agg(F.sum("compared")).first()[0] < 0.05 * 40 * 6000


def test_numbers_in_several_blocks(spark, monkeypatch):
    """Many labels have the best score; the first of them may lie in any block."""
    for name, n in (("BLOCK", 64), ("VALUES", 8)):
        monkeypatch.setattr(matching, name, n)
    rng = random.Random(12)
    labels = [(f"customer#{i:09d}", n // 2, rng.choice("AB")) for n, i in enumerate(rng.sample(range(3000), 500))]
    values = [(f"supplier#{i:09d}{at}", s) for i in rng.sample(range(3000), 15) for at in ("", " bei nation_12", " #" * 40) for s in "AB"]
    assert got(spark, values, labels) == plain(values, labels)


@pytest.mark.parametrize("width", [1, 2, 8])
@pytest.mark.parametrize("shared", [0, 0.4, 2])
def test_index_of_texts(monkeypatch, width, shared):
    """With and without trees, however few nodes are kept at first, the best text and the first of equals."""
    import numpy as np

    for name, n in (("WIDTH", width), ("GROWTH", 2), ("PAIRS", 16), ("SHARED", shared)):
        monkeypatch.setattr(lcs.Index, name, n)
    rng = random.Random(13)
    say = lambda letters, n: "".join(rng.choices(letters, k=rng.choice(n)))
    texts = [rng.choice(["customer#", "x", "aa é "]) + say("0123", [3, 4, 5]) for _ in range(150)]
    values = ["supplier#" + say("0123", [0, 4, 5]) for _ in range(15)] + ["bei nation_2 supplier#" + say("0123", [5]) for _ in range(5)] + ["", "zzz", "c" * 70, "0" * 80, "😀é"]
    ranks = rng.sample(range(len(texts)), len(texts))
    least, below = ([rng.choice(x) for _ in values] for x in ([0, 5000, 8000], [0, 75, 1000]))
    points, found, _ = lcs.Index(texts, ranks).best(values, np.array(least), np.array(below))
    for i, v in enumerate(values):
        every = [(ratio_of(v, t), -r) for t, r in zip(texts, ranks)]
        best = max((x for x in every if x[0] > least[i] or (x[0] == least[i] and -x[1] < below[i])), default=(least[i], 1))
        assert (points[i], found[i]) == (best[0], -best[1])


def ratio_of(a, b):
    return int(lcs.points([lcs.length(a, b)], [len(a) + len(b)])[0])
