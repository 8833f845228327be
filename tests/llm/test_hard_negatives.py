"""Hard negatives against all products."""

import numpy as np
import pytest

from orrery.llm import negatives

SCHEMA = "vec_id long, embedding array<float>, label int, block string, n int"


def plain(rows, every=100, k=5):
    own = [(i, c, [int(np.floor(256 * float(np.float32(x)))) for x in v]) for i, v, c, *_ in rows if i is not None and c is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    own = [r for r in own if sum(x * x for x in r[2]) < 1 << 62]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, label, v in own:
        if a % every:
            continue
        scored = sorted((-dot(v, w), i, c) for i, c, w in own)
        for s, p, _ in [x for x in scored if x[2] == label and x[1] != a][:k]:
            hard = [x for x in scored if x[2] != label and 80 * -s <= 100 * -x[0] <= 100 * -s][:k]
            out += [(a, p, n + 1, x[1], -s, -x[0]) for n, x in enumerate(hard)]
    return sorted(out)


def got(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    return sorted(map(tuple, negatives.hard_negatives(negatives.quantized(df)).collect()))


def clustered(rng, n, dims, clusters, spread):
    centres = rng.standard_normal((clusters, dims))
    own = rng.integers(0, clusters, n)
    x = centres[own] + spread * rng.standard_normal((n, dims))
    return [(i, (v / np.linalg.norm(v)).tolist(), int(c % 4)) for i, (v, c) in enumerate(zip(x, rng.integers(0, 9, n)))]


@pytest.mark.parametrize("spread", [0.05, 2.0])
def test_rows(spark, monkeypatch, spread):
    monkeypatch.setattr(negatives, "BLOCK", 32)
    monkeypatch.setattr(negatives, "GROUPS", 3)
    rows = clustered(np.random.default_rng(11), 1500, 12, 20, spread)
    assert got(spark, rows) == plain(rows)


def test_keys_exclude_blocks_of_clustered_vectors(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 32)
    rows = clustered(np.random.default_rng(5), 2000, 12, 20, 0.02)
    index = negatives.Index(negatives.quantized(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)), 100)
    from pyspark.sql import functions as F

    goals = index.groups.select("group", F.lit(0).alias("place"), F.lit(0).alias("rank"), F.lit(negatives.FAR).alias("top"), F.lit(60_000).cast("long").alias("low"))
    aimed = index.groups.join(goals.groupBy("group").agg(F.collect_list(F.struct("place", "rank", "top", "low")).alias("goals")), "group")
    assert index.needed(aimed).count() < 0.4 * index.groups.count() * index.store.count()


def test_nothing_that_grows_with_pairs_goes_through_the_driver(spark, monkeypatch, capsys):
    monkeypatch.setattr(negatives, "BLOCK", 32)
    plans, kept = [], negatives.written

    def shown(df, name):
        df.explain()
        plans.append((name, capsys.readouterr().out))
        return kept(df, name)

    monkeypatch.setattr(negatives, "written", shown)
    rows = clustered(np.random.default_rng(7), 600, 8, 10, 0.3)
    out = negatives.hard_negatives(negatives.quantized(spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)))
    shown(out, "out")
    assert {"home", "aimed", "needed", "nearest", "out"} <= {n for n, _ in plans}
    assert not [n for n, p in plans if "Broadcast" in p]


def test_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK", 16)
    rng = np.random.default_rng(3)
    rows = clustered(rng, 300, 3, 3, 0.3)
    same = [0.5, -0.25, 0.125]
    rows += [(1000 + i, same, i % 3) for i in range(200)]  # copies, ties by id
    rows += [(None, same, 1), (400, None, 1), (401, same, None), (500, [0.1, None, 0.2], 1), (600, [float("nan"), 0.0, 0.0], 1), (700, [float("inf"), 0.0, 0.0], 1), (800, [1e30, 0.0, 0.0], 1)]
    rows += [(900, [], 1), (901, [1.0], 1), (902, [-1.0], 2), (2000, [-1.0, 0.5], 9), (100, same, 2), (100, rows[100][1], rows[100][2]), (-100, same, 1), (2100, [0.0, 0.0, 0.0], 0)]
    assert got(spark, rows) == plain(rows)


def test_large_components(spark):
    rows = [(i, [float(3e6 * (i % 7 - 3)), float(2e6 - i)], i % 2) for i in range(0, 400, 4)]
    assert got(spark, rows) == plain(rows)


def test_empty(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
