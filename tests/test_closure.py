"""Closures by doubling against plain search."""

import random
from collections import deque

import pytest

from orrery.operators import graph


def plain(edges, wanted=None):
    up, out = {}, []
    for c, p in edges:
        if c is not None and p is not None:
            up.setdefault(c, set()).add(p)
    for node in up if wanted is None else [w for w in set(wanted) if w in up]:
        seen, queue = {}, deque([(node, 0)])
        while queue:
            at, d = queue.popleft()
            for p in up.get(at, ()):
                if p not in seen:
                    seen[p] = d + 1
                    queue.append((p, d + 1))
        out += [(node, a, d) for a, d in seen.items()]
    return sorted(out)


def got(spark, edges, wanted=None):
    asked = None if wanted is None else spark.createDataFrame([(w,) for w in wanted], "n string")
    return sorted(map(tuple, graph.closure(spark.createDataFrame(edges, "child string, parent string"), asked).select("node", "ancestor", "depth").collect()))


@pytest.mark.parametrize("seed", range(3))
def test_random_graphs(spark, seed):
    rng = random.Random(seed)
    n = 30
    edges = [(f"n{rng.randrange(n)}", f"n{rng.randrange(n)}") for _ in range(rng.choice([15, 35, 60]))] + [("n1", None), (None, "n2"), ("n3", "n3")]
    assert got(spark, edges) == plain(edges)
    wanted = ["n1", "n1", "n3", "n5", "absent", None]
    assert got(spark, edges, wanted) == plain(edges, wanted)


def test_empty(spark):
    assert got(spark, []) == [] and got(spark, [("a", "b")], []) == []


def test_long_chain_in_few_rounds(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(graph, "stored", lambda df, keep=graph.stored: rounds.append(1) or keep(df))
    n = 10_000
    edges = [(f"n{i}", f"n{i + 1}") for i in range(n)] + [(f"n{n}", "n0")]
    found = graph.closure(spark.createDataFrame(edges, "child string, parent string"), spark.createDataFrame([("n7",)], "n string"))
    assert found.count() == n + 1 and found.where("ancestor = 'n7'").first()["depth"] == n + 1
    assert len(rounds) <= 2 * 15 + 3  # a table of pairs and one of jumps each round
