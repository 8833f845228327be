"""Closures, chains and roots of edge tables."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def stored(df: DataFrame) -> DataFrame:
    """Cuts the lineage of an iteration by a table in the shared folder; where none is named, the plan is cached, and lost executors mean that it is computed again."""
    base = df.sparkSession.conf.get("spark.checkpoint.dir", None)
    if not base:
        return df.cache()
    path = f"{base.rstrip('/')}/step-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rounds whose pairs stay tables of their own before they are written as one.
PARTS = 8


def closure(edges: DataFrame, wanted: DataFrame | None = None) -> DataFrame:
    """(node, ancestor, depth): everything that one or more (child, parent) edges reach; a node only reaches itself on a cycle.

    With `wanted` (one column of nodes) only from those. Paths double: after round k all pairs up to 2^k edges apart are known, and a
    table of jumps holds the pairs that walks of exactly 2^k edges join, so that the rounds are the logarithm of the depth.
    A round that finds nothing new ends it, as a longer shortest path would have a part of any shorter length. Each round writes
    only what is new. The depth is the least one; there is no limit to it.
    """
    jumps = stored(edges.select(F.col("child").alias("low"), F.col("parent").alias("high")).where("low is not null and high is not null").distinct())
    front = jumps.select(F.col("low").alias("node"), F.col("high").alias("ancestor"), F.lit(1).alias("depth"))
    if wanted is not None:
        front = front.join(wanted.toDF("node").distinct(), "node", "left_semi")
    parts, length = [front], 1
    while True:
        found = reduce(DataFrame.unionByName, parts)
        step = found.join(jumps, found["ancestor"] == jumps["low"]).groupBy("node", F.col("high").alias("ancestor")).agg((F.min("depth") + length).alias("depth"))
        front = stored(step.join(found, ["node", "ancestor"], "left_anti"))
        if front.isEmpty():
            return found
        parts = [*parts, front] if len(parts) < PARTS else [stored(found.unionByName(front))]
        length *= 2
        on = jumps.select(F.col("low").alias("mid"), F.col("high").alias("top"))
        jumps = stored(jumps.join(on, jumps["high"] == on["mid"]).select("low", F.col("top").alias("high")).distinct())


def nearest(edges: DataFrame, prefixes: list[str]) -> DataFrame:
    """(node, ancestor, depth): the closest ancestor whose IRI has one of the prefixes; ties go to the smallest IRI."""
    anchored = closure(edges).where(" or ".join(f"startswith(ancestor, '{p}')" for p in prefixes))
    return anchored.groupBy("node").agg(F.min(F.struct("depth", "ancestor")).alias("m")).select("node", "m.ancestor", "m.depth")


def chain(edges: DataFrame, prefixes: list[str], most: int = 20) -> DataFrame:
    """(node, path): one walk up from each node, at each step to a parent with a prefix if there is one, else the smallest; at most `most` steps."""
    good = F.lit(False)
    for p in prefixes:
        good = good | F.col("parent").startswith(p)
    step = edges.groupBy("child").agg(F.min(F.struct((~good).alias("other"), "parent")).alias("m")).select("child", F.col("m.parent").alias("parent"))
    step = stored(step)
    nodes = step.select(F.col("child").alias("node"), F.array("child").alias("path"), F.col("child").alias("at"))
    for _ in range(most):
        nodes = stored(nodes.join(step, nodes["at"] == step["child"], "left").select("node", F.when(F.col("parent").isNotNull() & ~F.array_contains("path", F.col("parent")), F.concat("path", F.array("parent"))).otherwise(F.col("path")).alias("path"), F.when(~F.array_contains("path", F.col("parent")), F.col("parent")).alias("at")))
        if nodes.where("at is not null").isEmpty():
            break
    return nodes.select("node", "path")


def roots(activities: DataFrame, informed: DataFrame) -> DataFrame:
    """Activities that nothing informed: never the subject of an informed-by edge."""
    return activities.join(informed.select(F.col("s").alias("activity")).distinct(), "activity", "left_anti")


def root(activities: DataFrame, informed: DataFrame) -> DataFrame:
    """The one with the earliest start (as text), else the smallest IRI."""
    return roots(activities, informed).orderBy(F.col("started").asc_nulls_last(), "activity").limit(1)
