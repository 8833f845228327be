"""Connected components of a link table by minimum labels with pointer jumping, each round a written table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """(node, component) of every node of (a, b) links: the smallest node that it reaches.

    Each round takes the least label among a node and its neighbours and then the label of that label, so a path of
    n nodes takes about log n rounds. Hubs are combined before they are shuffled and AQE splits their joins.
    """
    links = links.where("a <> b")
    edges = written(links.union(links.select("b", "a")).toDF("a", "b").distinct(), "edges")
    label = edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("component"))
    label = written(label, "labels")
    while True:
        near = edges.join(label.select(F.col("node").alias("b"), F.col("component").alias("c")), "b").groupBy(F.col("a").alias("node")).agg(F.min("c").alias("c"))
        step = written(label.join(near, "node").select("node", F.col("component").alias("old"), F.least("component", "c").alias("c")), "labels")
        jump = step.select(F.col("node").alias("c"), F.col("c").alias("further"))
        label = written(step.join(jump, "c", "left").select("node", "old", F.coalesce("further", "c").alias("component")), "labels")
        if label.where("old <> component").isEmpty():
            return label.select("node", "component")
        label = label.select("node", "component")
