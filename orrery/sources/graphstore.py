"""A graph as a table partitioned by predicate and bucketed by subject.

A pattern with a predicate reads that predicate's partition only, and patterns that share their subject are joined bucket by bucket
without a shuffle. Appending is idempotent: only triples that are not there yet are written, so that a run that is repeated, wholly or
after a failure, changes nothing; a write appears as a whole by Spark's committer. The number of buckets is the table's for good: choose it so
that a bucket of the largest predicate fits a task. Data lie in the shared folder under a table name of the session's catalog.

A triple is its six columns, nulls included. A very frequent subject fills one bucket of a predicate; joins of it are split by AQE only where
they shuffle, so graphs whose subjects hold a large part of all triples are better read as they are. An empty graph gives an empty table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orrery.operators.graph import stored
from orrery.operators.triples import COLUMNS
from orrery.sources.write import shared


class GraphStore:
    """Stands where a Graph of tables does: `of` gives the triples with some predicates, or all."""

    def __init__(self, spark: SparkSession, name: str, buckets: int = 64):
        self.spark, self.name, self.buckets = spark, name, buckets

    def _write(self, triples: DataFrame, mode: str, path: str | None = None) -> None:
        # a task holds whole buckets, so that a predicate has one file a bucket and write
        writer = triples.select(*COLUMNS).repartition(self.buckets, "s").write.format("parquet").partitionBy("p").bucketBy(self.buckets, "s").sortBy("s").mode(mode)
        (writer.option("path", path) if path else writer).saveAsTable(self.name)

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def append(self, triples: DataFrame) -> int:
        """Writes the triples that are not there yet; how many they were."""
        new = triples.select(*COLUMNS).distinct()
        if self.exists():
            # only the partitions of predicates that are written are looked at
            there = self.spark.table(self.name).join(new.select("p").distinct(), "p", "left_semi").select(*COLUMNS)
            same = reduce(lambda a, b: a & b, (F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in COLUMNS))
            new = new.alias("a").join(there.alias("b"), (F.col("a.s") == F.col("b.s")) & same, "left_anti").select(*COLUMNS)
        new = stored(new)
        n = new.count()
        if n or not self.exists():
            self._write(new, "append", None if self.exists() else shared(self.spark, "graph"))
        return n

    def of(self, *predicates: str) -> DataFrame:
        table = self.spark.table(self.name).select(*COLUMNS)
        return table.where(F.col("p").isin(*predicates)) if predicates else table

    def join_on_subject(self, *predicates: str) -> DataFrame:
        """(s, o0, o1, ...): the objects of subjects that have all the predicates, joined within buckets."""
        parts = [self.of(p).select("s", F.col("o").alias(f"o{i}")) for i, p in enumerate(predicates)]
        return reduce(lambda a, b: a.join(b, "s"), parts)
