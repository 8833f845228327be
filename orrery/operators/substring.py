"""Literals that contain a text, by an index of their trigrams.

The index is two stored tables: the distinct literals, lower-cased, with a hash as number, and postings (trigram, number) sorted by
trigram, so that a search reads the row groups of its trigrams only. A search takes the RAREST trigrams of the text by their counts, keeps the
numbers that all of them have, and looks into those literals for the text itself; what the other trigrams or equal hashes let through
is found there, so the answer is exact. A text of fewer than three letters has no trigram and looks into all literals.

Literals, postings and what a search meets are dealt to tasks by their numbers of rows. The graph is read several times, so give a stored one.

Case is ignored as lower-casing does. Null literals contain nothing, the empty text is in all others. A trigram that a third of all
literals have is a long list, which is read by many tasks and used only if no rarer one exists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.operators.graph import stored
from orrery.operators.triples import dealt, tasks

#: Trigrams of a text that a search takes.
RAREST = 4


def trigrams(c: Column) -> Column:
    """The distinct runs of three letters."""
    letters, n = F.split(c, ""), F.size(F.split(c, "")) - 2
    both = lambda a, b: F.concat(a, b)
    runs = F.zip_with(F.zip_with(F.slice(letters, 1, n), F.slice(letters, 2, n), both), F.slice(letters, 3, n), both)
    return F.when(n < 1, F.array().cast("array<string>")).otherwise(F.array_distinct(runs))


class SubstringIndex:
    """An index of the literals of a graph."""

    def __init__(self, triples: DataFrame):
        said = triples.where("o_kind = 'lit' and o is not null").select("o")
        own = dealt(said, said.count(), "o").distinct()
        self.literals = stored(own.select("o", F.lower("o").alias("low"), F.xxhash64(F.lower("o")).alias("number")))
        n = self.literals.agg(F.sum(F.greatest(F.length("low") - 2, F.lit(0)))).first()[0] or 0
        # literals are dealt before they unfold; a text has each trigram once, so only texts of one hash give a pair twice, which a search allows for
        lists = dealt(self.literals.select("low", "number"), n, "number", "low").distinct().select("number", F.explode(trigrams(F.col("low"))).alias("gram"))
        self.postings = stored(lists.repartitionByRange(*([tasks(n)] if tasks(n) > 1 else []), "gram", "number").sortWithinPartitions("gram", "number"))
        self.counts = stored(self.postings.groupBy("gram").agg(F.count("*").alias("n")))

    def counted(self, text: str) -> dict[str, int]:
        """The trigrams to search by and how many literals have them; those that none has come first."""
        spark = self.literals.sparkSession
        own = spark.createDataFrame([(text.lower(),)], "t string").select(F.explode(trigrams(F.col("t"))).alias("gram"))
        return {r["gram"]: r["n"] or 0 for r in own.join(self.counts, "gram", "left").orderBy(F.col("n").asc_nulls_first(), "gram").limit(RAREST).collect()}

    def rarest(self, text: str) -> list[str]:
        return list(self.counted(text))

    def containing(self, text: str) -> DataFrame:
        """(o): the literals with the text."""
        found, grams = self.literals, self.counted(text)
        if grams:
            n = sum(grams.values())
            numbers = dealt(self.postings.where(F.col("gram").isin(*grams)), n, "number").groupBy("number").agg(F.count("*").alias("n")).where(F.col("n") >= len(grams))
            found = dealt(found, n, "number").join(numbers.select("number").hint("shuffle_hash"), "number", "left_semi")
        return found.where(F.contains("low", F.lit(text.lower()))).select("o")

    def statements(self, triples: DataFrame, text: str) -> DataFrame:
        """The triples whose literal contains the text."""
        said = triples.where("o_kind = 'lit'")
        n = said.count()
        # the side that is held is the one of distinct literals: a literal of very many statements passes
        return dealt(said, n, "o").join(dealt(self.containing(text), n, "o").hint("shuffle_hash"), "o", "left_semi").select(*triples.columns)
