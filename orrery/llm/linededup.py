"""Lines that many documents share, kept in one of them.

A line's key is the line without white space (x20, x09-x0D) at its ends, A-Z lower-cased. Keys of at least `least_chars` code
points that at least `least_docs` documents hold lose their lines everywhere but in the largest doc_id that holds them.

The plan is JVM expressions throughout. A first pass counts 64-bit hashes of the distinct keys of each row: a hash with too
few rows is no shared line's, whatever collides. Only the lines of the hashes that are left go on, with 128 bits, the place in
their text and no text, to count distinct documents. A document then meets the sorted places of its dropped lines and is
put together from the runs between them, in time linear in its lines. A line that a third of all documents hold is summed
before each shuffle, and the join that spreads its decision is broadcast up to `SENT` keys, else split by AQE.

A document is a doc_id: rows that repeat one count as one document and keep or lose a key together. Rows without a doc_id
count for nothing and keep all lines. Null text is empty, and empty text is one empty line. Columns other than doc_id and
text are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import texts, written

SPACE = "\t\n\x0b\x0c\r "
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Keys that are sent to every executor; more are joined by shuffle, with the same result.
SENT = 500_000


def keys(text: Column) -> Column:
    """The key of each line."""
    folded = F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.transform(F.split(folded, "\n", -1), lambda line: F.btrim(line, F.lit(SPACE)))


def long_keys(text: Column, least_chars: int) -> Column:
    return F.filter(keys(text), lambda k: F.length(k) >= least_chars)


def _sent(df: DataFrame) -> DataFrame:
    """A stored table, marked as broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= SENT else df


def shared_lines(docs: DataFrame, least_chars: int = 20, least_docs: int = 3) -> DataFrame:
    """(doc_id, stamp, line): the places, from 0, of the lines that go; `stamp` tells apart texts that share a doc_id."""
    rows = texts(docs.where("doc_id is not null")).withColumn("stamp", F.xxhash64("text"))
    often = (
        rows.select(F.explode(F.array_distinct(F.transform(long_keys(F.col("text"), least_chars), lambda k: F.xxhash64(k)))).alias("h"))
        .groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") >= least_docs).select("h")
    )
    often = written(often, "often")
    lines = rows.select("doc_id", "stamp", F.posexplode(keys(F.col("text"))).alias("line", "key")).where(F.length("key") >= least_chars)
    lines = lines.select("doc_id", "stamp", "line", F.xxhash64("key").alias("h"), F.xxhash64(F.lit(13), "key").alias("g"))
    hits = written(lines.join(_sent(often), "h"), "hits")
    of = hits.groupBy("h", "g", "doc_id").agg(F.lit(1).alias("one")).groupBy("h", "g").agg(F.count("*").alias("n"), F.max("doc_id").alias("last"))
    shared = written(of.where(F.col("n") >= least_docs).select("h", "g", "last"), "shared")
    return hits.join(_sent(shared), ["h", "g"]).where("doc_id < last").select("doc_id", "stamp", "line")


def dedup_lines(docs: DataFrame, least_chars: int = 20, least_docs: int = 3) -> DataFrame:
    """(doc_id, n_lines, n_dropped, kept): `kept` is the text without its dropped lines."""
    gone = shared_lines(docs, least_chars, least_docs).groupBy("doc_id", "stamp").agg(F.sort_array(F.collect_set("line")).alias("gone"))
    rows = texts(docs).withColumn("stamp", F.xxhash64("text")).join(gone, ["doc_id", "stamp"], "left")
    lines = F.split("text", "\n", -1)
    starts = F.concat(F.array(F.lit(0)), F.transform("gone", lambda i: i + 1))
    runs = F.zip_with(starts, F.concat("gone", F.array(F.size("lines"))), lambda a, b: F.slice("lines", a + 1, b - a))
    return rows.withColumn("lines", lines).select(
        "doc_id",
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(F.flatten(runs), "\n")).alias("kept"),
    )
