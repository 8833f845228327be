"""The corpus pipeline: documents that pass quality, toxicity, near-duplicate and benchmark checks, packed for training.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns the columns of
`documents`, but for the last one, which returns the packed pieces. Every stage's output is written as Parquet in the
shared folder and read again.

A decision is about a doc_id: rows that repeat one go or stay together, and go if one of them is to go. Rows without a
doc_id can't be named in a decision and stay. Null and empty texts are of good quality, not toxic, nobody's copy and clean,
so they reach packing (as an end token alone). Columns beside those of `documents` are carried along, but for packing.
Every stage takes empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orrery.llm import decontam, jaccard, kneser, packing, toxicity
from orrery.llm.common import scratch, table
from orrery.llm.queries import vocabulary

#: Near duplicates: shingles of this many words, linked from this Jaccard similarity in percent.
WIDTH, PERCENT = 5, 80


def without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows of docs whose doc_id isn't in `rejected`; rows without a doc_id stay."""
    return docs.join(rejected.select("doc_id").where("doc_id is not null").distinct(), "doc_id", "left_anti").select(*docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps; without a good label all of them."""
    return without(docs, kneser.classify(docs, table(spark, sf_dir, "labels")).where("not keep"))


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold; without labels all of them."""
    return without(docs, toxicity.classify(docs, table(spark, sf_dir, "labels")).where("predicted = 1"))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id; a chain of near copies is one group."""
    return without(docs, jaccard.link_components(docs, PERCENT, WIDTH).where("doc_id <> component_id"))


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage within the edit budget of a benchmark item, however long or short."""
    return without(docs, decontam.matches(docs, table(spark, sf_dir, "benchmark")))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, ties on the curve by doc_id."""
    return packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality),
    ("toxicity", clean),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", uncontaminated),
    ("packing", packed),
]

#: SQL expresses none of the first four stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
