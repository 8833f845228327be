"""Columns that must not reach the graph: which of their cells are literals of it.

Rows x triples are never compared. The distinct values of the audited columns fill a blocked Bloom filter, made of Spark's
bitmap aggregates: a value has one bitmap of 2^15 bits and BITS bits in it. Bitmaps are broadcast; their number follows that of the values and
ends at BITMAPS (32 MB), beyond which more literals pass that are none of the values. A literal of the graph that the
filter lets through meets the values in an exact join, summed by value before its shuffle, so that no value is hot. The filter only saves
shuffling; it decides nothing.

Cells and literals are compared without the white space at their ends. Empty cells (null, blank, nan) say nothing, nor do values that
a published column holds as well. Only literals count: an IRI that holds a value isn't a statement of it. Empty tables leak nothing, and a
column without values passes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orrery.functions.text import is_empty, strip
from orrery.operators.graph import stored

#: Bits of a bitmap, bits that a value sets, values to a bitmap, most bitmaps.
SIZE, BITS, VALUES, BITMAPS = 1 << 15, 3, 2048, 8192


def cells(source: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, cells): the distinct filled cells of columns, and how often each occurs."""
    every = F.array(*(F.struct(F.lit(c).alias("column"), F.when(~is_empty(F.col(f"`{c}`").cast("string")), strip(F.col(f"`{c}`").cast("string"))).alias("value")) for c in columns))
    return source.select(F.inline(every)).where("value is not null").groupBy("column", "value").agg(F.count("*").alias("cells"))


def _bit(value: Column, i: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(i), value), F.lit(SIZE))


def _bitmap(value: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(n))


def bitmaps(values: DataFrame, n: int) -> DataFrame:
    """(bitmap, bits) of a one-column table of values."""
    value = F.col(values.columns[0])
    bits = values.select(_bitmap(value, n).alias("bitmap"), F.explode(F.array(*(_bit(value, i) for i in range(BITS)))).alias("bit"))
    return bits.groupBy("bitmap").agg(F.bitmap_construct_agg("bit").alias("bits"))


def maybe(rows: DataFrame, value: str, values: DataFrame) -> DataFrame:
    """Rows whose value may be one of `values` (a stored one-column table): all that are, and few others."""
    n = min(BITMAPS, values.count() // VALUES + 1)
    filled = F.broadcast(bitmaps(values, n))
    own = F.col(value)

    def on(i: int) -> Column:
        byte = F.conv(F.hex(F.substring("bits", F.shiftright(_bit(own, i), 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        return byte.bitwiseAND(F.element_at(F.array(*(F.lit(1 << k) for k in range(8))), (F.pmod(_bit(own, i), F.lit(8)) + 1).cast("int"))) != 0

    passed = rows.withColumn("bitmap", _bitmap(own, n)).join(filled, "bitmap")
    for i in range(BITS):
        passed = passed.where(on(i))
    return passed.select(*rows.columns)


def leaks(source: DataFrame, triples: DataFrame, audited: list[str], published: list[str] = ()) -> DataFrame:
    """(column, value, cells, triples): values of audited columns that literals of the graph state."""
    own = cells(source, audited)
    if published:
        own = own.join(cells(source, list(published)).select("value").distinct(), "value", "left_anti")
    own = stored(own.select("column", "value", "cells"))
    literals = triples.where("o_kind = 'lit'").select(strip("o").alias("value")).where("value is not null")
    passed = maybe(literals, "value", stored(own.select("value").distinct()))
    return own.join(passed.groupBy("value").agg(F.count("*").alias("triples")), "value").select("column", "value", "cells", "triples")


def status(source: DataFrame, triples: DataFrame, audited: list[str], published: list[str] = ()) -> DataFrame:
    """(column, filled, leaked, status): how many cells of each audited column are filled, and how many of them the graph states; none may be."""
    filled = cells(source, audited).groupBy("column").agg(F.sum("cells").alias("filled"))
    names = source.sparkSession.createDataFrame([(c,) for c in audited], "column string")
    found = leaks(source, triples, audited, published).groupBy("column").agg(F.sum("cells").alias("leaked"))
    out = names.join(filled, "column", "left").join(found, "column", "left").select("column", F.coalesce("filled", F.lit(0)).alias("filled"), F.coalesce("leaked", F.lit(0)).alias("leaked"))
    return out.withColumn("status", F.when(F.col("leaked") == 0, "PASS").otherwise("FAIL"))
