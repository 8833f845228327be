"""Quality classifier: an interpolated modified Kneser-Ney n-gram model of trusted text.

The tokens are characters, any code point, with one symbol more for a word that repeats the word before it; the model's
base is uniform over all of them. Trusted rows are all those that labels call good. Their
n-gram counts are aggregated natively, sharded by n-gram; counts of counts give the discounts; continuation counts come
from the next order's table. Each order has a table of discounted shares by n-gram and one of freed shares by context.

A document's n-grams meet these tables in joins, from the highest order to the lowest, and its bits are summed. So that
most need no shuffle, n-grams of the trusted text's ALPHABET most frequent symbols are looked up in a dense table of what
the joins would give; it is bounded by ALPHABET ** ORDER and sent out. Which way an n-gram goes changes no result.

A document's score is its bits per character. A document is rejected when its bits lie beyond a band of quantiles
of the trusted documents of its language, plus z standard errors (short texts vary more). Languages with fewer than MIN_ROWS trusted rows (null is a language) use the band
of all rows. Empty and null texts have no characters, no perplexity, and are kept; so is every row if nothing is trusted. Rows that
repeat a doc_id or lack one are judged each; a text of any length is scored whole; a score on the band's end is kept. Columns
other than doc_id, text, lang and the labels' quality are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import discard, texts, trim, written

#: The order, and the symbols of the dense table.
ORDER, ALPHABET = 3, 128
MIN_ROWS = 30
#: Ids of trusted rows that are sent out instead of joined.
SENT_IDS = 200_000
#: Stands for a repeated word: a code point that is no character.
DITTO = "\U0010ffff"
#: Begins and ends a text: beyond all code points. Bits of a symbol; number of symbols.
END, SYMBOL, SYMBOLS = 0x110000, 21, 0x110001
LOW, HIGH, Z = 0.005, 0.995, 3.0
#: N-grams that a task counts before it sums them up.
CHUNK = 4_000_000


def ditto(text: str) -> str:
    """`text` with DITTO for each word that repeats the one before it: a repetition is an event that the model can find rare."""
    w = text.split(" ")
    if not any(map(eq, w, w[1:])):
        return text
    return w[0] + "".join(DITTO if a and a == b else " " + a for a, b in zip(w[1:], w))


def symbols(text: str) -> np.ndarray:
    """The symbols of a text, with what begins and ends it."""
    points = np.frombuffer(ditto(text).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.int64)
    return np.concatenate([np.full(ORDER - 1, END), points, [END]])


def grams(s: np.ndarray) -> np.ndarray:
    """Numbers of the n-grams of symbols, each ending at a character or at the end."""
    out = np.zeros(len(s) - ORDER + 1, np.int64)
    for i in range(ORDER):
        out = out << SYMBOL | s[i : len(s) - ORDER + 1 + i]
    return out


@dataclass
class Model:
    """Of each order from 1 on a table (gram, own) and one (context, backoff); the dense table and the symbols' places in it (ALPHABET: none)."""

    tables: list[tuple[DataFrame, DataFrame]]
    places: np.ndarray
    logs: np.ndarray


@dataclass
class Dense:
    """What tasks need of a model."""

    places: np.ndarray
    logs: np.ndarray
    size: int  # symbols

    def bits(self, text: str) -> tuple[float, float, int, np.ndarray, np.ndarray]:
        """Sum and sum of squares of the bits of the characters that the dense table knows, the number of all, and the other n-grams with their counts."""
        s = symbols(text)
        at = self.places[s].astype(np.int64)
        n = len(s) - ORDER + 1
        place, known = np.zeros(n, np.int64), np.ones(n, bool)
        for i in range(ORDER):
            place = place * self.size + at[i : n + i]
            known &= at[i : n + i] < self.size
        if known.all():
            b, rare, times = self.logs[place].astype(np.float64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        else:
            b = self.logs[place[known]].astype(np.float64)
            rare, times = np.unique(grams(s)[~known], return_counts=True)
        return float(b.sum()), float((b * b).sum()), n, rare, times


def trusted_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts of all rows whose label is good."""
    good = written(labels.where("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct(), "kn-trusted")
    return texts(docs).join(F.broadcast(good) if good.count() <= SENT_IDS else good, "doc_id", "left_semi")


def counts(rows: DataFrame) -> DataFrame:
    """(gram, n): counts of the highest order, combined within tasks and then sharded by n-gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def summed():
            found, n = np.unique(np.concatenate(held), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], names=["gram", "n"])

        for b in batches:
            for t in b.column(0).to_pylist():
                held.append(grams(symbols(t)))
                size += len(held[-1])
                if size > CHUNK:
                    yield summed()
                    held, size = [], 0
        if held:
            yield summed()
        trim()

    return rows.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def discounts(table: DataFrame) -> list[float]:
    """D1, D2 and D3+ of Chen and Goodman from counts of counts."""
    n1, n2, n3, n4 = table.agg(*(F.count_if(F.col("n") == i).alias(f"n{i}") for i in (1, 2, 3, 4))).first()
    if not n1 or not n2:
        return [0.5, 0.75, 0.9]
    y = n1 / (n1 + 2 * n2)
    d = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3 if n3 else 0.9]
    return [min(max(x, 0.05), i + 0.95) for i, x in enumerate(d)]


def train(docs: DataFrame, labels: DataFrame) -> Model | None:
    """The model; None if no row is trusted."""
    full = written(counts(trusted_rows(docs, labels)), "kn")
    if full.isEmpty():
        return None
    # continuation counts: how many left neighbours an (n - 1)-gram follows
    # every order and its contexts are stored: what is read several times is counted once, and the driver keeps book of fewer tasks
    orders = [full]
    for n in range(ORDER - 1, 0, -1):
        orders.append(written(orders[-1].groupBy(F.col("gram").bitwiseAND(F.lit((1 << n * SYMBOL) - 1)).alias("gram")).agg(F.count("*").alias("n")), "kn"))
    tables = []
    for t in reversed(orders):
        d1, d2, d3 = discounts(t)
        t = t.withColumns({"context": F.shiftright("gram", SYMBOL), "less": F.when(F.col("n") == 1, d1).when(F.col("n") == 2, d2).otherwise(d3)})
        of = written(t.groupBy("context").agg(F.sum("n").alias("total"), F.sum("less").alias("freed")), "kn-context")
        own = written(t.join(of, "context").select("gram", ((F.col("n") - F.col("less")) / F.col("total")).alias("own")), "kn-own")
        tables.append((own, of.select("context", (F.col("freed") / F.col("total")).alias("backoff"))))
    # the most frequent symbols by continuation counts, and what begins a text
    top = [r["gram"] for r in orders[-1].where(F.col("gram") != END).orderBy(F.desc("n"), "gram").limit(ALPHABET - 1).collect()]
    discard(*orders)
    places = np.full(SYMBOLS, ALPHABET, np.uint8)
    places[[END, *top]] = np.arange(len(top) + 1)
    model = Model(tables, places, -np.log2(dense(tables, [END, *top])).astype(np.float32))
    trim()
    return model


def dense(tables: list[tuple[DataFrame, DataFrame]], top: list[int]) -> np.ndarray:
    """Probabilities of all n-grams of ALPHABET symbols (those of `top`), by place."""
    place = np.zeros(SYMBOLS, np.int64)
    place[top] = np.arange(len(top))
    symbol = (1 << SYMBOL) - 1

    def placed(df: DataFrame, column: str, value: str, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and values of the n-grams that have only such symbols: at most ALPHABET ** n."""
        for i in range(n):
            df = df.where(F.shiftright(column, i * SYMBOL).bitwiseAND(F.lit(symbol)).isin(top))
        rows = df.select(column, value).toArrow()
        gram, at = rows[column].to_numpy(), 0
        for i in reversed(range(n)):
            at = at * ALPHABET + place[gram >> i * SYMBOL & symbol]
        return at, rows[value].to_numpy()

    p = np.full(1, 1 / SYMBOLS)
    for n, (own, backoff) in enumerate(tables, 1):
        freed = np.ones(ALPHABET ** (n - 1))
        if n == 1:
            freed[0] = backoff.first()["backoff"]
        else:
            at, shares = placed(backoff, "context", "backoff", n - 1)
            freed[at] = shares
        # an n-gram falls back on its last n - 1 symbols
        p = np.repeat(freed, ALPHABET) * (np.tile(p, ALPHABET) if n > 1 else np.full(ALPHABET, p[0]))
        at, shares = placed(own, "gram", "own", n)
        p[at] += shares
    return p


def probabilities(found: DataFrame, tables: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(gram, p) of distinct n-grams of the highest order, by joins with the counts' tables."""
    p = F.lit(1 / SYMBOLS)
    out = found.select("gram")
    for n, (own, backoff) in enumerate(tables, 1):
        out = out.withColumn("g", F.col("gram").bitwiseAND(F.lit((1 << n * SYMBOL) - 1))).withColumn("c", F.shiftright("g", SYMBOL))
        out = out.join(own.select(F.col("gram").alias("g"), "own"), "g", "left")
        out = out.join(backoff.select(F.col("context").alias("c"), "backoff"), "c", "left")
        out = out.select("gram", *([F.col("p")] if n > 1 else []), F.coalesce("own", F.lit(0.0)).alias("own"), F.coalesce("backoff", F.lit(1.0)).alias("backoff"))
        out = out.select("gram", (F.col("own") + F.col("backoff") * p).alias("p"))
        p = F.col("p")
    return out


def perplexities(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang, n, bits, spread): bits per character and their standard deviation."""
    sent = docs.sparkSession.sparkContext.broadcast(Dense(model.places, model.logs, ALPHABET))
    keep = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    entry = pa.struct([("gram", pa.int64()), ("times", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in batches:
            total, square, n, rare = [], [], [], []
            for t in b.column(2).to_pylist():
                s, q, k, g, times = m.bits(t) if t else (0.0, 0.0, 0, (), ())
                total.append(s)
                square.append(q)
                n.append(k)
                rare.append([{"gram": int(x), "times": int(y)} for x, y in zip(g, times)])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(total, pa.float64()), pa.array(square, pa.float64()), pa.array(rare, pa.list_(entry))], names=["doc_id", "lang", "n", "total", "square", "rare"])
        trim()

    first = written(keep.mapInArrow(run, "doc_id long, lang string, n long, total double, square double, rare array<struct<gram: long, times: long>>").withColumn("row", F.monotonically_increasing_id()), "bits")
    asked = first.select("row", F.inline("rare"))
    bits = -F.log2("p")
    met = asked.join(probabilities(asked.select("gram").distinct(), model.tables), "gram").groupBy("row").agg(F.sum(F.col("times") * bits).alias("more"), F.sum(F.col("times") * bits * bits).alias("more_square"))
    whole = first.drop("rare").join(met, "row", "left")
    zero, n = F.lit(0.0), F.nullif("n", F.lit(0))
    mean = (F.col("total") + F.coalesce("more", zero)) / n
    spread = F.sqrt(F.greatest((F.col("square") + F.coalesce("more_square", zero)) / n - mean * mean, zero))
    return whole.select("doc_id", "lang", "n", mean.alias("bits"), F.when(n.isNotNull(), spread).alias("spread"))


def classify(docs: DataFrame, labels: DataFrame, low: float = LOW, high: float = HIGH, z: float = Z) -> DataFrame:
    """(doc_id, lang, n_chars, perplexity, low, high, keep) for every row of docs, in bits where not named otherwise."""
    model = train(docs, labels)
    if model is None:
        return texts(docs, "doc_id", "text", "lang").select("doc_id", "lang", F.char_length("text").cast("long").alias("n_chars"), *(F.lit(None).cast("double").alias(c) for c in ("perplexity", "low", "high")), F.lit(True).alias("keep"))
    scored = written(perplexities(docs, model), "quality")
    good = labels.where("quality = 1").select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    seen = scored.where("n > 0").join(good, "doc_id", "left_semi")
    ends = [F.percentile_approx("bits", F.array(F.lit(low), F.lit(high)), 10_000).alias("ends"), F.count("*").alias("rows")]
    every = seen.agg(*ends).first()
    # one row a language that labels hold; languages are few, and beyond the check the join is a shuffled one
    bands = seen.groupBy("lang").agg(*ends).where(f"rows >= {MIN_ROWS}").select(F.col("lang").alias("l"), "ends")
    out = scored.join(bands, F.col("lang").eqNullSafe(F.col("l")), "left")
    default = F.array(*(F.lit(x) for x in every["ends"])) if every["ends"] else F.lit(None).cast("array<double>")
    ends = F.coalesce("ends", default)
    error = F.lit(z) * F.col("spread") / F.sqrt("n")
    keep = F.coalesce((F.col("bits") <= ends[1] + error) & (F.col("bits") >= ends[0] - error), F.lit(True))
    return out.select("doc_id", "lang", F.greatest(F.col("n") - 1, F.lit(0)).alias("n_chars"), F.pow(F.lit(2.0), "bits").alias("perplexity"), F.round(ends[0], 6).alias("low"), F.round(ends[1], 6).alias("high"), keep.alias("keep"))
