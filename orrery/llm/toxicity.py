"""Toxicity by the nearest labelled examples under exact TF-IDF cosine, from a block-max inverted index.

Fit: a bounded sample of labelled rows (EXAMPLES) outside the held-out fold. Terms are ASCII-lower-cased runs of
letters and digits; all that two examples or more hold are in the vocabulary. A term's weight in a text is
(1 + log tf) * idf * rf ** 2, where rf = log2(2 + a / max(1, c)) is the relevance frequency of Lan et al.: a toxic
examples (as many as begin, and as end, in different terms, so that copies of one text don't count) and c others hold
the term. Without it neighbours are those of a text's rare words (README). Equal and nearly equal examples (cosine
NEAR or more to one of their neighbours) are one example with their mean label.

The index: terms that few examples hold have postings; those that many hold have a weight for every example and, for
each block of BLOCK examples, the largest one. Search: the postings of rare terms are summed for all examples; a block's
bound is its best sum and the block maxima of the text's other terms; the blocks of the highest bounds are opened, then all
others that may beat the k-th best cosine, so the k nearest are exact (cosines are rounded to 6 places). Their votes, weighted by squared cosine and shrunk towards the prior,
are calibrated by isotonic regression on the examples' own votes without themselves. All neighbours are kept as evidence,
and a text's terms of most weight. The index is bounded by EXAMPLES, so it is broadcast; documents are not shuffled.

Null and empty texts and those without a known term get the rate among such examples. Without any usable label every
score is 0. A doc_id with several labels is toxic if one is; rows that repeat a doc_id or lack one are scored each; ties go
to the lower example; texts of any length are taken whole. Columns other than doc_id and text (and the labels' toxic)
are not read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import arrow_rows, discard, hashed_sample, held_out, texts, trim, written

EXAMPLES, BLOCK, NEIGHBOURS = 4_096, 64, 15
#: Least number of examples that hold a term of the vocabulary; share of them from which a term's weights are dense.
LEAST_DF, DENSE = 2, 1 / 16
#: Weight of the prior; cosine from which two examples are one; terms of evidence.
PRIOR, NEAR, EVIDENCE = 0.5, 0.9, 10
#: Blocks opened first; blocks above which all are summed at once.
OPENED, MANY = 4, 12
FOLD, THRESHOLD = 4, 0.3

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))

#: Terms and their counts, by term.
Vector = tuple[Sequence[int] | np.ndarray, Sequence[int] | np.ndarray]
Unit = tuple[np.ndarray, np.ndarray]


def terms(text: str | None) -> list[bytes]:
    return text.encode().translate(_FOLD).split() if text else []


def packed(numbers: Sequence[int]) -> bytes:
    """Numbers of 4 bytes, which are ordered as they are."""
    return np.array(numbers, ">i4").tobytes()


def unpacked(vector: tuple[bytes, bytes]) -> Vector:
    t, n = (np.frombuffer(x, ">i4").astype(np.int64) for x in vector)
    return t, n


@dataclass
class Terms:
    """The vocabulary and its weights."""

    number: dict[bytes, int]
    weight: np.ndarray

    def vector(self, text: str | None) -> Vector:
        """The vocabulary's terms in a text."""
        known = self.number
        found = {i: n for w, n in Counter(terms(text)).items() if (i := known.get(w)) is not None}
        order = sorted(found)
        return tuple(order), tuple(map(found.__getitem__, order))

    def unit(self, vector: Vector) -> Unit:
        t = np.array(vector[0])
        w = (1 + np.log(np.array(vector[1]))) * self.weight[t]
        return t, w / np.sqrt(w @ w)


class Index:
    """Unit vectors of examples, by term and block."""

    def __init__(self, known: Terms, vectors: list[Vector]):
        self.size = len(vectors)
        self.blocks = -(-self.size // BLOCK)
        units = [known.unit(v) for v in vectors]
        t = np.concatenate([a for a, _ in units]) if units else np.zeros(0, int)
        e, w = np.repeat(np.arange(self.size), [len(a) for a, _ in units]), np.concatenate([b for _, b in units]) if units else np.zeros(0)
        df = np.bincount(t, minlength=len(known.weight))
        common = np.flatnonzero(df > DENSE * self.size)
        self.row = np.full(len(df), -1)
        self.row[common] = np.arange(len(common))
        dense = self.row[t] >= 0
        self.dense = np.zeros((len(common), self.blocks * BLOCK), np.float32)
        self.dense[self.row[t[dense]], e[dense]] = w[dense]
        self.largest = self.dense.reshape(len(common), self.blocks, BLOCK).max(2) if common.size and self.blocks else np.zeros((len(common), self.blocks), np.float32)
        order = np.flatnonzero(~dense)
        order = order[np.lexsort((e[order], t[order]))]
        self.starts = np.searchsorted(t[order], np.arange(len(df) + 1))
        self.examples, self.values = e[order].astype(np.int32), w[order]

    def sums(self, t: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Dot products of all examples with the weights of rare terms, by block."""
        a, n = self.starts[t], self.starts[t + 1] - self.starts[t]
        at = np.repeat(a - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.bincount(self.examples[at], self.values[at] * np.repeat(w, n), self.blocks * BLOCK).reshape(self.blocks, BLOCK)

    def nearest(self, unit: Unit, k: int) -> list[tuple[float, int]]:
        """The k largest cosines above 0 as (cosine, example); ties go to the lower example."""
        t, w = unit
        row = self.row[t]
        common = row >= 0
        rows, heavy = row[common], w[common].astype(np.float32)
        sums = self.sums(t[~common], w[~common])
        bound = sums.max(1) + heavy @ self.largest[rows]
        order = np.argsort(-bound, kind="stable")

        def opened(blocks: np.ndarray) -> np.ndarray:
            if len(blocks) > MANY:
                return sums[blocks] + (heavy @ self.dense[rows]).reshape(-1, BLOCK)[blocks]
            at = (blocks[:, None] * BLOCK + np.arange(BLOCK)).ravel()
            return sums[blocks] + (heavy @ self.dense[rows[:, None], at]).reshape(-1, BLOCK)

        first = order[:OPENED]
        cosine = np.round(opened(first), 6)
        kth = np.partition(cosine, -k, axis=None)[-k] if cosine.size >= k else 0.0
        # sums are rounded: a bound that equals the k-th cosine may still hold a lower example
        rest = order[OPENED:]
        rest = rest[bound[rest] >= kth - 2e-6]
        if len(rest):
            first, cosine = np.concatenate([first, rest]), np.concatenate([cosine, np.round(opened(rest), 6)])
        number, cosine = (first[:, None] * BLOCK + np.arange(BLOCK)).ravel(), cosine.ravel()
        if len(cosine) > k:
            high = cosine >= np.partition(cosine, -k)[-k]
            number, cosine = number[high], cosine[high]
        best = np.lexsort((number, -cosine))[:k]
        return [(float(c), int(i)) for c, i in zip(cosine[best], number[best]) if c > 0]


@dataclass
class Model:
    known: Terms
    index: Index
    doc_ids: np.ndarray
    toxic: np.ndarray  # mean label of each example
    empty: float  # rate of examples without a term
    prior: float
    knots: tuple[np.ndarray, np.ndarray]  # calibration

    def vote(self, near: list[tuple[float, int]]) -> float:
        weight = np.array([c * c for c, _ in near])
        return float((weight @ self.toxic[[i for _, i in near]] + PRIOR * self.prior) / (weight.sum() + PRIOR)) if near else self.empty

    def calibrated(self, vote: float) -> float:
        x, y = self.knots
        return float(np.clip(np.interp(vote, x, y), 0.0, 1.0)) if len(x) else vote


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the nondecreasing step means of y over x (pool adjacent violators); each pool holds a pseudo-example of the mean."""
    if not len(x):
        return np.zeros(0), np.zeros(0)
    order, mean = np.argsort(x, kind="stable"), float(y.mean())
    pools: list[list[float]] = []
    for a, b in zip(x[order], y[order]):
        if pools and pools[-1][3] == a:
            pools[-1][0] += b
            pools[-1][1] += 1
        else:
            pools.append([b, 1, a, a])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            s, n, _, last = pools.pop()
            pools[-1][0] += s
            pools[-1][1] += n
            pools[-1][3] = last
    xs, ys = [], []
    for s, n, first, last in pools:
        for e in dict.fromkeys((first, last)):
            xs.append(e)
            ys.append((s + mean) / (n + 1))
    return np.array(xs), np.maximum.accumulate(ys)


def examples(docs: DataFrame, labels: DataFrame, bound: int, fold: int) -> DataFrame:
    """(doc_id, text, toxic): a bounded sample of the labelled rows outside the held-out fold."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id", fold))
    known = written(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")), "toxic-labels")
    return texts(docs).join(F.broadcast(hashed_sample(known, "doc_id", bound)), "doc_id")


def vocabulary(sample: DataFrame) -> tuple[Terms, float] | None:
    """The terms with their weights and the share of toxic examples; None without examples."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for b in batches:
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                w = terms(t)
                found.update((x, y, *((w[0], w[-1]) if y else (b"", b""))) for x in {*w})
                found[b"", y, b"", b""] += 1
        yield from arrow_rows(((*k, n) for k, n in found.items()), pa.schema([("term", pa.binary()), ("toxic", pa.int32()), ("head", pa.binary()), ("tail", pa.binary()), ("n", pa.int64())]))

    counted = sample.select("text", "toxic").mapInArrow(count, "term binary, toxic int, head binary, tail binary, n long")
    ends = [F.count_distinct(F.when(F.col("toxic") == 1, F.col(c))).alias(c) for c in ("head", "tail")]
    by = counted.groupBy("term").agg(*ends, *(F.sum(F.when(F.col("toxic") == y, F.col("n")).otherwise(0)).alias(f"n{y}") for y in (0, 1)))
    by = by.where((F.octet_length("term") == 0) | (F.col("n0") + F.col("n1") >= LEAST_DF))
    # the terms of a bounded sample
    rows = by.select("term", F.least("head", "tail").alias("a"), "n0", (F.col("n0") + F.col("n1")).alias("df"), "n1").orderBy("term").toArrow().to_pydict()
    if not rows["term"]:
        return None
    at = 1 if rows["term"][0] == b"" else 0
    if not at:
        return None
    total, toxic = rows["df"][0], rows["n1"][0]
    a, c, df = (np.array(rows[x][1:], float) for x in ("a", "n0", "df"))
    weight = (np.log((total + 1) / (df + 0.5)) + 1e-6) * np.log2(2 + a / np.maximum(c, 1)) ** 2
    return Terms({w: i for i, w in enumerate(rows["term"][1:])}, weight), toxic / total


def fit(docs: DataFrame, labels: DataFrame, bound: int = EXAMPLES, fold: int = FOLD) -> Model | None:
    """The model; None without labelled rows."""
    spark = docs.sparkSession
    # stored: two passes read it
    sample = written(examples(docs, labels, bound, fold), "examples")
    if (found := vocabulary(sample)) is None:
        return None
    known, prior = found
    sent = spark.sparkContext.broadcast(known)

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        rows = ((d, y, *map(packed, m.vector(t))) for b in batches for d, t, y in zip(*(b.column(i).to_pylist() for i in range(3))))
        yield from arrow_rows(rows, pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("t", pa.binary()), ("n", pa.binary())]), 500)

    # at most `bound` rows; their terms stay packed, 8 bytes each, as the driver holds them
    rows = sample.select("doc_id", "text", "toxic").mapInArrow(vectors, "doc_id long, toxic int, t binary, n binary").toArrow().to_pydict()
    discard(sample)
    none = [y for y, t in zip(rows["toxic"], rows["t"]) if not t]
    whole: dict[tuple[bytes, bytes], list[tuple[int, int]]] = {}
    for d, y, t, n in zip(*rows.values()):
        if t:
            whole.setdefault((t, n), []).append((d, y))
    del rows
    model = Model(known, Index(known, []), np.zeros(0, np.int64), np.zeros(0), (sum(none) + prior) / (len(none) + 1), prior, (np.zeros(0), np.zeros(0)))
    if not whole:
        return model
    held = sorted(whole.items())
    # nearly equal examples: the lowest of them stands for all
    vectors_of = [unpacked(v) for v, _ in held]
    index = Index(known, vectors_of)
    root = [*range(len(held))]
    for i, near in own_neighbours(spark, known, index, vectors_of, 3):
        for c, j in near:
            if c >= NEAR:
                a, b = _find(root, i), _find(root, j)
                root[max(a, b)] = min(a, b)
    groups: dict[int, list[tuple[int, int]]] = {}
    for i, (_, ys) in enumerate(held):
        groups.setdefault(_find(root, i), []).extend(ys)
    kept = [vectors_of[i] for i in groups]
    model.index = Index(known, kept)
    model.doc_ids = np.array([min(ys)[0] for ys in groups.values()], np.int64)
    model.toxic = np.array([sum(y for _, y in ys) / len(ys) for ys in groups.values()])
    votes = np.zeros(len(kept))
    for i, near in own_neighbours(spark, known, model.index, kept, NEIGHBOURS + 1):
        # without the example itself: it is among the k + 1 nearest, or k others tie with it
        votes[i] = model.vote([x for x in near if x[1] != i][:NEIGHBOURS])
    model.knots = isotonic(votes, model.toxic)
    del held, whole, index, vectors_of, kept
    trim()
    return model


def _find(root: list[int], i: int) -> int:
    while root[i] != i:
        root[i] = root[root[i]]
        i = root[i]
    return i


def own_neighbours(spark, known: Terms, index: Index, held: list[Vector], k: int) -> list[tuple[int, list[tuple[float, int]]]]:
    """(example, its k nearest examples) of every example, by tasks."""
    sent = spark.sparkContext.broadcast((known, index, held))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, index, held = sent.value
        rows = ((i, *map(list, zip(*index.nearest(known.unit(held[i]), k)))) for b in batches for i in b.column(0).to_pylist())
        yield from arrow_rows(rows, pa.schema([("i", pa.int64()), ("cosine", pa.list_(pa.float64())), ("j", pa.list_(pa.int64()))]))

    found = spark.range(0, len(held), 1, max(1, min(64, len(held) // 64))).mapInArrow(run, "i long, cosine array<double>, j array<long>")
    return sorted((r.i, [*zip(r.cosine, r.j)]) for r in found.collect())


_OUT = "doc_id long, score double, terms array<string>, neighbours array<struct<doc_id: long, toxic: double, cosine: double>>"


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """(doc_id, score, terms, neighbours) of every whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kinds = pa.schema([("doc_id", pa.int64()), ("score", pa.float64()), ("terms", pa.list_(pa.string())), ("neighbours", pa.list_(pa.struct([("doc_id", pa.int64()), ("toxic", pa.float64()), ("cosine", pa.float64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        names = [w.decode("utf-8", "replace") for w in m.known.number] if m else []
        last: tuple = (None, None)

        def of(text):
            nonlocal last
            if m is None:
                return 0.0, [], []
            if text == last[0]:
                return last[1]
            v = m.known.vector(text)
            if not v[0]:
                return m.empty, [], []
            t, w = unit = m.known.unit(v)
            near = m.index.nearest(unit, NEIGHBOURS)
            top = np.lexsort((t, -w))[:EVIDENCE]
            out = m.calibrated(m.vote(near)), [names[i] for i in t[top]], [{"doc_id": int(m.doc_ids[i]), "toxic": float(m.toxic[i]), "cosine": c} for c, i in near]
            last = text, out
            return out

        yield from arrow_rows(((d, *of(t)) for b in batches for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist())), kinds, 5_000)

    return texts(docs).mapInArrow(run, _OUT)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, fold: int = FOLD) -> DataFrame:
    """(doc_id, held_out, score, predicted, terms, neighbours) of every row of docs."""
    out = score(docs, fit(docs, labels, fold=fold))
    return out.select("doc_id", held_out("doc_id", fold).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "terms", "neighbours")
