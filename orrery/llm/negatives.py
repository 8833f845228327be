"""Hard negatives by inner product, found through one-dimensional distance keys.

Vectors x get one more component, sqrt(M - |x|²) with M the largest squared norm, and anchors a zero: then the squared distance
of an anchor from a row is |a|² + M - 2 a·x, so that nearer is better. Each row lies under its nearest pivot, keyed by
the distance to it, and the table is stored in blocks sorted by (pivot, distance). All rows within r of an
anchor at distance d from a pivot have keys in [d - r, d + r] there.

A search starts at the block that holds the anchor. What it finds there bounds the distance of the k-th best; the second
scan takes the key intervals out to that radius, for windows of scores without what is surely nearer than the window (an
annulus). No row outside can be among the first k, so the result is exact however little the keys exclude: in many dimensions with
unclustered vectors they exclude next to nothing, and the scan is then of all blocks, as matrix products of a block with
the anchors that need it. Anchors travel in the groups of their blocks; a block that many groups need is copied for each
`GROUPS` of them. No pair of rows is ever a row of a table: a block gives at most k rows for each anchor and window.

Rows with a null id or label, a null vector or a component that is null or not finite take no part, nor do rows whose squared norm
reaches 2^62, as products would not fit 64 bits. Shorter vectors count as filled up with zeros. Rows that repeat an id are
rows of their own, but none is a positive of its own id. Equal scores go by the smaller id. Only vec_id, embedding and label
are read. Tables without rows or anchors give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orrery.llm.common import arrow_rows, hashed_sample, written

#: Rows of a block, pivots, rows that the pivots are chosen from, parts that the groups at a pivot are dealt over, and groups of anchors that share a copy of a block.
BLOCK, PIVOTS, SAMPLE, PARTS, GROUPS = 1024, 32, 2048, 16, 512
#: No score is this large.
FAR = 1 << 62
_STORE = "block long, pivot int, low double, high double, n int, ids binary, labels binary, vectors binary"
_FOUND = "group long, place int, rank int, score long, vec_id long"


def quantized(embeddings: DataFrame, scale: int = 256) -> DataFrame:
    """(vec_id, label, q): rows that take part, components as whole numbers."""
    e = embeddings.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("embedding").cast("array<double>").alias("v")).where("vec_id is not null and label is not null and v is not null")
    e = e.where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    e = e.withColumn("v", F.transform("v", lambda x: x * scale)).where(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x) < float(FAR) * (1 - 1e-9))
    e = e.withColumn("q", F.transform("v", lambda x: F.floor(x).cast("int")))
    return e.where(F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x) < float(FAR)).select("vec_id", "label", "q")


def matrix(rows: list, dims: int) -> np.ndarray:
    """Vectors of any length up to `dims` as rows."""
    out = np.zeros((len(rows), dims), np.int32)
    for i, row in enumerate(rows):
        out[i, : len(row)] = row
    return out


def augmented(vectors: np.ndarray, most: float) -> np.ndarray:
    x = vectors.astype(np.float64)
    return np.column_stack([x, np.sqrt(np.maximum(0, most - (x * x).sum(axis=1)))])


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * x @ pivots.T
    return np.sqrt(np.maximum(0, square))


def choose_pivots(x: np.ndarray, n: int, rounds: int = 4) -> np.ndarray:
    """Far points first, each then moved to the mean of what is nearest to it."""
    at, near = [0], distances(x, x[:1])[:, 0]
    while len(at) < min(n, len(x)) and near.max() > 0:
        at.append(int(near.argmax()))
        near = np.minimum(near, distances(x, x[at[-1:]])[:, 0])
    pivots = x[at]
    for _ in range(rounds):
        own = distances(x, pivots).argmin(axis=1)
        pivots = np.array([x[own == i].mean(axis=0) if (own == i).any() else p for i, p in enumerate(pivots)])
    return pivots


class Index:
    """Vectors stored in blocks sorted by (pivot, distance)."""

    def __init__(self, vectors: DataFrame, anchor_every: int):
        vectors = written(vectors, "vectors")
        spark = vectors.sparkSession
        seen = vectors.agg(F.count("*").alias("n"), F.max(F.size("q")).alias("dims"), F.max(F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x)).alias("most")).first()
        self.n, self.dims, self.most = seen["n"], max(1, seen["dims"] or 0), seen["most"] or 0.0
        self.slack = 1e-5 * self.most**0.5 + 1e-9
        sample = matrix([r["q"] for r in hashed_sample(vectors.select("vec_id", "q"), "vec_id", SAMPLE).collect()], self.dims)
        pivots = choose_pivots(augmented(sample, self.most), PIVOTS) if len(sample) else np.zeros((1, self.dims + 1))
        self.pivots = spark.sparkContext.broadcast(pivots)
        sent, dims, most = self.pivots, self.dims, self.most

        def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = matrix(batch.column(2).to_pylist(), dims)
                d = distances(augmented(x, most), sent.value)
                pivot = d.argmin(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(pivot.astype(np.int32)), pa.array(d[np.arange(len(d)), pivot])], names=["vec_id", "label", "vector", "pivot", "distance"])

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyspark import TaskContext

            first = TaskContext.get().partitionId() << 32

            def blocks():
                held, n = [], 0
                for batch in batches:
                    for row in zip(*(c.to_pylist() for c in batch.columns)):
                        if held and (len(held) == BLOCK or held[0][3] != row[3]):
                            yield _block(first + n, held)
                            held, n = [], n + 1
                        held.append(row)
                if held:
                    yield _block(first + n, held)

            yield from arrow_rows(blocks(), pa.schema([(c.split()[0], {"long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "binary": pa.binary()}[c.split()[1]]) for c in _STORE.split(", ")]), 64)

        rows = vectors.mapInArrow(keyed, "vec_id long, label long, vector binary, pivot int, distance double").withColumn("row", F.monotonically_increasing_id())
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), self.n // (64 * BLOCK) + 1)
        order = ["pivot", "distance", "vec_id", "row"]
        self.store = written(rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).drop("row").mapInArrow(cut, _STORE), "store")

        def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for block, ids, labels, x in zip(*(c.to_pylist() for c in batch.columns)):
                    ids, labels, x = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64), np.frombuffer(x, np.int32).reshape(-1, dims)
                    if len(at := np.flatnonzero(ids % anchor_every == 0)):
                        out.append((block, len(at), ids[at].tobytes(), labels[at].tobytes(), x[at].tobytes()))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), *[pa.binary()] * 3))], names=["group", "m", "ids", "labels", "vectors"])

        self.groups = written(self.store.select("block", "ids", "labels", "vectors").mapInArrow(anchors, "group long, m int, ids binary, labels binary, vectors binary"), "anchors")

    def needed(self, aimed: DataFrame) -> DataFrame:
        """(group, block): other blocks that may hold rows for a group's goals."""
        sent, dims, most, slack = self.pivots, self.dims, self.most, self.slack

        def intervals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for group, x, goals in zip(*(c.to_pylist() for c in batch.columns)):
                    x = np.frombuffer(x, np.int32).reshape(-1, dims)
                    # anchors lie at zero in the added dimension
                    d = distances(np.column_stack([x.astype(np.float64), np.zeros(len(x))]), sent.value)
                    place, top, low = (np.array([g[c] for g in goals], np.int64) for c in ("place", "top", "low"))
                    own = (x.astype(np.float64) ** 2).sum(axis=1)[place] + most
                    outer, inner = np.sqrt(np.maximum(0, own - 2.0 * low)), np.sqrt(np.maximum(0, own - 2.0 * top))
                    lows = np.maximum(d[place] - outer[:, None], inner[:, None] - d[place]).min(axis=0) - slack
                    highs = (d[place] + outer[:, None]).max(axis=0) + slack
                    out += [(group, p, max(0.0, a), b) for p, (a, b) in enumerate(zip(lows.tolist(), highs.tolist()))]
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int32(), pa.float64(), pa.float64()))], names=["group", "pivot", "low", "high"])

        wanted = aimed.select("group", "vectors", "goals").mapInArrow(intervals, "group long, pivot int, low double, high double").where("low <= high").withColumn("part", F.pmod(F.xxhash64("group"), F.lit(PARTS)).cast("int"))
        there = self.store.select("block", "pivot", "low", "high").withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1)))).alias("b")
        met = _met(wanted.alias("g"), there, ["pivot", "part"]).where("g.low <= b.high and g.high >= b.low and group <> block")
        # a block has one pivot, so each pair is met once
        return met.select("group", "block")

    def scan(self, aimed: DataFrame, pairs: DataFrame, same: bool, k: int) -> DataFrame:
        """The first k rows of each goal within each block that its group is paired with."""
        dims, exact = self.dims, self.most < 1 << 53

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kind = np.float64 if exact else np.int64

            def found():
                ids = labels = x = None
                for batch in batches:
                    for group, i, c, v, goals in zip(*(batch.column(c).to_pylist() for c in ("group", "ids", "labels", "vectors", "goals"))):
                        i, c, v = np.frombuffer(i, np.int64), np.frombuffer(c, np.int64), np.frombuffer(v, np.int32).reshape(-1, dims).astype(kind)
                        if group is None:
                            ids, labels, x = i, c, v
                            continue
                        scores = (x @ v.T).astype(np.int64)
                        for g in goals:
                            s, at = scores[:, g["place"]], g["place"]
                            ok = (labels == c[at]) & (ids != i[at]) if same else labels != c[at]
                            rows = np.flatnonzero(ok & (s <= g["top"]) & (s >= g["low"]))
                            if len(rows) > k:
                                rows = rows[s[rows] >= np.partition(s[rows], -k)[-k]]
                            for r in rows[np.lexsort((ids[rows], -s[rows]))[:k]].tolist():
                                yield group, at, g["rank"], int(s[r]), int(ids[r])

            yield from arrow_rows(found(), pa.schema([(c.split()[0], {"long": pa.int64(), "int": pa.int32()}[c.split()[1]]) for c in _FOUND.split(", ")]))

        salts = max(1, self.groups.count() // GROUPS)
        columns = ["block", "salt", "group", "ids", "labels", "vectors", "goals"]
        asked = _met(pairs, aimed, ["group"]).withColumn("salt", F.pmod(F.xxhash64("group"), F.lit(salts)).cast("int")).select(*columns)
        blocks = _met(self.store, pairs.select("block").distinct(), ["block"], "left_semi").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        blocks = blocks.select("block", "salt", F.lit(None).cast("long").alias("group"), "ids", "labels", "vectors", F.lit(None).cast(aimed.schema["goals"].dataType).alias("goals"))
        return blocks.unionByName(asked).repartition("block", "salt").sortWithinPartitions("block", "salt", F.col("group").asc_nulls_first()).mapInArrow(run, _FOUND)

    def nearest(self, goals: DataFrame, same: bool, k: int) -> DataFrame:
        """(group, place, rank, score, vec_id, nth): for each goal (group, place, rank, top, low) the first k rows of the anchor's label, or of others, with scores from low to top."""
        goals = written(goals.where("low <= top"), "goals")
        aim = lambda g: _met(self.groups, g.groupBy("group").agg(F.collect_list(F.struct("place", "rank", "top", "low")).alias("goals")), ["group"])
        home = written(self.scan(aim(goals), goals.select("group", F.col("group").alias("block")).distinct(), same, k), "home")
        of = ["group", "place", "rank"]
        bound = home.groupBy(*of).agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") >= k)
        closer = _met(goals, bound, of, "left").withColumn("low", F.greatest("low", F.coalesce("kth", "low"))).select(*goals.columns)
        aimed = written(aim(closer), "aimed")
        rest = self.scan(aimed, written(self.needed(aimed), "needed"), same, k)
        nth = F.row_number().over(Window.partitionBy(*of).orderBy(F.desc("score"), "vec_id"))
        return written(home.unionByName(rest).withColumn("nth", nth).where(F.col("nth") <= k), "nearest")


def _met(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """A join by shuffle: pairs of groups and blocks compress to files far smaller than their rows, so that a plan that goes by the size of files would send them through the driver."""
    return left.join(right.hint("merge"), on, how)


def _block(number: int, rows: list[tuple]) -> tuple:
    ids, labels, vectors, pivots, keys = zip(*rows)
    return number, pivots[0], keys[0], keys[-1], len(rows), np.array(ids, np.int64).tobytes(), np.array(labels, np.int64).tobytes(), b"".join(vectors)


def hard_negatives(vectors: DataFrame, anchor_every: int = 100, k: int = 5, percent: int = 80) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of (vec_id, label, q).

    For each anchor the first k other rows of its label are positives; for each positive the first k rows of other labels
    with at least `percent` of its score and no more than it are its negatives.
    """
    index = Index(vectors, anchor_every)
    places = index.groups.select("group", F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("place"))
    every = places.select("group", "place", F.lit(0).alias("rank"), F.lit(FAR).alias("top"), F.lit(-FAR).alias("low"))
    positives = index.nearest(every, True, k).select("group", "place", F.col("nth").alias("rank"), F.col("score").alias("top"), F.col("vec_id").alias("positive_id"))
    low = F.ceil(F.col("top").cast("decimal(20,0)") * percent / 100).cast("long")
    found = index.nearest(positives.select("group", "place", "rank", "top", low.alias("low")), False, k)

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(group, place, id_) for group, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for place, id_ in enumerate(np.frombuffer(ids, np.int64).tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64()))], names=["group", "place", "anchor_id"])

    anchors = index.groups.select("group", "ids").mapInArrow(named, "group long, place int, anchor_id long")
    return _met(_met(found, positives, ["group", "place", "rank"]), anchors, ["group", "place"]).select(
        "anchor_id", "positive_id", F.col("nth").alias("rank"), F.col("vec_id").alias("negative_id"), F.col("top").alias("positive_score"), F.col("score").alias("negative_score")
    )
