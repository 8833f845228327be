"""Exact similarity join of shingle sets (Jaccard >= percent / 100) by set-relation skipping, and its components.

Shingles are 64-bit hashes of `width` words. Sets that are equal are joined as one. All sets order their shingles
alike: those that repeat within a task's share of the documents come last, by the power of two of their count over
all documents, then by hash; the order is only a matter of speed. Two sets that link share a shingle of their
prefixes (prefix filter), so the index has a list for each prefix shingle, sorted by set size.

Skipping in an index list: partners whose size is out of range end a probe; the positions of the shingle in both sets
bound their overlap; a 64-bit parity of each set bounds the symmetric difference. What is left is a candidate, and
goes on if a parity of SKETCH bits leaves room for a link too.

Skipping of answers: every set is first compared with the most central set of its list (whose shingle stands
foremost) and with its first possible partner, and the central sets of a long list's parts with the most central of
them. The components of those answers are then carried to all sets alike: a pair within one component adds nothing to
the answer, so a probe jumps over whole blocks of its own component; only pairs across components are compared, exactly,
on their whole sets. So a group of n near copies costs about n comparisons, not n * n, also beside strangers.

A list of a shingle that very many documents share is dealt out in parts of about PART rows for the first answers.
Afterwards only lists that hold more than one component are read again.

Null and empty texts and texts without words have no shingles and link with nothing; a text with fewer than `width`
words is one shingle. Every row of docs gets a row: a doc_id that repeats stands for several texts, each with its own
links, and rows without one have the component of what they link with, else null. Texts of any length are taken whole;
equal sizes and places are ordered by row. Columns other than doc_id and text are not read. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import discard, lower_words, slices, texts, trim, written
from orrery.llm.components import components

#: Most shingles whose counts go to the tasks (16 bytes each), shingles that a task counts at once, words that it keeps hashes of.
HOT, CHUNK, MEMO = 200_000, 1_000_000, 120_000
#: Most ids by which a scan is filtered where it lies; beyond it a shuffled join does so, with the same result.
FILTER_IDS = 500_000
SALTS = 32
#: Bits of the long parity, a power of two.
SKETCH = 1024
#: Logarithm of the rows of a part of a long index list.
PART_LEVEL = 11
#: Probes of a list that go on one by one, each over all that is left for it.
FEW = 64

_C1, _C2, _C3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xFF51AFD7ED558CCD))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(33)) * _C3
    return (x ^ x >> np.uint64(29)) * _C2 ^ x >> np.uint64(32)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        from xxhash import xxh64_intdigest

        h = xxh64_intdigest(word)
        if len(self) < MEMO:
            self[word] = h
        return h


#: A worker process keeps its hashes from task to task.
_KEPT = _Hashes()


class Shingler:
    """Sorted distinct shingle hashes of a text."""

    def __init__(self, width: int):
        self.width, self.hashes = width, _KEPT

    def __call__(self, text: str | None) -> np.ndarray:
        w = lower_words(text)
        if not w:
            return np.zeros(0, np.uint64)
        if len(w) < self.width:
            return mixed(np.array([self.hashes[b"\n".join(w)]], np.uint64))
        h = np.fromiter(map(self.hashes.__getitem__, w), np.uint64, len(w))
        n = len(h) - self.width + 1
        out = h[:n].copy()
        for i in range(1, self.width):
            out = (out * _C1) + h[i : n + i]
        return np.unique(mixed(out))


def prefix_length(n: int, percent: int) -> int:
    """How many of its first shingles a set of n must show: n - ceil(t n) + 1."""
    return n - -(-percent * n // 100) + 1


def _map(df: DataFrame, make: Callable[[], Callable[[list], list[pa.Array]]], schema: str, size: int = 2_000, text: int | None = None) -> DataFrame:
    """mapInArrow over slices of at most `size` rows (and a bounded number of bytes of column `text`); make() sets up a worker."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = make()
        names = [c.split()[0] for c in schema.split(", ")]
        for b in batches:
            for part in slices(b, text, size) if text is not None else (b.slice(at, size) for at in range(0, b.num_rows, size)):
                yield pa.RecordBatch.from_arrays(f(part.columns), names=names)
        trim()

    return df.mapInArrow(run, schema)


def frequent(docs: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted shingles, level): of shingles that repeat within a task's chunk, the most frequent, HOT at most, and the power of two of their count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingle, held, n = Shingler(width), [], 0

        def flush():
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            at = counts > 1
            return pa.RecordBatch.from_arrays([pa.array(keys[at].view(np.int64)), pa.array(counts[at])], names=["key", "n"])

        for b in batches:
            for t in b.column(0).to_pylist():
                held.append(shingle(t))
                n += len(held[-1])
                if n > CHUNK:
                    yield flush()
                    held, n = [], 0
        if held:
            yield flush()
        held.clear()
        trim()

    found = written(docs.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")), "frequent")
    # the least count that HOT shingles reach at most; the counts' powers of two are at most 64 rows
    least, seen = 1, 0
    for level, k in found.groupBy(F.floor(F.log2("n")).alias("level")).agg(F.count("*").alias("k")).orderBy(F.desc("level")).collect():
        seen += k
        if seen > HOT:
            least = 2 ** (level + 1)
            break
    top = found.where(F.col("n") >= least).toArrow()
    keys = top["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.log2(np.maximum(top["n"].to_numpy().astype(float)[order], 2)).astype(np.int8)


_SETS = "doc_id long, n long, d1 long, d2 long, bits long, keys array<long>, parts array<int>, sketch binary"


def sets(docs: DataFrame, percent: int, width: int) -> DataFrame:
    """(doc_id, n, d1, d2, bits, keys, parts, sketch): size, digest, short parity, prefix with the parts of long lists (null: no list is long) and long parity of each document's set; the last three only of the first of equal sets within a task."""
    sent = docs.sparkSession.sparkContext.broadcast(frequent(docs, width))

    def make():
        shingle, (hot, level), seen = Shingler(width), sent.value, set()

        def prefix(s, p):
            """Places, shingles and parts of a set's prefix."""
            at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
            late = np.where(hot[at] == s, level[at], 0)
            order = np.argsort(late, kind="stable")[:p]
            s, late = s[order], late[order].astype(np.int64)
            # as many parts as make about PART rows of each
            parts = np.maximum(1 << np.maximum(late, PART_LEVEL) >> PART_LEVEL, 1)
            return s, parts

        def one(text):
            s = shingle(text)
            n = len(s)
            if not n:
                return 0, 0, 0, 0, None, None, None
            d1, d2 = int(mixed(s + _C1).sum().view(np.int64)), int(np.bitwise_xor.reduce(mixed(s ^ _C2)).view(np.int64))
            bits = (np.bincount((s & np.uint64(SKETCH - 1)).view(np.int64), minlength=SKETCH) & 1).astype(np.uint8)
            short = int(np.packbits(np.bitwise_xor.reduce(bits.reshape(-1, 64))).view(np.int64)[0])
            if (n, d1, d2) in seen:
                return n, d1, d2, short, None, None, None
            seen.add((n, d1, d2))
            p = prefix_length(n, percent)
            if len(hot):
                s, parts = prefix(s, p)
            else:
                s, parts = s[:p], np.ones(p, np.int64)
            part = np.where(parts > 1, 1 + (d2 & 0x7FFFFFFF) % parts, 0).astype(np.int32) if (parts > 1).any() else None
            return n, d1, d2, short, s.view(np.int64), part, np.packbits(bits).tobytes()

        def f(columns):
            rows = [*zip(*map(one, columns[1].to_pylist()))]
            lists = lambda c, kind: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([0 if x is None else len(x) for x in c])]).astype(np.int32)), pa.array(np.concatenate([np.zeros(0, kind), *(x for x in c if x is not None)])), mask=pa.array([x is None for x in c]))
            return [columns[0], *(pa.array(c, pa.int64()) for c in rows[:4]), lists(rows[4], np.int64), lists(rows[5], np.int32), pa.array(rows[6], pa.binary())]

        return f

    return _map(docs, make, _SETS, text=1)


def representatives(found: DataFrame) -> DataFrame:
    """(n, d1, d2, salt, rep, least): of each distinct set the first row and the smallest doc_id, for every salt that the set's rows have."""
    salted = found.where("n > 0").select("n", "d1", "d2", "salt", "row", "doc_id")
    small = salted.groupBy("n", "d1", "d2", "salt").agg(F.min("row").alias("rep"), F.min("doc_id").alias("least"))
    whole = small.groupBy("n", "d1", "d2").agg(F.min("rep").alias("rep"), F.min("least").alias("least"), F.collect_set("salt").alias("salts"))
    return whole.select("n", "d1", "d2", F.explode("salts").alias("salt"), "rep", "least")


class Lists:
    """The rows of whole index lists of a sorted partition, in numpy columns; `by`: the columns whose values a list shares, the last of which decides where rows may be cut."""

    def __init__(self, batches: Iterator[pa.RecordBatch], names: list[str], by: tuple[str, ...] = ("key",), least: int = 200_000):
        self.batches, self.names, self.by, self.least = batches, names, by, least

    def starts(self, t: dict[str, np.ndarray]) -> np.ndarray:
        """Whether a row is the first of its list."""
        out = np.ones(len(t["key"]), bool)
        out[1:] = np.logical_or.reduce([t[c][1:] != t[c][:-1] for c in self.by])
        return out

    def __iter__(self) -> Iterator[dict[str, np.ndarray]]:
        held: list[pa.RecordBatch] = []
        n = 0
        for b in self.batches:
            if b.num_rows:
                held.append(b)
                n += b.num_rows
            if n >= self.least:
                t = {c: np.concatenate([x.column(c).to_numpy(zero_copy_only=False) for x in held]) for c in self.names}
                cut = int(np.flatnonzero(self.starts(t))[-1])
                if cut:
                    yield self.shared({c: v[:cut] for c, v in t.items()})
                    held = [pa.RecordBatch.from_arrays([pa.array(v[cut:]) for v in t.values()], names=self.names)]
                    n = held[0].num_rows
                self.least = max(self.least, 2 * n)
        if held:
            yield self.shared({c: np.concatenate([x.column(c).to_numpy(zero_copy_only=False) for x in held]) for c in self.names})

    def shared(self, t: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
        """Without the lists of one row that are not a part of a longer one (parts count from 1); `list` numbers the lists."""
        first = self.starts(t)
        keep = ~first | ~np.concatenate([first[1:], [True]])
        if "part" in t:
            keep |= t["part"] > 0
        number = np.cumsum(first)
        return {c: v[keep] for c, v in t.items()} | {"list": number[keep]}


def possible(t: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether rows i and j of a list may link, by the shingle's positions and by parity."""
    a, b = t["n"][i], t["n"][j]
    overlap = -(-percent * (a + b) // (100 + percent))
    ok = np.minimum(a - t["pos"][i], b - t["pos"][j]) >= overlap
    differ = np.bitwise_count((t["bits"][i] ^ t["bits"][j]).view(np.uint64)).astype(np.int64)
    return ok & (differ <= a + b - 2 * overlap)


def reach(t: dict[str, np.ndarray], i: int, percent: int) -> tuple[int, int]:
    """The rows of row i's list whose sizes are in its range, as (first, end): lists stand in order, each by size."""
    lo, hi = np.searchsorted(t["list"], t["list"][i]), np.searchsorted(t["list"], t["list"][i], "right")
    n, size = t["n"][lo:hi], t["n"][i]
    return lo + int(np.searchsorted(100 * n, percent * size)), lo + int(np.searchsorted(percent * n, 100 * size, "right"))


def first_partners(t: dict[str, np.ndarray], percent: int) -> np.ndarray:
    """For every row a row of its list that it may link with, or -1."""
    size = len(t["key"])
    partner = np.full(size, -1)
    for step in (1, -1):
        # rows go on side by side, and the few that are left one by one over all that is in their range
        active, far = np.flatnonzero(partner < 0), step
        while len(active) > FEW:
            active = active[(active + far >= 0) & (active + far < size)]
            j = active + far
            low, high = (active, j) if step > 0 else (j, active)
            inside = (t["list"][active] == t["list"][j]) & (percent * t["n"][high] <= 100 * t["n"][low])
            active, j = active[inside], j[inside]
            ok = possible(t, active, j, percent)
            partner[active[ok]] = j[ok]
            none = ok & (partner[j] < 0)
            partner[j[none]] = active[none]
            active = active[~ok]
            far += step
        for i in active:
            lo, hi = reach(t, i, percent)
            others = np.arange(i + far, hi) if step > 0 else np.arange(lo, i + far + 1)
            if len(others) and (at := np.flatnonzero(possible(t, np.full(len(others), i), others, percent))).size:
                partner[i] = others[at[0]]
    return partner


def across(t: dict[str, np.ndarray], percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of a list that may link and are in different components; blocks of one component are jumped over."""
    size = len(t["key"])
    change = np.flatnonzero((t["component"][1:] != t["component"][:-1]) | (t["list"][1:] != t["list"][:-1])) + 1
    beyond = np.concatenate([change, [size]])[np.searchsorted(change, np.arange(size), "right")]
    active, at = np.arange(size), beyond.copy()
    while len(active) > FEW:
        inside = at < size
        active, at = active[inside], at[inside]
        inside = (t["list"][active] == t["list"][at]) & (percent * t["n"][at] <= 100 * t["n"][active])
        active, at = active[inside], at[inside]
        apart = t["component"][active] != t["component"][at]
        i, j = active[apart], at[apart]
        ok = possible(t, i, j, percent)
        if ok.any():
            yield i[ok], j[ok]
        at = np.where(apart, at + 1, beyond[np.minimum(at, size - 1)])
    for i, a in zip(active, at):
        others = np.arange(a, reach(t, i, percent)[1])
        others = others[t["component"][others] != t["component"][i]]
        if len(others) and (ok := possible(t, np.full(len(others), i), others, percent)).any():
            yield np.full(int(ok.sum()), i), others[ok]


_ROWS = ["key", "part", "pos", "n", "bits", "rep"]


def first_answers(index: DataFrame, percent: int) -> DataFrame:
    """The rows of the index that share their list, each with up to two partners to compare first: the most central set of its part of the list and the first possible partner; `head`: whether the row is that central set."""
    out = "key long, part int, pos int, n long, bits long, rep long, central long, partner long, head boolean"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in Lists(batches, _ROWS, ("key", "part")):
            size = len(t["key"])
            if not size:
                continue
            partner = first_partners(t, percent)
            starts = np.flatnonzero(np.concatenate([[True], t["list"][1:] != t["list"][:-1]]))
            lengths = np.diff(np.concatenate([starts, [size]]))
            best = np.minimum.reduceat(t["pos"].astype(np.int64) * size + np.arange(size), starts) % size
            central = np.repeat(best, lengths)
            # a row without a partner in its part may have one in another part
            rows = np.flatnonzero((partner >= 0) | (t["part"] > 0))
            c = central[rows]
            lo, hi = np.minimum(t["n"][rows], t["n"][c]), np.maximum(t["n"][rows], t["n"][c])
            near = possible(t, rows, c, percent) & (percent * hi <= 100 * lo) & (rows != c)
            rep = t["rep"]
            yield pa.RecordBatch.from_arrays([*(pa.array(t[k][rows]) for k in _ROWS), pa.array(rep[c], mask=~near), pa.array(rep[partner[rows]], mask=partner[rows] < 0), pa.array(rows == c)], names=[*_ROWS, "central", "partner", "head"])

    dealt = index.select(*_ROWS).repartition(F.col("key"), F.col("part")).sortWithinPartitions("key", "part", "n", "rep")
    return dealt.mapInArrow(run, out)


def cross_pairs(index: DataFrame, percent: int) -> DataFrame:
    """(a, b): pairs of rows that may link and whose sets are in different components so far."""
    names = ["key", "pos", "n", "bits", "rep", "component"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in Lists(batches, names):
            for i, j in across(t, percent) if len(t["key"]) else ():
                a, b = t["rep"][i], t["rep"][j]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

    mixed_lists = index.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo <> hi").select("key")
    dealt = index.select(*names).join(mixed_lists, "key", "left_semi").repartition(F.col("key")).sortWithinPartitions("key", "n", "component", "rep")
    return dealt.mapInArrow(run, "a long, b long").distinct()


def likely(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs whose long parities leave room for a link: a bit that differs stands for a shingle that only one set has."""

    def make():
        def f(columns):
            a, b, m, n, x, y = columns
            m, n = m.to_numpy(), n.to_numpy()
            x, y = (np.frombuffer(b"".join(v.to_pylist()), np.uint64).reshape(len(m), -1) for v in (x, y))
            differ = np.bitwise_count(x ^ y).astype(np.int64).sum(1)
            keep = pa.array(differ <= m + n - 2 * -(-percent * (m + n) // (100 + percent)))
            return [a.filter(keep), b.filter(keep)]

        return f

    left = sketches.select(F.col("rep").alias("a"), F.col("n").alias("m"), F.col("sketch").alias("x"))
    right = sketches.select(F.col("rep").alias("b"), "n", F.col("sketch").alias("y"))
    return _map(pairs.join(left, "a").join(right, "b").select("a", "b", "m", "n", "x", "y"), make, "a long, b long")


#: Sets that are compared with one hub by one task.
PER_HUB = 500


def hubbed(tried: DataFrame) -> DataFrame:
    """(hub, rep) of each pair, which meets at its set with the more partners."""
    degree = tried.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("k"))
    for c in "ab":
        tried = tried.join(degree.select(F.col("rep").alias(c), F.col("k").alias(f"k{c}")), c)
    first = F.col("ka") >= F.col("kb")
    return tried.select(F.when(first, F.col("a")).otherwise(F.col("b")).alias("hub"), F.when(first, F.col("b")).otherwise(F.col("a")).alias("rep"))


def meetings(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(hub, part, lead, rep, least, d1, d2): where each set is needed, so that each pair (a stored table) meets and few sets travel twice; the hub's set leads each of its parts."""
    hubs = pairs.groupBy("hub").agg(F.ceil(F.count("*") / PER_HUB).cast("int").alias("parts"))
    others = pairs.join(hubs, "hub").select("hub", F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int").alias("part"), F.lit(False).alias("lead"), "rep")
    leads = hubs.select("hub", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(True).alias("lead"), F.col("hub").alias("rep"))
    return others.unionByName(leads).join(nodes, "rep").select("hub", "part", "lead", "rep", "least", "d1", "d2")


def whole_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """(hub, part, lead, rep, shingles): the sets at their meetings (a stored table), from the texts under their smallest doc_id; a text that differs from the set is told by its digest."""
    few = wanted.count() <= FILTER_IDS
    if few:
        rows = wanted.orderBy("d1").toArrow().combine_chunks()
        known = [rows[c].to_numpy() for c in ("d1", "d2", "hub", "part", "rep")]
        ids = np.unique(rows["least"].drop_null().to_numpy())
        sent = docs.sparkSession.sparkContext.broadcast((ids, rows["least"].null_count > 0, *known, rows["lead"].to_pylist()))
    else:
        sent = None
        docs = docs.join(wanted.select(F.col("least").alias("_id")).distinct(), F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")
    schema = "hub long, part int, lead boolean, rep long, shingles binary" if few else "d1 long, d2 long, shingles binary"

    def make():
        shingle = Shingler(width)

        def f(columns):
            key, text = columns
            if few:
                ids, nulls, known1, known2, hub, part, rep, lead = sent.value
                keep = np.isin(key.fill_null(0).to_numpy(zero_copy_only=False), ids)
                missing = key.is_null().to_numpy(zero_copy_only=False)
                text = text.filter(pa.array(np.where(missing, nulls, keep)))
            out = []
            for t in text.to_pylist():
                s = shingle(t)
                if len(s):
                    x, y = int(mixed(s + _C1).sum().view(np.int64)), int(np.bitwise_xor.reduce(mixed(s ^ _C2)).view(np.int64))
                    whole = s.tobytes()
                    if few:
                        for i in range(*np.searchsorted(known1, (x, x + 1))):
                            if known2[i] == y:
                                out.append((int(hub[i]), int(part[i]), lead[i], int(rep[i]), whole))
                    else:
                        out.append((x, y, whole))
            kinds = [pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.binary()] if few else [pa.int64(), pa.int64(), pa.binary()]
            columns = [*zip(*out)] or [()] * len(kinds)
            return [pa.array(c, k) for c, k in zip(columns, kinds)]

        return f

    found = _map(docs, make, schema, text=1)
    return found if few else found.join(wanted, ["d1", "d2"]).select("hub", "part", "lead", "rep", "shingles")


def verified(sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): the pairs of a hub and another set at its parts whose whole sets link."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, first = None, None
        for batch in batches:
            a, b = [], []
            for hub, part, lead, rep, whole in zip(*(batch.column(i).to_pylist() for i in range(4)), batch.column(4)):
                own = np.frombuffer(whole.as_buffer(), np.int64)
                if lead:
                    at, first = (hub, part), own.copy()
                elif at == (hub, part):
                    both = len(np.intersect1d(first, own, assume_unique=True))
                    if 100 * both >= percent * (len(first) + len(own) - both):
                        a.append(min(hub, rep))
                        b.append(max(hub, rep))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
        trim()

    dealt = sets.repartition(F.col("hub"), F.col("part")).sortWithinPartitions("hub", "part", F.desc("lead"), "rep")
    return dealt.mapInArrow(run, "a long, b long")


def checked(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, sketches: DataFrame, percent: int, width: int) -> DataFrame:
    """The links among some pairs, stored; pairs that the parities rule out don't meet."""
    tried = written(likely(pairs, sketches, percent), "pairs")
    met = written(hubbed(tried), "met")
    wanted = written(meetings(met, nodes), "wanted")
    links = written(verified(whole_sets(docs, wanted, width), percent).distinct(), "links")
    discard(tried, met, wanted)
    return links


def foremost(found: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows with prefixes that stand for their set: without those that are the first of their set in a task, but not over all."""
    firsts = found.where("keys is not null")
    others = firsts.select(F.col("row").alias("rep")).join(nodes.select("rep"), "rep", "left_anti")
    few = others.limit(FILTER_IDS + 1).count() <= FILTER_IDS
    return firsts.withColumnRenamed("row", "rep").join(F.broadcast(others) if few else others, "rep", "left_anti")


def link_components(docs: DataFrame, percent: int = 90, width: int = 3) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of docs."""
    docs = texts(docs)
    # rows count up within a task, so the first row of a set over all is the first in its task, which has the prefix
    found = written(sets(docs, percent, width).withColumn("row", F.monotonically_increasing_id()), "sets")
    salted = found.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    reps = written(representatives(salted), "reps")
    member = written(salted.select("doc_id", "n", "d1", "d2", "salt").join(reps, ["n", "d1", "d2", "salt"], "left").select("doc_id", "n", "rep", "least"), "members")
    nodes = written(reps.select("rep", "least", "d1", "d2").dropDuplicates(["rep"]), "nodes")
    entries = foremost(found, nodes).select("rep", "n", "bits", "parts", F.posexplode("keys").alias("pos", "key"))
    index = written(first_answers(entries.withColumn("part", F.coalesce(F.get("parts", "pos"), F.lit(0))), percent), "index")
    sketches = written(found.where("sketch is not null").select(F.col("row").alias("rep"), "n", "sketch").join(index.select("rep").distinct(), "rep", "left_semi"), "sketches")
    discard(found, reps)
    ordered = lambda df, c: df.where(f"{c} is not null and {c} <> rep").select(F.least("rep", c).alias("a"), F.greatest("rep", c).alias("b"))
    heads = index.where("head and part > 0").select("key", "pos", "rep")
    tops = heads.groupBy("key").agg(F.min_by("rep", F.struct("pos", "rep")).alias("top"))
    pairs = written(ordered(index, "central").union(ordered(index, "partner")).union(ordered(heads.join(tops, "key"), "top")).distinct(), "pairs")
    links = checked(docs, nodes, pairs, sketches, percent, width)
    part = components(links)
    joined = index.join(part.select(F.col("node").alias("rep"), "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    joined = written(joined.select("key", "pos", "n", "bits", "rep", "component"), "joined")
    discard(index)
    others = written(cross_pairs(joined, percent).join(pairs, ["a", "b"], "left_anti"), "pairs")
    more = checked(docs, nodes, others, sketches, percent, width)
    discard(joined, others, pairs, sketches)
    if not more.isEmpty():
        part = components(part.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more))
    part = part.select(F.col("node").alias("rep"), "component")
    names = part.join(nodes.select("rep", "least"), "rep").groupBy("component").agg(F.min("least").alias("component_id"))
    named = part.join(names, "component").select("rep", "component_id")
    return member.join(named, "rep", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("rep").isNull(), F.col("doc_id")).otherwise(F.coalesce("component_id", "least")).alias("component_id"))
