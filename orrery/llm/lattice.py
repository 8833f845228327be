"""Document likelihood under a subword lattice, beside an add-one word model.

The lattice's vocabulary is that of a public byte-level tokenizer, with the score that each piece has there (its merge
rank, read as a Zipf probability), every single byte, and every training word as a piece of its own. Scores are
brought to the training rows' words by EM over all segmentations (nothing is tokenized). Left out are only pieces that
no word can hold: those with A-Z (texts are lower-cased) or with white space behind their first byte.

A text is a chain of words and an end, so its lattice falls apart into those of its words. A word is one arc (its
absolutely discounted share of the training tokens) or a segmentation: a piece with a leading space, other pieces, and a
stop, weighted by what the discount freed. The log-space forward recursion sums over all of them. There is a set of such
scores for each of the languages with the most training rows (GROUPS - 1) and one for all other rows; a text's language
is no input to its score but a further choice that is summed over. So a score is the marginal log10 probability of the
text, and the probabilities of all texts sum to one at most.

Words are counted in a sharded table over all rows, each distinct word meets the recursion once, in numpy batches of
words of like length (a word of over LONG bytes alone, its arcs found window by window), and documents only add up its results. The table's most frequent training words (COMMON at most)
go out to the tasks, all others meet the documents' words in a join; which words go which way changes no score.

Null and empty texts are an end alone. Rows that repeat, with or without a doc_id, are scored each; a text of any
length is counted whole; without training rows pieces keep the scores that they came with. Languages with equally many
rows are taken by name, null first. Columns other than doc_id, text and lang are not read, whatever their names. An
empty table gives an empty result.
"""

from __future__ import annotations

import base64
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property
from math import exp, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import arrow_rows, discard, held_out, lower_words, texts, trim, written

COMMON, ROUNDS, FOLD, GROUPS = 200_000, 3, 7, 6
#: Words that a task counts before it passes the counts on; words of a batch; bytes from which a word goes through the recursion alone.
CHUNK, BATCH, LONG = 400_000, 20_000, 64
#: Bytes of such a word whose arcs are held at a time.
WINDOW = 1 << 16
#: Pseudo-count of a piece; what keeps the share of ends and of new words above 0.
PSEUDO, SMALL = 0.05, 0.5
LN10 = log(10)


@dataclass
class Pieces:
    """A trie of pieces and their log probabilities, a column for each set of scores: those with a leading space sum to one, and all others with the stop (the last row)."""

    names: list[bytes]
    keys: np.ndarray  # 256 * node + byte, of every trie edge
    children: np.ndarray
    piece: np.ndarray  # of each node, or -1
    logs: np.ndarray
    trie: str  # names the trie, which sets of scores share

    def begins(self) -> np.ndarray:
        return np.array([p[:1] == b" " for p in self.names] + [False])

    def counted(self, n: np.ndarray) -> Pieces:
        """With probabilities in proportion to `n`, which has a column for each set of scores."""
        first = self.begins()
        return replace(self, logs=np.log(n) - np.log(np.where(first[:, None], n[first].sum(0), n[~first].sum(0))))


def pieces(vocabulary: str) -> Pieces:
    """The pieces of a tokenizer's file (base64 and rank a line) that a lower-cased word can hold, with all single bytes."""
    ranks: dict[bytes, int] = {}
    for line in open(vocabulary, "rb"):
        piece, rank = line.split()
        piece = base64.b64decode(piece)
        if piece == piece.lower() and not set(piece[1:]) & set(b" \t\n\v\f\r"):
            ranks[piece] = int(rank)
    last = max(ranks.values(), default=0) + 1
    for b in range(256):
        ranks.setdefault(bytes([b]), last)
    return trie({p: 1 / (r + 2.7) for p, r in sorted(ranks.items())})


def trie(weights: dict[bytes, float]) -> Pieces:
    """Pieces with probabilities in proportion to their weights; the stop has that of the heaviest other piece."""
    edges: dict[int, int] = {}
    ends = []
    for p in weights:
        node = 0
        for b in p:
            node = edges.setdefault(256 * node + b, len(edges) + 1)
        ends.append(node)
    piece = np.full(len(edges) + 1, -1, np.int32)
    piece[ends] = np.arange(len(ends))
    n = np.array([*weights.values(), max(weights.values())])
    made = Pieces([*weights], np.fromiter(edges, np.int64, len(edges)), np.fromiter(edges.values(), np.int32, len(edges)), piece, n, uuid.uuid4().hex)
    return made.counted(n[:, None])


#: The child of every node by byte, of the trie that a worker used last: it serves all tasks and rounds.
_TRIES: dict[str, np.ndarray] = {}


class Lattice:
    """The recursion over words (each with its leading space)."""

    def __init__(self, given: Pieces):
        self.given, self.piece, self.logs = given, given.piece, given.logs
        if given.trie not in _TRIES:
            _TRIES.clear()
            _TRIES[given.trie] = np.full(256 * len(given.piece), -1, np.int32)
            _TRIES[given.trie][given.keys] = given.children
        self.next = _TRIES[given.trie]

    @cached_property
    def longest(self) -> int:
        return max(map(len, self.given.names))

    def windows(self, word: bytes, order: int = 1) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """The arcs of one word by position, window by window of WINDOW bytes (from the last back if `order` is -1): starts, ends, pieces. Single bytes are pieces, so an arc ends at each position."""
        letters = np.frombuffer(word, np.uint8)
        for low in range(0, len(word), WINDOW)[::order]:
            high = min(low + WINDOW, len(word))
            begin = np.arange(max(0, low + 1 - self.longest), high)
            alive, node, found, d = begin, np.zeros(len(begin), np.int64), [], 0
            while len(alive):
                keep = alive + d < high
                alive, node = alive[keep], node[keep]
                node = self.next[256 * node + letters[alive + d]].astype(np.int64)
                keep = node >= 0
                alive, node, d = alive[keep], node[keep], d + 1
                own = self.piece[node]
                here = (own >= 0) & (alive + d > low)
                found.append((alive[here], alive[here] + d, own[here]))
            start, end, piece = (np.concatenate(x) for x in zip(*found))
            by = np.lexsort((start, end))
            yield start[by], end[by], piece[by]

    def one(self, word: bytes, g: int) -> np.ndarray:
        """By the scores of column g, log of the summed probability of the ways to each position of a word of any length."""
        logs, at, j, own = np.ascontiguousarray(self.logs[:, g]), [0.0], 1, []
        for start, end, piece in self.windows(word):
            for i, e, s in zip(start.tolist(), end.tolist(), logs[piece].tolist()):
                if e != j:
                    at.append(log_sum(own))
                    j, own = e, []
                own.append(at[i] + s)
        return np.array([*at, log_sum(own)])

    def batch(self, words: list[bytes], logs: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, ...]]]:
        """By scores with one or more columns, log sums at every position of every word, the positions of the words' ends, and the arcs by position: (log sum, start, end, piece)."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        first = np.cumsum(size) - size
        letters = np.frombuffer(b"".join(words), np.uint8)
        offset = np.arange(len(letters)) - np.repeat(first, size)
        left, node0 = np.repeat(size, size) - offset, np.arange(len(letters)) + np.repeat(np.arange(len(words)), size)
        alive, node, found, d = np.arange(len(letters)), np.zeros(len(letters), np.int64), [], 0
        while len(alive):
            keep = left[alive] > d
            alive, node = alive[keep], node[keep]
            node = self.next[256 * node + letters[alive + d]].astype(np.int64)
            keep = node >= 0
            alive, node, d = alive[keep], node[keep], d + 1
            own = self.piece[node]
            at = alive[own >= 0]
            found.append((offset[at] + d, node0[at], node0[at] + d, own[own >= 0]))
        j, start, end, piece = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((end, j))
        j, start, end, piece = j[order], start[order], end[order], piece[order]
        at = np.zeros((len(letters) + len(words), *logs.shape[1:]))
        cuts = np.flatnonzero(np.diff(j)) + 1
        arcs = []
        for a, b in zip([0, *cuts], [*cuts, len(j)]):
            s, e = start[a:b], end[a:b]
            x = at[s] + logs[piece[a:b]]
            heads = np.flatnonzero(np.concatenate([[True], e[1:] != e[:-1]]))
            top = np.maximum.reduceat(x, heads)
            many = np.diff(np.concatenate([heads, [len(e)]]))
            at[e[heads]] = top + np.log(np.add.reduceat(np.exp(x - np.repeat(top, many, axis=0)), heads))
            arcs.append((x, s, e, piece[a:b]))
        return at, first + np.arange(len(words)) + size, arcs

    def forward(self, words: list[bytes]) -> np.ndarray:
        """Log of the summed probability of all segmentations of each word, its stop included; a column for each of the scores."""
        out = np.empty((len(words), self.logs.shape[1]))
        for at in batches(words):
            own = [words[i] for i in at]
            if len(own[-1]) > LONG:
                out[at] = [[self.one(w, g)[-1] for g in range(self.logs.shape[1])] for w in own]
            else:
                sums, ends, _ = self.batch(own, self.logs)
                out[at] = sums[ends]
        return out + self.logs[-1]

    def expected(self, words: list[bytes], g: int, into: np.ndarray) -> None:
        """Adds the expected counts, by the scores of column g, of the pieces of words that are seen once each."""
        logs = np.ascontiguousarray(self.logs[:, g])
        into[-1] += len(words)
        for at in batches(words):
            own = [words[i] for i in at]
            if len(own[-1]) > LONG:
                for w in own:
                    self._expected_one(w, g, into)
                continue
            sums, ends, arcs = self.batch(own, logs)
            # the share of a position's ways that pass on through it, from the end back
            share = np.zeros(len(sums))
            share[ends] = 1.0
            for x, s, e, piece in reversed(arcs):
                part = share[e] * np.exp(x - sums[e])
                np.add.at(share, s, part)
                np.add.at(into, piece, part)

    def _expected_one(self, word: bytes, g: int, into: np.ndarray) -> None:
        at, logs = self.one(word, g), np.ascontiguousarray(self.logs[:, g])
        share = [0.0] * len(word) + [1.0]
        for start, end, piece in self.windows(word, -1):
            passed = np.exp(at[start] + logs[piece] - at[end])
            for i, e, x in zip(start[::-1].tolist(), end[::-1].tolist(), passed[::-1].tolist()):
                share[i] += share[e] * x
            np.add.at(into, piece, np.array(share[end[0] : end[-1] + 1])[end - end[0]] * passed)


def log_sum(x: list[float]) -> float:
    """Log of the sum of exponentials."""
    top = max(x)
    return top + log(sum([exp(y - top) for y in x])) if len(x) > 1 else top


def batches(words: list[bytes]) -> Iterator[np.ndarray]:
    """Positions of words, by length, in batches in which either all or no words are longer than LONG."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(size, kind="stable")
    cut = int(np.searchsorted(size[order], LONG, "right"))
    for part in (order[:cut], order[cut:]):
        for i in range(0, len(part), BATCH):
            yield part[i : i + BATCH]


def groups(docs: DataFrame) -> list[str | None]:
    """The languages whose training rows have scores of their own; all others share the last set."""
    top = docs.where("not held_out").groupBy("lang").agg(F.count("*").alias("k")).orderBy(F.desc("k"), F.col("lang").asc_nulls_first()).limit(GROUPS - 1).collect()
    return [r["lang"] for r in top]


def word_counts(docs: DataFrame, langs: list[str | None]) -> DataFrame:
    """(word, n, by) of every word of all rows: its count in training rows, in all and by set of scores; counted within tasks first."""
    last = len(langs)

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("k", pa.int32()), ("word", pa.binary()), ("n", pa.int64())])
        found = [Counter() for _ in range(last + 1)]
        number = {x: k for k, x in enumerate(langs)}

        def counted():
            for k, own in enumerate(found):
                yield from ((k, w, n) for w, n in own.items())
                own.clear()

        for b in rows:
            for t, held, lang in zip(*(b.column(i).to_pylist() for i in range(3))):
                own = found[number.get(lang, last)]
                if held:
                    for w in {*lower_words(t)}:
                        own.setdefault(w, 0)
                else:
                    own.update(lower_words(t))
                if sum(map(len, found)) > CHUNK:
                    yield from arrow_rows(counted(), kinds)
        yield from arrow_rows(counted(), kinds)

    out = docs.select("text", "held_out", "lang").mapInArrow(run, "k int, word binary, n long")
    by = [F.sum(F.when(F.col("k") == k, F.col("n")).otherwise(0)).alias(f"n{k}") for k in range(last + 1)]
    return out.groupBy("word").agg(F.sum("n").alias("n"), *by).select("word", "n", F.array(*(f"n{k}" for k in range(last + 1))).alias("by"))


def train(counts: DataFrame, given: Pieces, k: int, rounds: int = ROUNDS) -> Pieces:
    """The pieces with the probabilities that EM finds over each set's distinct training words: what they are for is words that are new."""
    spark, seen, size = counts.sparkSession, counts.where("n > 0").select("word", "by"), len(given.logs)
    given = given.counted(np.exp(np.repeat(given.logs, k, axis=1)))
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(given)

        def run(rows: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            lattice, into = Lattice(sent.value), np.zeros((k, size))
            for words, by in blocks(rows):
                for g in range(k):
                    lattice.expected([b" " + words[i] for i in np.flatnonzero(by[:, g])], g, into[g])
            at = np.flatnonzero(into)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(into.ravel()[at])], names=["piece", "n"])
            trim()

        # a row a piece of the vocabulary and set at most
        rows = seen.mapInArrow(run, "piece long, n double").groupBy("piece").agg(F.sum("n")).collect()
        n = np.full(k * size, PSEUDO)
        for piece, more in rows:
            n[piece] += more
        if not rows:
            break
        given = given.counted(n.reshape(k, size).T)
    return given


def blocks(rows: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Words and their counts by set, about 5 BATCH rows at a time, so that words of like length meet."""
    words: list[bytes] = []
    counts: list[np.ndarray] = []
    for b in rows:
        if b.num_rows:
            words += b.column("word").to_pylist()
            counts.append(b.column("by").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1))
        if len(words) >= 5 * BATCH:
            yield words, np.concatenate(counts)
            words, counts = [], []
    if words:
        yield words, np.concatenate(counts)


@dataclass
class Shares:
    """Of the training rows' tokens, by set of scores: rows (ends), tokens with ends, distinct words, discount."""

    ends: np.ndarray
    total: np.ndarray
    distinct: np.ndarray
    discount: np.ndarray
    all_words: int  # distinct ones of all training rows

    def start(self) -> np.ndarray:
        """Log probability of each set and of an end in it."""
        rows = self.ends + SMALL
        return np.log(rows / rows.sum()) + np.log(rows) - np.log(self.total + 2 * SMALL)

    def words(self, n: np.ndarray, by_pieces: np.ndarray) -> np.ndarray:
        """Log probability of words that are seen n times and have that of `by_pieces` in the lattice of pieces."""
        by_pieces = by_pieces + np.log(self.discount * self.distinct + SMALL) - np.log(self.total + 2 * SMALL)
        own = np.log(np.where(n > 0, n - self.discount, 1.0)) - np.log(self.total + 2 * SMALL)
        return np.where(n > 0, np.logaddexp(own, by_pieces), by_pieces)

    def base(self) -> float:
        """log10 of the base model's denominator."""
        return log(self.total.sum() + self.all_words + (self.ends.sum() > 0) + 1) / LN10


def shares(docs: DataFrame, counts: DataFrame, langs: list[str | None]) -> Shares:
    k = len(langs) + 1
    own = F.col("lang").isin(*(x for x in langs if x is not None)) | F.lit(None in langs) & F.col("lang").isNull()
    found = {(r["other"], r["lang"]): r["n"] for r in docs.where("not held_out").select(F.coalesce(~own, F.lit(True)).alias("other"), F.when(own, F.col("lang")).alias("lang")).groupBy("other", "lang").agg(F.count("*").alias("n")).collect()}
    ends = np.array([*(found.get((False, x), 0) for x in langs), found.get((True, None), 0)], float)
    by = [F.col("by")[i] for i in range(k)]
    sums = counts.agg(F.count_if(F.col("n") > 0), *(F.coalesce(f(x), F.lit(0)) for x in by for f in (F.sum, lambda x: F.count_if(x > 0), lambda x: F.count_if(x == 1), lambda x: F.count_if(x == 2)))).first()
    total, distinct, once, twice = np.array(sums[1:], float).reshape(k, 4).T
    discount = np.where((once > 0) & (twice > 0), once / np.maximum(once + 2 * twice, 1), 0.5)
    return Shares(ends, total + ends, distinct, discount, sums[0])


def score(docs: DataFrame, vocabulary: Pieces, fold: int = FOLD) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row of docs."""
    spark = docs.sparkSession
    docs = texts(docs, "doc_id", "text", F.col("lang").cast("string").alias("lang")).withColumn("held_out", held_out("doc_id", fold))
    langs = groups(docs)
    k = len(langs) + 1
    counts = written(word_counts(docs, langs), "words")
    known = shares(docs, counts, langs)
    sent_pieces = spark.sparkContext.broadcast(train(counts, vocabulary, k))
    columns = [f"s{g}" for g in range(k)]

    def words(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(sent_pieces.value)
        for names, by in blocks(rows):
            logs = (known.words(by, lattice.forward([b" " + w for w in names])) / LN10).astype(np.float32)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(by.sum(1)), *map(pa.array, np.ascontiguousarray(logs.T))], names=["word", "n", *columns])
        trim()

    scored = written(counts.select("word", "by").mapInArrow(words, "word binary, n long, " + ", ".join(f"{c} float" for c in columns)), "scored")
    discard(counts)
    # the least count that at most COMMON words reach; counts differ in a number of ways that grows as a root of the input
    least, seen = 1, 0
    for n, here in scored.where("n > 0").groupBy(F.least("n", F.lit(100_000)).alias("n")).agg(F.count("*").alias("here")).orderBy(F.desc("n")).collect():
        seen += here
        if seen > COMMON:
            least = n + 1
            break
    common = scored.where(F.col("n") >= least).toArrow().combine_chunks()
    values = np.array([np.log10(common["n"].to_numpy() + 1), *(common[c].to_numpy() for c in columns)]).T.reshape(len(common), 1 + k)
    sent = spark.sparkContext.broadcast((common["word"].to_pylist(), values))
    ends = int(known.ends.sum())
    out = "doc_id long, held_out boolean, n_tokens long, n_known long, base double, " + ", ".join(f"{c} double" for c in columns) + ", rare array<struct<word: binary, n: long>>"

    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, values = sent.value
        number = {w: i for i, w in enumerate(names)}

        def one(t):
            w, rare, at, times = lower_words(t), [], [], []
            for x, n in Counter(w).items():
                i = number.get(x)
                if i is None:
                    rare.append({"word": x, "n": n})
                else:
                    at.append(i)
                    times.append(n)
            return len(w) + 1, sum(times) + (ends > 0), *(np.array(times, float) @ values[at]).tolist(), rare

        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), *[pa.float64()] * (1 + k), pa.list_(pa.struct([("word", pa.binary()), ("n", pa.int64())]))]
        kinds = pa.schema([*zip(("doc_id", "held_out", "n_tokens", "n_known", "base", *columns, "rare"), kinds)])
        yield from arrow_rows(((doc, held, *one(t)) for b in rows for doc, t, held in zip(*(b.column(i).to_pylist() for i in range(3)))), kinds, 500)

    first = written(docs.select("doc_id", "text", "held_out").mapInArrow(run, out).withColumn("row", F.monotonically_increasing_id()), "lattice")
    asked = first.select("row", F.explode("rare").alias("w")).select("row", "w.word", F.col("w.n").cast("int").alias("times"))
    met = asked.join(scored.where(F.col("n") < least), "word").select("row", "times", "n", *columns)
    met = met.groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("base_more"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("met"), *(F.sum(F.col("times") * F.col(c).cast("double")).alias(f"{c}_more") for c in columns))
    zero = F.lit(0)
    whole = first.drop("rare").join(met, "row", "left")
    sums = [F.col(c) + F.coalesce(f"{c}_more", zero) + F.lit(float(x) / LN10) for c, x in zip(columns, known.start())]
    top = F.greatest(*sums) if k > 1 else sums[0]
    score = top + F.log10(sum((F.pow(F.lit(10.0), x - top) for x in sums[1:]), F.pow(F.lit(10.0), sums[0] - top)))
    return whole.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("met", zero)).alias("n_known"),
        F.lit(int(known.total.sum())).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_more", zero) + F.lit(log(ends + 1) / LN10) - F.col("n_tokens") * F.lit(known.base())).alias("base_score"),
        score.alias("score"),
    )
