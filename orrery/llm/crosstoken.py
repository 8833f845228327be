"""Alignment of two tokenizers over the same texts, and how often each pair of their ids ends together.

A is a byte-level BPE vocabulary, B a SentencePiece model that writes a space before each text. Where a token of A and one
of B end at the same byte of space + text, that pair is a link, and the place closes a group. Each text is cut into
units that neither tokenizer joins: before each space that follows a character other than white space, the text's last
character apart (A's pattern has white space only at the start of a token, and no piece of B goes on behind a space). A
unit is encoded by both once per worker and kept; counts and alignments of a batch are then numpy arrays. A unit whose tokens
don't spell its bytes leaves its whole text without tokens.

Links are written to the shared folder as one row for each batch of texts and stripe of B ids (id modulo the number of
stripes), distinct within a text. Each map task also adds up its own pairs. A stripe's counts are added with np.add.at into a dense
matrix (B ids of the stripe x all A ids); the row maxima are the best counts. Stripes hold at most `STRIPE_BYTES`. The counts
then go to where the links of their stripe lie, split by salt into parts of bounded size, where both are
streamed: counts first, then links. A batch's sums of all stripes meet its texts again.

Null and empty texts have no tokens and get zeros. Each row is a text of its own, also where ids repeat or are missing.
Columns other than doc_id and text are not read. Texts are encoded whole, in windows cut at units; a text without spaces
is one unit. An empty table gives an empty result.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import slices, texts, trim, written
from orrery.llm.packing import encoder

#: Bytes of text in a batch, of a dense block, and of the links that one task streams.
BATCH_BYTES, STRIPE_BYTES, PART_BYTES = 4 << 20, 100 << 20, 64 << 20
#: Characters of a window of a long text, and units that a worker keeps between batches.
WINDOW, MEMO = 4 << 20, 200_000
#: Bits of an id of A within a pair's number.
A_BITS = 20
#: White space before a space.
_ODD = [c + " " for c in map(chr, range(0x3001)) if c.isspace()]
_CUT = re.compile(r"(?<=\S)(?= .)", re.DOTALL)

_DOCS = "batch long, place int, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string"
_LINKS = "stripe int, links int, texts binary, pairs binary, times binary"


class Aligner:
    """The units of a worker: their numbers of tokens and groups, group texts, and links, by a running number."""

    def __init__(self, vocabulary: str, model: str):
        import sentencepiece

        self.a, self.b = encoder(vocabulary).coder, sentencepiece.SentencePieceProcessor(model_file=model)
        n_a, n_b = self.a.n_vocab, self.b.get_piece_size()
        self.shape = n_b, n_a
        self.bytes_a = [b""] * n_a
        for token in self.a.token_byte_values():
            self.bytes_a[self.a.encode_single_token(token)] = token
        self.bytes_b = [self.spelt(i) for i in range(n_b)]
        self.length_a, self.length_b = (np.array([len(x) for x in all_], np.int64) for all_ in (self.bytes_a, self.bytes_b))
        self.clear()

    def spelt(self, i: int) -> bytes:
        if self.b.is_control(i) or self.b.is_unknown(i):
            return b""
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def clear(self) -> None:
        self.known, self.shown = {}, []
        self.n_a, self.n_b, self.n_groups, self.links = array("q"), array("q"), array("q"), array("q")

    def add(self, units: list[str]) -> None:
        """Encodes units that are not known yet. Those that end in white space or hold B's sign for a space go alone, the others in one string."""
        alone = [u for u in units if not u or u[-1].isspace() or "▁" in u]
        if not self._together([u for u in units if u and not u[-1].isspace() and "▁" not in u]):
            alone = units
        for u in alone:
            if not self._together([u]):  # no token of the two spells it
                self._put([u], np.array([-1]), np.array([-1]), np.array([0]), [], [""])

    def _together(self, units: list[str]) -> bool:
        """Adds units, which lie behind each other in one string, if both tokenizers spell it."""
        if not units:
            return True
        whole = "".join(" " + u for u in units)
        a, b = self.a.encode_ordinary(whole), self.b.encode(whole[1:], num_threads=1)
        spelt = whole.encode()
        if b"".join(map(self.bytes_a.__getitem__, a)) != spelt or b"".join(map(self.bytes_b.__getitem__, b)) != spelt:
            return False
        a, b = np.array(a), np.array(b)
        ends = np.cumsum([1 + len(u.encode()) for u in units])
        ends_a, ends_b = np.cumsum(self.length_a[a]), np.cumsum(self.length_b[b])
        common, at_a, at_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        n_a, n_b, n_groups = (np.bincount(np.searchsorted(ends, x), minlength=len(units)) for x in (ends_a, ends_b, common))
        name_a, name_b = list(map(str, a.tolist())), list(map(str, b.tolist()))
        stop_a, stop_b = (at_a + 1).tolist(), (at_b + 1).tolist()
        cut = [",".join(name_a[i:j]) + "|" + ",".join(name_b[k:m]) for i, j, k, m in zip([0, *stop_a], stop_a, [0, *stop_b], stop_b)]
        stops = np.cumsum(n_groups).tolist()
        self._put(units, n_a, n_b, n_groups, (b[at_b].astype(np.int64) << A_BITS | a[at_a]).tolist(), [";".join(cut[i:j]) for i, j in zip([0, *stops], stops)])
        return True

    def _put(self, units: list[str], n_a: np.ndarray, n_b: np.ndarray, n_groups: np.ndarray, links: list[int], shown: list[str]) -> None:
        self.known.update(zip(units, range(len(self.shown), len(self.shown) + len(units))))
        for held, new in ((self.n_a, n_a), (self.n_b, n_b), (self.n_groups, n_groups), (self.links, links)):
            held.extend(map(int, new))
        self.shown += shown


def windows(text: str, window: int = WINDOW) -> Iterator[list[str]]:
    """The units of a text that isn't empty, without the space before each, a window at a time."""
    at = 0
    while at < len(text):
        end = len(text)
        if end - at > window:
            cut = _CUT.search(text, at + window)
            end = cut.start() if cut else end
        part = text[at:end]
        parts = part.split(" ")
        # a part that is empty or ends in white space is no unit of its own
        if part[0] == " " or part[-1].isspace() or any(end in part for end in _ODD):
            parts = [u[1:] for u in _CUT.split(" " + part)]
        yield parts
        at = end + 1


@lru_cache(1)
def aligner(vocabulary: str, model: str) -> Aligner:
    return Aligner(vocabulary, model)


def stripes_of(shape: tuple[int, int]) -> int:
    """How many stripes keep a dense block of 64-bit counts within STRIPE_BYTES."""
    return -(-shape[0] * shape[1] * 8 // STRIPE_BYTES)


def align(docs: DataFrame, vocabulary: str, model: str) -> DataFrame:
    """Rows of three kinds: a text's numbers (stripe null), links of a batch and stripe, and pairs that a task has added up (texts null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        al = aligner(vocabulary, model)
        n_stripes = stripes_of(al.shape)
        batch_id = TaskContext.get().partitionId() << 32
        mine = (np.zeros(0, np.int64), np.zeros(0, np.int64))
        for batch in batches:
            for part in slices(batch, 1, 1 << 16, BATCH_BYTES):
                if len(al.shown) > MEMO:
                    al.clear()
                numbers, sizes, shown = _encoded(al, part.column(1).to_pylist())
                rows, links, pairs = _batch(al, numbers, sizes, n_stripes)
                yield _docs(batch_id, part.column(0), rows, shown)
                yield _links(batch_id, links)
                mine = _added(np.concatenate([mine[0], pairs[0]]), np.concatenate([mine[1], pairs[1]]))
                if len(mine[0]) > 2_000_000:
                    yield _pairs(batch_id, *mine, n_stripes)
                    mine = (np.zeros(0, np.int64), np.zeros(0, np.int64))
                batch_id += 1
        yield _pairs(batch_id, *mine, n_stripes)
        trim()

    return texts(docs).mapInArrow(run, f"{_DOCS}, {_LINKS}")


def _encoded(al: Aligner, texts_: list[str]) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """The units of all texts, how many each has (none if a unit has no tokens), and the digests of their groups."""
    ids: list[list[np.ndarray]] = [[] for _ in texts_]
    digests, bad, held, size = [sha256() for _ in texts_], set(), [], 0

    def settle() -> None:
        if new := set().union(*(units for _, units in held)) - al.known.keys():
            al.add(list(new))
        for i, units in held:
            of = list(map(al.known.__getitem__, units))
            digests[i].update(((";" if ids[i] else "") + ";".join(map(al.shown.__getitem__, of))).encode())
            ids[i].append(np.array(of, np.int64))
            if 0 in map(al.n_groups.__getitem__, of):
                bad.add(i)

    for i, text in enumerate(texts_):
        for units in windows(text, WINDOW) if text else ():
            held.append((i, units))
            size += len(text)
            if size > WINDOW:
                settle()
                held, size = [], 0
    settle()
    for i in bad:
        ids[i] = []
    sizes = np.array([sum(map(len, x)) for x in ids], np.int64)
    flat = [x for own in ids for x in own]
    return np.concatenate(flat) if flat else np.zeros(0, np.int64), sizes, [d.hexdigest() if n else "" for d, n in zip(digests, sizes.tolist())]


def _added(pairs: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each distinct pair with its sum."""
    own, at = np.unique(pairs, return_inverse=True)
    total = np.zeros(len(own), np.int64)
    np.add.at(total, at, times)
    return own, total


def _batch(al: Aligner, units: np.ndarray, sizes: np.ndarray, n_stripes: int):
    """Per text (n_a, n_b, n_groups); links by stripe (text, pair, times); pairs of the batch with their sums."""
    of = np.repeat(np.arange(len(sizes)), sizes)
    n_groups = np.frombuffer(al.n_groups, np.int64)
    rows = [np.bincount(of, np.frombuffer(x, np.int64)[units], len(sizes)).astype(np.int64) if len(units) else np.zeros(len(sizes), np.int64) for x in (al.n_a, al.n_b, al.n_groups)]
    n = n_groups[units]
    first = (np.cumsum(n_groups) - n_groups)[units]
    at = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
    pair, text = np.frombuffer(al.links, np.int64)[at] if len(at) else np.zeros(0, np.int64), np.repeat(of, n)
    pairs = _added(pair, np.ones(len(pair), np.int64))
    # distinct pairs of each text: by the pair's number in the batch, which is short enough to share a word with the text's
    code = text * len(pairs[0]) + np.searchsorted(pairs[0], pair) if len(pair) else pair
    code, times = np.unique(code, return_counts=True)
    text, pair = np.divmod(code, max(1, len(pairs[0])))
    pair = pairs[0][pair]
    stripe = (pair >> A_BITS) % n_stripes
    order = np.argsort(stripe, kind="stable")
    bounds = np.flatnonzero(np.diff(stripe[order], prepend=-1))
    links = [(int(stripe[o[0]]), text[o], pair[o], times[o]) for o in np.split(order, bounds[1:])] if len(order) else []
    return rows, links, pairs


def _table(n: int, **columns) -> pa.RecordBatch:
    schema = pa.schema([(c.split()[0], {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]]) for c in f"{_DOCS}, {_LINKS}".split(", ")])
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)


def _docs(batch: int, ids: pa.Array, rows: list[np.ndarray], shown: list[str]) -> pa.RecordBatch:
    n = len(shown)
    return _table(n, batch=np.full(n, batch), place=np.arange(n, dtype=np.int32), doc_id=ids, n_a=rows[0], n_b=rows[1], n_groups=rows[2], groups_sha256=shown)


def _links(batch: int, links: list) -> pa.RecordBatch:
    return _table(
        len(links), batch=[batch] * len(links), stripe=[x[0] for x in links], links=[len(x[1]) for x in links],
        texts=[x[1].astype("<u2").tobytes() for x in links], pairs=[_packed(x[2]) for x in links], times=[x[3].astype("<u4").tobytes() for x in links],
    )


def _packed(pairs: np.ndarray) -> bytes:
    """Pairs as B ids, then A ids, of 32 bits each."""
    return (pairs >> A_BITS).astype("<u4").tobytes() + (pairs & (1 << A_BITS) - 1).astype("<u4").tobytes()


def _pairs(batch: int, pairs: np.ndarray, times: np.ndarray, n_stripes: int) -> pa.RecordBatch:
    stripe = (pairs >> A_BITS) % n_stripes
    order = np.argsort(stripe, kind="stable")
    parts = np.split(order, np.flatnonzero(np.diff(stripe[order], prepend=-1))[1:]) if len(order) else []
    return _table(len(parts), batch=[batch] * len(parts), stripe=[int(stripe[o[0]]) for o in parts], links=[len(o) for o in parts], pairs=[_packed(pairs[o]) for o in parts], times=[times[o].astype("<i8").tobytes() for o in parts])


class Block:
    """The dense counts of one stripe: a row for each of its B ids, a column for each A id. Cells in use are listed, so that no pass is over empty ones."""

    def __init__(self, shape: tuple[int, int], n_stripes: int):
        self.n_stripes = n_stripes
        self.counts = np.zeros((-(-shape[0] // n_stripes), shape[1]), np.int64)
        self.used, self.more, self.best = np.zeros(0, np.int64), [], None

    def clear(self) -> None:
        self.counts.reshape(-1)[self.cells()] = 0
        self.used, self.best = np.zeros(0, np.int64), None

    def places(self, pairs: bytes) -> tuple[np.ndarray, np.ndarray]:
        b, a = np.frombuffer(pairs, "<u4").astype(np.int64).reshape(2, -1)
        return b // self.n_stripes, a

    def add(self, pairs: bytes, times: bytes) -> None:
        b, a = self.places(pairs)
        np.add.at(self.counts, (b, a), np.frombuffer(times, "<i8"))
        self.more.append(b * self.counts.shape[1] + a)
        if len(self.more) >= 256:
            self.cells()

    def cells(self) -> np.ndarray:
        """Numbers of the cells in use, ordered."""
        if self.more:
            self.used, self.more = np.unique(np.concatenate([self.used, *self.more])), []
        return self.used

    def held(self, stripe: int) -> tuple[bytes, bytes]:
        """Pairs that occur, with their counts."""
        b, a = np.divmod(self.cells(), self.counts.shape[1])
        return (b * self.n_stripes + stripe).astype("<u4").tobytes() + a.astype("<u4").tobytes(), self.counts[b, a].astype("<i8").tobytes()

    def maxima(self) -> np.ndarray:
        """The largest count of each row."""
        best = np.zeros(len(self.counts), np.int64)
        b, a = np.divmod(self.cells(), self.counts.shape[1])
        np.maximum.at(best, b, self.counts[b, a])
        return best

    def score(self, links: bytes, times: bytes, texts_: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each text with links here: its place, how many links are best, the sum of their counts."""
        if self.best is None:
            self.best = self.maxima()
        b, a = self.places(links)
        count, n = self.counts[b, a], np.frombuffer(times, "<u4").astype(np.int64)
        text = np.frombuffer(texts_, "<u2")
        starts = np.flatnonzero(np.diff(text.astype(np.int32), prepend=-1))
        return text[starts], np.add.reduceat((count == self.best[b]) * n, starts), np.add.reduceat(count * n, starts)


def counted(aligned: DataFrame, shape: tuple[int, int]) -> DataFrame:
    """(stripe, pairs, times): the pairs of each stripe with their counts over the corpus."""
    n_stripes = stripes_of(shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, now = Block(shape, n_stripes), None
        out = lambda: pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), *(pa.array([x], pa.binary()) for x in block.held(now))], names=["stripe", "pairs", "times"])
        for batch in batches:
            for stripe, pairs, times in zip(*(c.to_pylist() for c in batch.columns)):
                if now is not None and stripe != now:
                    yield out()
                    block.clear()
                now = stripe
                block.add(pairs, times)
        if now is not None:
            yield out()
        trim()

    mine = aligned.where("stripe is not null and texts is null").select("stripe", "pairs", "times")
    return mine.repartition("stripe").sortWithinPartitions("stripe").mapInArrow(run, "stripe int, pairs binary, times binary")


def scored(aligned: DataFrame, counts: DataFrame, shape: tuple[int, int]) -> DataFrame:
    """(batch, places, best, sums): for each batch and stripe the texts with links there and their sums."""
    n_stripes = stripes_of(shape)
    links = aligned.where("texts is not null")
    total = links.agg(F.sum("links")).first()[0] or 0
    salts = max(1, int(total * 14 // (n_stripes * PART_BYTES)) + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, now = Block(shape, n_stripes), None
        for batch in batches:
            out = []
            for stripe, salt, at, texts_, pairs, times in zip(*(c.to_pylist() for c in batch.columns)):
                if (stripe, salt) != now:
                    block.clear()
                    now = (stripe, salt)
                if texts_ is None:
                    block.add(pairs, times)
                else:
                    out.append((at, *(x.tobytes() for x in block.score(pairs, times, texts_))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.binary(), pa.binary(), pa.binary()))], names=["batch", "places", "best", "sums"])
        trim()

    columns = ["stripe", "salt", "batch", "texts", "pairs", "times"]
    dealt = links.withColumn("salt", F.pmod(F.xxhash64("batch"), F.lit(salts)).cast("int")).select(*columns)
    sent = counts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).withColumns({"batch": F.lit(None).cast("long"), "texts": F.lit(None).cast("binary")}).select(*columns)
    return dealt.unionByName(sent).repartition("stripe", "salt").sortWithinPartitions("stripe", "salt", F.col("texts").isNotNull()).mapInArrow(run, "batch long, places binary, best binary, sums binary")


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _whole(docs: pa.Table, sums: pa.Table) -> pa.Table:
    """The texts of one batch with the sums of all stripes."""
    order = docs.sort_by("place")
    n = order.num_rows
    best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for places, b, t in zip(*(sums.column(c).to_pylist() for c in ("places", "best", "sums"))):
        at = np.frombuffer(places, "<u2")
        best[at] += np.frombuffer(b, "<i8")
        total[at] += np.frombuffer(t, "<i8")
    names = [c.split()[0] for c in _RESULT.split(", ")]
    more = {"n_links": order["n_groups"], "n_best": pa.array(best), "count_sum": pa.array(total)}
    return pa.table({c: more[c] if c in more else order[c] for c in names})


def alignments(docs: DataFrame, vocabulary: str, model: str) -> DataFrame:
    """Each text's numbers of tokens, groups and links, of links whose pair is the most frequent of its B id, and the sum of the counts of its links."""
    aligned = written(align(docs, vocabulary, model), "aligned")
    shape = _shape(vocabulary, model)
    counts = written(counted(aligned, shape), "counts")
    rows = aligned.where("place is not null").select(*(c.split()[0] for c in _DOCS.split(", ")))
    return rows.groupBy("batch").cogroup(scored(aligned, counts, shape).groupBy("batch")).applyInArrow(_whole, _RESULT)


@lru_cache
def _shape(vocabulary: str, model: str) -> tuple[int, int]:
    """Numbers of ids of B and A."""
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model).get_piece_size(), encoder(vocabulary).coder.n_vocab
