"""Packing documents into token sequences along a Hilbert curve.

Every document's bag of token ids is projected to DIMS + 1 dimensions by fixed pseudo-random weights, of which only the
direction is kept: it depends on the ids' shares, not on how many there are. A direction's first DIMS coordinates lie in
a ball and become a cell of a Hilbert curve, and documents are range-partitioned by curve position. A hash of the doc_id breaks ties, so a third of all documents may share a
cell and still spread over partitions. Within each partition neighbours are packed into sequences of at most
`length` ids; what is left at the end becomes sequences of 2^k ids, which need no padding. Only ids, keys and
doc_ids are shuffled, once.

Null texts are empty, and an empty document is its end id alone. Documents are cut freely; each id lies in one piece.
Rows that repeat a doc_id or lack one are packed each; documents in one place of the curve follow each other by the hash,
then by doc_id. A text of any length is encoded whole; strings of special tokens in a text are ordinary text. Columns
other than doc_id and text are not read, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import texts, trim, written

DIMS, BITS = 3, 10
#: Bits of the tie-breaking hash below the curve position.
TIE_BITS = 24
#: Words that a worker keeps the ids of.
MEMO = 120_000


class Encoder:
    """Ids of a byte-level BPE vocabulary as little-endian unsigned 16-bit bytes.

    The split pattern starts a match at each single space that a non-space follows, so the parts between such spaces
    are encoded apart and kept; texts with other white space around spaces are encoded whole.
    """

    def __init__(self, vocabulary: str):
        import json

        import tiktoken

        model = json.load(open(vocabulary, encoding="utf-8"))
        back = {c: b for b, c in _byte_letters().items()}
        special = {t["content"] for t in model["added_tokens"] if t["special"]}
        ranks = {bytes(back[c] for c in piece): i for piece, i in model["model"]["vocab"].items() if piece not in special}
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        self.coder = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.memo: dict[str, bytes] = {}
        self.pairs = [i.to_bytes(2, "little") for i in range(1 << 16)]

    def plain(self, text: str) -> bytes:
        return b"".join(map(self.pairs.__getitem__, self.coder.encode_ordinary(text)))

    def __call__(self, text: str) -> bytes:
        head, *parts = text.split(" ")
        if not head or "" in parts or any(p[0].isspace() for p in parts):
            return self.plain(text)
        memo, out = self.memo, [self.plain(head)]
        for p in parts:
            ids = memo.get(p)
            if ids is None:
                ids = self.plain(" " + p)
                if len(memo) < MEMO:
                    memo[p] = ids
            out.append(ids)
        return b"".join(out)


@lru_cache(1)
def encoder(vocabulary: str) -> Encoder:
    """One encoder a worker process, whose kept words serve all its tasks."""
    return Encoder(vocabulary)


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Positions on the Hilbert curve of rows of cells (n x d, `bits` bits each), by Skilling's transform."""
    x = cells.astype(np.uint64).T.copy()
    d = len(x)
    q = np.uint64(1) << np.uint64(bits - 1)
    while q > 1:
        p = q - np.uint64(1)
        for i in range(d):
            on = (x[i] & q) > 0
            swap = np.where(on, np.uint64(0), (x[0] ^ x[i]) & p)
            x[0] = np.where(on, x[0] ^ p, x[0]) ^ swap
            x[i] = x[i] ^ swap if i else x[0]
        q >>= np.uint64(1)
    for i in range(1, d):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = np.uint64(1) << np.uint64(bits - 1)
    while q > 1:
        t = np.where((x[d - 1] & q) > 0, t ^ (q - np.uint64(1)), t)
        q >>= np.uint64(1)
    x ^= t
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(d):
            out = out << np.uint64(1) | (x[i] >> np.uint64(b)) & np.uint64(1)
    return out


def weights(n_ids: int, seed: int = 12) -> np.ndarray:
    """Fixed random weights of each id in each dimension, one more than the curve has."""
    return np.random.default_rng(seed).standard_normal((n_ids, DIMS + 1)).astype(np.float32)


def directions(sums: np.ndarray) -> np.ndarray:
    """Cells of documents, whose ids' weights are summed up in rows: the direction without its last coordinate."""
    length = np.sqrt((sums.astype(np.float64) ** 2).sum(1, keepdims=True))
    ball = sums[:, :DIMS] / np.where(length > 0, length, 1)
    return np.clip((ball + 1) / 2 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)


def encode(docs: DataFrame, vocabulary: str, end_id: int = 1, n_ids: int = 65_536) -> DataFrame:
    """(doc_id, key, ids): token ids as 16-bit binary and the curve position with its tie-breaking bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = encoder(vocabulary), end_id.to_bytes(2, "little")
        columns = [np.ascontiguousarray(w) for w in weights(n_ids).T]
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = [coder(t) + end for t in part.column(1).to_pylist()]
                flat, n = np.frombuffer(b"".join(ids), "<u2"), np.array([len(x) // 2 for x in ids])
                starts = np.concatenate([[0], np.cumsum(n)[:-1]])
                cells = directions(np.stack([np.add.reduceat(w[flat], starts) for w in columns], 1))
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(hilbert(cells, BITS).astype(np.int64)), pa.array(ids, pa.binary())], names=["doc_id", "curve", "ids"])
        trim()

    got = texts(docs).mapInArrow(run, "doc_id long, curve long, ids binary")
    tie = F.shiftrightunsigned(F.xxhash64("doc_id", F.crc32("ids")), 64 - TIE_BITS)
    return got.select("doc_id", (F.shiftleft("curve", TIE_BITS) + tie).alias("key"), "ids")


def cuts(total: int, length: int) -> Iterator[int]:
    """Lengths of the sequences that hold `total` ids: full ones, then powers of two."""
    for _ in range(total // length):
        yield length
    rest = total % length
    for bit in range(rest.bit_length() - 1, -1, -1):
        if rest >> bit & 1:
            yield 1 << bit


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, sequence_length long, curve long"


def pack(encoded: DataFrame, length: int = 2048, partition_mb: int = 8) -> DataFrame:
    """One row per piece. `encoded` is a stored table: its keys are read for the partition bounds, its ids once.

    Bounds are token-weighted quantiles of the keys over all rows, from a histogram of the keys' leading bits with a
    fixed number of bins; cells that are heavy by themselves are spread by their tie-breaking bits.
    """
    spark = encoded.sparkSession
    bins = 1 << 16
    shift = DIMS * BITS + TIE_BITS - 16
    histogram = encoded.groupBy(F.shiftright("key", shift).alias("bin")).agg(F.sum(F.octet_length("ids") + 32).alias("n")).collect()
    sizes = np.zeros(bins, np.int64)
    for r in histogram:
        sizes[r["bin"]] = r["n"]
    parts = max(1, min(50_000, int(sizes.sum() // (partition_mb << 20)) + 1), int(spark.conf.get("spark.sql.shuffle.partitions")))
    target = max(1, sizes.sum() / parts)
    before = np.cumsum(sizes) - sizes
    first, spread = (before / target).astype(np.int64), np.maximum(1, np.round(sizes / target)).astype(np.int64)
    first = np.minimum(first, parts - 1)
    spread = np.minimum(spread, parts - first)
    low = (1 << shift) - 1
    # cells that fill much of a partition alone: their number is bounded by that of the partitions
    heavy = encoded.groupBy(F.shiftright("key", TIE_BITS).alias("cell")).agg(F.sum(F.octet_length("ids") + 32).alias("n")).where(F.col("n") > float(target / 4)).select("cell").collect()
    bounds = spark.sparkContext.broadcast((first, spread, np.sort(np.array([r["cell"] for r in heavy], np.int64))))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, spread, heavy = bounds.value
        for b in batches:
            key = b.column(1).to_numpy()
            bin_, rest = key >> shift, key & low
            # a bin that several partitions share is cut by its lower bits, and a heavy cell in it by its tie-breaking bits
            tied = np.isin(key >> TIE_BITS, heavy)
            rest = np.where(tied, (key & (1 << TIE_BITS) - 1) << shift - TIE_BITS, rest)
            part = first[bin_] + (rest * spread[bin_] >> shift)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(part.astype(np.int32))], names=["doc_id", "key", "ids", "part"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from orrery.llm.common import arrow_rows

        base = TaskContext.get().partitionId() << 40
        kinds = pa.schema([(c.split()[0], pa.int64()) for c in _PIECES.split(", ")])

        def rows():
            held, total, sequence = [], 0, 0

            def flush(keep: int):
                """Packs what is held but for the last `keep` ids."""
                nonlocal held, total, sequence
                lengths = [*cuts(total, length)] if not keep else [length] * (total // length)
                at, take = iter(lengths), 0
                room = next(at, 0)
                size = room
                for i, (doc, start, ids, curve, n_doc) in enumerate(held):
                    done, n = 0, len(ids) // 2
                    while done < n and room:
                        take = min(room, n - done)
                        yield doc, start + done, take, crc32(np.frombuffer(ids, "<u2")[done : done + take].astype("<u4").tobytes()), n_doc, base + sequence, size - room, size, curve
                        done += take
                        room -= take
                        if not room:
                            sequence += 1
                            room = size = next(at, 0)
                    if done < n:
                        held = [(doc, start + done, ids[2 * done :], curve, n_doc), *held[i + 1 :]]
                        total = sum(len(x[2]) // 2 for x in held)
                        return
                held, total = [], 0

            for batch in batches:
                for doc, key, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
                    held.append((doc, 0, ids, key >> TIE_BITS, len(ids) // 2))
                    total += len(ids) // 2
                    if total >= 64 * length:
                        yield from flush(1)
            yield from flush(0)

        yield from arrow_rows(rows(), kinds)

    placed = encoded.select("doc_id", "key", "ids").mapInArrow(place, "doc_id long, key long, ids binary, part int")
    dealt = placed.repartitionById(parts, F.col("part")).sortWithinPartitions("key", "doc_id")
    return dealt.select("doc_id", "key", "ids").mapInArrow(run, _PIECES)


def pack_documents(docs: DataFrame, vocabulary: str, length: int = 2048, end_id: int = 1) -> DataFrame:
    return pack(written(encode(docs, vocabulary, end_id), "packing"), length)
