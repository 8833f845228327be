"""Benchmark decontamination by pigeonhole edit matching.

A test item of n letters may differ from a passage by k = floor(rate * n) edits. It is cut into k + 1 pieces, so a
passage within k edits holds at least one piece unchanged. An item that is too short for an edit must stand as it is, between
spaces or ends. One Aho-Corasick automaton finds the pieces of a block of
items in every whole document; each hit opens a window around the place where its item would lie, and Myers'
bit-parallel distance decides. Documents are never shuffled; items go out in blocks of at most `block_chars` letters,
so what is broadcast stays bounded, and further blocks mean further passes.

Both sides are compared as ASCII-lower-cased words of letters and digits with single spaces between them; lengths, edits
and places count code points of that form. Null texts and texts without words match nothing, nor do such items; items
without an item_id are searched all the same. Equal items each match; a document row that occurs twice is reported twice. Of
several places of one item the one with the fewest edits is reported, then the first. Texts of any length are searched
whole. Columns other than doc_id, item_id and text are not read; an empty table on either side gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orrery.llm.common import arrow_rows, texts

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or 97 <= c <= 122 or 48 <= c <= 57 else 32 for c in range(256))
_OUT = "doc_id long, item_id long, distance long, item_chars long, start long, end long"


def fold(text: str) -> str:
    """Letters, digits and single spaces."""
    return b" ".join(text.encode().translate(_FOLD).split()).decode()


def pieces(item: str, budget: int) -> list[tuple[int, str]]:
    """(offset, piece): budget + 1 pieces whose lengths differ by one at most."""
    n, k = len(item), budget + 1
    marks = [i * n // k for i in range(k + 1)]
    return [(a, item[a:b]) for a, b in zip(marks, marks[1:]) if a < b]


class Myers:
    """Least edit distance between a pattern and any substring of a text, with where the best match ends (Myers 1999)."""

    def __init__(self, pattern: str):
        self.n = len(pattern)
        self.masks: dict[str, int] = {}
        for i, c in enumerate(pattern):
            self.masks[c] = self.masks.get(c, 0) | 1 << i
        self.full, self.top = (1 << self.n) - 1, 1 << self.n - 1

    def best(self, text: str, budget: int | None = None) -> tuple[int, int]:
        """(distance, end). Beyond `budget` the scan stops as soon as the rest of the text can't bring the distance down to it."""
        slack = len(text) + self.n if budget is None else len(text) + budget
        up, down, score = self.full, 0, self.n
        best, at, full, top, masks = self.n, 0, self.full, self.top, self.masks
        for j, c in enumerate(text):
            eq = masks.get(c, 0)
            xv = eq | down
            xh = (((eq & up) + up) ^ up) | eq
            ph = down | ~(xh | up) & full
            mh = up & xh
            if ph & top:
                score += 1
            elif mh & top:
                score -= 1
            ph = ph << 1 & full
            up = (mh << 1 & full) | ~(xv | ph) & full
            down = ph & xv
            if score < best:
                best, at = score, j + 1
            elif score + j >= slack and best > slack - len(text):
                break
        return best, at


class Matcher:
    """Finds items within their edit budgets in a folded text."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        import ahocorasick

        self.items = [(i, t, int(rate * len(t)), Myers(t)) for i, t in items]
        found: dict[str, list[tuple[int, int]]] = {}
        for k, (_, t, budget, _) in enumerate(self.items):
            for offset, piece in pieces(t, budget) if budget else [(-1, f" {t} ")]:
                found.setdefault(piece, []).append((k, offset + len(piece)))
        self.search = ahocorasick.Automaton()
        for piece, places in found.items():
            self.search.add_word(piece, places)
        self.search.make_automaton()

    def windows(self, text: str) -> dict[int, list[list[int]]]:
        """Windows of each item, merged where they overlap; of an item that must stand as it is, its first place."""
        out: dict[int, list[list[int]]] = {}
        # the search sees a space before and after the text
        for end, places in self.search.iter(f" {text} "):
            for k, after in places:
                _, t, budget, _ = self.items[k]
                a = end - after - budget
                if not budget:
                    out.setdefault(k, [[a, a + len(t)]])
                    continue
                b = a + len(t) + 2 * budget
                a = max(0, a)
                own = out.setdefault(k, [])
                if own and a <= own[-1][1] and a >= own[-1][0] and b - own[-1][0] < 3 * len(t):
                    own[-1][1] = max(own[-1][1], b)
                elif not own or [a, b] != own[-1]:
                    own.append([a, b])
        return out

    def matches(self, text: str) -> Iterator[tuple[int, int, int, int, int]]:
        """(item_id, distance, item length, start, end) of the best match of each item that has one."""
        for k, spans in self.windows(text).items():
            item, t, budget, myers = self.items[k]
            best = None
            for a, b in spans:
                distance, end = myers.best(text[a:b], budget)
                if distance <= budget and (best is None or (distance, a + end) < best):
                    best = distance, a + end
            if best:
                start = best[1] - Myers(t[::-1]).best(text[max(0, best[1] - len(t) - budget) : best[1]][::-1])[1]
                yield item, best[0], len(t), max(0, start), best[1]


def blocks(benchmark: DataFrame, item: str, text: str, block_chars: int) -> Iterator[list[tuple[int, str]]]:
    """The folded items in blocks of bounded size, fetched one after another; items without words are left out."""
    held, n = [], 0
    for key, t in benchmark.select(F.col(item).cast("long"), text).where(F.col(text).isNotNull()).toLocalIterator(prefetchPartitions=False):
        t = fold(t)
        if not t:
            continue
        held.append((key, t))
        n += len(t)
        if n >= block_chars:
            yield held
            held, n = [], 0
    if held:
        yield held


def matches(docs: DataFrame, benchmark: DataFrame, rate: float = 0.07, block_chars: int = 2_000_000) -> DataFrame:
    """One row per (document row, item) within the item's edit budget, with the best match and its place in the folded text."""
    spark = docs.sparkSession
    docs = texts(docs)
    kinds = pa.schema([(c.split()[0], pa.int64()) for c in _OUT.split(", ")])
    out = None
    for block in blocks(benchmark, "item_id", "text", block_chars):
        sent = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            matcher = Matcher(sent.value, rate)
            yield from arrow_rows(((d, *m) for b in batches for d, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if t for m in matcher.matches(fold(t))), kinds)

        found = docs.mapInArrow(run, _OUT)
        out = found if out is None else out.unionByName(found)
    return spark.createDataFrame([], _OUT) if out is None else out
