"""Longest common subsequences of many pairs of texts at once, for matching inside Arrow batches."""

from __future__ import annotations

import numpy as np

#: Letters that fit the bits of one machine word.
WORD = 64


def length(a: str, b: str) -> int:
    """LCS length of two texts of any length: a's letters are the bits of a number, and each letter of b clears those that it extends (Hyyrö's recurrence)."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    open_ = full
    for c in b:
        hit = open_ & masks.get(c, 0)
        open_ = ((open_ + hit) | (open_ - hit)) & full
    return len(a) - open_.bit_count()


def letters(texts: list[str], width: int, fill: int) -> np.ndarray:
    """Code points, a row a text of at most `width` letters."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    out = np.full((len(texts), width), fill, np.int32)
    out[np.arange(width) < size[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.int32)
    return out


def _read(open_: np.ndarray, mask: np.ndarray) -> np.ndarray:
    hit = open_ & mask
    return (open_ + hit) | (open_ - hit)


def lengths(a: list[str], b: list[str]) -> np.ndarray:
    """LCS length of each pair."""
    out = np.zeros(len(a), np.int64)
    short = np.array([len(x) <= WORD for x in a], bool)
    for i in np.flatnonzero(~short):
        out[i] = length(a[i], b[i])
    at = np.flatnonzero(short)
    if len(at):
        own, other = [a[i] for i in at], [b[i] for i in at]
        bits, read = letters(own, WORD, -1), letters(other, max(map(len, other)), -2)
        open_ = np.full(len(at), np.iinfo(np.uint64).max)
        for c in read.T:
            open_ = _read(open_, np.packbits(bits == c[:, None], axis=1, bitorder="little").view(np.uint64).ravel())
        out[at] = WORD - np.bitwise_count(open_).astype(np.int64)
    return out


#: Classes that letters fall into for bounds.
CLASSES = 32


def histogram(texts: list[str]) -> np.ndarray:
    """How many letters of each class every text has."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32) % CLASSES
    return np.bincount(np.repeat(np.arange(len(texts)), size) * CLASSES + codes, minlength=len(texts) * CLASSES).reshape(-1, CLASSES)


class Block:
    """A list of texts that single texts are compared with."""

    #: Masks that are kept at most, letters times texts.
    KEPT = 1 << 23

    def __init__(self, texts: list[str]):
        self.texts = texts
        self.long = np.array([len(t) > WORD for t in texts], bool)
        self.bits = letters([t if len(t) <= WORD else "" for t in texts], WORD, -1)
        self.masks: dict[str, np.ndarray] = {}
        self.classes = histogram(texts)

    def lengths(self, text: str, at: np.ndarray) -> np.ndarray:
        """LCS lengths of a text and the block's texts at the places `at`."""
        open_ = np.full(len(at), np.iinfo(np.uint64).max)
        for c in text:
            mask = self.masks.get(c)
            if mask is None:
                if len(self.masks) * len(self.texts) > self.KEPT:
                    self.masks.clear()
                mask = self.masks[c] = np.packbits(self.bits == ord(c), axis=1, bitorder="little").view(np.uint64).ravel()
            open_ = _read(open_, mask[at])
        out = WORD - np.bitwise_count(open_).astype(np.int64)
        for i in np.flatnonzero(self.long[at]):
            out[i] = length(self.texts[at[i]], text)
        return out

    def bounds(self, classes: np.ndarray) -> np.ndarray:
        """What the LCS of each text and one with these classes can't exceed: a common subsequence takes no more letters of a class than either has."""
        return np.minimum(self.classes, classes).sum(axis=1)


def points(common: np.ndarray, total: np.ndarray) -> np.ndarray:
    """2 LCS / (m + n) in ten-thousandths, rounded half up; two empty texts are equal."""
    common, total = np.asarray(common, np.int64), np.asarray(total, np.int64)
    return np.where(total == 0, 10_000, (40_000 * common + total) // np.maximum(2 * total, 1))


class Trie:
    """Texts of one length as a tree of their beginnings, searched for the best texts of many values at once.

    A step reads one more letter for all pairs of a value and a beginning (the value's letters are the bits), so that texts
    pay for a common beginning once. `ranks` order the texts among equals, the least wins.
    """

    def __init__(self, texts: list[str], ranks: np.ndarray, alphabet: np.ndarray):
        self.size = len(texts[0])
        order = sorted(range(len(texts)), key=texts.__getitem__)
        ranks = ranks[order]
        codes = np.searchsorted(alphabet, letters([texts[i] for i in order], self.size, 0)).astype(np.int32)
        new = np.ones(codes.shape, bool)
        new[1:] = np.logical_or.accumulate(codes[1:] != codes[:-1], axis=1)
        #: for each depth the nodes' letters and least ranks, the places of the first child of every node before, and the letters from there on
        self.levels, before = [], np.zeros(1, np.int64)
        for d in range(self.size):
            at = np.flatnonzero(new[:, d])
            first = np.append(np.searchsorted(at, before), len(at))
            there = np.zeros(len(alphabet), bool)
            there[codes[:, d:].ravel()] = True
            self.levels.append((codes[at, d], np.minimum.reduceat(ranks, at), first, there))
            before = at

    @property
    def nodes(self) -> int:
        return sum(len(x[0]) for x in self.levels)

    def limits(self, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(masks, most), a row a depth: with the letters of `mask` that are taken so far, and `most` to come, a value (rows of places in the alphabet, -1 behind its end) has no longer subsequence.

        The letters to come are some of the texts' letters from there on; those lie in the last part of the value that holds so many of them, or
        cost a letter taken.
        """
        masks, most, before = np.zeros((self.size, len(own)), np.uint64), np.zeros((self.size, len(own)), np.int64), None
        for d in range(self.size):
            rest = self.size - d - 1
            there = self.levels[d + 1][3] if rest else None
            if there is None:
                masks[d] = ~np.uint64(0)
                continue
            if before is None or (there != before).any():
                fit = (own >= 0) & there[own]
                left = np.zeros((len(own), WORD + 1), np.int64)
                left[:, :-1] = fit[:, ::-1].cumsum(axis=1)[:, ::-1]
                others = np.packbits(~fit, axis=1, bitorder="little").view(np.uint64).ravel()
                before = there
            at = (left >= rest).sum(axis=1) - 1
            masks[d] = others | ((np.uint64(1) << np.clip(at, 0, WORD - 1).astype(np.uint64)) - np.uint64(1))
            most[d] = np.minimum(rest, left[:, 0])
        return masks, most

    def search(self, values: np.ndarray, bits: np.ndarray, limits: tuple[np.ndarray, np.ndarray], need: np.ndarray, tie: np.ndarray, rank: np.ndarray, width: int) -> tuple:
        """(best length, its least rank, most that was dropped and its least rank, nodes seen) for each of `values`, numbers of rows of `bits` (a value's masks by letter).

        Looked for are lengths of `need` and more, and of `tie` and more with a rank below `rank`; -1 where there are none.
        At most `width` nodes of a depth are kept for a value, those that can become best.
        """
        n = len(values)
        own, node, open_ = np.arange(n), np.zeros(n, np.int64), np.full(n, np.iinfo(np.uint64).max)
        lost, lost_rank, seen = np.full(n, -1), np.full(n, np.iinfo(np.int64).max), np.zeros(n, np.int64)
        best, best_rank = np.full(n, -1), np.full(n, -1)
        flat, width_of = bits.ravel(), bits.shape[1]
        for d, (letter, least, first, _) in enumerate(self.levels):
            many = first[node + 1] - first[node]
            start = first[node]
            if len(many) and many.max() > 1:
                at = np.repeat(np.arange(len(many)), many)
                start = start[at] + np.arange(len(at)) - np.repeat(many.cumsum() - many, many)
                own, open_ = own[at], open_[at]
            node = start
            open_ = _read(open_, flat[values[own] * width_of + letter[node]])
            bound = np.bitwise_count(~open_ & limits[0][d, values[own]]).astype(np.int64) + limits[1][d, values[own]]
            seen += np.bincount(own, minlength=n)
            ranks = least[node]
            keep = np.flatnonzero((bound >= need[own]) | ((bound >= tie[own]) & (ranks < rank[own])))
            own, node, open_, bound, ranks = own[keep], node[keep], open_[keep], bound[keep], ranks[keep]
            count = np.bincount(own, minlength=n)
            if len(own) and count.max() > width and d < self.size - 1:
                # numbers of a value in order: its best bounds first, then its least ranks
                order = np.argsort((own << 44) | ((4095 - bound) << 32) | ranks, kind="stable")
                place = np.arange(len(order)) - np.repeat(count.cumsum() - count, count)
                out = order[place >= width]
                np.maximum.at(lost, own[out], bound[out])
                np.minimum.at(lost_rank, own[out], ranks[out])
                keep = order[place < width]
                own, node, open_, bound, ranks = own[keep], node[keep], open_[keep], bound[keep], ranks[keep]
        if len(own):
            order = np.lexsort((ranks, -bound, own))
            top = order[np.flatnonzero(np.diff(own[order], prepend=-1))]
            best[own[top]], best_rank[own[top]] = bound[top], ranks[top]
        return best, best_rank, lost, lost_rank, seen


class Index:
    """A list of texts, of which the best for many values are sought at once; `ranks` decide among texts of equal points."""

    #: Nodes that a value keeps at first, by what that grows, and pairs of values and nodes at a time.
    WIDTH, GROWTH, PAIRS = 8, 8, 1 << 16
    #: Letters of the longest text that is kept in a tree, and how many of all letters its nodes may be at most.
    LONGEST, SHARED = 128, 0.4

    def __init__(self, texts: list[str], ranks: np.ndarray):
        self.texts, self.ranks, self.block, self.tries = texts, np.asarray(ranks, np.int64), None, None
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        self.size = size
        if 0 < size.min() and size.max() <= self.LONGEST:
            self.alphabet = np.unique(np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32))
            tries = [Trie([texts[i] for i in at], self.ranks[at], self.alphabet) for at in (np.flatnonzero(size == n) for n in np.unique(size))]
            if sum(t.nodes for t in tries) <= self.SHARED * size.sum():
                self.tries = tries

    def best(self, values: list[str], least: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(points, rank, compared) of each value's best text, among those above `least` points, or with as many and a rank below `rank`; rank -1 if there is none.

        What is read of beginnings is added up to whole texts in `compared`.
        """
        points_, ranks = np.asarray(least, np.int64).copy(), np.full(len(values), -1)
        limit, compared = np.asarray(rank, np.int64).copy(), np.zeros(len(values), np.int64)
        alone = np.ones(len(values), bool)
        if self.tries and values:
            alone = self._in_tries(values, points_, limit, ranks, compared)
        for i in np.flatnonzero(alone):
            points_[i], ranks[i], compared[i] = self._one(values[i], points_[i], limit[i])
        return points_, ranks, compared

    def _one(self, text: str, least: int, rank: int) -> tuple[int, int, int]:
        """Texts are compared in the order of their bounds by letter classes, until the next bound is below the best."""
        block = self.block = self.block or Block(self.texts)
        total = self.size + len(text)
        bound = points(block.bounds(histogram([text])[0]), total)
        order = np.flatnonzero((bound > least) | ((bound == least) & (self.ranks < rank)))
        order = order[np.argsort(-bound[order], kind="stable")]
        best, found, done, step = least, -1, 0, 16
        while done < len(order) and bound[order[done]] >= best:
            at = order[done : done + step]
            at = at[bound[at] >= best]
            got = points(block.lengths(text, at), total[at])
            if got.max() >= best:
                first = self.ranks[at[got == got.max()]].min()
                if got.max() > best or first < rank:
                    best, found, rank = int(got.max()), int(first), int(first)
            done += len(at)
            step *= 2
        return best, found, done

    def _in_tries(self, values: list[str], best: np.ndarray, limit: np.ndarray, ranks: np.ndarray, compared: np.ndarray) -> np.ndarray:
        """Fills in what the trees say; True for the values that have more letters of the texts than a word has bits."""
        size = np.fromiter(map(len, values), np.int64, len(values))
        codes = np.frombuffer("".join(values).encode("utf-32-le", "surrogatepass"), np.uint32)
        place = np.minimum(np.searchsorted(self.alphabet, codes), len(self.alphabet) - 1)
        known = self.alphabet[place] == codes
        who, place = np.repeat(np.arange(len(values)), size)[known], place[known]
        count = np.bincount(who, minlength=len(values))
        bit = np.arange(len(who)) - np.repeat(count.cumsum() - count, count)
        long = count > WORD
        short = ~long[who]
        who, place, bit = who[short], place[short], bit[short]
        own = np.full((len(values), WORD), -1, np.int64)
        own[who, bit] = place
        bits = np.zeros((len(values), len(self.alphabet)), np.uint64)
        np.bitwise_or.at(bits, (who, place), np.uint64(1) << bit.astype(np.uint64))
        limits = [t.limits(own) for t in self.tries]
        open_ = [np.flatnonzero(~long) for _ in self.tries]
        near = np.argsort([abs(t.size - np.median(size)) for t in self.tries], kind="stable")
        width = self.WIDTH
        while any(len(x) for x in open_):
            for k in near:
                trie, left = self.tries[k], []
                step = max(1, self.PAIRS // width)
                for i in range(0, len(open_[k]), step):
                    at = open_[k][i : i + step]
                    need, tie = _needed(best[at], size[at], trie.size)
                    got, rank, lost, lost_rank, seen = trie.search(at, bits, limits[k], need, tie, limit[at], width)
                    compared[at] += -(-seen // trie.size)
                    gain = got >= 0
                    to = at[gain]
                    best[to], limit[to], ranks[to] = points(got[gain], size[to] + trie.size), rank[gain], rank[gain]
                    need, tie = _needed(best[at], size[at], trie.size)
                    left.append(at[(lost >= need) | ((lost >= tie) & (lost_rank < limit[at]))])
                open_[k] = np.concatenate(left) if left else open_[k]
            width *= self.GROWTH
        return long


def _needed(best: np.ndarray, size: np.ndarray, other: int) -> tuple[np.ndarray, np.ndarray]:
    """The least LCS lengths that give more points than `best`, and as many."""
    total = np.maximum(size + other, 1)
    # floor((40000 l + total) / (2 total)) >= p means that 40000 l >= (2 p - 1) total
    least = lambda p: np.maximum(-(-(2 * p - 1) * total // 40_000), 0)
    return least(best + 1), least(best)
