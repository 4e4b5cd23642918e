"""A compressed full-text index over integer sequences: BWT in a wavelet matrix with packed bits.

Suffixes are sorted by their first ``depth`` symbols only, which is all that patterns up to
that length need. The order and the ranks it comes from are dropped when the index is built:
what stays is the wavelet matrix, two packed bit vectors that mark where suffixes stop agreeing
in their first ``length`` and ``length - 1`` symbols, and the smallest owner of each run of
suffixes that agree. All queries work on arrays, many patterns side by side.
"""

from __future__ import annotations

import numpy as np


def sorted_suffixes(text: np.ndarray, depth: int) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Suffix order by the first ``depth`` (a power of two) symbols, by prefix doubling, and the
    ranks of all suffixes by their first 1, 2, 4, ... symbols."""
    n = len(text)
    rank = np.unique(text, return_inverse=True)[1].astype(np.int64)
    ranks, width = {1: rank}, 1
    while width < depth:
        behind = np.full(n, -1, np.int64)
        behind[:max(n - width, 0)] = rank[width:]
        rank = np.unique(rank * (n + 2) + behind + 1, return_inverse=True)[1].astype(np.int64)
        width *= 2
        ranks[width] = rank
    return np.argsort(rank, kind="stable"), ranks


class Bits:
    """A bit vector packed into 64-bit words, with the number of ones before each word."""

    def __init__(self, bits: np.ndarray):
        n = len(bits)
        padded = np.zeros(-(-(n + 1) // 64) * 64, np.uint8)
        padded[:n] = bits
        self.words = np.packbits(padded, bitorder="little").view(np.uint64)
        ones = np.bitwise_count(self.words)
        self.before = np.concatenate(([0], np.cumsum(ones)[:-1])).astype(np.int32)
        self.ones = int(ones.sum())

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & mask).astype(np.int64)


class Classes:
    """Runs of places in suffix order whose suffixes agree in their first symbols."""

    def __init__(self, change: np.ndarray):
        self.bits = Bits(change)
        self.starts = np.append(np.flatnonzero(change), len(change)).astype(np.int32)

    def of(self, place: np.ndarray) -> np.ndarray:
        """Number of the run that holds each place."""
        return self.bits.rank(place + 1) - 1

    def interval(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return self.starts[number].astype(np.int64), self.starts[number + 1].astype(np.int64)


class FMIndex:
    """Index of ``text`` for windows of ``length`` symbols.

    Symbols are 0 (separator) to ``symbols`` - 1; ``owner`` names the owner of each place of the
    text, and ``least`` is the smallest owner per class of equal windows.
    """

    def __init__(self, text: np.ndarray, symbols: int, length: int, owner: np.ndarray):
        self.n, self.length = len(text), length
        order, ranks = sorted_suffixes(text, 1 << max(length - 1, 0).bit_length())
        row = text[order - 1]
        self.levels = max(1, (symbols - 1).bit_length())
        self.bits: list[Bits] = []
        for level in range(self.levels - 1, -1, -1):
            bit = ((row >> level) & 1).astype(np.uint8)
            self.bits.append(Bits(bit))
            row = np.concatenate((row[bit == 0], row[bit == 1]))
        counts = np.bincount(text, minlength=symbols)
        self.first = np.concatenate(([0], np.cumsum(counts)[:-1]))
        self.symbols = symbols
        self.full = Classes(_changes(order, ranks, length))
        self.shorter = Classes(_changes(order, ranks, length - 1))
        self.least = np.minimum.reduceat(owner[order], self.full.starts[:-1])

    def occurrences(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place in the BWT."""
        left, right = np.zeros_like(at), at
        for i, bits in enumerate(self.bits):
            one = ((symbol >> (self.levels - 1 - i)) & 1).astype(bool)
            ones = bits.rank(np.concatenate((left, right)))
            a, b = ones[:len(at)], ones[len(at):]
            zeros = self.n - bits.ones
            left = np.where(one, zeros + a, left - a)
            right = np.where(one, zeros + b, right - b)
        return right - left

    def extend(self, symbol: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: the interval of ``symbol`` + pattern from that of the pattern."""
        both = self.occurrences(np.concatenate((symbol, symbol)), np.concatenate((lo, hi)))
        base = self.first[symbol]
        return base + both[:len(lo)], base + both[len(lo):]


def _changes(order: np.ndarray, ranks: dict[int, np.ndarray], length: int) -> np.ndarray:
    """Where in suffix order the first ``length`` symbols differ from those one place before."""
    n = len(order)
    change = np.zeros(n, bool)
    change[:1] = True
    offset = 0
    for width in sorted(ranks, reverse=True):
        while length - offset >= width:
            part = np.full(n, -1, np.int64)
            part[:max(n - offset, 0)] = ranks[width][offset:]
            part = part[order]
            change[1:] |= part[1:] != part[:-1]
            offset += width
    return change


def _one_by_one(index: FMIndex, flat: np.ndarray, begin: np.ndarray, query: np.ndarray,
                start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Those of the given windows that occur in the index (see ``matches``)."""
    lo, hi = np.zeros(len(query), np.int64), np.full(len(query), index.n, np.int64)
    for step in range(index.length - 1, -1, -1):
        symbol = flat[begin[query] + start + step]
        known = (symbol > 0) & (symbol < index.symbols)
        lo, hi = index.extend(np.where(known, symbol, 0), lo, hi)
        left = known & (lo < hi)
        query, start, lo, hi = query[left], start[left], lo[left], hi[left]
    return query, start, index.least[index.full.of(lo)]


def matches(index: FMIndex, queries: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the queries, of the index's length, that occur in the index.

    Returns query number, start in the query and the smallest owner of the window. This is
    matching statistics cut off at the length: each query is read backwards, all queries side by
    side, with one backward step a symbol; a match that has grown beyond the length is widened
    to the suffixes that share its first ``length`` symbols. Where no match of the full length
    goes on, the search falls back to those that share ``length`` - 1 symbols. Where these end
    too, the windows of the query that are left (they end before that match and before the symbol
    that failed) are searched one by one, those of all queries side by side.
    """
    length = index.length
    if not queries or not index.n:
        return (np.zeros(0, np.int64),) * 3
    sizes = np.array([len(q) for q in queries])
    flat = np.concatenate(queries)
    begin = np.cumsum(sizes) - sizes
    active = np.flatnonzero(sizes >= length)
    at = sizes[active] - 1
    # Where the search of each query stands: interval, matched length, right end of the match.
    lo, hi = np.zeros(len(active), np.int64), np.full(len(active), index.n, np.int64)
    grown = np.zeros(len(active), np.int64)
    tail = at.copy()
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    parked: list[tuple[np.ndarray, np.ndarray]] = []
    while len(active):
        symbol = flat[begin[active] + at]
        known = (symbol > 0) & (symbol < index.symbols)
        safe = np.where(known, symbol, 0)
        new_lo, new_hi = index.extend(safe, lo, hi)
        ok = known & (new_lo < new_hi)
        retry = np.flatnonzero(~ok & known & (grown == length))
        if len(retry):
            a, b = index.extend(safe[retry], *index.shorter.interval(index.shorter.of(lo[retry])))
            new_lo[retry], new_hi[retry] = a, b
            again = a < b
            ok[retry] = again
            grown[retry[again]] = length - 1
        lo, hi = np.where(ok, new_lo, 0), np.where(ok, new_hi, index.n)
        grown = np.where(ok, grown + 1, 0)
        over = np.flatnonzero(grown >= length)
        if len(over):
            kind = index.full.of(lo[over])
            lo[over], hi[over] = index.full.interval(kind)
            grown[over] = length
            found.append((active[over], at[over], index.least[kind]))
        tail = np.where(grown >= length, at + length - 1, tail)
        failed = np.flatnonzero(~ok)
        if len(failed):
            last = np.minimum(tail[failed] - 1, at[failed] + length - 2)
            parked.append((active[failed], last - length + 2))
        at -= 1
        left = ok & (at >= 0)
        if not left.all():
            active, at, lo, hi, grown, tail = (x[left] for x in (active, at, lo, hi, grown, tail))
    if parked:
        query, many = (np.concatenate(x) for x in zip(*parked))
        many = np.maximum(many, 0)
        start = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        found.append(_one_by_one(index, flat, begin, np.repeat(query, many), start))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(x) for x in zip(*found))
