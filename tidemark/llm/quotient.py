"""Counting quotient filter over 64-bit fingerprints, built in bulk and merged by sorted remainders."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np


class CountingQuotientFilter:
    """A multiset of fingerprints: the high bits are the slot's quotient, the low bits its stored remainder.

    Bulk building leaves no gaps, so the runs of the quotients stand in order, remainders sorted within
    each. ``occupied`` has a bit for each quotient, ``run_ends`` a bit for each stored remainder; the
    two bit vectors alone restore the quotients, so nothing is lost and merging needs no rehashing.
    """

    def __init__(self, quotient_bits: int, occupied: np.ndarray, run_ends: np.ndarray, remainders: np.ndarray, counts: np.ndarray):
        self.quotient_bits = quotient_bits
        self.occupied, self.run_ends, self.remainders, self.counts = occupied, run_ends, remainders, counts

    @classmethod
    def of_sorted(cls, prints: np.ndarray, counts: np.ndarray) -> CountingQuotientFilter:
        """From distinct ascending fingerprints; as many quotients as make about one remainder for each."""
        bits = max(3, int(len(prints)).bit_length())
        quotients = (prints >> np.uint64(64 - bits)).astype(np.int64)
        occupied = np.zeros(1 << bits, bool)
        occupied[quotients] = True
        run_ends = np.append(quotients[1:] != quotients[:-1], True)[: len(prints)]
        remainders = prints & np.uint64((1 << (64 - bits)) - 1)
        return cls(bits, np.packbits(occupied), np.packbits(run_ends), remainders, counts.astype(np.uint32))

    @classmethod
    def of(cls, prints: np.ndarray) -> CountingQuotientFilter:
        return cls.of_sorted(*np.unique(prints.astype(np.uint64), return_counts=True))

    def entries(self) -> tuple[np.ndarray, np.ndarray]:
        """The fingerprints, ascending, and their counts."""
        stored = len(self.remainders)
        ends = np.unpackbits(self.run_ends, count=stored).astype(bool)
        run = np.concatenate(([0], np.cumsum(ends)[:-1])).astype(np.int64) if stored else np.zeros(0, np.int64)
        quotients = np.flatnonzero(np.unpackbits(self.occupied))[run].astype(np.uint64)
        return quotients << np.uint64(64 - self.quotient_bits) | self.remainders, self.counts

    def merged(self, other: CountingQuotientFilter) -> CountingQuotientFilter:
        """Both multisets in one filter: sorted entries interleave, counts of equal ones add up."""
        (a, a_counts), (b, b_counts) = self.entries(), other.entries()
        both = np.concatenate((a, b))
        order = np.argsort(both, kind="stable")  # two ascending runs: the stable sort merges them
        both, counts = both[order], np.concatenate((a_counts, b_counts))[order].astype(np.uint64)
        first = np.flatnonzero(np.append(True, both[1:] != both[:-1])[: len(both)])
        counts = np.add.reduceat(counts, first) if len(first) else counts
        return CountingQuotientFilter.of_sorted(both[first], np.minimum(counts, np.uint64(0xFFFFFFFF)))

    def to_bytes(self) -> bytes:
        head = np.array([self.quotient_bits, len(self.remainders)], np.uint64)
        return b"".join(x.tobytes() for x in (head, self.remainders, self.counts, self.occupied, self.run_ends))

    @classmethod
    def from_bytes(cls, raw: bytes) -> CountingQuotientFilter:
        bits, stored = (int(x) for x in np.frombuffer(raw, np.uint64, 2))
        at = 16
        parts = []
        for kind, n in ((np.uint64, stored), (np.uint32, stored), (np.uint8, (1 << bits) // 8), (np.uint8, (stored + 7) // 8)):
            parts.append(np.frombuffer(raw, kind, n, at))
            at += n * np.dtype(kind).itemsize
        return cls(bits, parts[2], parts[3], parts[0], parts[1])


def merged_all(filters: Iterable[CountingQuotientFilter]) -> CountingQuotientFilter | None:
    """All of them in one (None if there are none); like sizes merge, so an entry moves only log(n) times."""
    held: list[CountingQuotientFilter] = []
    for one in filters:
        while held and len(held[-1].remainders) <= 2 * len(one.remainders):
            one = held.pop().merged(one)
        held.append(one)
    while len(held) > 1:
        held.append(held.pop().merged(held.pop()))
    return held[0] if held else None
