"""Byte-pair merging over whole columns of words: ranks in a hash table, one numpy step for many words.

``Merges`` holds the pairs of a vocabulary, ``encode`` merges the words given as rows of ids, and
``PieceCache`` keeps the ids of pieces seen before, found by the hash of their bytes.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Base of the polynomial hash of bytes; odd, so it has an inverse modulo 2^64.
_BASE = 0x100000001B3
#: Pieces longer than this are merged one by one, and not cached.
LONG_PIECE = 64
_NONE = np.int32(0x7FFFFFFF)


class Merges:
    """(left id, right id) -> (rank, merged id), by open addressing."""

    def __init__(self, pairs: np.ndarray, ranks: np.ndarray, merged: np.ndarray):
        bits = max(4, int(len(pairs) * 4).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        keys = pairs[:, 0].astype(np.uint64) << np.uint64(32) | pairs[:, 1].astype(np.uint64)
        self.keys = np.full(1 << bits, 0xFFFFFFFFFFFFFFFF, np.uint64)
        self.ranks, self.merged = np.full(1 << bits, _NONE, np.int32), np.zeros(1 << bits, np.int32)
        self.probes = 0
        left, slots = np.arange(len(keys)), self._slots(keys)
        while len(left):
            self.probes += 1
            free = self.keys[slots[left]] == 0xFFFFFFFFFFFFFFFF
            _, first = np.unique(np.where(free, slots[left], -1 - left), return_index=True)
            placed = left[first][free[first]]
            self.keys[slots[placed]], self.ranks[slots[placed]], self.merged[slots[placed]] = keys[placed], ranks[placed], merged[placed]
            left = np.setdiff1d(left, placed, assume_unique=True)
            slots[left] = slots[left] + 1 & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys * _MIX >> self.shift).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64)
        slots = self._slots(keys)
        for _ in range(self.probes - 1):
            other = (self.keys[slots] != keys) & (self.ranks[slots] != _NONE)
            if not other.any():
                break
            slots = np.where(other, slots + 1 & self.mask, slots)
        hit = self.keys[slots] == keys
        return np.where(hit, self.ranks[slots], _NONE), self.merged[slots]


def encode(words: list[np.ndarray], merges: Merges) -> list[np.ndarray]:
    """The ids of each word after all merges: the lowest rank first, the leftmost of equal ranks."""
    out: list[np.ndarray] = [w for w in words]
    lengths = np.fromiter((len(w) for w in words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    at = int(np.searchsorted(lengths[order], 2))
    while at < len(order):
        width = lengths[order[at]]
        # words of about one length fill a matrix of bounded size
        end = int(np.searchsorted(lengths[order], width + (width >> 2) + 1))
        end = min(end, at + max(1, (1 << 20) // int(width)))
        rows = order[at:end]
        if width > LONG_PIECE:
            end, rows = at + 1, order[at : at + 1]
            out[rows[0]] = _encode_long(words[rows[0]], merges)
        else:
            for row, ids in zip(rows, _encode_matrix([words[r] for r in rows], lengths[rows], merges)):
                out[row] = ids
        at = end
    return out


def _encode_matrix(words: list[np.ndarray], lengths: np.ndarray, merges: Merges) -> list[np.ndarray]:
    width = int(lengths.max())
    inside = np.arange(width) < lengths[:, None]
    ids = np.zeros((len(words), width), np.int32)
    ids[inside] = np.concatenate(words)
    ranks = np.full((len(words), width), _NONE, np.int32)
    made = np.zeros((len(words), width), np.int32)
    ranks[:, :-1], made[:, :-1] = merges.look_up(ids[:, :-1], ids[:, 1:])
    ranks[~inside] = _NONE
    ranks[np.arange(len(words)), lengths - 1] = _NONE
    lengths = lengths.copy()
    done: dict[int, np.ndarray] = {}
    names = np.arange(len(words))
    columns = np.arange(width)
    while len(names):
        best = ranks.argmin(axis=1)
        row = np.arange(len(names))
        going = ranks[row, best] != _NONE
        if not going.all():
            for i in np.flatnonzero(~going):
                done[int(names[i])] = ids[i, : lengths[i]].copy()
            ids, ranks, made, lengths, names, best = (x[going] for x in (ids, ranks, made, lengths, names, best))
            if not len(names):
                break
            row = np.arange(len(names))
        ids[row, best] = made[row, best]
        # close the gap: everything right of the merged pair moves one to the left
        source = np.minimum(columns + (columns > best[:, None]), width - 1)
        ids, ranks, made = (np.take_along_axis(x, source, 1) for x in (ids, ranks, made))
        lengths -= 1
        ranks[row, lengths - 1] = _NONE
        ranks[row, lengths] = _NONE
        for spot, valid in ((best, best < lengths - 1), (best - 1, best > 0)):
            r, s = row[valid], spot[valid]
            ranks[r, s], made[r, s] = merges.look_up(ids[r, s], ids[r, s + 1])
    return [done[i] for i in range(len(words))]


def _encode_long(word: np.ndarray, merges: Merges) -> np.ndarray:
    """One long word: all pairs of the lowest rank merge in one sweep, unless that makes a pair of lower rank."""
    ids = word.astype(np.int32)
    while len(ids) > 1:
        ranks, made = merges.look_up(ids[:-1], ids[1:])
        lowest = ranks.min()
        if lowest == _NONE:
            break
        spots = np.flatnonzero(ranks == lowest)
        # of overlapping spots every second one merges, counted from the left end of their run
        run = np.cumsum(np.append(True, np.diff(spots) > 1)) - 1
        starts = np.flatnonzero(np.append(True, np.diff(run) > 0))
        spots = spots[(np.arange(len(spots)) - starts[run]) % 2 == 0]
        swept = ids.copy()
        swept[spots] = made[spots]
        swept = np.delete(swept, spots + 1)
        at = spots - np.arange(len(spots))
        sides = np.concatenate((at[at > 0] - 1, at[at < len(swept) - 1]))
        if len(spots) > 1 and len(sides) and merges.look_up(swept[sides], swept[sides + 1])[0].min() < lowest:
            ids[spots[0]] = made[spots[0]]
            ids = np.delete(ids, spots[0] + 1)
        else:
            ids = swept
    return ids


def piece_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each piece's bytes and length."""
    powers = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * powers[0][: len(raw)], out=sums[1:])
    keys = (sums[ends] - sums[starts]) * powers[1][starts]
    keys ^= keys >> np.uint64(29)
    keys = (keys + (ends - starts).astype(np.uint64)) * np.uint64(0xBF58476D1CE4E5B9)
    return keys ^ keys >> np.uint64(32)


_kept_powers: list[tuple[np.ndarray, np.ndarray]] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _kept_powers or len(_kept_powers[0][0]) < n:
        n = max(n, 1 << 16)
        bases = (_BASE, pow(_BASE, -1, 1 << 64))
        made = []
        for base in bases:
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            made.append(np.cumprod(steps))
        _kept_powers[:] = [tuple(made)]
    return _kept_powers[0]


class PieceCache:
    """Ids of byte pieces; forgets everything when full, so its memory is bounded."""

    SLOTS = 1 << 21
    PROBES = 6

    def __init__(self, make: Callable[[list[bytes]], list[np.ndarray]], most_ids: int = 4_000_000):
        self.make, self.most_ids = make, most_ids
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(self.SLOTS, np.uint64)
        self.at = np.zeros(self.SLOTS, np.int32)
        self.lengths = np.zeros(self.SLOTS, np.int32)
        self.pool = np.zeros(self.most_ids, np.uint16)
        self.used = self.stored = 0

    def _find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for those that are not there."""
        slots = (keys & np.uint64(self.SLOTS - 1)).astype(np.int64)
        found = np.where(self.keys[slots] == keys, slots, -1)
        left = np.flatnonzero(found < 0)
        for step in range(1, self.PROBES):
            if not len(left):
                break
            spots = slots[left] + step & self.SLOTS - 1
            hit = self.keys[spots] == keys[left]
            found[left[hit]] = spots[hit]
            left = left[~hit & (self.keys[spots] != 0)]
        return found

    def _store(self, keys: np.ndarray, ids: list[np.ndarray]) -> None:
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        flat = np.concatenate(ids)
        if self.used + len(flat) > self.most_ids or self.stored + len(ids) > self.SLOTS // 2:
            self._clear()
            if len(flat) > self.most_ids or len(ids) > self.SLOTS // 2:
                return
        starts = self.used + np.cumsum(lengths) - lengths
        self.pool[self.used : self.used + len(flat)] = flat
        self.used += len(flat)
        left = np.arange(len(keys))
        for step in range(self.PROBES):
            spots = (keys[left] & np.uint64(self.SLOTS - 1)).astype(np.int64) + step & self.SLOTS - 1
            free = self.keys[spots] == 0
            self.keys[spots[free]] = keys[left[free]]  # of several for one slot the last stays
            own = free & (self.keys[spots] == keys[left])
            self.at[spots[own]], self.lengths[spots[own]] = starts[left[own]], lengths[left[own]]
            self.stored += int(own.sum())
            left = left[~own]
            if not len(left):
                break

    def ids(self, buffer: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pieces' ids in one array, and how many each piece has."""
        if not len(starts):
            return np.zeros(0, np.uint16), np.zeros(0, np.int64)
        keys = piece_hashes(np.frombuffer(buffer, np.uint8), starts, ends) | np.uint64(1)
        found = self._find(keys)
        found[ends - starts > LONG_PIECE] = -1
        counts = np.zeros(len(keys), np.int64)
        hit = found >= 0
        counts[hit] = self.lengths[found[hit]]
        missing = np.flatnonzero(~hit)
        fresh: list[np.ndarray] = []
        if len(missing):
            long = ends[missing] - starts[missing] > LONG_PIECE
            names = keys[missing]
            names[long] = np.arange(int(long.sum()), dtype=np.uint64) << np.uint64(1)  # even: each by itself
            unique, first, which = np.unique(names, return_index=True, return_inverse=True)
            fresh = self.make([buffer[starts[i] : ends[i]] for i in missing[first]])
            sizes = np.fromiter(map(len, fresh), np.int64, len(fresh))
            counts[missing] = sizes[which]
        out = np.empty(int(counts.sum()), np.uint16)
        begins = np.cumsum(counts) - counts
        out[_ranges(begins[hit], counts[hit])] = self.pool[_ranges(self.at[found[hit]].astype(np.int64), counts[hit])]
        if len(missing):
            flat = np.concatenate(fresh).astype(np.uint16)
            offsets = np.cumsum(sizes) - sizes
            out[_ranges(begins[missing], counts[missing])] = flat[_ranges(offsets[which], counts[missing])]
            short = unique & np.uint64(1) == 1
            if short.any():
                self._store(unique[short], [x for x, s in zip(fresh, short) if s])
        return out, counts


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start, start + 1, ... of all ranges, one after the other."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    some = lengths > 0
    starts, lengths = starts[some], lengths[some]
    steps = np.ones(total, np.int64)
    heads = np.cumsum(lengths) - lengths
    steps[0] = starts[0]
    steps[heads[1:]] = starts[1:] - starts[:-1] - lengths[:-1] + 1
    return np.cumsum(steps)
