"""Documents into sequences of at most ``CAPACITY`` ids, by multiway differencing.

A document's ids end with ``END_ID``. Whole sequences are cut off documents that are longer than one; what
remains is packed in groups, each partition for itself and without a shuffle. A group of pieces goes to
the fewest sequences that could hold it: every piece starts as a partial partition, the two partial
partitions of the largest imbalance are merged again and again, the fullest sequence of one with the
emptiest of the other, until one near-equal partition is left. If a sequence then exceeds the capacity, the
number of sequences is raised by one and the group is partitioned anew.

The vocabulary's own pre-tokenisation is done on arrays of bytes for text of ASCII and Latin-1 letters;
white-space separated chunks with other code points are given to the library, and all pieces are cached.

Null and empty texts have the end id alone. Rows are packed one by one: repeated rows are packed each,
extra columns play no part. An empty table gives no rows.
"""

from __future__ import annotations

import heapq
import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidemark.llm.bpe import Merges, PieceCache, encode
from tidemark.llm.common import as_bytes, id_and_text, map_arrow, portions, table

CAPACITY = 4096
END_ID = 2
#: Pieces that are packed together, and the ids they may have at most before the group is closed.
GROUP_PIECES = 512
GROUP_IDS = 1 << 20

_PLAIN = re.compile(rb"(?:[\x00-\x7f]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])*")


def _printable() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself where it prints, else one from U+0100 on."""
    printing = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printing]
    return [chr(b) if b in printing else chr(0x100 + others.index(b)) for b in range(256)]


class WordTokenizer:
    """A byte-level vocabulary with word ends, lower case, white space dropped."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocabulary, end = model["vocab"], model["end_of_word_suffix"]
        self._inner = np.array([vocabulary[c] for c in _printable()], np.int32)
        self._final = np.array([vocabulary[c + end] for c in _printable()], np.int32)
        pairs = [x if isinstance(x, list) else x.split(" ") for x in model["merges"]]
        rows = np.array([(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in pairs], np.int32)
        self._merges = Merges(rows[:, :2], np.arange(len(rows), dtype=np.int32), rows[:, 2])
        self._cache = PieceCache(self._merge)

    def _merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(pieces)
        plain, other = [], []
        for i, piece in enumerate(pieces):
            (plain if _PLAIN.fullmatch(piece) else other).append(i)
        words = []
        for i in plain:
            raw = np.frombuffer(pieces[i], np.uint8)
            ids = self._inner[raw]
            ids[-1] = self._final[raw[-1]]
            words.append(ids)
        for i, ids in zip(plain, encode(words, self._merges)):
            out[i] = ids
        if other:
            found = self._library.encode_batch([pieces[i].decode() for i in other], add_special_tokens=False)
            for i, x in zip(other, found):
                out[i] = np.array(x.ids, np.int32)
        return out

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and each text's end in it."""
        buffer, starts, ends = pre_tokens(b"\n".join([*texts, b""]))
        ids, counts = self._cache.ids(buffer, starts, ends)
        before = np.concatenate(([0], np.cumsum(counts)))
        return ids, before[np.searchsorted(starts, np.cumsum([len(t) + 1 for t in texts]))]


def pre_tokens(joined: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The bytes in lower case, and where pre-tokens (or chunks left to the library) begin and end in them."""
    raw = np.frombuffer(joined, np.uint8)
    n = len(raw)
    kinds = _KINDS[raw]
    led = np.zeros(n, bool)
    led[1:] = raw[:-1] == 0xC3
    kinds[led & (raw >= 0x80) & (raw < 0xC0) & (raw != 0x97) & (raw != 0xB7)] = 1
    lower = raw + (_UPPER[raw] | led & (raw >= 0x80) & (raw < 0x9F) & (raw != 0x97)) * np.uint8(32)
    white = kinds == 0
    edge = np.diff(white.astype(np.int8), prepend=1, append=1)
    chunk_starts, chunk_ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    strange = np.concatenate(([0], np.cumsum(kinds == 4)))
    odd = strange[chunk_ends] > strange[chunk_starts]
    begins = np.zeros(n + 1, bool)
    begins[:n] = (kinds != np.append(np.uint8(0), kinds[:-1])) & ~white | (kinds == 2)
    quotes = np.flatnonzero(begins[:n] & (raw == 0x27))
    quotes = quotes[quotes + 2 < n]
    if len(quotes):
        one, two = lower[quotes + 1], lower[quotes + 2]
        short = np.isin(one, np.frombuffer(b"stmd", np.uint8))
        long = (two == 0x65) & ((one == 0x72) | (one == 0x76)) | (one == 0x6C) & (two == 0x6C)
        hit = quotes[short | long]
        length = np.where(short, 2, 3)[short | long]
        begins[hit + 1] = False
        rest = hit + length
        rest = rest[rest < n]
        begins[rest[kinds[rest] == 1]] = True
    if odd.any():
        inside = np.zeros(n + 1, np.int32)
        np.add.at(inside, chunk_starts[odd], 1)
        np.add.at(inside, chunk_ends[odd], -1)
        inside = np.cumsum(inside)[:n] > 0
        begins[:n][inside] = False
        begins[chunk_starts[odd]] = True
        lower = np.where(inside, raw, lower)
    starts = np.flatnonzero(begins[:n])
    # a pre-token ends at the next one, or before the white space that comes first
    chunk = np.searchsorted(chunk_starts, starts, "right") - 1
    ends = np.minimum(np.append(starts[1:], n)[: len(starts)], chunk_ends[chunk]) if len(starts) else starts
    return lower.tobytes(), starts, ends


def _kinds() -> np.ndarray:
    """0 white space, 1 letter, 2 digit, 3 other ASCII, 4 not ASCII (unless led by 0xC3)."""
    kinds = np.full(256, 3, np.uint8)
    kinds[[*range(9, 14), 32]] = 0
    kinds[[*range(65, 91), *range(97, 123), 0xC3]] = 1
    kinds[48:58] = 2
    kinds[128:] = 4
    kinds[0xC3] = 1
    return kinds


_KINDS = _kinds()
_UPPER = np.isin(np.arange(256), np.arange(65, 91))


def differenced(sizes: np.ndarray, windows: int) -> np.ndarray:
    """The window of each piece, by multiway differencing."""
    n = len(sizes)
    if windows == 1:
        return np.zeros(n, np.int64)
    # contents are trees: node < n is a piece, others have two children
    left, right = np.full(2 * n + n * windows, -1, np.int64), np.full(2 * n + n * windows, -1, np.int64)
    made = n
    heap = []
    for i, size in enumerate(sizes.tolist()):
        heap.append((-size, i, None))
    heapq.heapify(heap)
    parts: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def part(number: int) -> tuple[np.ndarray, np.ndarray]:
        if number in parts:
            return parts.pop(number)
        sums, nodes = np.zeros(windows, np.int64), np.full(windows, -1, np.int64)
        sums[-1], nodes[-1] = sizes[number], number  # ascending
        return sums, nodes

    serial = n
    while len(heap) > 1:
        a, b = part(heapq.heappop(heap)[1]), part(heapq.heappop(heap)[1])
        sums = a[0] + b[0][::-1]
        x, y = a[1], b[1][::-1]
        both = np.flatnonzero((x >= 0) & (y >= 0))
        nodes = np.where(x >= 0, x, y)
        fresh = np.arange(made, made + len(both))
        made += len(both)
        left[fresh], right[fresh], nodes[both] = x[both], y[both], fresh
        order = np.argsort(sums, kind="stable")
        sums, nodes = sums[order], nodes[order]
        parts[serial] = (sums, nodes)
        heapq.heappush(heap, (-int(sums[-1] - sums[0]), serial, None))
        serial += 1
    out = np.zeros(n, np.int64)
    for window, node in enumerate(part(heap[0][1])[1].tolist()):
        stack = [node] if node >= 0 else []
        while stack:
            node = stack.pop()
            if node < n:
                out[node] = window
            else:
                stack += (int(left[node]), int(right[node]))
    return out


def packed_groups(sizes: np.ndarray, capacity: int = CAPACITY) -> np.ndarray:
    """The sequence of each piece; as many sequences as it takes that none exceeds the capacity."""
    windows = max(1, -(-int(sizes.sum()) // capacity))
    while True:
        where = differenced(sizes, windows)
        if np.bincount(where, sizes, windows).max() <= capacity:
            return where
        windows += 1


@cache
def word_tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def packed(documents: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """A row for each piece: its document and place there, its sequence and place there, its ids' crc32."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = word_tokenizer(path)
        task = TaskContext.get()
        sequence = (task.partitionId() if task else 0) << 40
        names = [x.split()[0] for x in _PIECES.split(", ")]
        waiting: list[tuple] = []
        held = 0

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return table({name: ([r[i] for r in rows], pa.int64()) for i, name in enumerate(names)})

        def close() -> list[tuple]:
            nonlocal sequence
            where = packed_groups(np.array([p[2] for p in waiting], np.int64), capacity)
            filled = [0] * (int(where.max()) + 1)
            rows = []
            for piece, window in zip(waiting, where.tolist()):
                rows.append((*piece, sequence + window, filled[window]))
                filled[window] += piece[2]
            sequence += len(filled)
            waiting.clear()
            return rows

        for batch in portions(batches):
            ids, ends = tokenizer.encode(as_bytes(batch.column("text")))
            at, rows = 0, []
            for doc_id, end in zip(batch.column("doc_id").to_pylist(), ends.tolist()):
                own = np.append(ids[at:end].astype("<u4"), np.uint32(END_ID))
                at = end
                for start in range(0, len(own), capacity):
                    piece = own[start : start + capacity]
                    row = (doc_id, start, len(piece), zlib.crc32(piece.astype("<u4").tobytes()), len(own))
                    if len(piece) == capacity:
                        rows.append((*row, sequence, 0))
                        sequence += 1
                    else:
                        waiting.append(row)
                        held += len(piece)
                if len(waiting) >= GROUP_PIECES or held >= GROUP_IDS:
                    rows += close()
                    held = 0
            if rows:
                yield out(rows)
        if waiting:
            yield out(close())

    return map_arrow(id_and_text(documents), run, _PIECES)
