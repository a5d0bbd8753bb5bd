"""Byte-level BPE of whole texts, and back.

Pre-tokens are found without a regular expression. Each code point gets a symbol from class arrays
(letter, number, white space, other; apostrophes that begin a contraction and white space before other
text are told by the next code points). A small automaton over these symbols knows where a pre-token
begins; its transition functions form a monoid of a few dozen elements, so the state before every code
point comes from an associative scan: compositions within blocks, then over the blocks' totals.

The pre-tokens are slices of the text's bytes. Slices seen before have their ids in a cache, others are
merged pair by pair, many at a time. The ids' byte offsets are kept, so any run of ids decodes.

Null texts are empty and have no ids. Rows are independent: repeated rows and extra columns play no part.
"""

from __future__ import annotations

import base64
import hashlib
import itertools
import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.bpe import Merges, PieceCache, encode
from tidemark.llm.common import id_and_text, map_arrow, portions

# Symbols of code points; those of a text's first code point follow, in the same order.
LETTER, NUMBER, OTHER, QUOTE_1, QUOTE_2, JOINING_SPACE, LONE_SPACE, SPACES = range(8)
# States: in a run of letters, numbers, others or white space; after a joining space; one or two code
# points of a contraction to come; at an end.
IN_LETTERS, IN_NUMBERS, IN_OTHERS, IN_SPACES, JOINED, LAST_ONE, LAST_TWO, ENDED = range(8)

# The code points that \s matches in the pattern.
WHITE_SPACE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)


def _step(state: int, symbol: int) -> tuple[bool, int]:
    """Whether a pre-token begins at the symbol, and the state after it."""
    if symbol == LETTER:
        if state in (LAST_ONE, LAST_TWO):
            return False, ENDED if state == LAST_ONE else LAST_ONE
        return state not in (IN_LETTERS, JOINED), IN_LETTERS
    if symbol == NUMBER:
        return state not in (IN_NUMBERS, JOINED), IN_NUMBERS
    if symbol in (OTHER, QUOTE_1, QUOTE_2) and state in (IN_OTHERS, JOINED):
        return False, IN_OTHERS
    if symbol == SPACES:
        return state != IN_SPACES, IN_SPACES
    return True, {OTHER: IN_OTHERS, QUOTE_1: LAST_ONE, QUOTE_2: LAST_TWO, JOINING_SPACE: JOINED, LONE_SPACE: ENDED}[symbol]


@dataclass(frozen=True)
class _Automaton:
    begins: np.ndarray  # state * 16 + symbol -> whether a pre-token begins
    first: np.ndarray  # symbol -> monoid element
    product: np.ndarray  # earlier * size + later -> monoid element
    apply: np.ndarray  # element * 8 + state -> state


@cache
def _automaton() -> _Automaton:
    def function(symbol: int) -> tuple[int, ...]:
        return tuple(_step(ENDED if symbol >= 8 else s, symbol % 8)[1] for s in range(8))

    symbols = [function(x) for x in range(16)]
    elements = list(dict.fromkeys(symbols))
    known = {f: i for i, f in enumerate(elements)}
    for f in elements:  # grows while it is read, until closed under composition
        for g in symbols:
            both = tuple(g[s] for s in f)
            if both not in known:
                known[both] = len(elements)
                elements.append(both)
    product = [known[tuple(g[s] for s in f)] for f in elements for g in elements]
    begins = [symbol >= 8 or _step(s, symbol)[0] for s in range(8) for symbol in range(16)]
    return _Automaton(np.array(begins), np.array([known[f] for f in symbols], np.uint16), np.array(product, np.uint16), np.array(elements, np.uint8).ravel())


@cache
def _classes() -> np.ndarray:
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(unicodedata.category(chr(c))[0], OTHER) for c in range(sys.maxunicode + 1)), np.uint8, sys.maxunicode + 1)
    table[list(WHITE_SPACE)] = SPACES
    return table


def _scan(elements: np.ndarray, block: int = 256) -> np.ndarray:
    """The composition of each element with all before it."""
    a, n = _automaton(), len(elements)
    size = len(a.apply) // 8
    if n <= block:
        return np.fromiter(itertools.accumulate(elements.tolist(), lambda f, g: int(a.product[f * size + g])), np.uint16, n)
    rows = -(-n // block)
    lanes = np.zeros(rows * block, np.uint16)
    lanes[:n] = elements
    lanes = np.ascontiguousarray(lanes.reshape(rows, block).T)
    for i in range(1, block):
        lanes[i] = a.product[lanes[i - 1].astype(np.intp) * size + lanes[i]]
    before = _scan(lanes[-1])[:-1]
    lanes[:, 1:] = a.product[before.astype(np.intp) * size + lanes[:, 1:]]
    return lanes.T.reshape(-1)[:n]


def pre_token_starts(points: np.ndarray, text_starts: np.ndarray) -> np.ndarray:
    """Indices of the code points at which pre-tokens begin; ``text_starts``: where (non-empty) texts begin."""
    n = len(points)
    if not n:
        return np.zeros(0, np.int64)
    a = _automaton()
    symbols = _classes()[points]
    first = np.zeros(n + 1, bool)
    first[text_starts] = True
    first[n] = True
    last = first[1:]  # the last code point of its text
    after = np.append(points[1:], 0)
    after[last] = 0
    spaces = symbols == SPACES
    final = spaces & ~np.append(spaces[1:], False) & ~last
    symbols[final] = np.where(points[final] == 0x20, JOINING_SPACE, LONE_SPACE)
    quotes = np.flatnonzero((points == 0x27) & ~last)
    if len(quotes):
        second = after[quotes]
        third = np.where(last[np.minimum(quotes + 1, n - 1)], 0, after[np.minimum(quotes + 1, n - 1)])
        one = np.isin(second, [ord(c) for c in "stmd"])
        two = (third == ord("e")) & ((second == ord("r")) | (second == ord("v"))) | (second == ord("l")) & (third == ord("l"))
        symbols[quotes[one]], symbols[quotes[two]] = QUOTE_1, QUOTE_2
    symbols = symbols + 8 * first[:n].astype(np.uint8)
    through = _scan(a.first[symbols])
    states = np.empty(n, np.uint8)
    states[0] = ENDED
    states[1:] = a.apply[through[:-1].astype(np.intp) * 8 + ENDED]
    return np.flatnonzero(a.begins[states.astype(np.intp) * 16 + symbols])


@dataclass
class Encoded:
    """Ids of several texts, one after the other; ``ends``: each text's end among them; ``offsets``: where
    each id's bytes begin within the texts' joined bytes."""

    ids: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray


class ByteTokenizer:
    """A rank file's vocabulary; ranks are ids."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for raw, rank in ranks.items():
            self.bytes[rank] = raw
        self.names = [str(i) for i in range(len(self.bytes))]
        self.lengths = np.fromiter(map(len, self.bytes), np.int64, len(self.bytes))
        self._ranks = ranks
        self._singles = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        splits = [(ranks[raw[:i]], ranks[raw[i:]], rank) for raw, rank in ranks.items() for i in range(1, len(raw)) if raw[:i] in ranks and raw[i:] in ranks]
        table = np.array(splits, np.int32)
        self._merges = Merges(table[:, :2], table[:, 2], table[:, 2])
        self._cache = PieceCache(self._merge)

    def _merge(self, pieces: list[bytes]) -> list[np.ndarray]:
        whole = [self._ranks.get(piece, -1) for piece in pieces]
        merged = iter(encode([self._singles[np.frombuffer(p, np.uint8)] for p, w in zip(pieces, whole) if w < 0], self._merges))
        return [np.array([w], np.int32) if w >= 0 else next(merged) for w in whole]

    def encode(self, texts: list[str]) -> Encoded:
        joined = "".join(texts)
        raw = joined.encode()
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        text_ends = np.cumsum([len(t) for t in texts], dtype=np.int64) if texts else np.zeros(0, np.int64)
        begins = np.unique(np.concatenate(([0], text_ends[:-1]))) if len(points) else np.zeros(0, np.int64)
        starts = pre_token_starts(points, begins[begins < len(points)].astype(np.int64))
        places = np.zeros(len(points) + 1, np.int64)
        np.cumsum(1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000), out=places[1:])
        piece_starts = places[starts]
        ids, counts = self._cache.ids(raw, piece_starts, np.append(piece_starts[1:], len(raw))[: len(starts)])
        before = np.concatenate(([0], np.cumsum(counts)))
        sizes = self.lengths[ids]
        return Encoded(ids, before[np.searchsorted(starts, text_ends)], np.cumsum(sizes) - sizes)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids))


@cache
def byte_tokenizer(path: str) -> ByteTokenizer:
    return ByteTokenizer(path)


def encoded(documents: DataFrame, path: str) -> DataFrame:
    """``doc_id, ids, offsets``: each text's ids and the byte offsets at which they begin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = byte_tokenizer(path)
        for batch in portions(batches):
            e = tokenizer.encode(batch.column("text").to_pylist())
            begins = np.concatenate(([0], e.ends[:-1])).astype(np.int64)
            bases = np.repeat(np.append(e.offsets, 0)[begins], e.ends - begins)
            ends = pa.array(np.concatenate(([0], e.ends)).astype(np.int32))
            arrays = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (e.ids.astype(np.int32), (e.offsets - bases).astype(np.int64))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=["doc_id", "ids", "offsets"])

    return map_arrow(id_and_text(documents), run, "doc_id long, ids array<int>, offsets array<long>")


def token_digests(documents: DataFrame, path: str) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: the texts encoded, and their ids decoded again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = byte_tokenizer(path)
        name = tokenizer.names.__getitem__
        for batch in portions(batches):
            e = tokenizer.encode(batch.column("text").to_pylist())
            ids, at, rows = e.ids.tolist(), 0, ([], [], [])
            for end in e.ends.tolist():
                own = ids[at:end]
                at = end
                rows[0].append(len(own))
                rows[1].append(hashlib.sha256(",".join(map(name, own)).encode()).hexdigest())
                rows[2].append(hashlib.sha256(tokenizer.decode(own)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows[0], pa.int64()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.string())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return map_arrow(id_and_text(documents), run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
