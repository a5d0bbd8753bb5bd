"""Token counts of whole texts as the tokenizer's library gives them, very long texts by overlapping chunks.

A text longer than ``CHUNK`` code points is encoded in chunks that overlap, with offsets. Two neighbours are
spliced where both begin a unit at the same code point and that boundary is proven stable:

* the units are found from left to right, each from where the one before ended, without looking back, so a
  chunk that has a boundary in common with its exact predecessor is exact from there on;
* the boundary keeps ``MARGIN`` (and the longest special string) away from the predecessor's end, so no unit
  or special string before it was cut;
* the code point there composes with nothing before it, so normalisation stops there too.

A unit is a pre-token of a ``.json`` vocabulary and a white-space led word of a ``.model`` one (where no
piece has white space after something else). Where neighbours have no such boundary in common the overlap is
doubled on both sides and both are encoded again, up to the whole text if it is one unit.

Shorter texts are encoded whole. If the vocabulary drops white space and no special string holds any, its
pre-tokens never cross ASCII white space; then the pieces between it are encoded, each distinct one once
while it is kept.

Null and empty texts have no tokens. Repeated rows and ids are counted each, extra columns play no part; an
empty table gives no rows. What is held at once is bounded by the chunk, but for a longer single unit.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import as_bytes, id_and_text, map_arrow, portions, table

LIMIT = 2048
CHUNK = 1 << 15
OVERLAP = 512
MARGIN = 16
#: Distinct pieces whose counts are kept, and their most bytes.
KEPT_PIECES = 1 << 19
PIECE_BYTES = 64


@cache
def _composing() -> frozenset[str]:
    """Code points that normalisation may join to what stands before them."""
    jamo = chain(range(0x1161, 0x1176), range(0x11A8, 0x11C3))
    found = {chr(x) for x in jamo}
    for x in range(0x110000):
        parts = unicodedata.decomposition(chr(x))
        if parts and not parts.startswith("<") and " " in parts:
            found.add(chr(int(parts.split()[1], 16)))
    return frozenset(found)


def stands_alone(character: str) -> bool:
    return character < "\x80" or not (unicodedata.combining(character) or character in _composing())


@dataclass(frozen=True)
class Encoded:
    """A chunk's ids, and where in the whole text its units begin (with the index of their first token)."""

    ids: np.ndarray
    places: np.ndarray
    tokens: np.ndarray


class LibraryTokenizer:
    """A ``.json`` vocabulary, by ``tokenizers``."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._library.no_truncation()
        self._library.no_padding()
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        special = [x["content"] for x in config["added_tokens"]]
        self.margin = MARGIN + max(map(len, special), default=0)
        self.drops_white = not any(c.isspace() for c in "".join(special)) and _drops_white(config["pre_tokenizer"])
        self._kept: dict[bytes, int] = {}

    def encoded(self, text: str, begin: int, end: int) -> Encoded:
        found = self._library.encode(text[begin:end], add_special_tokens=False)
        units = np.array([-1 if x is None else x for x in found.word_ids], np.int64)
        offsets = np.array(found.offsets, np.int64).reshape(-1, 2)
        # a unit's first token, if nothing before it reaches over its begin
        first = np.append(True, units[1:] != units[:-1])[: len(units)]
        first[1:] &= offsets[1:, 0] >= offsets[:-1, 1]
        tokens = np.flatnonzero(first)
        return Encoded(np.array(found.ids, np.int64), offsets[tokens, 0] + begin, tokens)

    def counts(self, texts: list[bytes]) -> list[int]:
        """Tokens of texts that are short enough to be encoded whole."""
        if not self.drops_white:
            return [len(x) for x in self._library.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]
        split = [t.split() for t in texts]
        fresh = list(set(chain.from_iterable(split)).difference(self._kept))
        if len(self._kept) + len(fresh) > KEPT_PIECES:
            self._kept.clear()
            fresh = list(set(chain.from_iterable(split)))
        sizes = map(len, self._library.encode_batch_fast([x.decode() for x in fresh], add_special_tokens=False))
        self._kept.update(zip(fresh, sizes))
        out = [sum(map(self._kept.__getitem__, pieces)) for pieces in split]
        for piece in fresh:
            if len(piece) > PIECE_BYTES:
                del self._kept[piece]
        return out


def _drops_white(step: dict | None) -> bool:
    """Whether pre-tokens are the matches of one pattern that no white space can be part of."""
    if not step or step["type"] != "Sequence":
        return False
    first, *others = step["pretokenizers"]
    return (
        first["type"] == "Split" and first["behavior"] == "Removed" and first["invert"]
        and first["pattern"] == {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
        and all(x["type"] == "ByteLevel" and not x["add_prefix_space"] and not x["use_regex"] for x in others)
    )


class PieceTokenizer:
    """A ``.model`` vocabulary, by ``sentencepiece``."""

    WHITE = "▁"

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self._library = SentencePieceProcessor(model_file=path)
        pieces = (self._library.id_to_piece(i) for i in range(self._library.get_piece_size()))
        self.margin = MARGIN
        self.white_leads = not any(self.WHITE in piece.lstrip(self.WHITE) for piece in pieces)

    def encoded(self, text: str, begin: int, end: int) -> Encoded:
        found = self._library.encode(text[begin:end], return_type="proto", num_threads=1).pieces
        names = [x.piece for x in found]
        tokens = [
            i for i, name in enumerate(names)
            if i and self.white_leads and name.startswith(self.WHITE) and not names[i - 1].endswith(self.WHITE)
        ]
        # the library counts bytes: a code point begins at each byte that continues none
        heads = np.flatnonzero(np.frombuffer(text[begin:end].encode(), np.uint8) & 0xC0 != 0x80)
        places = begin + np.searchsorted(heads, np.array([found[i].begin for i in tokens], np.int64))
        return Encoded(np.array([x.id for x in found], np.int64), places, np.array(tokens, np.int64))

    def counts(self, texts: list[bytes]) -> list[int]:
        return [len(x) for x in self._library.encode([t.decode() for t in texts], num_threads=1)]


@cache
def tokenizer(path: str) -> LibraryTokenizer | PieceTokenizer:
    return PieceTokenizer(path) if path.endswith(".model") else LibraryTokenizer(path)


def _boundary(text: str, before: Encoded, after: Encoded, least: int, most: int) -> tuple[int, int, int] | None:
    """The first stable boundary that both have behind ``least``, up to ``most``: its place and both tokens."""
    places, left, right = np.intersect1d(before.places, after.places, assume_unique=True, return_indices=True)
    for place, i, j in zip(places.tolist(), left.tolist(), right.tolist()):
        if least < place <= most and stands_alone(text[place]):
            return place, int(before.tokens[i]), int(after.tokens[j])
    return None


def spliced(model: LibraryTokenizer | PieceTokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> Iterator[np.ndarray]:
    """The ids of the whole text, part by part."""
    proven = first = begin = 0
    end, lap = min(len(text), chunk), overlap
    now = model.encoded(text, begin, end)
    while end < len(text):
        start = max(begin, end - lap)
        stop = min(len(text), end + chunk)
        after = model.encoded(text, start, stop)
        found = _boundary(text, now, after, max(proven, start), end - model.margin)
        if found is None:
            # its first part is as before: only its end has more to go by
            end = min(len(text), end + lap)
            lap *= 2
            now = model.encoded(text, begin, end)
            continue
        proven, cut, own = found
        yield now.ids[first:cut]
        now, first, begin, end, lap = after, own, start, stop, overlap
    yield now.ids[first:]


_ROW = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"


def token_counts(documents: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = tokenizer(path)
        for batch in portions(batches):
            texts = as_bytes(batch.column("text"))
            whole = [len(t) <= CHUNK or len(t.decode()) <= CHUNK for t in texts]
            short = iter(model.counts([t for t, w in zip(texts, whole) if w]))
            n = [next(short) if w else sum(map(len, spliced(model, t.decode()))) for t, w in zip(texts, whole)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array([x > limit for x in n], pa.bool_()),
                ],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

    return map_arrow(id_and_text(documents), run, _ROW)
