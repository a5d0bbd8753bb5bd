"""Secrets in whole texts: all rules in one automaton, one pass over the bytes.

Each rule is a head and a body; matches are the leftmost, longest, non-overlapping ones of the rule, and those whose
body is shorter than the rule's least length are dropped (they use up their text). The rules' automata
are joined by subset construction, minimised, and laid out as transition arrays; the pass follows one
state over the bytes and stops only where some rule has matched. There the rule's reversed automaton
finds the begin and its own automaton the end.

Spans are in code points, end exclusive. Null and empty texts have none. Rows are independent: repeated
rows and extra columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.automata import Automaton, backwards, compiled, parsed
from tidemark.llm.common import as_bytes, id_and_text, map_arrow, portions


@dataclass(frozen=True)
class Rule:
    kind: str
    head: str
    body: str
    least: int


# The rules of the contract, then forms that widely used services publish for their keys.
BASE_RULES = (
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""", r"[A-Za-z0-9+/_.=-]+", 6),
    Rule("access", "", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", "", r"[0-9a-f]{24,}", 24),
)
MORE_RULES = (
    Rule("github", "", r"gh[opsu]_[A-Za-z0-9]+", 40),
    Rule("slack", "", r"xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule("private_key", "", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 1),
    Rule("jwt", "", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 1),
)
RULES = BASE_RULES + MORE_RULES


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        whole = [parsed(r.head + r.body) for r in rules]
        self._all = compiled(whole, anywhere=True)
        self._rows = [row.tolist() for row in self._all.moves]
        self._bits = [[k for k in range(len(rules)) if mask >> k & 1] for mask in self._all.accepts.tolist()]
        self._ahead: list[Automaton] = [compiled([node]) for node in whole]
        self._back: list[Automaton] = [compiled([backwards(node)]) for node in whole]
        self._heads: list[Automaton | None] = [compiled([parsed(r.head)]) if r.head else None for r in rules]
        self._each: list[Automaton] = [compiled([node], anywhere=True) for node in whole]
        self._each_rows = [[row.tolist() for row in a.moves] for a in self._each]

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("_rows", "_each_rows")}  # workers make their lists from the arrays

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._rows = [row.tolist() for row in self._all.moves]
        self._each_rows = [[row.tolist() for row in a.moves] for a in self._each]

    def spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """(begin, rule, end) in bytes, by begin and rule."""
        rows, accepting, state = self._rows, self._all.accepting, self._all.start
        found: list[tuple[int, int, int]] = []
        used = [0] * len(self.rules)
        # behind a rule's last match its own automaton starts anew: it tells matches that begin there from those that
        # begin inside, and reads each byte once however often the combined one accepts
        read, states = [0] * len(self.rules), [0] * len(self.rules)
        for at, byte in enumerate(data):
            state = rows[state][byte]
            if state >= accepting:
                for k in self._bits[state]:
                    if at >= used[k] and (used[k] == 0 or self._ends(data, at + 1, k, used, read, states)):
                        self._resolve(data, at + 1, k, used, found)
        found.sort()
        return found

    def _ends(self, data: bytes, hit: int, k: int, used: list[int], read: list[int], states: list[int]) -> bool:
        """Whether a match that begins behind the rule's last one ends here."""
        if read[k] < used[k]:
            read[k], states[k] = used[k], self._each[k].start
        rows, state = self._each_rows[k], states[k]
        for byte in data[read[k] : hit]:
            state = rows[state][byte]
        read[k], states[k] = hit, state
        return state >= self._each[k].accepting

    def _resolve(self, data: bytes, hit: int, k: int, used: list[int], found: list[tuple[int, int, int]]) -> None:
        begin = self._back[k].longest_back(data, hit, used[k])
        if begin < 0:
            return
        end = self._ahead[k].longest(data, begin)
        used[k] = end
        head = self._heads[k]
        body = head.longest(data, begin) if head else begin
        if end - body >= self.rules[k].least:
            found.append((begin, k, end))


@cache
def scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    """Compiled once, on the driver; tasks get the transition arrays."""
    return Scanner(rules)


def found_in(data: bytes, scan: Scanner) -> list[tuple[int, int, int]]:
    """(begin, rule, end) in code points."""
    spans = scan.spans(data)
    if not spans or data.isascii():
        return spans
    points = np.concatenate(([0], np.cumsum(np.frombuffer(data, np.uint8) & 0xC0 != 0x80)))
    return [(int(points[a]), k, int(points[b])) for a, k, b in spans]


def secret_spans(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id, spans``: kind, begin and end of every match, by begin and order of the rules."""
    scan = scanner(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            rows = [[{"kind": rules[k].kind, "begin": a, "end": b} for a, k, b in found_in(x, scan)] for x in as_bytes(batch.column("text"))]
            kind = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(rows, kind)], names=["doc_id", "spans"])

    return map_arrow(id_and_text(documents), run, "doc_id long, spans array<struct<kind:string,begin:long,end:long>>")


def span_digests(spans: DataFrame) -> DataFrame:
    """Counts by base kind, and the spans as text."""
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in BASE_RULES]))

    def joined(some: F.Column) -> F.Column:
        return F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind: str) -> F.Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(r.kind) for r in BASE_RULES]
    return spans.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def masked(text: str, spans: list[tuple[int, int, int]], rules: tuple[Rule, ...]) -> str:
    """The text with each stretch that spans cover replaced by ``[kind]`` of its first span."""
    parts, at = [], 0
    for i, (begin, k, end) in enumerate(spans):
        if begin >= at or i == 0:
            parts += (text[at:begin], f"[{rules[k].kind}]")
        at = max(at, end)
    return "".join([*parts, text[at:]])


def without_secrets(documents: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """All rows and columns; secrets in ``text`` masked, ``n_chars`` (if there is one) counted anew where they were."""
    scan = scanner(rules)
    n_chars = next((f for f in documents.schema if f.name == "n_chars"), None)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            texts = batch.column("text").to_pylist()
            fresh, lengths = list(texts), {}
            for i, x in enumerate(as_bytes(batch.column("text"))):
                if spans := found_in(x, scan):
                    fresh[i] = masked(texts[i], spans, rules)
                    lengths[i] = len(fresh[i])
            if lengths:
                at = batch.schema.get_field_index("text")
                batch = batch.set_column(at, batch.schema.field(at), pa.array(fresh, batch.schema.field(at).type))
                if n_chars is not None and n_chars.dataType.typeName() in ("long", "integer"):
                    at = batch.schema.get_field_index("n_chars")
                    counts = [lengths.get(i, n) for i, n in enumerate(batch.column(at).to_pylist())]
                    batch = batch.set_column(at, batch.schema.field(at), pa.array(counts, batch.schema.field(at).type))
            yield batch

    return map_arrow(documents, run, documents.schema)
