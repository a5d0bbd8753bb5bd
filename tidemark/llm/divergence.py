"""Which sources of a language differ, and by which terms: counts by a translate table, compared group by group.

One ``bytes.translate`` lowers A-Z and blanks every separator, ``bytes.split`` gives the terms and a Counter
for each document their frequencies. A task numbers the terms it meets and adds documents up by group and
term, in arrays; what it holds goes on as blocks, one for each slice of the terms' hashes. A slice's blocks
meet in one task, where they are added up; since all groups' counts of a term lie there, rare terms end
there too.

A language keeps the terms of at least ``LEAST_DOCUMENTS`` of its documents. Each group and each language
gives a kept term the share ``p`` (in ``SCALE`` parts, one count added); two groups differ in a term by
``floor((p - q)^2 / (p + q))``. Pairs of sources are summed over all kept terms: a term contributes the
rows of the groups that hold it against every other, the terms that neither group of a pair holds
contribute one product. Terms are dealt to slices by their hash, so no language is one task's work; a
slice keeps sums of its pairs only. All arithmetic is on integers that do not overflow.

Null text, lang and source are empty; a group whose texts have no terms is still a group. Repeated rows
are documents of their own. Long texts are read in blocks; equal values rank by the item's bytes. An
empty table gives no rows. Columns besides ``text``, ``lang`` and ``source`` play no part.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import as_bytes, map_arrow, portions, stored, table
from tidemark.llm.resampling import word_blocks

LEAST_DOCUMENTS = 10
SCALE = 1_000_000_000
TERM_RANKS = 10
#: Counts (of a document's term, 16 bytes) and distinct terms that a task holds before it hands them on.
HELD_COUNTS = 1 << 22
HELD_TERMS = 1 << 19
#: Slices that terms are counted in: one for each so many documents, and at least so many.
SLICE_DOCUMENTS = 1 << 12
LEAST_SLICES = 64
#: Rows of a slice that wait until they are added up.
WAITING_ROWS = 1 << 20
#: Kept terms of a slice of pairs, about, and cells that are compared at once.
SLICE_TERMS = 1 << 14
BLOCK_CELLS = 1 << 12

_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 0x20 for b in range(256))
#: Bits of a code that number the term; those above number the group.
_TERM_BITS = 40


class _Held:
    """Counts of a task's documents by group and term."""

    def __init__(self) -> None:
        self.terms: defaultdict[bytes, int] = defaultdict()
        self.terms.default_factory = self.terms.__len__  # a new term gets the next number
        self.groups: dict[tuple[str, str], int] = {}
        self.codes: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.size = 0

    def add(self, group: tuple[str, str], own: Counter) -> None:
        ids = np.fromiter(map(self.terms.__getitem__, own), np.int64, len(own))
        self.codes.append(ids | self.groups.setdefault(group, len(self.groups)) << _TERM_BITS)
        self.counts.append(np.fromiter(own.values(), np.int64, len(own)))
        self.size += len(own)

    def full(self) -> bool:
        return self.size > HELD_COUNTS or len(self.terms) > HELD_TERMS

    def blocks(self, slices: int) -> Iterator[tuple[int, bytes]]:
        if not self.size:
            return
        codes = np.concatenate(self.codes)
        order = np.argsort(codes, kind="stable")
        codes = codes[order]
        starts = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
        counts = np.add.reduceat(np.concatenate(self.counts)[order], starts)
        documents = np.diff(np.append(starts, len(codes)))
        terms = codes[starts] & ((1 << _TERM_BITS) - 1)
        groups = codes[starts] >> _TERM_BITS
        places = np.fromiter(map(crc32, self.terms), np.int64, len(self.terms))[terms] % slices
        order = np.argsort(places, kind="stable")
        names = pa.array(list(self.terms), pa.large_binary()).cast(pa.large_string())
        langs, sources = (pa.array([g[i] for g in self.groups], pa.string()) for i in (0, 1))
        own = pa.array(groups[order])
        columns = [langs.take(own), sources.take(own), names.take(pa.array(terms[order])), pa.array(counts[order]), pa.array(documents[order])]
        whole = pa.RecordBatch.from_arrays(columns, schema=_BLOCK)
        places = places[order]
        cuts = np.flatnonzero(np.append(True, places[1:] != places[:-1]))
        for begin, end in zip(cuts.tolist(), [*cuts[1:].tolist(), len(places)]):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, _BLOCK) as writer:
                writer.write_batch(whole.slice(begin, end - begin))
            yield int(places[begin]), sink.getvalue().to_pybytes()


_BLOCK = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.large_string()), ("n", pa.int64()), ("docs", pa.int64())])
_CELLS = "lang string, source string, term string, n long, n_lang long, first boolean"


def _counted(slices: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(held: _Held) -> Iterator[pa.RecordBatch]:
            for number, block in held.blocks(slices):
                yield table({"slice": ([number], pa.int32()), "block": ([block], pa.binary())})

        held = _Held()
        for batch in portions(batches):
            keys = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist())
            for group, text in zip(keys, as_bytes(batch.column("text"))):
                own: Counter = Counter()
                for words in word_blocks(text, _TABLE):
                    own.update(words)
                held.add(group, own)
                if held.full():
                    yield from out(held)
                    held = _Held()
        yield from out(held)

    return run


def _added(rows: pa.Table, keys: list[str]) -> pa.Table:
    sums = rows.group_by(keys, use_threads=False).aggregate([("n", "sum"), ("docs", "sum")])
    return sums.rename_columns({"n_sum": "n", "docs_sum": "docs"})


def _kept_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The cells of kept terms, slice by slice (rows come sorted by slice)."""

    def rows() -> Iterator[tuple[int, bytes]]:
        for batch in batches:
            yield from zip(batch.column("slice").to_pylist(), batch.column("block").to_pylist())

    group = ["lang", "source", "term"]
    for _, own in groupby(rows(), itemgetter(0)):
        waiting, n_waiting, sums = [], 0, None
        for _, block in own:
            waiting.append(pa.ipc.open_stream(block).read_all())
            n_waiting += waiting[-1].num_rows
            if n_waiting > WAITING_ROWS + (sums.num_rows if sums else 0):
                sums = _added(pa.concat_tables([*([sums] if sums else []), *waiting]).select(_BLOCK.names), group).select(_BLOCK.names)
                waiting, n_waiting = [], 0
        sums = _added(pa.concat_tables([*([sums] if sums else []), *waiting]).select(_BLOCK.names), group)
        terms = _added(sums, ["lang", "term"])
        terms = terms.filter(pc.greater_equal(terms["docs"], LEAST_DOCUMENTS)).rename_columns({"n": "n_lang"}).drop_columns("docs")
        cells = sums.join(terms, ["lang", "term"], join_type="inner", use_threads=False).sort_by([("lang", "ascending"), ("term", "ascending")])
        if not cells.num_rows:
            continue
        cells = cells.combine_chunks()
        changed = [pc.not_equal(cells[c].combine_chunks()[1:], cells[c].combine_chunks()[:-1]).to_numpy(zero_copy_only=False) for c in ("lang", "term")]
        first = pa.array(np.append(True, changed[0] | changed[1]))
        columns = [cells[c] for c in ("lang", "source")] + [cells["term"].cast(pa.string()), cells["n"], cells["n_lang"], first]
        yield from pa.table(columns, names=["lang", "source", "term", "n", "n_lang", "first"]).to_batches(max_chunksize=1 << 16)


def kept_cells(documents: DataFrame) -> DataFrame:
    """``lang, source, term, n, n_lang, first``: occurrences of kept terms in groups that have them and in
    their language; ``first`` marks one row of each language's term."""
    slices = max(LEAST_SLICES, documents.count() // SLICE_DOCUMENTS)
    blocks = map_arrow(documents, _counted(slices), "slice int, block binary")
    return map_arrow(blocks.repartition("slice").sortWithinPartitions("slice"), _kept_cells, _CELLS)


def _share(count: str, total: str, kept: str) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * kept)), exactly."""
    return F.expr(f"1 + (cast({SCALE} as decimal(10,0)) * (cast({count} as decimal(20,0)) + 2)) div (cast({total} as decimal(24,0)) + 2 * {kept})")


def shares(counts: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """The same on arrays; ``totals`` already hold two for each kept term. Three digits at a time stay within 64 bits."""
    whole, rest = np.divmod(counts + 2, totals)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, totals)
        whole = whole * 1000 + digits
    return whole + 1


def differences(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // (p + q)


_DEALT = "lang string, slice int, kind int, term string, place int, n long, total long"
_SUMS = "lang string, a int, b int, summed long, n_both long"


class _Pairs:
    """Sums over one slice of a language's terms, for all pairs of its groups."""

    def __init__(self, totals: np.ndarray):
        self.totals = totals
        self.summed, self.both = (np.zeros((len(totals), len(totals)), np.int64) for _ in range(2))

    def add(self, terms: np.ndarray, places: np.ndarray, counts: np.ndarray) -> None:
        """Cells of whole terms; ``terms`` numbers them from 0."""
        groups = np.zeros((int(terms[-1]) + 1, len(self.totals)), np.int64)
        groups[terms, places] = counts
        p = shares(groups, self.totals)
        held = groups > 0
        for begin in range(0, len(terms), BLOCK_CELLS):
            rows, own = terms[begin : begin + BLOCK_CELLS], places[begin : begin + BLOCK_CELLS]
            each = differences(p[rows, own][:, None], p[rows])
            there = held[rows]
            np.add.at(self.summed, own, each)
            # the pair's other row adds the same again where both hold the term
            np.add.at(self.summed.T, own, np.where(there, 0, each))
            np.add.at(self.both, own, there)

    def rows(self, lang: str) -> pa.RecordBatch:
        a, b = np.nonzero(self.summed + self.both)
        apart = a != b
        a, b = a[apart], b[apart]
        return table({
            "lang": ([lang] * len(a), pa.string()),
            "a": (a.tolist(), pa.int32()),
            "b": (b.tolist(), pa.int32()),
            "summed": (self.summed[a, b].tolist(), pa.int64()),
            "n_both": (self.both[a, b].tolist(), pa.int64()),
        })


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by language and slice: first its groups in order (kind 0), then its cells by term (kind 1)."""
    lang = number = pairs = None
    totals: list[int] = []
    waiting: list[pa.RecordBatch] = []

    def flush(last: bool) -> None:
        """Compares the cells that wait, up to the last term's (which may go on in the next batch)."""
        nonlocal pairs, waiting
        if not waiting:
            return
        cells = pa.Table.from_batches(waiting).combine_chunks()
        terms = cells.column("term").combine_chunks()
        changed = np.concatenate(([False], pc.not_equal(terms[1:], terms[:-1]).to_numpy(zero_copy_only=False)))
        numbers = np.cumsum(changed)
        end = len(terms) if last else int(np.searchsorted(numbers, numbers[-1]))
        if pairs is None:
            pairs = _Pairs(np.array(totals, np.int64))
        if end:
            places, counts = (cells.column(c).to_numpy()[:end] for c in ("place", "n"))
            pairs.add(numbers[:end], places, counts)
        waiting = cells.slice(end).to_batches()

    for batch in batches:
        kinds = batch.column("kind").to_numpy()
        langs, numbers = batch.column("lang").to_pylist(), batch.column("slice").to_pylist()
        begin = 0
        while begin < len(kinds):
            if (langs[begin], numbers[begin]) != (lang, number):
                flush(True)
                if pairs is not None:
                    yield pairs.rows(lang)
                lang, number, pairs, totals = langs[begin], numbers[begin], None, []
            end = begin + 1
            while end < len(kinds) and kinds[end] == kinds[begin] and numbers[end] == number and langs[end] == lang:
                end += 1
            part = batch.slice(begin, end - begin)
            if kinds[begin] == 0:
                totals += part.column("total").to_pylist()
            else:
                waiting.append(part)
            begin = end
        if sum(b.num_rows for b in waiting) >= BLOCK_CELLS:
            flush(False)
    flush(True)
    if pairs is not None:
        yield pairs.rows(lang)


def _pairs(groups: DataFrame, cells: DataFrame, slices: int) -> DataFrame:
    """``lang, source, item, value`` for every ordered pair of a language's sources."""
    keys = groups.select("lang", "place", (F.col("total") + 2 * F.col("kept")).alias("total"))
    heads = keys.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))).select(
        "lang", "slice", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("term"), "place", F.lit(0).cast("long").alias("n"), "total"
    )
    tails = cells.select(
        "lang", F.pmod(F.xxhash64("term"), F.lit(slices)).cast("int").alias("slice"), F.lit(1).alias("kind"), "term", "place", "n", F.lit(0).cast("long").alias("total")
    )
    dealt = heads.unionByName(tails).repartition("lang", "slice").sortWithinPartitions("lang", "slice", "kind", "term", "place")
    sums = map_arrow(dealt, _pair_sums, _SUMS).groupBy("lang", "a", "b").agg(F.sum("summed").alias("summed"), F.sum("n_both").alias("n_both"))
    side = lambda name: groups.select(
        "lang", "kept", F.col("place").alias(name), F.col("source").alias(f"source_{name}"), F.col("held").alias(f"held_{name}"), F.col("unseen").alias(f"unseen_{name}")
    )
    pairs = side("a").join(side("b").drop("kept"), "lang").where("a <> b").join(sums, ["lang", "a", "b"], "left")
    neither = F.col("kept") - F.col("held_a") - F.col("held_b") + F.coalesce("n_both", F.lit(0))
    apart = F.expr("((unseen_a - unseen_b) * (unseen_a - unseen_b)) div (unseen_a + unseen_b)")
    value = F.when(F.col("kept") == 0, 0).otherwise(F.coalesce("summed", F.lit(0)) + neither * apart)
    return pairs.select("lang", F.col("source_a").alias("source"), F.lit("pair").alias("part"), F.col("source_b").alias("item"), value.cast("long").alias("value"))


def _terms(cells: DataFrame) -> DataFrame:
    """The terms that a group has more of than its language."""
    priced = cells.withColumn("p", _share("n", "total", "kept")).withColumn("q", _share("n_lang", "total_lang", "kept"))
    value = F.expr("((p - q) * (p - q)) div (p + q)")
    return priced.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), value.alias("value"))


def audited(documents: DataFrame) -> DataFrame:
    """``lang, source, part, item, value, rank``: the pairs of sources, and each source's leading terms."""
    texts = documents.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    found = stored(kept_cells(texts))
    held = found.groupBy("lang", "source").agg(F.count("*").alias("held"), F.sum("n").alias("total"), F.count_if("first").alias("firsts"))
    of_lang, zero = Window.partitionBy("lang"), F.lit(0).cast("long")
    groups = (
        texts.select("lang", "source").distinct().join(held, ["lang", "source"], "left")
        .select("lang", "source", *[F.coalesce(c, zero).alias(c) for c in ("held", "total", "firsts")])
        .withColumns({"kept": F.sum("firsts").over(of_lang), "total_lang": F.sum("total").over(of_lang)})
        .withColumn("place", F.row_number().over(of_lang.orderBy("source")) - 1)
        .withColumn("unseen", F.when(F.col("kept") > 0, _share("0", "total", "kept")))
    )
    groups = stored(groups)
    known = groups.select(F.col("lang").alias("lang_"), F.col("source").alias("source_"), "place", "total", "kept", "total_lang")
    # null-safe equality gives the join shuffles of its own, of which Spark can split a large group's
    cells = found.join(known, F.col("lang").eqNullSafe(F.col("lang_")) & F.col("source").eqNullSafe(F.col("source_")))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.asc("item")))
    slices = max(1, groups.agg(F.sum("firsts")).first()[0] or 0) // SLICE_TERMS + 1
    pairs = _pairs(groups, cells, slices).withColumn("rank", place)
    terms = _terms(cells).withColumn("rank", place).where(F.col("rank") <= TERM_RANKS)
    return pairs.unionByName(terms)


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
words AS (SELECT id, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*)::HUGEINT AS c FROM words GROUP BY ALL HAVING count(DISTINCT id) >= 10),
langs AS (SELECT lang, count(*)::HUGEINT AS v, sum(c) AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM d),
found AS (SELECT lang, source, term, count(*)::HUGEINT AS c FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
cells AS (SELECT g.lang, g.source, k.term, k.c AS c_lang, coalesce(f.c, 0) AS c, sum(coalesce(f.c, 0)) OVER (PARTITION BY g.lang, g.source) AS n
  FROM groups g JOIN kept k USING (lang) LEFT JOIN found f USING (lang, source, term)),
shares AS (SELECT lang, source, term, cells.c, 1 + (1000000000::HUGEINT * (cells.c + 2)) // (cells.n::HUGEINT + 2 * v) AS p,
  1 + (1000000000::HUGEINT * (c_lang + 2)) // (langs.n::HUGEINT + 2 * v) AS q FROM cells JOIN langs USING (lang)),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p))::BIGINT AS value
  FROM shares a JOIN shares b USING (lang, term) WHERE a.source <> b.source GROUP BY ALL),
every AS (SELECT lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b USING (lang) LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source WHERE a.source <> b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value FROM shares WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
  FROM (SELECT * FROM every UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""
