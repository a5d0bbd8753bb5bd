"""Importance resampling towards a target corpus: weights scored from arrays, ranks by regular sampling.

Features are all runs of 1 to ``RUN_WORDS`` consecutive words of a whole text, hashed into ``BUCKETS``. A
bucket's gain is the log ratio of its shares in the target and in the documents, a document's weight the
mean gain of its features, its score the weight with Gumbel noise drawn from its id: the highest scores are
a sample without replacement in proportion to the exponentiated weights.

The drawn documents get their exact ranks by parallel sorting with regular sampling:

1. each partition of the scored rows is a run, sorted by itself;
2. every stride-th row of every run is a sample row, their sorted quantiles are the splitters. At most
   ``SAMPLES`` rows and one for each run reach the driver, however long the table;
3. rows go to the segment between their splitters, where they are merged;
4. counts of the segments before give each segment's first rank. Segments that lie wholly behind the last
   drawn rank have no ranks to give and are not exchanged.

Null and empty texts have no features and weight 0. A null ``doc_id`` draws its noise from the empty id and
comes last among equal scores. Repeated rows are documents of their own, equal ones take neighbouring
ranks; splitters tell them apart by their place, so a row repeated any number of times is split over
segments. Long texts are read in blocks. An empty table gives no rows, an empty target has no counts.
Columns besides ``doc_id`` and ``text`` play no part.
"""

from __future__ import annotations

import hashlib
import math
from bisect import bisect_right
from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import as_bytes, id_and_text, map_arrow, portions, stored, table

BUCKETS = 10_000
RUN_WORDS = 2
LEAST_WORDS = 20
DRAWN_PERCENT = 25
SEED = 7
#: Sample rows that all runs give together, one for each run beyond that.
SAMPLES = 1 << 17
#: Rows of a segment, about.
SEGMENT_ROWS = 1 << 18
#: Bytes of a text whose words are held at once.
BLOCK = 1 << 20

_NO_WORD = [b for b in range(128) if not (chr(b).isdigit() or chr(b).isalpha())]
_TABLE = bytes(0x20 if b in _NO_WORD else b + 32 if 65 <= b <= 90 else b for b in range(256))


def word_blocks(text: bytes, translation: bytes = _TABLE) -> Iterator[list[bytes]]:
    """The words of a text, block by block; a block ends between words."""
    plain = text.translate(translation)
    begin = 0
    while begin < len(plain):
        end = plain.find(b" ", begin + BLOCK)
        end = len(plain) if end < 0 else end
        yield plain[begin:end].split()
        begin = end


def feature_blocks(text: bytes) -> Iterator[tuple[int, np.ndarray]]:
    """The words of each block, and the buckets of the features that end in it."""
    lead: list[bytes] = []
    for words in word_blocks(text):
        both = lead + words
        sums = list(map(crc32, both))
        found = sums[len(lead) :]
        for more in range(1, RUN_WORDS):
            # sums[i] covers the words i to i + more
            sums = list(map(crc32, both[more:], map(crc32, repeat(b" "), sums)))
            found += sums[max(0, len(lead) - more) :]
        yield len(words), np.array(found, np.int64) % BUCKETS
        lead = both[max(0, len(both) - RUN_WORDS + 1) :]


def bucket_counts(rows: DataFrame) -> DataFrame:
    """``bucket, n``: the features of all texts, summed by task before they are shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(BUCKETS, np.int64)
        for batch in portions(batches):
            for text in as_bytes(batch.column("text")):
                for _, buckets in feature_blocks(text):
                    counts += np.bincount(buckets, minlength=BUCKETS)
        some = np.flatnonzero(counts)
        yield table({"bucket": (some.tolist(), pa.int32()), "n": (counts[some].tolist(), pa.int64())})

    texts = rows.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    return map_arrow(texts, run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(documents: DataFrame, target: DataFrame) -> list[int]:
    """A gain in thousandths for each bucket; only the ``BUCKETS`` sums reach the driver."""
    sums = []
    for rows in (documents, target):
        counts = [0] * BUCKETS
        for row in bucket_counts(rows).collect():
            counts[row.bucket] = row.n
        sums.append(counts)
    all_s, all_t = (float(sum(x) + BUCKETS) for x in sums)
    return [math.floor(1000 * math.log((t + 1.0) * all_s / ((s + 1.0) * all_t))) for s, t in zip(*sums)]


def noise(doc_id: int | None) -> int:
    """Gumbel noise in thousandths, drawn from the id."""
    name = f"{SEED}:{'' if doc_id is None else doc_id}"
    drawn = int(hashlib.sha256(name.encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((drawn + 0.5) / 4294967296)))


_SCORED = "doc_id long, n_features long, weight long, score long, n_words long, serial long"


def scored(documents: DataFrame, gains: list[int]) -> DataFrame:
    """Features, weight and score of every row, with the place it was read at."""
    array = np.array(gains, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        serial = (task.partitionId() if task else 0) << 40
        for batch in portions(batches):
            ids = batch.column("doc_id").to_pylist()
            words, features, weights = [], [], []
            for text in as_bytes(batch.column("text")):
                n_words = n_features = total = 0
                for n, buckets in feature_blocks(text):
                    n_words, n_features, total = n_words + n, n_features + len(buckets), total + int(array[buckets].sum())
                words.append(n_words)
                features.append(n_features)
                weights.append(total // n_features if n_features else 0)
            long = pa.int64()
            yield table({
                "doc_id": (ids, long),
                "n_features": (features, long),
                "weight": (weights, long),
                "score": ([w + noise(i) for w, i in zip(weights, ids)], long),
                "n_words": (words, long),
                "serial": (list(range(serial, serial + len(ids))), long),
            })
            serial += len(ids)

    return map_arrow(id_and_text(documents), run, _SCORED)


def _keys(batch: pa.RecordBatch) -> list[tuple]:
    """Ascending keys: higher scores first, then smaller ids, null last, then the place."""
    columns = [batch.column(name).to_pylist() for name in ("score", "doc_id", "serial")]
    return [(-score, doc_id is None, doc_id or 0, serial) for score, doc_id, serial in zip(*columns)]


_ORDER = (F.desc, "score"), (F.asc_nulls_last, "doc_id"), (F.asc, "serial")


def _order() -> list:
    return [way(name) for way, name in _ORDER]


def splitters(rows: DataFrame, n: int, segments: int) -> list[tuple]:
    """Keys that part the rows into segments: quantiles of every stride-th row of each sorted run."""
    stride = max(1, n // SAMPLES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = stride // 2  # of the next sample row, counted from the batch's first
        seen = 0
        for batch in batches:
            picked = [i - seen for i in range(at, seen + batch.num_rows, stride)]
            if picked:
                at = picked[-1] + seen + stride
                yield batch.take(pa.array(picked, pa.int64()))
            seen += batch.num_rows

    runs = rows.select("score", "doc_id", "serial").sortWithinPartitions(*_order())
    sample = map_arrow(runs, run, "score long, doc_id long, serial long").toArrow()
    keys = sorted(key for batch in sample.to_batches() for key in _keys(batch))
    return [keys[len(keys) * i // segments] for i in range(1, segments)] if keys else []


_ASSIGNED = f"{_SCORED}, segment int"


def _assigned(rows: DataFrame, cuts: list[tuple]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = [bisect_right(cuts, key) for key in _keys(batch)]
            yield batch.append_column("segment", pa.array(places, pa.int32()))

    return map_arrow(rows, run, _ASSIGNED)


def ranked(rows: DataFrame, drawn: int, n: int) -> DataFrame:
    """The rows with their rank in the order of keys; null beyond the rank ``drawn``.

    ``rows`` is a stored table of ``n`` rows, so its runs are the same each time they are read.
    """
    segments = max(1, -(-n // SEGMENT_ROWS))
    assigned = stored(_assigned(rows, splitters(rows, n, segments) if segments > 1 else []))
    counts = {r.segment: r["count"] for r in assigned.groupBy("segment").count().collect()}
    before, firsts = 0, []
    for segment in range(segments):
        firsts.append(before)
        before += counts.get(segment, 0)
    wanted = sum(first < drawn for first in firsts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now = position = -1
        for batch in batches:
            out = []
            for segment in batch.column("segment").to_pylist():
                if segment != now:
                    now, position = segment, firsts[segment]
                position += 1
                out.append(position if position <= drawn else None)
            yield batch.append_column("rank", pa.array(out, pa.int64()))

    merged = assigned.where(F.col("segment") < wanted).repartition("segment").sortWithinPartitions("segment", *_order())
    behind = assigned.where(F.col("segment") >= wanted).withColumn("rank", F.lit(None).cast("long"))
    return map_arrow(merged, run, f"{_ASSIGNED}, rank long").unionByName(behind)


def resampled(documents: DataFrame, target: DataFrame) -> DataFrame:
    """``doc_id, n_features, weight, score, rank`` for every row; rank is null where it is not drawn."""
    rows = stored(scored(documents, bucket_gains(documents, target)))
    enough = F.col("n_words") >= LEAST_WORDS
    n = rows.where(enough).count()
    drawn = ranked(rows.where(enough), DRAWN_PERCENT * n // 100, n)
    short = rows.where(~enough).withColumn("rank", F.lit(None).cast("long"))
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    return drawn.select(columns).unionByName(short.select(columns))


#: crc32 by its table of 256 entries, one list_reduce over the bytes of each distinct feature.
ORACLE = r"""
WITH RECURSIVE step(i, k, c) AS (
  SELECT i::BIGINT, 0, i::BIGINT FROM range(256) AS r(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM step WHERE k < 8),
crcs AS (SELECT list(c ORDER BY i) AS t FROM step WHERE k = 8),
texts AS (SELECT 'd' AS side, doc_id AS id, coalesce(text, '') AS text FROM documents
  UNION ALL SELECT 't', item_id, coalesce(text, '') FROM benchmark),
split AS (SELECT side, id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
spread AS (SELECT side, id, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS feature FROM split),
names AS (SELECT DISTINCT feature, hex(encode(feature)) AS h FROM spread),
hashed AS (SELECT feature, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(0, len(h) // 2),
  lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)), lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) % 10000 AS bucket
  FROM names, crcs),
counted AS (SELECT side, bucket, count(*) AS n FROM spread JOIN hashed USING (feature) GROUP BY ALL),
buckets AS (SELECT i AS bucket, coalesce(max(n) FILTER (side = 'd'), 0) AS s, coalesce(max(n) FILTER (side = 't'), 0) AS t
  FROM range(10000) AS r(i) LEFT JOIN counted ON counted.bucket = r.i GROUP BY i),
gains AS (SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * (sum(s) OVER () + 10000)::DOUBLE) / ((s + 1)::DOUBLE * (sum(t) OVER () + 10000)::DOUBLE)))::BIGINT AS gain FROM buckets),
weights AS (SELECT id, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
  FROM spread JOIN hashed USING (feature) JOIN gains USING (bucket) WHERE side = 'd' GROUP BY id),
scores AS (SELECT id AS doc_id, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight, len(w) AS n_words,
  coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM split LEFT JOIN weights USING (id) WHERE side = 'd'),
places AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, 25 * count(*) OVER () // 100 AS drawn FROM scores WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END AS rank FROM scores LEFT JOIN places USING (doc_id)
"""
