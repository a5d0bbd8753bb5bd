"""Toxic texts: a convolutional classifier over hashed word embeddings, trained in numpy.

A word is a run of letters (bytes a-z after lower-casing, and all beyond ASCII). Its vector is the sum of the
hashed embeddings of the word and of its first three to five bytes. Filters of several widths run over the words, each filter's largest response over the text goes
to a logistic output. The classifier is fitted on a bounded sample of labelled rows (``SAMPLE_ROWS``, half
of each class where there are as many, without texts above ``SAMPLE_TEXT_BYTES``); scoring reads every whole text. Thresholds are set by language,
the language being told from the text's own function words, so a score depends on the text alone: the
threshold's logit is taken off, and 0.5 is the threshold everywhere. A language's threshold is the best F1 over
all labelled rows outside the held-out fold whose text the classifier was not fitted on, each class weighted as it
counts among all of them (over all rows, fitted or not, where fewer than ``LEAST_OF_CLASS`` of a class are left).
Their logits are counted in steps of 1 / ``STEPS``.

Null and empty texts score like a text without words. Rows are scored one by one: repeated rows alike,
extra columns play no part. Labels that are null are left out; of several labels for a document the
highest counts; without labels of both classes every score is the share of toxic ones (0 if none).
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.bpe import piece_hashes
from tidemark.llm.common import give_back_memory, id_and_text, map_arrow, portions

#: Labelled rows that the classifier is fitted on, at most.
SAMPLE_ROWS = 4000
#: Longer texts (UTF-8 bytes) are scored like all others, but not fitted on: the sample's size has a bound.
SAMPLE_TEXT_BYTES = 1 << 17
FOLDS, HELD_OUT = 5, 0
#: Labelled ids that are sent to all executors, at most (some 8 MB).
BROADCAST_IDS = 1 << 18

BUCKETS, DIMENSIONS = 1 << 15, 8
WIDTHS, FILTERS = (1, 2, 3), 8
EPOCHS, BATCH, RATE, DECAY = 8, 64, 0.01, 1e-4
#: Training ends early once the mean loss of an epoch is below.
ENOUGH = 0.01
#: UTF-8 bytes scored at once.
SCORED_BYTES = 1 << 19
#: Documents of a language that its own threshold needs, of each class.
LEAST_OF_CLASS = 20
#: Steps of a logit that thresholds are told apart by, and the logit up to which they are.
STEPS, FARTHEST = 64, 64
# Common function words that the others of these languages lack.
FUNCTION_WORDS = {
    "en": "the of and to is that for it was with by this are not",
    "fr": "le les des et du une dans pour est sur au qui pas ce",
    "de": "der die das und ist ein eine nicht den von zu mit auf im",
    "es": "el los las y por con para del al como pero su lo es",
}
LANGUAGES = tuple(FUNCTION_WORDS)
_PREFIXES = (3, 4, 5)
_IN_WORD = np.isin(np.arange(256), [*range(ord("a"), ord("z") + 1), *range(128, 256)])


def _language_table() -> tuple[np.ndarray, np.ndarray]:
    words = {w: i + 1 for i, some in enumerate(FUNCTION_WORDS.values()) for w in some.split()}
    raw = np.frombuffer(" ".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    hashes = piece_hashes(raw, ends - np.array([len(w) for w in words]), ends)
    order = np.argsort(hashes)
    return hashes[order], np.array(list(words.values()), np.int8)[order]


@dataclass
class Words:
    """The words of several texts: their features' buckets and language codes; each text's begin among them.

    Each text is followed by as much padding (bucket 0) as the widest filter reaches, and one word at least.
    """

    features: np.ndarray
    languages: np.ndarray
    starts: np.ndarray

    @classmethod
    def of_many(cls, texts: list[str]) -> Words:
        """``of`` for more texts than are to be hashed at once."""
        parts = [cls.of(texts[at : at + BATCH]) for at in range(0, len(texts), BATCH)]
        before = np.cumsum([0, *(len(p.features) for p in parts[:-1])])
        return cls(
            np.concatenate([p.features for p in parts]),
            np.concatenate([p.languages for p in parts]),
            np.concatenate([p.starts + n for p, n in zip(parts, before)]),
        )

    @classmethod
    def of(cls, texts: list[str]) -> Words:
        parts = [t.lower().encode("utf-8", "replace") for t in texts]
        raw = np.frombuffer(b"\n".join([*parts, b""]), np.uint8)
        edge = np.diff(_IN_WORD[raw].astype(np.int8), prepend=0)
        begins, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        text_ends = np.cumsum([len(p) + 1 for p in parts], dtype=np.int64)
        upto = np.searchsorted(begins, text_ends)
        counts = np.diff(upto, prepend=0)
        room = np.maximum(counts, 1) + max(WIDTHS) - 1
        starts = np.cumsum(room) - room
        place = np.arange(len(begins)) + np.repeat(starts - (upto - counts), counts)
        features = np.zeros((int(room.sum()), 1 + len(_PREFIXES)), np.int32)
        languages = np.zeros(len(features), np.int8)
        hashes = piece_hashes(raw, begins, ends)
        features[place, 0] = (hashes >> np.uint64(33)) % np.uint64(BUCKETS - 1) + np.uint64(1)
        for k, n in enumerate(_PREFIXES):
            own = piece_hashes(raw, begins, np.minimum(begins + n, ends)) * np.uint64(2 * n + 1)
            features[place, 1 + k] = (own >> np.uint64(33)) % np.uint64(BUCKETS - 1) + np.uint64(1)
        known, codes = _LANGUAGE_TABLE
        spot = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        languages[place] = np.where(known[spot] == hashes, codes[spot], 0)
        return cls(features, languages, starts)


_LANGUAGE_TABLE = _language_table()


@dataclass
class Model:
    """Weights, and a threshold (as a logit) for each language; language 0 is any other."""

    constant: float | None = None
    embeddings: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, DIMENSIONS), np.float32))
    filters: list[np.ndarray] = field(default_factory=list)  # for each width: (width * DIMENSIONS, FILTERS)
    biases: list[np.ndarray] = field(default_factory=list)
    output: np.ndarray = field(default_factory=lambda: np.zeros(FILTERS * len(WIDTHS), np.float32))
    bias: float = 0.0
    thresholds: np.ndarray = field(default_factory=lambda: np.zeros(len(LANGUAGES) + 1, np.float32))
    seen: np.ndarray = field(default_factory=lambda: np.zeros(0, np.uint32))  # checksums of the texts fitted on

    def vectors(self, features: np.ndarray) -> np.ndarray:
        found = self.embeddings[features[:, 0]]
        for k in range(1, features.shape[1]):
            found += self.embeddings[features[:, k]]
        return found

    def pooled(self, vectors: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each text's largest response of each filter; the responses. Texts are padded (see ``Words``)."""
        reach = max(WIDTHS) - 1
        n = len(vectors) - reach
        blocks = [w[k * DIMENSIONS : (k + 1) * DIMENSIONS] for width, w in zip(WIDTHS, self.filters) for k in range(width)]
        shares = vectors @ np.concatenate(blocks, axis=1)
        responses = np.empty((n, FILTERS * len(WIDTHS)), np.float32)
        at = 0
        for i, width in enumerate(WIDTHS):
            own = responses[:, i * FILTERS : (i + 1) * FILTERS]
            own[:] = self.biases[i]
            for k in range(width):
                own += shares[k : n + k, at : at + FILTERS]
                at += FILTERS
        np.maximum(responses, 0, out=responses)
        return np.maximum.reduceat(responses, starts, axis=0), responses

    def logits(self, vectors: np.ndarray, starts: np.ndarray) -> np.ndarray:
        return self.pooled(vectors, starts)[0] @ self.output + self.bias


def _languages(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    counts = np.column_stack([np.add.reduceat(codes == k, starts) for k in range(1, len(LANGUAGES) + 1)])
    return np.where(counts.max(axis=1) > 0, counts.argmax(axis=1) + 1, 0)


def fitted(texts: list[str], toxic: list[int], seed: int = 1) -> Model:
    """The classifier for these texts, without thresholds; every fifth (by the text's checksum) is kept for those."""
    labels = np.array(toxic, np.float32)
    if len(set(toxic)) < 2:
        return Model(constant=float(labels.mean()) if len(labels) else 0.0)
    words = Words.of_many(texts)
    starts, ends = words.starts, np.append(words.starts[1:], len(words.features))
    sums = _checksums(texts)
    apart = sums % 5 == 0
    if len(set(labels[~apart])) < 2 or min((labels[apart] == k).sum() for k in (0, 1)) < LEAST_OF_CLASS:
        apart[:] = False
    random = np.random.default_rng(seed)
    model = Model(embeddings=(random.standard_normal((BUCKETS, DIMENSIONS)) * 0.05).astype(np.float32))
    model.embeddings[:, 0] = _log_odds([np.unique(words.features[a:b]) for a, b in zip(starts, ends)], labels, ~apart)
    model.embeddings[0] = 0
    for width in WIDTHS:
        weights = (random.standard_normal((width * DIMENSIONS, FILTERS)) * 0.2).astype(np.float32)
        weights[::DIMENSIONS] = np.abs(weights[::DIMENSIONS]) + 0.3
        model.filters.append(weights)
        model.biases.append(np.zeros(FILTERS, np.float32))
    model.output[:] = 0.3
    model.bias = -2.0
    _train(model, words.features, starts, ends, labels, np.flatnonzero(~apart), random)
    model.seen = np.unique(sums[~apart])
    return model


def _checksums(texts: list[str]) -> np.ndarray:
    return np.array([zlib.crc32(t.encode("utf-8", "surrogatepass")) for t in texts], np.uint32)


def _log_odds(present: list[np.ndarray], labels: np.ndarray, use: np.ndarray) -> np.ndarray:
    """Of a feature's presence in toxic against clean texts, between -1 and 1; the training's start for one dimension."""
    counts = np.zeros((2, BUCKETS))
    for own, label, used in zip(present, labels, use):
        if used:
            counts[int(label), own] += 1
    sums = np.array([max(1, ((labels == k) & use).sum()) for k in (0, 1)])[:, None]
    odds = np.log((counts + 0.5) / (sums + 1))
    weight = np.minimum(1, counts.sum(axis=0) / 5)
    return np.clip((odds[1] - odds[0]) * weight / 4, -1, 1).astype(np.float32)


def _train(model: Model, features: np.ndarray, starts: np.ndarray, ends: np.ndarray, labels: np.ndarray, rows: np.ndarray, random: np.random.Generator) -> None:
    """Logistic loss by Adam; a maximum passes its gradient to the first place where it stood."""
    toxic_weight = min(10.0, float((labels[rows] == 0).sum() / max(1, (labels[rows] == 1).sum())))
    held = [model.embeddings, *model.filters, *model.biases, model.output]
    first, second = [np.zeros_like(x) for x in held], [np.zeros_like(x) for x in held]
    step = 0
    for _ in range(EPOCHS):
        random.shuffle(rows)
        losses = []
        for at in range(0, len(rows), BATCH):
            some = rows[at : at + BATCH]
            own = np.concatenate([features[starts[i] : ends[i]] for i in some])
            begins = np.cumsum(ends[some] - starts[some]) - (ends[some] - starts[some])
            vectors = model.vectors(own)
            pooled, responses = model.pooled(vectors, begins)
            logit = pooled @ model.output + model.bias
            y = labels[some]
            weights = np.where(y > 0, toxic_weight, 1.0)
            losses.append(float((np.logaddexp(0, np.where(y > 0, -logit, logit)) * weights).mean()))
            slope = ((1 / (1 + np.exp(-logit)) - y) * weights / len(some)).astype(np.float32)
            grads = [np.zeros_like(x) for x in held]
            grads[-1] = pooled.T @ slope
            back = slope[:, None] * model.output * (pooled > 0)
            text = np.repeat(np.arange(len(some)), np.diff(np.append(begins, len(responses))))
            for column in range(responses.shape[1]):
                active = np.flatnonzero(back[:, column])
                if not len(active):
                    continue
                k, f = divmod(column, FILTERS)
                tops = np.flatnonzero(responses[:, column] == pooled[text, column])
                spots = tops[np.searchsorted(tops, begins[active])]
                g = back[active, column]
                grads[1 + len(WIDTHS) + k][f] += g.sum()
                for j in range(WIDTHS[k]):
                    part = slice(j * DIMENSIONS, (j + 1) * DIMENSIONS)
                    grads[1 + k][part, f] += g @ vectors[spots + j]
                    np.add.at(grads[0], own[spots + j].ravel(), np.repeat(g[:, None] * model.filters[k][part, f], own.shape[1], axis=0))
            grads[0][0] = 0
            step += 1
            model.bias -= RATE * float(slope.sum())
            for x, g, a, b in zip(held, grads, first, second):
                a += 0.1 * (g - a)
                b += 0.01 * (g * g - b)
                x -= RATE * (a / (1 - 0.9**step) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8) + DECAY * x)
        if np.mean(losses) < ENOUGH:
            break


def _steps(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, step, language, seen`` of every row: its logit, and whether its text was fitted on."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, most=SCORED_BYTES):
            texts = batch.column("text").to_pylist()
            if texts:
                words = Words.of(texts)
                logits = model.logits(model.vectors(words.features), words.starts)
                steps = np.floor(np.clip(logits, -FARTHEST, FARTHEST).astype(np.float64) * STEPS)
                columns = (steps, _languages(words.languages, words.starts), np.isin(_checksums(texts), model.seen))
                kinds = (np.int32, np.int32, bool)
                arrays = [pa.array(c.astype(k)) for c, k in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=["doc_id", "step", "language", "seen"])

    return map_arrow(documents, run, "doc_id long, step int, language int, seen boolean")


def _calibrate(model: Model, steps: np.ndarray, languages: np.ndarray, labels: np.ndarray, seen: np.ndarray, counts: np.ndarray) -> None:
    """Thresholds from the numbers of rows (``counts``) of each step, language, label and state of ``seen``."""

    def of(rows: np.ndarray, use: np.ndarray) -> float | None:
        weights = np.zeros(len(counts))
        for k in (0, 1):
            own = rows & (labels == k)
            left = counts[own & use].sum()
            if left < LEAST_OF_CLASS:
                return None
            weights[own & use] = counts[own & use] * (counts[own].sum() / left)
        return _threshold(steps, labels, weights)

    every = np.ones(len(counts), bool)
    use = ~seen
    overall = of(every, use)
    if overall is None:
        use = every
        overall = _threshold(steps, labels, counts)
    model.thresholds[:] = overall
    for k in range(1, len(LANGUAGES) + 1):
        own = of(languages == k, use)
        if own is not None:
            model.thresholds[k] = own


def _threshold(steps: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The middle of the cut with the best F1."""
    found, place = np.unique(-steps[weights > 0], return_inverse=True)
    toxic, rows = (np.bincount(place, weights=(w * weights)[weights > 0]) for w in (labels, np.ones(len(labels))))
    score = 2 * np.cumsum(toxic) / (np.cumsum(rows) + toxic.sum())
    tops = np.flatnonzero(score >= score.max() - 1e-12)
    best = int(tops[len(tops) // 2])
    lowest = -found[best]
    below = 1 - found[best + 1] if best + 1 < len(found) else lowest - 2 * STEPS
    return float((lowest + below) / 2 / STEPS)


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row: the model fitted on all rows of the task."""
    rows = [r for batch in batches for r in zip(*(batch.column(c).to_pylist() for c in ("text", "label")))]
    model = pickle.dumps(fitted([r[0] for r in rows], [r[1] for r in rows]))
    del rows
    give_back_memory()
    yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], names=["model"])


def trained(documents: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fitted on ``sample_rows`` labelled rows outside the held-out fold, in one task; thresholds by all of them, counted.

    The sample's texts stay in that task, which gives back one row, the model. Labelled rows are scored where they are,
    and at most a row for each step, language, label and state of ``seen`` comes here.
    """
    known = (
        labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("label"))
        .where(~held_out(F.col("id")))
    )
    order = F.xxhash64("id", F.lit(17))
    halves = [known.where(F.col("label") == k).orderBy(order, "id").limit(sample_rows // 2) for k in (0, 1)]
    picked = F.broadcast(halves[0].unionByName(halves[1]))  # at most sample_rows ids
    docs = id_and_text(documents)
    short = docs.where(F.octet_length("text") <= SAMPLE_TEXT_BYTES)
    rows = short.join(picked, docs.doc_id == picked.id).select("doc_id", "text", "label").orderBy("doc_id", "text").limit(sample_rows)
    sample = rows.repartition(1).sortWithinPartitions("doc_id", "text")
    row = map_arrow(sample, _fit, "model binary").first()
    model = pickle.loads(row.model) if row else fitted([], [])
    if model.constant is None:
        wanted = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        if known.count() <= BROADCAST_IDS:
            # few labels: other documents need no score here. Of many, finding them first would shuffle the texts
            wanted = wanted.join(F.broadcast(known.select(F.col("id").alias("told"))), F.col("doc_id") == F.col("told"), "left_semi")
        placed = _steps(wanted, model).join(known, F.col("doc_id").eqNullSafe(F.col("id")))
        counted = placed.groupBy("step", "language", "label", "seen").agg(F.count("*").alias("n")).collect()
        steps, languages, labelled, seen, counts = (np.array(c) for c in zip(*counted))
        _calibrate(model, steps, languages, labelled, seen, counts)
    return model


def held_out(doc_id: F.Column) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def scores(model: Model, texts: list[str]) -> np.ndarray:
    if model.constant is not None or not texts:
        return np.full(len(texts), model.constant or 0.0)
    words = Words.of(texts)
    logits = model.logits(model.vectors(words.features), words.starts) - model.thresholds[_languages(words.languages, words.starts)]
    return 1 / (1 + np.exp(-logits.astype(np.float64)))


def scored(documents: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, most=SCORED_BYTES):
            found = scores(model, batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.float64())], names=["doc_id", "score"])

    found = map_arrow(id_and_text(documents), run, "doc_id long, score double")
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(documents: DataFrame, model: Model) -> DataFrame:
    """The rows whose text is not toxic, all their columns unchanged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches, most=SCORED_BYTES):
            found = scores(model, [t or "" for t in batch.column("text").to_pylist()])
            yield batch.filter(pa.array(found < 0.5))

    return map_arrow(documents, run, documents.schema)
