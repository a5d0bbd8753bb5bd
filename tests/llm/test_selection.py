"""Resampling, divergence and token counts against brute force on small, awkward tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import counts, divergence, resampling

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
CLASHING = "doc_id long, text string, lang string, source string, term string, n long, place int, score string, segment string, rank int, slice int, kept string"


def documents(spark, rows):
    """Rows of id, text, lang and source, beside columns whose names the operators use inside."""
    return spark.createDataFrame([(*r, "t", 1, 2, "s", "g", 3, 4, "k") for r in rows], CLASHING)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def awkward_rows(n=400, seed=5):
    r = random.Random(seed)
    stock = [f"w{i}" for i in range(60)] + ["Ünder", "ÄB", "x9", "naïve", "Word", "word"]
    rows = [(i, " ".join(r.choices(stock, k=r.choice([0, 1, 5, 19, 20, 40]))), r.choice(["en", "de", None]), r.choice(["a", "b", "ü", None])) for i in range(n)]
    rows += [(None, "null id " * 12, "en", "a"), (n, None, "en", "silent"), (n + 1, "", "xx", "empty"), (n + 2, "\t -- \n", "", ""), (n + 3, "aB-cd " * 60_000, "de", "b")]
    return rows + [(n + 4, "the same row " * 10, "en", "copy")] * 300


def resampled_by_hand(rows, target):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))
        return len(words), [zlib.crc32(f.encode()) % 10000 for f in words + [f"{a} {b}" for a, b in zip(words, words[1:])]]

    s, t = (Counter(b for text in texts for b in features(text)[1]) for texts in ([r[1] for r in rows], target))
    all_s, all_t = sum(s.values()) + 10000, sum(t.values()) + 10000
    gain = [math.floor(1000 * math.log((t[b] + 1) * all_s / ((s[b] + 1) * all_t))) for b in range(10000)]
    out, able = [], []
    for doc_id, text, *_ in rows:
        n_words, found = features(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        if n_words >= 20:
            able.append((-score, doc_id is None, doc_id, len(out)))
        out.append([doc_id, len(found), weight, score, None])
    for rank, key in enumerate(sorted(able)[: 25 * len(able) // 100], 1):
        out[key[3]][4] = rank
    return sorted(map(str, out))


@pytest.mark.parametrize("segment_rows, samples", [(1 << 18, 1 << 17), (7, 1 << 17), (7, 40)])
def test_resampled(spark, monkeypatch, segment_rows, samples):
    monkeypatch.setattr(resampling, "SEGMENT_ROWS", segment_rows)
    monkeypatch.setattr(resampling, "SAMPLES", samples)
    rows, target = awkward_rows(), ["w1 w2 w3 w4 w5", None, "", "Word naïve w7 w7"]
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in enumerate(target)], "item_id long, text string, bucket string")
    got = resampling.resampled(documents(spark, rows).repartition(5), benchmark).collect()
    assert sorted(str(list(r)) for r in got) == resampled_by_hand(rows, target)


def test_resampling_of_empty_tables(spark):
    nothing, some = documents(spark, []), documents(spark, awkward_rows(40))
    target = spark.createDataFrame([], "item_id long, text string")
    assert resampling.resampled(nothing, target).count() == 0
    assert sorted(str(list(r)) for r in resampling.resampled(some, target).collect()) == resampled_by_hand(awkward_rows(40), [])


def test_splitters_part_a_row_that_repeats(spark):
    rows = spark.range(0, 4000, 1, 5).selectExpr("5L AS score", "7L AS doc_id", "id AS serial")
    cuts = resampling.splitters(rows, 4000, 8)
    sizes = Counter(sum(c <= (-5, False, 7, serial) for c in cuts) for serial in range(4000))
    assert len(sizes) == 8 and max(sizes.values()) <= 4000 // 8 + 5


def test_words_across_blocks(monkeypatch):
    text = b"Ab cd  ef-gh " * 50
    whole = [(n, sorted(b)) for n, b in resampling.feature_blocks(text)]
    monkeypatch.setattr(resampling, "BLOCK", 7)
    parts = list(resampling.feature_blocks(text))
    assert len(whole) == 1 < len(parts)
    assert whole == [(sum(n for n, _ in parts), sorted(np.concatenate([b for _, b in parts])))]


def audited_by_hand(rows):
    rows = [tuple(x or "" for x in r[1:4]) for r in rows]
    docs, found, groups = Counter(), defaultdict(Counter), sorted({(lang, source) for _, lang, source in rows})
    for text, lang, source in rows:
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text))
        found[lang, source].update(terms)
        docs.update((lang, t) for t in set(terms))
    out = []
    for lang in {g[0] for g in groups}:
        kept = [t for (of, t), n in docs.items() if of == lang and n >= 10]
        own = {source: {t: found[lang, source][t] for t in kept} for of, source in groups if of == lang}
        every = {t: sum(c[t] for c in own.values()) for t in kept}

        def shares(counts):
            n = sum(counts.values())
            return {t: 1 + 10**9 * (c + 2) // (n + 2 * len(kept)) for t, c in counts.items()}

        p, q = {s: shares(c) for s, c in own.items()}, shares(every)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for a in own:
            pairs = [(-sum(f(p[a][t], p[b][t]) for t in kept), b.encode(), b) for b in own if b != a]
            terms = [(-f(p[a][t], q[t]), t.encode(), t) for t in kept if own[a][t] and p[a][t] > q[t]]
            out += [(lang, a, "pair", b, -v, i) for i, (v, _, b) in enumerate(sorted(pairs), 1)]
            out += [(lang, a, "term", t, -v, i) for i, (v, _, t) in enumerate(sorted(terms)[:10], 1)]
    return sorted(out)


@pytest.mark.parametrize("slice_terms, held, cells, waiting", [(1 << 14, 1 << 22, 1 << 12, 1 << 20), (3, 5, 4, 2)])
def test_audited(spark, monkeypatch, slice_terms, held, cells, waiting):
    monkeypatch.setattr(divergence, "SLICE_TERMS", slice_terms)
    monkeypatch.setattr(divergence, "HELD_COUNTS", held)
    monkeypatch.setattr(divergence, "BLOCK_CELLS", cells)
    monkeypatch.setattr(divergence, "WAITING_ROWS", waiting)
    monkeypatch.setattr(divergence, "SLICE_DOCUMENTS", 9 if held == 5 else 1 << 12)
    rows = awkward_rows()
    got = divergence.audited(documents(spark, rows).repartition(5))
    assert dict(got.dtypes)["value"] == "bigint" and dict(got.dtypes)["rank"] == "int"
    assert sorted(map(tuple, got.collect())) == audited_by_hand(rows)


def test_audit_of_few_or_no_rows(spark):
    assert divergence.audited(documents(spark, [])).count() == 0
    rows = [(1, "too few words", "en", "a"), (2, None, "en", "b"), (3, "x", None, None)]
    assert sorted(map(tuple, divergence.audited(documents(spark, rows)).collect())) == audited_by_hand(rows)


def test_shares_are_exact_beyond_64_bits(spark):
    counts_, totals = np.array([0, 10**12, 3 * 10**14]), np.array([7 * 10**14] * 3)
    wanted = [1 + 10**9 * (int(c) + 2) // int(n) for c, n in zip(counts_, totals)]
    assert divergence.shares(counts_, totals).tolist() == wanted
    frame = spark.createDataFrame([(int(c), int(n)) for c, n in zip(counts_, totals)], "n long, total long").withColumn("kept", F.lit(0))
    assert sorted(r.p for r in frame.select(divergence._share("n", "total", "kept").alias("p")).collect()) == sorted(wanted)


def strange_text(n, seed=3):
    stock = ["ab", "'s", "'ll", "<|endoftext|>", "<|startoftext|>", " ", "é", "é", "́", "각", "ᄀ", "ᅡ", "中", "12", "!!", "'", " ", "K", "<|endof", "\n "]
    r = random.Random(seed)
    return "".join(r.choices(stock, k=n))


LONG = [strange_text(9000), "x" * 40_000, " " * 9000 + "a" + " " * 9000, strange_text(500) + "q" * 3000 + "!" * 2000 + "it's " * 3000 + strange_text(2000, 4)]


@pytest.mark.parametrize("path", [WORDS, PIECES, public_tokenizers.path("byte_bpe_50k.json")])
@pytest.mark.parametrize("chunk, overlap", [(4000, 200), (300, 40)])
def test_spliced_as_the_library(path, chunk, overlap):
    model = counts.tokenizer(path)
    for text in LONG:
        whole = model._library.encode(text) if path == PIECES else model._library.encode(text, add_special_tokens=False).ids
        assert [i for part in counts.spliced(model, text, chunk, overlap) for i in part.tolist()] == whole


def test_a_neighbour_without_a_common_boundary_widens():
    model = counts.tokenizer(WORDS)
    seen = []

    class Watched:
        margin = model.margin

        def encoded(self, text, begin, end):
            seen.append((begin, end))
            return model.encoded(text, begin, end)

    assert sum(map(len, counts.spliced(Watched(), "ab " * 400, 300, 100))) == 400
    plain = len(seen)
    assert plain == len(range(300, 1200, 300)) + 1
    text = "ab " * 90 + "y" * 900 + " ab" * 90
    assert sum(map(len, counts.spliced(Watched(), text, 300, 100))) == len(model._library.encode(text, add_special_tokens=False).ids)
    assert len(seen) - plain > 6


@pytest.mark.parametrize("path", [WORDS, PIECES])
def test_token_counts(spark, monkeypatch, path):
    monkeypatch.setattr(counts, "CHUNK", 2000)
    monkeypatch.setattr(counts, "KEPT_PIECES", 50)
    texts = [None, "", " \t\n", "It's 12 o'clock", "a" * 100, "a" * 1999 + "é", "word " * 2049, "<|endoftext|> x<|startoftext|>", *LONG, "same", "same"]
    frame = documents(spark, [(None if i == 4 else i, t, "en", "a") for i, t in enumerate(texts)])
    model = counts.tokenizer(path)._library
    wanted = []
    for i, t in enumerate(texts):
        ids = model.encode(t or "") if path == PIECES else model.encode(t or "", add_special_tokens=False).ids
        wanted.append((None if i == 4 else i, len((t or "").encode()), len(ids), len(ids) > 2048))
    got = [tuple(r) for r in counts.token_counts(frame, path).collect()]
    assert sorted(map(str, got)) == sorted(map(str, wanted))
    assert counts.token_counts(documents(spark, []), path).count() == 0


def test_a_very_long_text_is_counted_by_chunks(spark):
    text = "It's 12 o'clock, naïve Wörter. " * 100_000
    row = counts.token_counts(documents(spark, [(1, text, "de", "a")]), WORDS).first()
    per = len(Tokenizer.from_file(WORDS).encode("It's 12 o'clock, naïve Wörter. ", add_special_tokens=False).ids)
    assert (row.n_tokens, row.n_bytes) == (100_000 * per, len(text.encode()))
