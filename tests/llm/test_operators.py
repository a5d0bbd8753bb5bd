"""The text operators against brute force on small, awkward tables."""

from __future__ import annotations

import base64
import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidemark.llm import automata, bpe, chat, components, exact, fingerprints, jaccard, packing, passages, quotient, secrets, suffixes, tokens, toxicity
from tidemark.llm.windows import Shape

BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
CLASHING = "doc_id long, text string, kept boolean, row string, sid string, digest string, spans int, packed int, place int"


def documents(spark, texts, ids=None):
    """Rows with columns whose names the operators use inside."""
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, False, "r", "s", "d", 1, 2, 3) for i, t in zip(ids, texts)], CLASHING)


def by_id(frame):
    return {r.doc_id: r.asDict() for r in frame.collect()}


def words(n, seed=0):
    r = random.Random(seed)
    return [f"w{r.randrange(10**9)}" for _ in range(n)]


PASSAGE = " ".join(words(70, 1))
AWKWARD = [
    None,
    "",
    " \n\t ",
    "é",
    "Same text. SAME ä",
    "same TEXT. same ä",
    "same text. same Ä",
    PASSAGE,
    PASSAGE + " tail one",
    "head " + PASSAGE.replace(" ", "\n "),
    PASSAGE,
    "aaaa" * 200,
    "long " * 30_000,
    " ".join(words(300, 2)),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return documents(spark, AWKWARD)


@pytest.fixture(scope="module")
def nothing(spark):
    return documents(spark, [])


def test_empty_tables(spark, nothing):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    found = [
        exact.exact_copies(nothing),
        exact.without_copies(nothing),
        fingerprints.edited_neighbours(nothing),
        toxicity.scored(nothing, toxicity.trained(nothing, labels)),
        secrets.secret_spans(nothing),
        tokens.encoded(nothing, BYTE_VOCABULARY),
        packing.packed(nothing, WORD_VOCABULARY),
        jaccard.similar_documents(nothing),
        passages.without_earlier_passages(nothing),
        suffixes.without_repeats(nothing),
    ]
    assert all(f.count() == 0 for f in found)
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.formatted(chat.best_branches(chat.turn_trees(empty))).count() == 0


def test_quotient_filters_merge_without_loss():
    r = np.random.default_rng(1)
    for size in (0, 1, 5, 3000):
        parts = [r.integers(0, 1 << 63, size, np.uint64) >> np.uint64(r.integers(0, 60)) for _ in range(3)]
        merged = quotient.CountingQuotientFilter.of(parts[0])
        for part in parts[1:]:
            merged = merged.merged(quotient.CountingQuotientFilter.from_bytes(quotient.CountingQuotientFilter.of(part).to_bytes()))
        prints, counts = merged.entries()
        assert dict(zip(prints.tolist(), counts.tolist())) == Counter(np.concatenate(parts).tolist())


def test_quotient_filters_merge_in_any_number():
    random = np.random.default_rng(4)
    assert quotient.merged_all([]) is None
    for n in (1, 2, 7, 40):
        parts = [random.integers(0, 500, random.integers(0, 60)).astype(np.uint64) << np.uint64(50) for _ in range(n)]
        prints, counts = quotient.merged_all(map(quotient.CountingQuotientFilter.of, parts)).entries()
        wanted = np.unique(np.concatenate(parts), return_counts=True)
        assert prints.tolist() == wanted[0].tolist() and counts.tolist() == wanted[1].tolist()


@pytest.mark.parametrize("least", [1, 14])
def test_exact_copies_at_any_number_of_ranges(spark, monkeypatch, least):
    monkeypatch.setattr(exact, "LEAST_RANGE_BITS", least)
    texts = [f"text {i % 700}" for i in range(1500)]
    got = exact.exact_copies(documents(spark, texts).repartition(5)).collect()
    assert {r.doc_id: (r.keep_id, r.group_size) for r in got} == {
        i: (max(j for j in range(i % 700, 1500, 700)), len(range(i % 700, 1500, 700))) for i in range(1500)
    }
    assert exact.range_bits(0) == least and exact.range_bits(1 << 40) == 21


def test_exact_copies(spark, awkward):
    got = by_id(exact.exact_copies(awkward))
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups = defaultdict(list)
    for i, t in enumerate(AWKWARD):
        groups[(t or "").translate(lower)].append(i)
    for text, ids in groups.items():
        for i in ids:
            want = {"doc_id": i, "keep_id": max(ids), "group_size": len(ids), "kept": i == max(ids), "text_sha256": hashlib.sha256(text.encode()).hexdigest()}
            assert got[i] == want
    rest = exact.without_copies(awkward)
    assert sorted(r.doc_id for r in rest.collect()) == sorted(max(x) for x in groups.values())
    assert rest.schema == awkward.schema


def test_a_hot_text_is_split(spark):
    lowered = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    before = {k: spark.conf.get(k, None) for k in lowered}
    for k, v in lowered.items():
        spark.conf.set(k, v)
    try:
        rest = exact.without_copies(documents(spark, ["hot"] * 8000 + [f"text {i}" for i in range(800)]).repartition(16))
        assert len(rest.collect()) == 801
        assert "skew=true" in rest._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_exact_copies_of_null_and_repeated_ids(spark):
    rows = exact.exact_copies(documents(spark, ["x", "X", "x", "y"], [None, 3, 3, None])).collect()
    assert sorted((r.doc_id is None, r.keep_id is None, r.group_size, r.kept) for r in rows) == [(False, False, 3, True)] * 2 + [(True, False, 3, False), (True, True, 1, True)]


def _turns(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_chat_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "<\\s>", "<\\\\/s>[\\INST]", "<", None, "<s", "é</s>"]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(nasty)] + [(2, 0, None, "x"), (2, 0, None, "x"), (None, 5, "assistant", "n"), (3, 1, "[/INST]", "[INST"), (4, None, "user", "u")]
    shaped = chat.formatted(chat.best_branches(chat.turn_trees(_turns(spark, rows))))
    back = {r.tree_id: r for r in chat.read_back(shaped).collect()}
    want = defaultdict(list)
    for conv, _, role, text in rows:
        want[conv].append((role or "", text or ""))
    assert {k: [tuple(t) for t in r.turns] for k, r in back.items()} == want
    assert back[1].loss_text == "".join(t or "" for i, t in enumerate(nasty) if i % 2)
    one = next(r for r in shaped.collect() if r.tree_id == 1)
    assert one.formatted.count("</s>") == len(nasty) and one.formatted.count("[INST]") == len(nasty)


def test_chat_branches_by_score(spark):
    # 1 -> 2 -> 4, 1 -> 3, and a long path of its own tree; ties go to the smaller leaf
    rows = [(1, 1, None, 1.0), (1, 2, 1, 1.0), (1, 3, 1, 5.0), (1, 4, 2, 4.0), (1, 5, 2, None), (3, 9, 77, 1.0)]
    rows += [(2, i, i - 1 if i else None, 1.0) for i in range(41)]
    frame = spark.createDataFrame([(t, n, p, "user", f"{n}", s) for t, n, p, s in rows], "tree_id long, node_id long, parent_id long, role string, text string, score double")
    got = defaultdict(list)
    for r in chat.best_branches(frame, 2).orderBy("place").collect():
        got[r.tree_id, r.branch].append(int(r.text))
    assert got == {(1, 1): [1, 3], (1, 2): [1, 2, 4], (2, 1): list(range(41)), (3, 1): [9]}
    circle = spark.createDataFrame([(1, 1, 2, "u", "", 1.0), (1, 2, 1, "u", "", 1.0)], frame.schema)
    old, chat.ROUNDS = chat.ROUNDS, 3
    try:
        with pytest.raises(ValueError):
            chat.best_branches(circle)
    finally:
        chat.ROUNDS = old


def test_fingerprints(spark, awkward):
    got = by_id(fingerprints.edited_neighbours(awkward, ranges=5))
    texts = [t or "" for t in AWKWARD]
    for i, t in enumerate(texts):
        other = fingerprints.edited(t, texts[(i + 1) % len(texts)])
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(other.encode()).hexdigest())
        assert (r["fingerprint"], r["edited_fingerprint"]) == (fingerprints.fingerprint(t), fingerprints.fingerprint(other))
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert got[0]["near_next"] == 1  # null and empty are one text
    long = " ".join(words(2000, 3))
    near, far = fingerprints.fingerprint(long[:6000] + "X" + long[6001:]), fingerprints.fingerprint(" ".join(words(2000, 4)))
    frame = spark.createDataFrame([(fingerprints.fingerprint(long), near, far)], "a string, b string, c string")
    row = frame.select(fingerprints.likeness("a", "b").alias("near"), fingerprints.likeness("a", "c").alias("far")).first()
    assert row.near > 0.9 and row.far < 0.35


def test_fingerprints_of_null_ties_and_one_row(spark):
    rows = fingerprints.edited_neighbours(documents(spark, ["abcd", "b", "a", "zz"], [None, 5, 5, 7]), ranges=3).collect()
    want = {"abcd": "aba", "a": "a", "b": "b", "zz": "za"}  # order: null, (5, a), (5, b), 7
    assert sorted(r.edited_sha256 for r in rows) == sorted(hashlib.sha256(x.encode()).hexdigest() for x in want.values())
    one = fingerprints.edited_neighbours(documents(spark, ["same"])).first()
    assert one.edited_sha256 == hashlib.sha256(b"sasa").hexdigest() and one.near_next == 1


def _toxic_corpus(n):
    r = random.Random(5)
    vocabulary = [f"{a}{b}" for a in ("ba", "co", "du", "fi", "go") for b in ("ner", "tal", "mik", "ros")]
    rows = []
    for i in range(n):
        text = [r.choice(vocabulary) for _ in range(r.randrange(3, 80))]
        if bad := i % 3 == 0:
            text.insert(r.randrange(len(text)), f"vilest{r.choice('abcdef')}{r.choice('xyz')}")
        rows.append((i, " ".join(text), int(bad)))
    return rows


def test_toxicity_on_the_held_out_fold(spark):
    rows = _toxic_corpus(600)
    docs = documents(spark, [t for _, t, _ in rows] + [None, "", "!!"])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None), (0, 0)], "doc_id long, toxic int")
    model = toxicity.trained(docs, labels, sample_rows=400)
    got = by_id(toxicity.scored(docs, model))
    fold = [i for i, _, _ in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert {i for i, r in got.items() if r["held_out"] and i < 600} == set(fold)
    assert np.mean([got[i]["predicted"] == rows[i][2] for i in fold]) > 0.95
    assert got[600]["score"] == got[601]["score"] == got[602]["score"] and got[600]["predicted"] == 0
    rest = toxicity.without_toxic(docs, model)
    assert rest.schema == docs.schema and {r.doc_id for r in rest.collect()} == {i for i, r in got.items() if not r["predicted"]}


def test_toxicity_without_both_classes():
    assert toxicity.scores(toxicity.fitted([], []), ["x"]).tolist() == [0.0]
    assert toxicity.scores(toxicity.fitted(["a", "b"], [1, 1]), ["x"]).tolist() == [1.0]


_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def _secrets_by_re(text):
    found = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    return sorted(found + [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24])


def test_secrets_against_re():
    r = random.Random(2)
    parts = ["password", "PassWd", "secret", "token", "api_key", "apikey", "=", ":", " ", "'", '"', "AKIA", "ABCDEFGH", "0123", "abcdef", "deadbeefdeadbeef01234567", "é", "\n", "-", "x"]
    for _ in range(3000):
        text = "".join(r.choice(parts) for _ in range(r.randrange(25)))
        assert [s for s in secrets.found_in(text.encode(), secrets.scanner()) if s[1] < 3] == _secrets_by_re(text)


@pytest.mark.parametrize("head", ["secret=xxtoken:", "secret=xx token:", "password=a", ""])
def test_secrets_of_a_long_text_in_linear_time(head):
    text = head + "n" * 500_000 + "token=abcdefg" + "f" * 500_000
    began = time.process_time()
    got = [s for s in secrets.found_in(text.encode(), secrets.scanner()) if s[1] < 3]
    assert time.process_time() - began < 10
    assert got == _secrets_by_re(text)


def test_secret_spans_and_masking(spark):
    token = "ghp_" + "a1B2" * 9
    texts = [None, "", f"é key {token} end", "token=abcdef1 token: x", "plain"]
    docs = documents(spark, texts).withColumn("n_chars", F.length("text").cast("long"))
    got = by_id(secrets.span_digests(secrets.secret_spans(docs)))
    assert [got[i]["spans"] for i in range(5)] == ["", "", "github:6:46", "assign:0:13", ""]
    assert (got[3]["n_assign"], got[3]["base_sha256"]) == (1, hashlib.sha256(b"assign:0:13").hexdigest())
    rest = {r.doc_id: r for r in secrets.without_secrets(docs).collect()}
    assert [rest[i].text for i in range(5)] == [None, "", "é key [github] end", "[assign] token: x", "plain"]
    assert [rest[i].n_chars for i in range(5)] == [None, 0, 18, 17, 5]


def test_automata_are_minimal_and_refuse_what_they_do_not_know():
    one = automata.compiled([automata.parsed("(a|b)*abb")])
    assert len(one.moves) == 5  # four states and the dead one
    assert one.longest(b"xabbabbz", 1) == 7 and one.longest(b"ba", 0) == -1
    for wrong in ("(a", "a)", "é" * 2 + "中"):
        with pytest.raises(ValueError):
            automata.parsed(wrong)


_BITS = ["'s", "'ll", "'re", "' ", "''", "  ", " ", "\n", "\t", "a", "é", "ß", "Z", "1", "²", "٣", "½", "!", "…", "中", "👍", "́", "\x1c", "\x85", "don't", "'LL", "x" * 70, " " * 40, "ab" * 50]


def _random_texts(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(_BITS) for _ in range(r.randrange(30))) for _ in range(n)]


def test_byte_bpe_as_the_library(spark):
    with open(BYTE_VOCABULARY, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = _random_texts(400, 1) + AWKWARD
    tokenizer = tokens.byte_tokenizer(BYTE_VOCABULARY)
    got = by_id(tokens.token_digests(documents(spark, texts), BYTE_VOCABULARY))
    whole = by_id(tokens.encoded(documents(spark, texts), BYTE_VOCABULARY))
    for i, text in enumerate(t or "" for t in texts):
        ids = library.encode_ordinary(text)
        assert whole[i]["ids"] == ids
        assert got[i]["n_tokens"] == len(ids) and got[i]["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        if ids:
            middle = len(ids) // 2
            assert tokenizer.decode(ids[middle:]) == text.encode()[whole[i]["offsets"][middle] :]


def test_pieces_survive_a_full_cache():
    cache = bpe.PieceCache(lambda pieces: [np.frombuffer(p, np.uint8).astype(np.int32) for p in pieces], most_ids=50)
    r = random.Random(3)
    for _ in range(50):
        pieces = [bytes(r.randrange(256) for _ in range(r.choice((1, 2, 9, 80)))) for _ in range(8)] * 2
        ends = np.cumsum([len(p) for p in pieces])
        ids, counts = cache.ids(b"".join(pieces), ends - [len(p) for p in pieces], ends)
        assert ids.astype(np.uint8).tobytes() == b"".join(pieces) and counts.tolist() == [len(p) for p in pieces]


def test_packing_keeps_every_id_once(spark):
    library = Tokenizer.from_file(WORD_VOCABULARY)
    texts = _random_texts(300, 4) + AWKWARD + ["ÀÉÖ×÷Þßÿ don't WE'RE we'll 'sx 12ab 's's", "İI Σς ΑΣ"]
    rows = packing.packed(documents(spark, texts), WORD_VOCABULARY, capacity=512).collect()
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    for i, text in enumerate(texts):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, packing.END_ID], "<u4")
        at = 0
        for p in sorted(pieces[i], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids)) and p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for own in sequences.values():
        own.sort(key=lambda p: p.offset)
        assert [p.offset for p in own] == np.cumsum([0, *(p.length for p in own)])[:-1].tolist() and sum(p.length for p in own) <= 512


def test_differencing_balances():
    sizes = np.random.default_rng(1).integers(1, 900, 400)
    where = packing.packed_groups(sizes, 4096)
    loads = np.bincount(where, sizes)
    assert loads.sum() == sizes.sum() and loads.max() <= 4096 and loads.max() - loads.min() < 60
    assert len(loads) == -(-sizes.sum() // 4096)
    assert packing.packed_groups(np.array([4000, 4000, 4000]), 4096).tolist().count(0) == 1  # raised from 3 only if needed


def _near_corpus():
    base, r = words(120, 7), random.Random(8)
    texts = [" ".join(base)] * 3
    for k in range(60):
        own = list(base)
        for _ in range(r.randrange(4)):
            own[r.randrange(120)] = f"new{k}"
        texts.append("  ".join(own))
    chain = words(200, 9)
    for k in range(6):  # each is near the next only
        texts.append(" ".join([*words(16 * k, 10)[: 8 * k], *chain[8 * k :]]))
    return texts + [None, "", " ", "one two", "one  two", "one two three", *(" ".join(words(60, 20 + k)) for k in range(20))]


def _links(texts):
    sets = []
    for t in texts:
        own = (t or "").split()
        sets.append({tuple(own[i : i + 5]) for i in range(max(1, len(own) - 4))} if own else set())
    n = len(sets)
    return [{j for j in range(n) if i != j and sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])} for i in range(n)]


@pytest.mark.parametrize("blocks", [(2000, 256), (9, 7)])
def test_similar_documents(spark, blocks):
    texts = _near_corpus()
    links, root = _links(texts), {}
    for i in range(len(texts)):
        stack = [] if i in root else [i]
        while stack:
            if (u := stack.pop()) not in root:
                root[u] = i
                stack += links[u]
    got = by_id(jaccard.similar_documents(documents(spark, texts), *blocks))
    sizes = Counter(root.values())
    for i in range(len(texts)):
        assert (got[i]["class_id"], got[i]["n_links"], got[i]["class_size"], got[i]["kept"]) == (root[i], len(links[i]), sizes[root[i]], root[i] == i)


def test_similar_documents_of_null_and_repeated_ids(spark):
    text = " ".join(words(30, 11))
    docs = documents(spark, [text, text, text + " more", "other"], [None, 4, 4, 4])
    rows = jaccard.similar_documents(docs).collect()
    assert sorted((r.doc_id or -1, r.class_id or -1, r.n_links, r.kept) for r in rows) == [(-1, -1, 2, True), (4, -1, 2, False), (4, -1, 2, False), (4, 4, 0, True)]
    rest = jaccard.without_similar(docs)
    assert sorted(r.text for r in rest.collect()) == sorted([text, "other"]) and rest.schema == docs.schema


def test_pruning_keeps_what_reaches_the_threshold():
    least = jaccard.least_matches()
    assert least[0] > 0 and least[-1] < 0.8 * jaccard.BANDS * jaccard.ROWS and (np.diff(least) >= 0).all()


@pytest.mark.parametrize("few", [1 << 18, 0])
def test_components(spark, monkeypatch, few):
    monkeypatch.setattr(components, "FEW", few)
    edges = [(5, 1), (1, 9), (9, 7), (20, 21), (21, 22), (22, 20), (3, 3)] + [(100 + i, 101 + i) for i in range(30)]
    got = {r.a: r.b for r in components.components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    assert got == {5: 1, 9: 1, 7: 1, 21: 20, 22: 20, **{101 + i: 100 for i in range(30)}}


def _passage_corpus():
    r, base = random.Random(12), words(40, 13)
    texts = []
    for k in range(30):
        own = words(r.randrange(30), 100 + k)
        for _ in range(r.randrange(3)):
            a = r.randrange(30)
            own += base[a : a + r.randrange(5, 15)] + words(r.randrange(4), 200 + k)
        texts.append("\n ".join(own))
    return texts + AWKWARD + ["ab " * 40, "ab " * 30]


@pytest.mark.parametrize("heavy", [1000, 1])
def test_earlier_passages(spark, heavy):
    shape, texts = Shape(size=6, gram=3, words=True), _passage_corpus()
    split = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode()) for t in texts]
    first = {}
    for i, own in enumerate(split):
        for j in range(len(own) - 5):
            first.setdefault(tuple(own[j : j + 6]), i)
    got = by_id(passages.without_earlier_passages(documents(spark, texts), shape, heavy))
    for i, own in enumerate(split):
        gone = {k for j in range(len(own) - 5) if first[tuple(own[j : j + 6])] < i for k in range(j, j + 6)}
        kept = b" ".join(w for k, w in enumerate(own) if k not in gone)
        assert (got[i]["n_words"], got[i]["n_removed"], got[i]["kept_sha256"]) == (len(own), len(gone), hashlib.sha256(kept).hexdigest())


def test_earlier_passages_of_null_and_repeated_ids(spark):
    rows = passages.without_earlier_passages(documents(spark, [PASSAGE, PASSAGE, PASSAGE], [None, 2, 2])).collect()
    assert sorted((r.doc_id or -1, r.n_removed) for r in rows) == [(-1, 0), (2, 70), (2, 70)]
    rows = passages.without_earlier_passages(documents(spark, [PASSAGE, PASSAGE], [2, 2])).collect()
    assert [r.n_removed for r in rows] == [0, 0]


@pytest.mark.parametrize("heavy", [1000, 1])
def test_repeated_strings(spark, heavy):
    shape, texts = Shape(size=12, gram=5, words=False), [(t or "")[:3000] for t in _passage_corpus()] + ["abcdefghijkl", "abcdefghijk", "éé" * 12]
    raw = [t.encode() for t in texts]
    counts = Counter(t[j : j + 12] for t in raw for j in range(len(t) - 11))
    got = by_id(suffixes.without_repeats(documents(spark, texts), shape, heavy))
    for i, t in enumerate(raw):
        gone = np.zeros(len(t), bool)
        for j in range(len(t) - 11):
            if counts[t[j : j + 12]] > 1:
                gone[j : j + 12] = True
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        runs = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        want = (len(t), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
        assert tuple(got[i][c] for c in ("n_bytes", "n_removed", "n_spans", "kept_sha256")) == want


def test_repeated_strings_in_production_shape(spark, awkward):
    got = by_id(suffixes.without_repeats(awkward))
    assert got[7]["n_removed"] == got[7]["n_bytes"] == len(PASSAGE) and got[11]["n_removed"] == 800
    assert got[12]["n_removed"] == 150_000 and got[12]["n_spans"] == 1 and got[13]["n_removed"] == 0
    twice = suffixes.without_repeats(documents(spark, [PASSAGE, PASSAGE], [None, None])).collect()
    assert [r.n_removed for r in twice] == [len(PASSAGE)] * 2
    assert (suffixes.multikey_order(np.array([[3, 1], [1, 2], [3, 0], [1, 2]], np.uint64)) == [1, 3, 2, 0]).all()


def test_long_texts_are_cut_into_segments(spark, monkeypatch):
    from tidemark.llm import windows

    monkeypatch.setattr(windows, "SEGMENT", 64)
    values = np.random.default_rng(3).integers(1, 1 << 60, 700, np.uint64)
    shape = Shape(size=20, gram=7, words=True)
    first, last, place, _ = windows.super_kmers(values, shape)
    covered = np.concatenate([np.arange(a, b + 1) for a, b in zip(first, last)])
    assert covered.tolist() == list(range(681)) and (place >= last).all() and (place <= first + 13).all()
