"""Near dedup, fingerprints, language ID, packing, LM scoring, pipeline: edge cases, and brute force on small tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import time
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from kinweave.llm import fingerprint, language, lmscore, neardup, packing, shingles

DOCS = "doc_id long, text string"
EDGES = [(900, None), (901, ""), (902, " \n "), (903, "one"), (904, "one"), (905, "two words"), (None, "no id here"), (906, "twice"), (906, "twice")]


def _docs(spark, rows, extra=False):
    df = spark.createDataFrame(rows, DOCS)
    if extra:  # columns that clash with names used inside
        for name in ("tie", "node", "label", "band", "class_id", "lang_pred", "score", "shard", "block", "held", "bucket", "_row"):
            df = df.withColumn(name, F.lit("mine"))
    return df


def _text(rng, n, words="abcdefghijklmnop"):
    return " ".join("".join(rng.choices(words, k=rng.randint(2, 5))) for _ in range(n))


def _set(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").lower())
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def _similarity(x, y):
    keys = set(x) | set(y)
    return sum(1 / sum(max(x[j] / x[i], y[j] / y[i]) for j in keys) for i in set(x) & set(y)) if keys else 1.0


def _groups(rows):
    sets = [_set(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if _similarity(sets[i], sets[j]) >= 0.8:
                root[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(rows))]


def test_similarity_formula():
    rng = random.Random(1)
    for _ in range(50):
        x, y = (Counter(rng.choices("abcdefgh", k=rng.randint(1, 12))) for _ in range(2))
        pack = lambda c: (np.array(sorted(map(ord, c)), dtype=np.uint64), np.array([c[k] for k in sorted(c)]))
        assert neardup.similarity(*pack(x), *pack(y)) == pytest.approx(_similarity(x, y))


def test_prob_minhash_estimates():
    rng = np.random.default_rng(0)
    keys = rng.integers(1, 1 << 62, 400).astype(np.uint64)
    x, y = rng.integers(1, 6, 400), rng.integers(0, 4, 400)
    doc = np.concatenate([np.zeros(400, int), np.ones((y > 0).sum(), int)])
    s = neardup.prob_minhash(doc, np.concatenate([keys, keys[y > 0]]), np.concatenate([x, y[y > 0]]), 2, 4000)
    a, b = Counter(dict(enumerate(x))), Counter({k: v for k, v in enumerate(y) if v})
    assert (s[0] == s[1]).mean() == pytest.approx(_similarity(a, b), abs=0.03)


def test_near_duplicates(spark):
    rng = random.Random(7)
    passage = _text(rng, 40)
    rows = [(k, passage + " " + _text(rng, 25)) for k in range(25)]  # share a passage, aren't alike
    for k in range(12):
        words = _text(rng, 120).split()
        for c in range(rng.randint(1, 5)):  # chains of near copies
            rows.append((100 + 10 * k + c, " ".join(words)))
            words[rng.randrange(120)] = "changed"
            words = words[:-1] if rng.random() < 0.3 else words
    rows += EDGES + [(300, rows[30][1].upper()), (301, "x " * 3000 + rows[31][1])]
    found = neardup.near_duplicates(_docs(spark, rows, extra=True)).collect()
    assert len(found) == len(rows)
    want: dict[int, set] = {}
    for (doc_id, _), g in zip(rows, _groups(rows), strict=True):
        want.setdefault(g, []).append(doc_id)
    got: dict[int, list] = {}
    for r in found:
        got.setdefault(r.class_id, []).append(r.doc_id)
    key = lambda g: sorted(map(str, g))
    assert sorted(map(key, got.values())) == sorted(map(key, want.values()))
    kept = neardup.deduplicate(_docs(spark, rows, extra=True))
    assert kept.columns == _docs(spark, rows, extra=True).columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(min((i for i in g if i is not None), default=None)) for g in want.values())
    assert neardup.near_duplicates(_docs(spark, [])).count() == 0


def test_near_duplicates_without_telling_ids(spark):
    rng = random.Random(11)
    a, b, c, d = (_text(rng, 60) for _ in range(4))
    rows = [(None, a), (None, a.upper()), (None, b), (7, c), (7, d), (8, d)]
    found = neardup.near_duplicates(_docs(spark, rows)).collect()
    assert Counter(Counter(r.class_key for r in found).values()) == Counter([2, 1, 1, 2])
    assert all((r.class_id, r.class_size) == (7, 1 + (r.tie == s.tie)) for r in found for s in found if s.doc_id == 8 and r.doc_id == 7)
    kept = sorted((str(r.doc_id), r.text.lower()) for r in neardup.deduplicate(_docs(spark, rows)).collect())
    assert kept == sorted([("None", a), ("None", b), ("7", c), ("7", d)])


def test_sketch_recovers_differences():
    rng = np.random.default_rng(1)
    for size, apart in ((0, 0), (5, 1), (200, 3), (500, 400)):
        both = rng.integers(0, 1 << 63, size + apart).astype(np.uint64)
        a, b = np.unique(both[: size + apart // 2]), np.unique(np.concatenate([both[:size], both[size + apart // 2 :]]))
        (ours, theirs), *_ = fingerprint.differences([a], [b])
        assert set(ours.tolist()) == set(a.tolist()) - set(b.tolist()) and set(theirs.tolist()) == set(b.tolist()) - set(a.tolist())
    one, other = (fingerprint.sketch(fingerprint.side([k])) for k in (both[:200], both[200:400]))
    assert not fingerprint.peel(fingerprint.subtract(one, other), fingerprint.CELLS)[3].any()


def test_pairs_do_not_meet():
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 1 << 63, 400).astype(np.uint64)
    pick = lambda: np.unique(rng.choice(pool, rng.integers(0, 300)))
    a, b = [pick() for _ in range(300)], [pick() for _ in range(300)]
    for x, y, (ours, theirs) in zip(a, b, fingerprint.differences(a, b), strict=True):
        assert np.array_equal(ours, np.setdiff1d(x, y)) and np.array_equal(theirs, np.setdiff1d(y, x))


@pytest.mark.parametrize("apart,seeds", [(1, 40), (2, 40), (19, 40), (30, 40), (150, 30), (1000, 20), (6000, 10), (16000, 6), (120_000, 2), (500_000, 1)])
def test_likeness_is_that_of_the_sets(apart, seeds):
    for seed in range(seeds):
        rng = np.random.default_rng(seed)
        common = rng.integers(0, 1 << 63, int(rng.integers(0, 2 * apart))).astype(np.uint64)
        left = int(rng.integers(0, apart + 1)) if seed % 2 else apart // 2
        own, other = rng.integers(0, 1 << 63, left).astype(np.uint64), rng.integers(0, 1 << 63, apart - left).astype(np.uint64)
        a, b = np.unique(np.concatenate([common, own])), np.unique(np.concatenate([common, other]))
        began = time.time()
        (ours, theirs), *_ = fingerprint.differences([a], [b])
        assert time.time() - began < 10
        assert np.array_equal(np.sort(ours), np.setdiff1d(a, b)) and np.array_equal(np.sort(theirs), np.setdiff1d(b, a))
        assert fingerprint.likeness(a, b) == len(np.intersect1d(a, b)) / len(np.union1d(a, b))


def test_likeness_of_numbered_lines():
    low, high = ("\n".join(map(str, range(k, k + 10000))) for k in (0, 10000))
    assert fingerprint.likeness(fingerprint.digests(low), fingerprint.digests(high)) == 0.0
    a, b = ("\n".join(map(str, range(k, k + 2_500_000))) for k in (0, 2_000_000))  # 18 and 20 MB
    began = time.time()
    assert fingerprint.likeness(fingerprint.digests(a), fingerprint.digests(b)) == 500_000 / 4_500_000
    assert time.time() - began < 60


def test_peeling_ends_on_a_sketch_that_is_none():
    rng = np.random.default_rng(0)
    for cells in (24, 192, 12288):
        noise = fingerprint.Sketch(rng.integers(-1, 2, 5 * cells), rng.integers(0, 1 << 63, 5 * cells).astype(np.uint64), rng.integers(0, 1 << 32, 5 * cells).astype(np.uint64))
        assert not fingerprint.peel(noise, cells)[3].any()
    # a cell that holds its own key although the key was never put in flips between two states
    odd = fingerprint.sketch(fingerprint.side([np.array([12345], dtype=np.uint64)]))
    odd.count[np.flatnonzero(odd.count)[0]] = -1
    assert not fingerprint.peel(odd, 24)[3].any()


def test_fingerprints(spark):
    rng = random.Random(3)
    rows = [(k, "\n".join(_text(rng, rng.randint(1, 9)) + "." for _ in range(rng.randint(0, 12)))) for k in range(60)]
    rows += [(71, rows[3][1]), (70, None), (72, "é" * 7), (73, "a\n" * 50)]
    out = {r.doc_id: r for r in fingerprint.fingerprint_edits(_docs(spark, rows, extra=True)).collect()}
    texts = {d: t or "" for d, t in rows}
    ids = sorted(texts, reverse=True)
    assert sorted(out) == sorted(ids)
    for k, d in enumerate(ids):
        other = texts[ids[(k + 1) % len(ids)]]
        changed = fingerprint.edited(texts[d], other)
        sets = [set(fingerprint.digests(t).tolist()) for t in (texts[d], changed, other)]
        like = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        r = out[d]
        assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest() and r.n_chars == len(texts[d])
        assert (r.near_edited, r.near_next) == pytest.approx((like(sets[0], sets[1]), like(sets[0], sets[2])))
    assert out[71].fingerprint == out[3].fingerprint != out[4].fingerprint
    assert fingerprint.fingerprint_edits(_docs(spark, [])).count() == 0
    assert fingerprint.fingerprint_edits(_docs(spark, [(None, "a. b.")])).first().near_next == 1.0


def test_language(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    out = language.identify(docs, language.train(docs.filter(~language.held_out(F.col("doc_id"))))).filter(language.held_out(F.col("doc_id"))).collect()
    assert sum(r.lang == r.lang_pred for r in out) >= 0.95 * len(out) and all(0 <= r.score <= 1 for r in out)
    model = language.train(docs)
    en, de = (docs.filter(F.col("lang") == x).orderBy(F.desc(F.length("text"))).first().text for x in ("en", "de"))
    _, _, shares = language.infer([en[:1500] + " " + de[:500]], model)[0]
    assert set(shares) == {"en", "de"} and shares["en"] > shares["de"] > 0.1
    edge = language.identify(_docs(spark, [*EDGES, (1, "12 34!"), (2, "x" * 200_000)], extra=True), model).collect()
    assert {r.doc_id: r.lang_pred for r in edge if r.doc_id in (1, 900, 901, 902)} == dict.fromkeys((1, 900, 901, 902), "und")
    assert all(r.tie == "mine" for r in edge)
    none = language.train(docs.limit(0))
    assert {r.lang_pred for r in language.identify(docs, none).collect()} == {"und"}
    assert language.identify(docs.limit(0), model).count() == 0


def test_packing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").limit(60)
    rows = [tuple(r) for r in docs.collect()] + EDGES[:-1] + [(950, "<|endoftext|> ¡é " * 1500)]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {d: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4") for d, t in rows}
    out = packing.pack_documents(_docs(spark, rows, extra=True), shard_bytes=40_000).collect()
    by, sequences = {}, {}
    for r in out:
        assert zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
        assert bytes(r.ids) == ids[r.doc_id][r.start : r.start + r.length].tobytes()
        by.setdefault(r.doc_id, []).append((r.start, r.length))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(by) == set(ids)
    for pieces, whole in [(p, len(ids[d])) for d, p in by.items()] + [(p, None) for p in sequences.values()]:
        end = 0
        for start, length in sorted(pieces):
            assert start == end and length > 0
            end += length
        assert end == whole if whole else end <= 2048
    assert sum(sum(n for _, n in p) < 2048 for p in sequences.values()) <= len({s >> 32 for s in sequences})
    assert packing.pack_documents(_docs(spark, [])).count() == 0


def test_token_ids(monkeypatch):
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer = Tokenizer.from_file(path)
    rng = random.Random(8)
    parts = [*"ab  \n\t's\u00e9\u6f22\U0001f6000123.,!", "<|endoftext|>", "<|endoftext", " don't", "word word"]
    texts = ["hi <|endoftext|> there", *("".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(500))]
    for size in (5, 1 << 18):
        monkeypatch.setattr(packing, "PART", size)
        assert all(packing.token_ids(t, path).tolist() == [*tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in texts)


def test_token_ids_without_looking_ahead(monkeypatch):
    """White space of every kind and length; only texts with an added token go to the slower encoder."""
    path, asked, made = public_tokenizers.path("byte_bpe_50k.json"), [], packing.encoder
    tokenizer = Tokenizer.from_file(path)
    monkeypatch.setattr(packing, "encoder", lambda path, ahead=True: asked.append(ahead) or made(path, ahead))
    rng = random.Random(9)
    parts = [*"ab  \n\t\r\x0b\x1c\x85\xa0\u2003\u200b\u3000's\u0301\u00bd7.", "\r\n", "\n\n", "'ll", "'LL"]
    for text in [*("".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(2000)), "a  b \n\n c  "]:
        assert packing.token_ids(text, path).tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
    assert True not in asked
    text = "a  <|endoftext|>  b \n<|endoftext|>\n\nc"
    assert packing.token_ids(text, path).tolist() == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
    assert True in asked


def test_document_frequency():
    rng = np.random.default_rng(6)
    doc, bucket = np.sort(rng.integers(0, 50, 4000)), rng.integers(0, 300, 4000)
    want = np.bincount([b for _, b in set(zip(doc.tolist(), bucket.tolist(), strict=True))], minlength=packing.TERMS)
    assert (packing._document_frequency(doc, bucket, 50) == want).all()
    one = packing._document_frequency(np.zeros_like(bucket), bucket, 1)
    assert (one[:300] == np.isin(np.arange(300), bucket)).all() and one.sum() == len(set(bucket.tolist()))
    assert not packing._document_frequency(doc[:0], bucket[:0], 0).any()


def test_retrieval_is_bm25():
    """Scores of a shard against the formula, term by term."""
    rng = np.random.default_rng(4)
    words = [rng.integers(0, 40, rng.integers(0, 30)) for _ in range(60)]
    frequency = np.zeros(packing.TERMS)
    for w in words:
        frequency[np.unique(w)] += 1
    idf, mean = np.log1p((60 - frequency + 0.5) / (frequency + 0.5)), float(np.mean([len(w) for w in words]))
    index = packing.Index(words, idf, mean)
    for seed in range(60):
        want = [
            sum(idf[t] * c * (packing.K1 + 1) / (c + packing.K1 * (1 - packing.B + packing.B * len(w) / mean)) for t in set(words[seed].tolist()) if (c := int((w == t).sum())))
            for w in words
        ]
        assert np.allclose(index.scores(seed), want)


def test_retrieval_order():
    words = [np.array(w) for w in ([1, 2, 3], [9, 9], [2, 3, 4], [5])]
    index = packing.Index(words, np.ones(packing.TERMS), 2.0)
    assert index.scores(0).argsort()[::-1][:2].tolist() == [0, 2] and index.scores(0)[[1, 3]].tolist() == [0, 0]
    assert packing.fill([5, 5, 3, 5], index, 8)[:2] == [(0, 0, 5, 0, 0), (2, 0, 3, 0, 5)]


def test_retrieval_walks_all_neighbours():
    n = 70
    words = [np.array([1, 2, 3])] + [np.array([1, 2])] * n + [np.array([1])]
    index = packing.Index(words, np.ones(packing.TERMS), 2.0)
    # only the last of 71 ranked neighbours fits in whole; then the best one is cut
    assert packing.fill([5, *[20] * n, 3], index, 9)[:3] == [(0, 0, 5, 0, 0), (n + 1, 0, 3, 0, 5), (1, 0, 1, 0, 8)]
    # more than 64 that all fit: document 1 isn't like the seed and comes after those that are
    words = [np.array([1, 2, 3]), np.array([9])] + [np.array([1, 2])] * n
    index = packing.Index(words, np.ones(packing.TERMS), 2.0)
    assert [p[0] for p in packing.fill([5, *[1] * (n + 1)], index, 100)] == [0, *range(2, n + 2), 1]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_lm_scores(spark, order):
    rng = random.Random(5)
    rows = [(k, " ".join(rng.choices(["A", "b", "c\td", "é", "longer"], k=rng.randint(0, 30)))) for k in range(50)] + EDGES
    found = lmscore.score_texts(_docs(spark, rows, extra=True), lmscore.held_out(F.col("doc_id")), order).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(d) for d, _ in rows)
    out = {r.doc_id: r for r in found}
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    tokens = [(d, [*re.findall(r"[^\x20\x09-\x0D]+", low(t)), None]) for d, t in rows]
    held = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1
    counts, left = Counter(), Counter()
    grams = lambda ts: [(tuple((["<s>"] * order + ts)[i + order - k : i + order]), w) for i, w in enumerate(ts) for k in range(order)]
    for d, ts in tokens:
        if not held(d):
            for h, w in grams(ts):
                counts[h, w] += 1
                left[h] += 1
    total, size = left[()], len({w for h, w in counts if not h})

    def p(h, w):
        if not h:
            return (counts[h, w] + 0.5) / (total + 0.5 * (size + 1))
        mu = lmscore.MU[min(len(h), len(lmscore.MU)) - 1]
        return (counts[h, w] + mu * p(h[1:], w)) / (left[h] + mu)

    for d, ts in tokens:
        r, each = out[d], grams(ts)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(d), len(ts), sum(counts[(), w] > 0 for w in ts), total)
        assert r.base_score == pytest.approx(sum(math.log10(p((), w)) for w in ts))
        assert r.score == pytest.approx(sum(math.log10(p(h, w)) for h, w in each if len(h) == order - 1))
    assert lmscore.score_texts(_docs(spark, []), F.lit(False), order).count() == 0


def test_shingles():
    texts = ["a b c d e f", "", "x", "a b c d e f a b c d e f", "é  ü"]
    doc, h, n = shingles.shingle_counts([t.encode() for t in texts])
    for k, t in enumerate(texts):
        assert sorted(n[doc == k].tolist()) == sorted(_set(t).values())
    assert set(h[doc == 0]) <= set(h[doc == 3])
    words, first = shingles.word_hashes([b"one two", b" two ", b"one"])
    assert first.tolist() == [0, 2, 3, 4] and words[1] == words[2] and words[0] == words[3] != words[1]


def test_pipeline(spark):
    sf = "/root/testdata/sf0.001"
    source = spark.read.parquet(f"{sf}/documents.parquet")
    docs = source
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf).cache()
        assert out.columns == source.columns and 0 < out.count() <= docs.count(), name
        docs = out
    left = [(r.doc_id, r.text) for r in docs.collect()]
    assert len(set(_groups(left))) == len(left)
    items = [r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert not any(item and item in text for _, text in left for item in items)
    lines = [x.strip().lower() for _, text in sorted(left) for x in text.split("\n") if x.strip()]
    assert len(lines) == len(set(lines))
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, sf)
    assert {r.doc_id for r in pieces.select("doc_id").distinct().collect()} == {d for d, _ in left}
    # every id of every document that is left, once and in its place; full windows but for the last of a shard
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = {d: np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 1], dtype="<u4") for d, t in left}
    rows, upto, used = pieces.collect(), Counter(), Counter()
    for r in sorted(rows, key=lambda r: (r.doc_id, r.start)):
        assert r.start == upto[r.doc_id] and r.doc_tokens == len(ids[r.doc_id])
        assert r.ids_crc32 == zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        upto[r.doc_id] += r.length
    for r in sorted(rows, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == used[r.sequence_id]
        used[r.sequence_id] += r.length
    assert upto == Counter({d: len(x) for d, x in ids.items()}) and max(used.values()) == 2048
    assert sum(n < 2048 for n in used.values()) <= len({k >> 32 for k in used})


def test_pipeline_brute_force(spark):
    """The stages on a small table with every kind of row: columns of the user's own, nulls, repeats, copies and passages."""
    rng = random.Random(11)
    text = lambda n: _text(rng, n, "abcdefghijklmnopqrstuvwxyz")
    passage = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").first().text
    base = text(60)
    words = base.split()
    near = " ".join([*words[:30], "changed", *words[31:]])
    rows = [
        (1, base), (2, near), (3, base), (4, None), (5, ""), (6, "12 34 !"), (7, f"{text(40)} {passage} {text(10)}"), (8, text(40)),
        (9, f"one line\n{text(12)}\none line"), (None, text(30)), (None, text(30)), (10, "tiny"), (10, "tiny"), (11, text(20_000)),
    ]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t) if t else None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for name in ("lang_pred", "score", "lang_shares", "removed", "n_lines", "n_words", "n_hit", "items", "tie", "_row", "class_id"):
        docs = docs.withColumn(name, F.lit("mine"))
    sf, stages = "/root/testdata/sf0.001", dict(corpus_pipeline.STAGES)
    keys = lambda df: sorted(str((r.doc_id, r.text)) for r in df.collect())
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns and stage(spark, docs.limit(0), sf).count() == 0
        assert {r[c] for r in out.collect() for c in docs.columns[5:]} == {"mine"}, name
    assert keys(stages["language_id"](spark, docs, sf)) == sorted(str((i, t)) for i, t in rows if t and re.search("[a-z]", t))
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert keys(stages["language_id"](spark, unlabelled, sf)) == sorted(str((i, t)) for i, t in rows if t and re.search("[a-z]", t))
    assert keys(stages["decontamination"](spark, docs, sf)) == sorted(str((i, t)) for i, t in rows if i != 7)
    # null and empty texts and the one without letters have no words: one group, but "12 34" has two
    kept = [(i, t) for i, t in rows if i not in (2, 3, 5, 10)] + [(10, "tiny")]
    assert keys(stages["near_dedup"](spark, docs, sf)) == sorted(map(str, kept))
    lined = {(r.doc_id, r.text, r.n_chars) for r in stages["line_dedup"](spark, docs.filter("doc_id IS NOT NULL"), sf).collect()}
    nine = "\n".join(rows[8][1].split("\n")[:2])
    assert {i for i, *_ in lined} == {1, 4, 5, 6, 7, 8, 9, 10, 11} and (9, nine, len(nine)) in lined and (4, None, None) in lined


def test_long_texts(spark):
    """Long texts in every model: words, shingles and trigrams in chunks give what they give in one piece."""
    rng = random.Random(12)
    words = rng.choices([f"w{k}é" for k in range(3000)], k=300_000)
    long = " ".join(words)
    doc, bucket, count = language.trigrams([long])
    whole = language._trigrams([long])
    assert len(long) > language.BLOCK and (bucket == whole[1]).all() and (count == whole[2]).all() and not doc.any()
    docs = _docs(spark, [(1, long), (2, long + " more"), (3, "short text"), (4, "x" * 2_000_000)])
    assert {r.doc_id: r.class_id for r in neardup.near_duplicates(docs).collect()} == {1: 1, 2: 1, 3: 3, 4: 4}
    found = {r.doc_id: r for r in fingerprint.fingerprint_edits(docs).collect()}
    assert found[1].n_chars == len(long) and 0 <= found[1].near_next <= 1
    scored = {r.doc_id: r for r in lmscore.score_texts(docs, F.lit(False)).collect()}
    assert scored[1].n_tokens == 300_001 and scored[4].n_tokens == 2
    packed = packing.pack_documents(docs).groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("t")).collect()
    assert all(r.n == r.t for r in packed) and len(packed) == 4


def test_fingerprint_repeats(spark):
    rows = [(3, "A one. B two."), (3, "A one. B two."), (None, "no id"), (1, "A one. C three."), (3, None)]
    out = fingerprint.fingerprint_edits(_docs(spark, rows, extra=True)).collect()
    assert sorted(str(r.doc_id) for r in out) == sorted(str(i) for i, _ in rows)
    same = [r.fingerprint for r in out if r.n_chars == 13]
    assert len(same) == 2 and len(set(same)) == 1
