"""Spelling variants: the bit-sliced index and whole queries against brute force."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kinweave.llm import spelling


def _one_apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def _brute(words: dict[str, int]):
    out = {}
    for w, n in words.items():
        others = [v for v in words if _one_apart(w, v)]
        best = min(others, key=lambda v: (-words[v], v), default=None)
        out[w] = (len(others), best if best and words[best] >= 2 * n else None)
    roots = {}
    for w in words:
        at = w
        while out[at][1]:
            at = out[at][1]
        roots[w] = at
    return {(w, form, roots[w], words[w], near, words[form] if form else None) for w, (near, form) in out.items()}


def _vocabulary(rng, n, letters="abcé", least=5):
    words = set()
    while len(words) < n:
        words.add("".join(rng.choices(letters, k=rng.randint(least, least + 4))))
    return {w: rng.choice([3, 4, 6, 7, 12, 30, 100]) for w in sorted(words)}


def test_near_by_bitsets():
    rng = random.Random(0)
    words = [w for w in _vocabulary(rng, 900) if len(w) in (6, 7)] + ["abcabc", "bcabca", "aaaaaa", "aaaaaaa", "aabaaa"]
    words = sorted(set(words))
    asked = [w for w in words if len(w) == 6]
    got = []
    for first_half in (True, False):
        a, b = spelling.near(asked, words, 6, first_half)
        pairs = [(asked[i], words[j]) for i, j in zip(a, b, strict=True)]
        assert all((x[:3] == y[:3]) == first_half for x, y in pairs)
        got += pairs
    assert sorted(got) == sorted((x, y) for x in asked for y in words if _one_apart(x, y))
    assert [len(x) for x in spelling.near([], words, 6, True)] == [0, 0]


@pytest.mark.parametrize("bucket,letters", [(1 << 14, 1 << 17), (40, 1 << 17), (1 << 14, 300)])
def test_variants_against_brute_force(spark, bucket, letters):
    words = _vocabulary(random.Random(1), 500)
    words |= {"prefix" + w: n for w, n in list(words.items())[:150]} | {"x" * 5000: 3, "x" * 5001: 30, "x" * 4999 + "y": 6}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    rows = spelling.variants(df, bucket=bucket, group_letters=letters).collect()
    assert len(rows) == len(words)
    assert {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in rows} == _brute(words)
    if letters == 300:  # hot groups in blocks: no group holds more than two blocks
        most = spelling.groups(df, len(words), group_letters=letters).filter("m < 100").groupBy("m", "side", "bucket", "asking", "answering").agg(F.sum(F.length("word")).alias("n"))
        assert most.agg(F.max("n")).first()[0] < 4 * letters


def test_vocabulary(spark, monkeypatch):
    monkeypatch.setattr(spelling, "PART", 11)
    monkeypatch.setattr(spelling, "HELD", 3)
    rng = random.Random(4)
    rows = [(k, " ".join(rng.choices(["Straße", "STRASSE", "naïve", "NAÏVE", "colour", "Color", "ok1ok", "x×y÷z", "łódź", "hello-world", "İstanbul"], k=40))) for k in range(60)]
    rows += [(None, "Nullid Nullid Nullid"), (None, None), (1, ""), (2, "12 34 !!"), (60, "q" * 100)] + [(61, "repeat")] * 3
    want = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            want[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 97 == 0 else run] += 1
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("mine") for c in ("word", "n", "m", "side", "form")})
    got = {r.word: r.n for r in spelling.vocabulary(df, damaged=97).collect()}
    assert got == {w: n for w, n in want.items() if len(w) >= 5 and n >= 3} and "repeat" in got and "nullid" in got
    assert spelling.variants(spelling.vocabulary(df.limit(0))).count() == 0
