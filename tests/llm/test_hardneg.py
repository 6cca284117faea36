"""Hard negatives against brute force; the bounds cut work and no result."""

from __future__ import annotations

import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from kinweave.llm import hardneg


def _brute(rows, is_anchor, positives=5, negatives=3):
    rows = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda s: (-s[0], s[1] is None, s[1] or 0)
    out = []
    for k, (i, label, v) in enumerate(rows):
        if not is_anchor(i):
            continue
        scored = [(sum(a * b for a, b in zip(v, w, strict=False)), j, other) for m, (j, other, w) in enumerate(rows) if m != k]
        for s, j, _ in sorted((x for x in scored if x[2] == label), key=key)[:positives]:
            fits = [x for x in scored if x[2] != label and 50 * s <= 100 * x[0] <= 95 * s]
            out += [(i, j, rank, x[1], s, x[0]) for rank, x in enumerate(sorted(fits, key=key)[:negatives], 1)]
    return sorted(out, key=str)


SCHEMA = "vec_id long, label int, embedding array<float>"


def _mined(spark, rows, parts=3):
    df = spark.createDataFrame(rows, SCHEMA).repartition(parts)
    for name in ("row", "v", "is_anchor", "rank", "score", "positive"):
        df = df.withColumn(name, F.lit("mine"))
    return sorted(map(tuple, hardneg.mine(hardneg.usable(df), "vec_id % 10 = 0").collect()), key=str)


def _vectors(rng, n, dims=6):
    centres = [[rng.gauss(0, 1) for _ in range(dims)] for _ in range(4)]
    return [[np.float32(c + rng.gauss(0, 0.4)).item() for c in centres[rng.randrange(4)]] for _ in range(n)]


def test_against_brute_force(spark, monkeypatch):
    rng = random.Random(0)
    rows = [(k, rng.randrange(3), v) for k, v in enumerate(_vectors(rng, 240))]
    rows += [(1000 + 10 * k, 1, [0.0] * 6) for k in range(2)] + [(1100, 2, [-1.0, 0.0, 0.0, 0.0, 0.0, 0.0]), (1110, 0, [1.0, 2.0]), (1121, 0, [])]
    rows += [(1130, None, [1.0] * 6), (1140, 1, None), (1150, 1, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (1160, 1, [float("nan")] * 6), (1170, 1, [float("inf")] * 6)]
    rows += [(None, 1, rows[3][2]), (None, 2, rows[4][2]), rows[20], (5000, 1, rows[20][2]), (5001, 2, rows[20][2])] + [(6000 + k, k % 3, rows[30][2]) for k in range(40)]
    want = _brute(rows, lambda i: i is not None and i % 10 == 0)
    assert len(want) > 200
    assert _mined(spark, rows) == want
    # many blocks of anchors, short lists, single steps, members apart
    for name, value in (("ANCHOR_VALUES", 60), ("LIST_VALUES", 64), ("FIRST_STEP", 1), ("STEP", 7), ("TOGETHER", 3), ("PER_CLUSTER", 4)):
        monkeypatch.setattr(hardneg, name, value)
    assert _mined(spark, rows[200:]) == _brute(rows[200:], lambda i: i is not None and i % 10 == 0)


def test_walks_end_early():
    rng = np.random.default_rng(0)
    centres = rng.normal(size=(8, 16))
    x = np.floor(256 * (centres[rng.integers(0, 8, 6000)] + 0.05 * rng.normal(size=(6000, 16))))
    label, row = rng.integers(0, 5, 6000), np.arange(6000)
    block = pa.table({"row": row[:80], "label": label[:80], "v": pa.array(x[:80].tolist(), pa.list_(pa.float64()))})
    walk = hardneg.Walk(hardneg.Anchors(block, 16, hardneg.fit_centres(x[:80], 8)), 5)
    walk.take(x, row, label, row)
    assert walk.scored < 80 * 6000 / 4
    scores = x[:80] @ x.T
    for k in range(80):
        mine = np.flatnonzero((label == label[k]) & (row != k))
        best = sorted(mine, key=lambda j: (-scores[k, j], j))[:5]
        at = np.flatnonzero(walk.a.row == k)[0]
        assert walk.best.row[at].tolist() == best


def test_edges(spark):
    assert _mined(spark, []) == [] and _mined(spark, [(1, 1, [1.0])]) == [] and _mined(spark, [(10, 1, [1.0])]) == []
    with pytest.raises(ValueError, match="too large"):
        _mined(spark, [(10, 1, [1e9]), (11, 1, [1.0])])
