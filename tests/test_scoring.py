from __future__ import annotations

import random

import numpy as np
import pytest

from kinweave.operators.candidates import kmers
from kinweave.operators.cluster import centre_pairs
from kinweave.operators.scoring import grouped_matrix, level_matrix, local_scores, read_matrix, scored_pairs


def _reference(a, b, m, gap_open, extend):
    """Local alignment cell by cell, gaps of every length tried."""
    h = [[0.0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i][j] = max(
                0.0, h[i - 1][j - 1] + m[ord(a[i - 1]), ord(b[j - 1])],
                *(h[i - n][j] - gap_open - (n - 1) * extend for n in range(1, i + 1)), *(h[i][j - n] - gap_open - (n - 1) * extend for n in range(1, j + 1)),
            )
    return max(map(max, h))


def test_local_scores(spark, tmp_path):
    m = grouped_matrix()
    assert local_scores(["ACDEF", "WWACDEFWW", "", "ACDEFGHIKL"], ["ACDEF", "KKACDEFKK", "ACD", "ACDEFIKL"], m, 3, 1).tolist() == [25.0, 25.0, 0.0, 36.0]
    rng = random.Random(1)
    word = lambda: "".join(rng.choices("ACDEFGHIKXZ", k=rng.randint(0, 12)))
    pairs = [(word(), word()) for _ in range(300)]
    for cost in ((11, 1), (3, 1), (2, 2)):
        assert np.allclose(local_scores(*map(list, zip(*pairs, strict=True)), m, *cost), [_reference(a, b, m, *cost) if a and b else 0 for a, b in pairs])
    (tmp_path / "m.txt").write_text("# test\n   A  B\nA  4 -1\nB -1  4\n")
    read = read_matrix(spark, str(tmp_path / "m.txt"))
    assert read[ord("B"), ord("A")] == -1.0 and read[ord("A"), ord("A")] == 4.0
    (tmp_path / "long.txt").write_text("x" * (2 << 20))
    with pytest.raises(ValueError):
        read_matrix(spark, str(tmp_path / "long.txt"))
    assert level_matrix(90)[ord("A"), ord("W")] < level_matrix(40)[ord("A"), ord("W")]
    df = spark.createDataFrame([("x", "y", "ACDEF", "ACDEW"), ("x", "z", None, "A")], "a string, b string, seq_a string, seq_b string")
    got = {r.b: (r.score, r.similarity) for r in scored_pairs(df, m).collect()}
    assert got == {"y": (21.0, 0.84), "z": (0.0, 0.0)}


def test_centre_pairs(spark):
    seqs = {"a": "ACDEFGH", "b": "ACDEF", "c": "CDEFK", "d": "WWWWW", "e": "AC"}
    df = spark.createDataFrame(list(seqs.items()), "key string, seq string")
    want = set()
    for k in {s[i : i + 3] for s in seqs.values() for i in range(len(s) - 2)}:
        group = sorted((-len(s), key) for key, s in seqs.items() if k in s)
        want |= {tuple(sorted((group[0][1], key))) for _, key in group[1:]}
    assert {tuple(sorted((r.a, r.b))) for r in centre_pairs(df, kmers(df, 3)).collect()} == want
