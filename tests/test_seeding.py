"""Seeds, candidates and clusterings of scored similarity against brute force."""

from __future__ import annotations

import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinweave import storage
from kinweave.operators import candidates, cluster, scoring, seeding
from kinweave.params import ClusterParams
from kinweave.plans import analysis

from conftest import shuffled_rows

AA = scoring.AMINO_ACIDS
MATRIX = scoring.grouped_matrix(5.0, 1.0, -2.0)


def _df(spark, seqs: dict[str, str]):
    return spark.createDataFrame(list(seqs.items()), "key string, seq string")


def _score(a: str, b: str) -> float:
    return sum(MATRIX[ord(x), ord(y)] for x, y in zip(a, b, strict=True))


def test_neighbours(spark):
    words = ["ACD", "WWW", "ILé", "ABC"]
    got = {(r.kmer, r.near) for r in seeding.neighbours(spark.createDataFrame([(w,) for w in words], "kmer string"), MATRIX, 4.0).collect() if not any("a" <= c <= "z" for c in r.near)}
    want = {(w, w) for w in words}
    for w in words:
        for i, c in enumerate(w):
            want |= {(w, w[:i] + d + w[i + 1 :]) for d in AA if d != c and c in AA and MATRIX[ord(c), ord(c)] - MATRIX[ord(c), ord(d)] <= 4.0}
    assert got == want


def _levels(seqs, k, hot, longest):
    open_ = [(key, s, p) for key, s in seqs.items() for p in range(len(s) - k + 1)]
    out = []
    for size in range(k, longest + 1):
        here = [(key, p, s[p : p + size], s) for key, s, p in open_ if p + size <= len(s)]
        n = Counter(g for _, _, g, _ in here)
        out += [(key, p + 1, g) for key, p, g, _ in here if n[g] <= hot]
        open_ = [(key, s, p) for key, p, g, s in here if n[g] > hot]
    return out


def _pairs(seqs, k, hits, hot, longest):
    """Pairs with enough seeds on a diagonal, by comparing all pairs of seeds."""
    held = _levels(seqs, k, hot, longest)
    near = lambda g, h: g == h or (len(g) == len(h) == k and _score(g, h) >= _score(g, g) - 4.0)
    by_diagonal = defaultdict(set)
    for a, p, g in held:
        for b, q, h in held:
            if a < b and len(g) == len(h) and (near(g, h) or near(h, g)):
                by_diagonal[a, b, q - p].add((p, q))
    return {(a, b) for (a, b, _), found in by_diagonal.items() if len(found) >= min(hits, *(len(seqs[x]) - k + 1 for x in (a, b)))}


@pytest.mark.parametrize("hot", [1000, 12])
def test_neighbour_pairs(spark, hot):
    rng = random.Random(3)
    seqs = {f"k{i:03d}": "".join(rng.choices("ACDIL", k=rng.randint(0, 9))) for i in range(70)} | {f"h{i:02d}": "CCCC" + "".join(rng.choices(AA, k=5)) for i in range(20)}
    df = _df(spark, seqs)
    assert {tuple(r) for r in seeding.seeds(df, hot=hot).collect()} == set(_levels(seqs, 3, hot, 8))
    got = [tuple(r) for r in seeding.neighbour_pairs(df, MATRIX, 4.0, hot=hot).collect()]
    assert len(got) == len(set(got)) and set(got) == _pairs(seqs, 3, 2, hot, 8)
    lists = seeding.seeds(df, hot=hot).groupBy("seed").count()
    assert lists.filter(F.length("seed") < 8).agg(F.max("count")).first()[0] <= hot


def test_single_hits_are_not_shuffled(spark):
    """Words with many seeds in common and few on one diagonal: rows of the shuffle are far fewer than hits."""
    rng = random.Random(9)
    seqs = {f"k{i:04d}": "".join(rng.choices("ACDE", k=7)) for i in range(3000)}
    lists = Counter(s[p : p + 3] for s in seqs.values() for p in range(5))
    hits = sum(n * (n - 1) // 2 for n in lists.values())
    rows = shuffled_rows(spark, seeding.neighbour_pairs(_df(spark, seqs), MATRIX, 0.0, hot=2000))
    assert rows < hits / 2, (rows, hits)


@pytest.mark.parametrize("least", [0.0, 0.5, 0.8])
def test_scored_neighbours(spark, least):
    """Scoring where pairs meet, with bounds, leaves what scoring all of them leaves."""
    rng = random.Random(12)
    seqs = _families(rng, 12, 6) | {"e1": "", "e2": "ACD", "e3": "ACD", "e4": "ACéACéACD"}
    df = _df(spark, seqs)
    every = scoring.scored_pairs(seeding.with_sequences(seeding.neighbour_pairs(df, MATRIX, 4.5), df), MATRIX).filter(F.col("similarity") >= least)
    got = [tuple(r) for r in seeding.scored_neighbours(df, MATRIX, 4.5, least).collect()]
    assert len(got) == len(set(got)) and set(got) == {(r.a, r.b) for r in every.collect()} and len(got) > 20


def _families(rng, n, size):
    """Families of peptides: replacements within a group of residues and others, a few insertions and deletions."""
    like = {c: [d for d in g if d != c] or [c] for g in scoring.GROUPS for c in g}
    seqs = {}
    for f in range(n):
        base = "".join(rng.choices(AA, k=rng.randint(8, 22)))
        for m in range(size):
            s = list(base)
            for _ in range(rng.randint(0, 1 + len(s) // 4)):
                i = rng.randrange(len(s))
                kind = rng.random()
                if kind < 0.7:
                    s[i] = rng.choice(like[s[i]])
                elif kind < 0.85:
                    s[i] = rng.choice(AA)
                elif kind < 0.95 and len(s) > 6:
                    del s[i]
                else:
                    s.insert(i, rng.choice(AA))
            seqs[f"f{f:02d}m{m}"] = "".join(s)
    return seqs


def test_recall_against_all_pairs(spark):
    """Of all pairs at or above the identity nine in ten are candidates, and few of the others."""
    seqs = _families(random.Random(8), 40, 7)
    df = _df(spark, seqs)
    keys = sorted(seqs)
    every = spark.createDataFrame([(a, b, seqs[a], seqs[b]) for i, a in enumerate(keys) for b in keys[i + 1 :]], "a string, b string, seq_a string, seq_b string")
    alike = {(r.a, r.b) for r in scoring.scored_pairs(every, MATRIX).filter("similarity >= 0.8").collect()}
    by_seeds = {tuple(r) for r in seeding.neighbour_pairs(df, MATRIX, 4.5).collect()}
    by_edits = {(r.a, r.b) for r in candidates.similar_pairs(df, 0.8).collect()}
    assert len(alike) > 300
    assert len(alike & (by_seeds | by_edits)) / len(alike) >= 0.9
    assert len(alike & by_seeds) / len(alike) >= 0.9
    assert len(by_seeds) < len(keys) * (len(keys) - 1) / 8


@pytest.mark.parametrize("top", [3, 5000])
def test_diagonal_candidates(spark, top):
    rng = random.Random(6)
    seqs = {f"k{i:02d}": "".join(rng.choices("ACD", k=rng.randint(0, 14))) for i in range(60)} | {"x1": "ACDWACDéA", "x2": "ACDWACDéA"}
    want = defaultdict(list)
    for a, s in seqs.items():
        for b, t in seqs.items():
            best = None
            for d in range(-len(s), len(t)):
                cells = [(i, i + d) for i in range(len(s)) if 0 <= i + d < len(t)]
                if a != b and any(s[i : i + 5] == t[j : j + 5] and i + 5 <= len(s) and j + 5 <= len(t) for i, j in cells):
                    run = top_run = 0.0
                    for i, j in cells:
                        known = ord(s[i]) < 128 and ord(t[j]) < 128
                        run = max(0.0, run + (MATRIX[ord(s[i]), ord(t[j])] if known else scoring.UNKNOWN))
                        top_run = max(top_run, run)
                    best = max(best or 0.0, top_run)
            if best is not None:
                want[a].append((-best, b))
    got = {(r.query, r.target, r.score) for r in seeding.diagonal_candidates(_df(spark, seqs), MATRIX, top=top).collect()}
    assert got == {(a, b, -s) for a, found in want.items() for s, b in sorted(found)[:top]} and len(got) > 20


@pytest.mark.parametrize("scored", [False, True])
def test_linear_time(spark, scored):
    """Centres of seed groups against a plain walk over all groups; rows of the candidate join are bounded by the seeds."""
    rng = random.Random(4)
    seqs = {f"k{i:02d}": "".join(rng.choices("ACD", k=rng.randint(0, 30 if i % 4 == 0 else 12))) for i in range(60)}
    df = _df(spark, seqs)
    kept = [tuple(r) for r in seeding.linear_seeds(df, 4, 6, 8, 2).collect()]
    per = Counter(k for k, g in kept if not g.startswith("short:"))
    assert max(per.values()) == 6 and all(per[k] == min(6, len({s[i : i + 4] for i in range(len(s) - 3)})) for k, s in seqs.items())
    assert {k for k, g in kept if g.startswith("short:")} == {k for k, s in seqs.items() if 2 <= len(s) < 8}
    pairs = cluster.centre_pairs(df, seeding.linear_seeds(df, 4, 6, 8, 2))
    assert pairs.count() <= len(kept)
    edits = lambda p: p.filter(F.levenshtein("seq_a", "seq_b") <= 3)
    alike = lambda p: scoring.scored_pairs(p, MATRIX).filter("similarity >= 0.6")
    verify = alike if scored else edits
    good = {(r.a, r.b) for r in verify(spark.createDataFrame([(a, b, s, t) for a, s in seqs.items() for b, t in seqs.items() if a != b], "a string, b string, seq_a string, seq_b string")).collect()}
    groups, rank, best = defaultdict(set), {k: (-len(s), k) for k, s in seqs.items()}, {}
    for k, g in kept:
        groups[g].add(k)
    for group in groups.values():
        centre = min(group, key=rank.get)
        for k in group:
            if k != centre and (k, centre) in good:
                best[k] = min(best.get(k, centre), centre, key=rank.get)
    got = {r.clonotypeKey: r.clusterId for r in cluster.linear_time(df, seeding.linear_seeds(df, 4, 6, 8, 2), verify).collect()}
    assert got == {k: best[k] if k in best and best[k] not in best else k for k in seqs} and len(set(got.values())) < len(seqs)


@pytest.mark.parametrize("params", [{}, {"clusteringTool": "easy-linclust"}, {"highPrecision": True}, {"clusteringTool": "easy-linclust", "similarityType": "sequence-identity"}])
def test_short_rows_disturb_no_others(spark, params):
    """Clusters of 20-letter peptides stay the same whatever short or empty sequences are beside them."""
    rng = random.Random(1)
    seqs = {}
    for i in range(40):
        s = "".join(rng.choices(AA, k=20))
        seqs[f"k{i:02d}"] = s
        seqs[f"k{i:02d}x"] = s[:5] + rng.choice(AA) + s[6:13] + rng.choice(AA) + s[14:]
    p = ClusterParams(identity=0.8, **params)
    matrix = None if "similarityType" in params else MATRIX

    def made(more):
        reps = spark.createDataFrame([*seqs.items(), *more.items()], "clonotypeKey string, sequence string")
        return {r.clonotypeKey: r.clusterId for r in analysis.cluster_representatives(reps, p, matrix).collect()}

    alone = made({})
    assert len(set(alone.values())) < 60
    for more in ({"a0": ""}, {"a0": "AC"}, {"a0": "A", "z1": "ACDE", "z2": "ACDEF"}):
        got = made(more)
        assert {k: c for k, c in got.items() if k in seqs} == alone and set(got) == set(seqs) | set(more)


def test_matrices_by_name(spark, tmp_path):
    named = ClusterParams(similarityType="blosum80")
    with pytest.raises(ValueError, match="blosum80 needs that matrix"):
        analysis.similarity_matrix(spark, named)
    with pytest.raises(FileNotFoundError, match="no matrix blosum80"):
        analysis.similarity_matrix(spark, named, matrices=str(tmp_path))
    rows = ["# by rule", "   " + "  ".join(AA), *(f"{a} " + " ".join(str(int(7 if a == b else -(ord(a) ^ ord(b)) % 3)) for b in AA) for a in AA)]
    (tmp_path / "BLOSUM80.txt").write_text("\n".join(rows) + "\n")
    got = analysis.similarity_matrix(spark, named, matrices=str(tmp_path))
    assert all(got[ord(a), ord(b)] == (7 if a == b else -(ord(a) ^ ord(b)) % 3) for a in AA for b in AA)
    (tmp_path / "blosum50.out").write_text("   A  B\nA  4 -1\nB -1  4\n")
    with pytest.raises(ValueError, match="no matrix of the amino acids"):
        analysis.similarity_matrix(spark, ClusterParams(similarityType="blosum50"), matrices=str(tmp_path))
    assert analysis.similarity_matrix(spark, ClusterParams(similarityType="sequence-identity")) is None
    assert analysis.similarity_matrix(spark, named, MATRIX) is MATRIX


def test_identity_of_nothing_is_refused(spark):
    reps = spark.createDataFrame([("a", "ACD")], "clonotypeKey string, sequence string")
    with pytest.raises(ValueError, match="identity of 0"):
        analysis.cluster_representatives(reps, ClusterParams(identity=0.0, similarityType="sequence-identity"))
    assert analysis.cluster_representatives(reps, ClusterParams(identity=0.0), MATRIX).count() == 1


def test_set_cover_of_a_long_path(spark):
    """A path of ascending keys takes a logarithmic number of rounds, and gives what the sequential greedy gives."""
    n = 10_000
    ids = spark.range(n).select(F.format_string("k%05d", "id").alias("key"), "id")
    nodes = ids.select("key").coalesce(2)
    edges = ids.filter(F.col("id") > 0).select(F.format_string("k%05d", F.col("id") - 1).alias("a"), F.col("key").alias("b")).coalesce(2)
    hashes = {int(r.id): r.h for r in ids.select("id", F.xxhash64("key").alias("h")).collect()}
    before = storage.n_stored()
    got = {int(r.clonotypeKey[1:]): int(r.clusterId[1:]) for r in cluster.set_cover(nodes, edges).collect()}
    assert (storage.n_stored() - before - 1) / 2 < 40
    want, free = {}, np.ones(n + 2, dtype=bool)
    free[[n, n + 1]] = False
    level = lambda i: int(free[i - 1]) + int(free[i + 1])  # noqa: E731  of one or two neighbours: levels 0 and 4
    import heapq

    heap = [(-level(i), hashes[i], i) for i in range(n)]
    heapq.heapify(heap)
    while heap:
        minus, h, i = heapq.heappop(heap)
        if not free[i]:
            continue
        if -minus != level(i):
            heapq.heappush(heap, (-level(i), h, i))
            continue
        for x in (i - 1, i, i + 1):
            if free[x]:
                want[x] = i
                free[x] = False
    assert got == want
