"""Expressions, profiles, layouts and clusterings against worked cases."""

from __future__ import annotations

import math
import random
from itertools import product

import duckdb
import pytest
from pyspark.sql import functions as F

from kinweave.functions import exprs
from kinweave.operators import candidates, cluster, dedup, layout, profile, reassign, rollup
from kinweave.operators.scoring import AMINO_ACIDS

from conftest import shuffled_rows

#: rows, weights, threshold, gap threshold, keep gaps, consensus. Fixed cases.
MSA = [
    (["-K", "-K", "AK"], [1, 1, 1], 0.6, 0.5, True, "-K"),
    (["-K", "-K", "AK"], [1, 1, 1], 0.6, 0.5, False, "K"),
    (["K", "R"], [1, 1], 0.6, 0.5, True, "X"),
    (["K", "R"], [1, 1], 0.5, 0.5, True, "K"),
    (["K", "K", "K", "R"], [1] * 4, 0.6, 0.5, True, "K"),
    (["K", "K", "K", "R"], [1] * 4, 1.0, 0.5, True, "X"),
    (["-", "B", "B", "C"], [1] * 4, 0.6, 0.5, True, "B"),
    (["A", "A", "-", "-"], [1] * 4, 0.6, 0.5, True, "A"),
    (["AK", "AK", "-K"], [1] * 3, 0.6, 0.0, True, "-K"),
    (["AK", "AK", "-K"], [1] * 3, 0.6, 1.0, True, "AK"),
    (["K", "K", "K", "R", "R", "W"], [1] * 6, 0.6, 0.5, False, "X"),
    (["K", "K", "K", "R", "R", "W"], [1] * 6, 0.0, 0.5, False, "K"),
    (["A", "B"], [1, 1], 0.0, 0.5, True, "A"),
    (["--A", "--A", "BCA"], [1] * 3, 0.6, 1.0, True, "BCA"),
    (["-", "-"], [1, 1], 0.6, 1.0, True, "-"),
]


def _cells(spark, msas):
    """One family a case; equal rows keep apart by their number."""
    rows = [(f"c{i}", "x", f"{k}", float(w), p, r) for i, (seqs, ws) in enumerate(msas) for k, (s, w) in enumerate(zip(seqs, ws, strict=True)) for p, r in enumerate(s)]
    return spark.createDataFrame(rows, "clusterId string, chain string, seq string, weight double, pos int, residue string")


def _reference(rows, weights, threshold, gap, keep):
    out = ""
    for col in zip(*rows, strict=True):
        tally = {}
        for r, w in zip(col, weights, strict=True):
            tally[r] = tally.get(r, 0) + w
        total, gaps = sum(tally.values()), tally.pop("-", 0)
        if gaps / total > gap or not tally:
            out += "-"
            continue
        best = max(sorted(tally), key=lambda r: tally[r])
        out += best if tally[best] / (total - gaps) >= threshold else "X"
    return out if keep else out.replace("-", "")


def test_consensus_cases(spark):
    for (t, g, keep) in {(c[2], c[3], c[4]) for c in MSA}:
        cases = [c for c in MSA if c[2:5] == (t, g, keep)]
        cols = profile.columns(profile.tally(_cells(spark, [c[:2] for c in cases])), g)
        got = {r.clusterId: r.consensus for r in profile.consensus(cols, t, keep).collect()}
        assert [got[f"c{i}"] for i in range(len(cases))] == [c[5] for c in cases]


def test_consensus_random(spark):
    rng = random.Random(3)
    msas = []
    for _ in range(120):
        n, m = rng.randint(2, 6), rng.randint(1, 6)
        msas.append((["".join(rng.choice("KRWAG-") for _ in range(m)) for _ in range(n)], [rng.randint(1, 20) for _ in range(n)]))
    tallied = profile.tally(_cells(spark, msas)).cache()
    for t, g in product((0.0, 0.5, 0.6, 1.0), (0.0, 0.5, 1.0)):
        got = {r.clusterId: r.consensus for r in profile.consensus(profile.columns(tallied, g), t, True).collect()}
        assert got == {f"c{i}": _reference(*msa, t, g, True) for i, msa in enumerate(msas)}


def test_distances(spark):
    msas = [(["K"] * 7 + ["R"] * 3, [1] * 10), (["K", "K", "K", "-"], [1] * 4), (["-KA", "-KA", "AKA"], [1] * 3)]
    cells = _cells(spark, msas)
    tallied = profile.tally(cells)
    cols = profile.columns(tallied)
    rows = [(f"c{i}", "x", str(k), row) for i, (seqs, _) in enumerate(msas) for k, row in enumerate(seqs)]
    laid = spark.createDataFrame(rows, "clusterId string, chain string, seq string, row string")
    d = {(r.clusterId, r.seq): round(r.d, 9) for r in profile.member_distances(laid, profile.families(cols)).collect()}
    assert d["c0", "0"] == 0.3 and d["c0", "9"] == 0.7 and d["c1", "0"] == 0.25 and d["c1", "3"] == 0.75
    assert {r.clusterId: r.l_cons for r in profile.consensus(cols).collect()}["c2"] == 2


def test_medoid_and_missing_chain(spark):
    members = spark.createDataFrame([("f", k) for k in "abcd"], "clusterId string, clonotypeKey string")
    values = spark.createDataFrame([("a", "KKK", "AA"), ("b", "KKR", "AA"), ("c", "WWW", "AA"), ("d", "KKK", None)], "clonotypeKey string, t0 string, t1 string")
    weights = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 1.0), ("d", 9.0)], "clonotypeKey string, weight double")
    rows = layout.chain_rows(members, values, ["t0", "t1"], weights)
    laid = layout.placed(layout.capped(layout.distinct_members(rows)), "stacked")
    lengths = profile.families(profile.columns(profile.tally(layout.cells_of_rows(laid))))
    parts = profile.distance_parts(rows, profile.member_distances(laid, lengths), lengths)
    # d is nearest but lacks a chain; of the others a is
    assert profile.medoids(parts, lengths, ["t0", "t1"]).first().medoid_key == "a"
    dist = {r.clonotypeKey: r.distanceToCentroid for r in profile.distance_to_centroid(parts).collect()}
    assert 0 <= dist["d"] < dist["b"] < dist["c"] <= 1
    capped = layout.placed(layout.capped(layout.distinct_members(rows), 1), "stacked")
    left_out = profile.distance_parts(rows, profile.member_distances(capped, lengths), lengths)
    assert {r.clonotypeKey: r.sum_d for r in left_out.collect()}["c"] >= 3.0


def test_trims(spark):
    df = spark.createDataFrame([("ABCDEF",), ("ABC",), ("",), (None,)], "s string")
    got = df.select(exprs.trim_key(F.col("s"), 1, 2).alias("k"), exprs.trim_report(F.col("s"), 1, 2).alias("r")).collect()
    assert [tuple(r) for r in got] == [("BCD", "BCD"), ("BC", ""), ("", ""), ("", "")]


def test_labels_and_scalars(spark):
    df = spark.createDataFrame([("YSVI",), ("",)], "s string")
    assert [r[0] for r in df.select(exprs.label_body(F.col("s"))).collect()] == ["EVYIK", None]
    one = spark.range(1).select(
        exprs.sanitize(F.lit("a*é_B")), exprs.cluster_label(F.lit("P-C-1")), exprs.percent(F.lit(0.35)), exprs.guarded_weight(F.lit(-2)),
        exprs.sample_fraction(F.lit(1), F.lit(0)), exprs.fraction(F.lit(1), F.lit(0)), exprs.residues(F.lit("-A-B")),
    ).first()
    assert list(one) == ["aXXXB", "CL-C-1", "35", 1.0, None, 0.0, 2]
    same = spark.createDataFrame([("a", "YSVI"), ("b", "YSVI"), ("c", None)], "clusterId string, s string")
    assert {r.clusterId: r.peptideLabel for r in rollup.peptide_labels(same, "s").collect()} == {"a": "PC-EVYIK", "b": "PC-EVYIK", "c": None}


def test_modal_share_and_alignment(spark):
    df = spark.createDataFrame([("A" * 9,)] * 9 + [("A" * 8,), ("",)], "s string")
    assert tuple(dedup.modal_share(df, "s").first()) == (10, 9, 0.9)
    assert tuple(dedup.modal_share(df.filter("s = ''"), "s").first()) == (0, 0, 0.0)
    assert [dedup.resolve_alignment("auto", True, s) for s in ([], [0.9], [0.89], [1, 0.9], [1, 0.89])] == ["gapped", "ungapped", "gapped", "ungapped", "gapped"]
    assert dedup.resolve_alignment("auto", False, [1.0]) == "gapped" and dedup.resolve_alignment("ungapped", False, []) == "ungapped"


@pytest.mark.parametrize("seqs, weights", [
    (["ACDEF", "ACDEG", "AGDEG"], [1, 1, 1]), (["ABCDEFGH", "CDEFGH", "ABCDEF", "BCDEFG"], [4, 3, 2, 1]),
    (["AAAABBBB", "BBBB", "AAAA"], [10, 1, 1]), (["KKWWKKWW", "WWKK", "KKWW"], [3, 2, 1]),
])
def test_ungapped_layout(seqs, weights):
    rows = layout.place_ungapped(seqs, weights)
    assert {len(r) for r in rows} == {max(map(len, seqs))}
    assert all(r.strip("-") == s for r, s in zip(rows, seqs, strict=True))
    gapped = layout.place_gapped(seqs, weights)
    assert len({len(r) for r in gapped}) == 1 and [r.replace("-", "") for r in gapped] == seqs


def _consensus(rows, weights):
    """Most frequent residue of each column that isn't mostly gaps."""
    out = ""
    for column in zip(*rows, strict=True):
        held = {}
        for c, w in zip(column, weights, strict=True):
            held[c] = held.get(c, 0.0) + w
        if held.pop("-", 0.0) / sum(weights) <= 0.5:
            out += max(held, key=lambda c: (held[c], -ord(c)))
    return out


def _library(rng, length, n, rate, deletions):
    """A parent, and distinct members with their numbers: replacements at a rate, and one deletion in a share of them."""
    parent, made = "".join(rng.choices(AMINO_ACIDS, k=length)), {}
    for _ in range(n):
        member = [rng.choice(AMINO_ACIDS) if rng.random() < rate else c for c in parent]
        if rng.random() < deletions:
            del member[rng.randrange(length)]
        made["".join(member)] = made.get("".join(member), 0.0) + 1
    order = sorted(made, key=lambda s: (-made[s], s))
    return parent, order, [made[s] for s in order]


#: Mean edits from centroid to parent with gaps, by the share of members with a deletion; mean, 90th percentile and most
#: columns beyond the length (length, members); least agreement of both layouts. Fixed values.
GAPPED_ERROR = {0.0: 0.27, 0.12: 0.29, 0.25: 0.36, 0.38: 0.47, 0.5: 0.46}
EXCESS_WIDTH = {(15, 8): (0.16, 1, 3), (15, 128): (2.68, 6, 8), (9, 128): (3.32, 9, 11)}
AGREEMENT = 0.93


def test_gapped_layout_meets_its_calibrations():
    for deletions, most in GAPPED_ERROR.items():
        rng, found = random.Random(1), []
        for _ in range(120):
            parent, seqs, weights = _library(rng, 15, 4, 0.15, deletions)
            found.append(_edits(_consensus(layout.place_gapped(seqs, weights), weights), parent))
        assert sum(found) / len(found) <= most, deletions
    for (length, n), (mean, high, most) in EXCESS_WIDTH.items():
        rng = random.Random(2)
        excess = sorted(len(layout.place_gapped(*_library(rng, length, n, 0.3, 0)[1:])[0]) - length for _ in range(150 if n < 100 else 20))
        assert sum(excess) / len(excess) <= mean and excess[int(0.9 * len(excess))] <= high and excess[-1] <= most
    for n in (4, 16, 128):
        rng, same = random.Random(3), 0
        for _ in range(30):
            _, seqs, weights = _library(rng, 15, n, 0.15, 0)
            same += _consensus(layout.place_gapped(seqs, weights), weights) == _consensus(layout.place_ungapped(seqs, weights), weights)
        assert same >= AGREEMENT * 30


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def test_layout_offsets(spark):
    assert layout.place_ungapped(["CASSLGQGAETQYFG", "GQGAETQYFG"], [2, 1])[1] == "-----GQGAETQYFG"
    assert layout.place_gapped(["ACDEF", "ACDEG", "ACEF"], [3, 2, 1]) == ["ACDEF", "ACDEG", "AC-EF"]
    rows = [("f", "x", "ABCD", 2.0), ("f", "x", "BCD", 1.0), ("g", "x", "AB", 1.0), ("g", "x", "AC", 1.0)]
    members = layout.capped(spark.createDataFrame(rows, "clusterId string, chain string, seq string, weight double"))
    got = layout.cells_of_rows(layout.placed(members, "ungapped")).groupBy("clusterId", "seq").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "residue"))), lambda x: x["residue"]), "").alias("row"))
    assert {(r.clusterId, r.seq): r.row for r in got.collect()} == {("f", "ABCD"): "ABCD", ("f", "BCD"): "-BCD", ("g", "AB"): "AB", ("g", "AC"): "AC"}


def _lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("identity", [0.9, 0.8, 0.6])
def test_similar_pairs_lose_nothing(spark, identity):
    rng = random.Random(int(identity * 10))
    seqs = sorted({"".join(rng.choice("AB") for _ in range(rng.randint(1, 12))) for _ in range(160)})
    df = spark.createDataFrame([(f"k{i:03d}", s) for i, s in enumerate(seqs)], "key string, seq string")
    want = {(f"k{i:03d}", f"k{j:03d}") for i, a in enumerate(seqs) for j, b in enumerate(seqs) if i < j and _lev(a, b) / max(len(a), len(b)) <= 1.0 - identity}
    assert {(r.a, r.b) for r in candidates.similar_pairs(df, identity).collect()} == want


def test_common_halves_make_no_candidates(spark):
    """Of words with a common half few are within an edit: what is shuffled grows with the words, not with their square."""
    rng = random.Random(5)
    seqs = sorted({"ofthedelos" + "".join(rng.choice("abcdefgh") for _ in range(rng.randint(5, 6))) for _ in range(2500)})
    seqs += [s[:7] + s[8:] for s in seqs[::100]] + [s[:6] + "z" + s[7:] for s in seqs[::90]] + ["abc", "abc", "a" * 25, "a" * 23 + "b", "aaa" + "b" * 22, ""]
    df = spark.createDataFrame([(f"k{i:04d}", s) for i, s in enumerate(seqs)], "key string, seq string")
    con = duckdb.connect()
    con.sql("CREATE TABLE t (key VARCHAR, seq VARCHAR)")
    con.executemany("INSERT INTO t VALUES (?, ?)", [(f"k{i:04d}", s) for i, s in enumerate(seqs)])
    want = con.sql("SELECT x.key, y.key, levenshtein(x.seq, y.seq) AS d FROM t x JOIN t y ON x.key < y.key AND x.seq <> '' AND y.seq <> '' WHERE d / greatest(length(x.seq), length(y.seq)) <= 1 - 0.9::DOUBLE")
    assert {tuple(r) for r in candidates.similar_pairs(df, 0.9).collect()} == set(want.fetchall())
    assert (n := shuffled_rows(spark, candidates.similar_pairs(df, 0.9))) < 60 * len(seqs), n


def test_float_radius(spark):
    """Two edits over ten letters are beyond 1.0 - 0.8, as doubles go."""
    df = spark.createDataFrame([("a", "AAAAAAAAAA"), ("b", "AAAAAAAABB"), ("c", "AAAAAAAAAB")], "key string, seq string")
    assert {(r.a, r.b) for r in candidates.similar_pairs(df, 0.8).collect()} == {("a", "c"), ("b", "c")}


def test_clusterings(spark):
    rng = random.Random(5)
    n = 60
    pairs = sorted({tuple(sorted(rng.sample(range(n), 2))) for _ in range(50)})
    nodes = spark.createDataFrame([(f"k{i:02d}",) for i in range(n)], "key string")
    edges = spark.createDataFrame([(f"k{a:02d}", f"k{b:02d}") for a, b in pairs], "a string, b string")
    root = list(range(n))
    for _ in range(n):
        for a, b in pairs:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.clonotypeKey: r.clusterId for r in cluster.connected_components(nodes, edges).collect()}
    assert got == {f"k{i:02d}": f"k{root[i]:02d}" for i in range(n)}
    near = {frozenset(p) for p in pairs}
    for made in (cluster.set_cover(nodes, edges), cluster.one_hop(nodes, edges)):
        rows = made.collect()
        assert sorted(r.clonotypeKey for r in rows) == [f"k{i:02d}" for i in range(n)]
        for r in rows:
            a, b = int(r.clusterId[1:]), int(r.clonotypeKey[1:])
            assert a == b or frozenset((a, b)) in near
        heads = {r.clusterId for r in rows}
        assert heads <= {r.clonotypeKey for r in rows if r.clusterId == r.clonotypeKey}
    # greedy set cover, one centre after the other
    hashes = {int(r.key[1:]): r.h for r in nodes.select("key", F.xxhash64("key").alias("h")).collect()}
    level = lambda m: math.floor(math.log2(m) * cluster.LEVELS) if m else -1
    free, neighbours, want = set(range(n)), {i: {x for p in near if i in p for x in p if x != i} for i in range(n)}, {}
    while free:
        c = min(free, key=lambda i: (-level(len(neighbours[i] & free)), hashes[i]))
        for x in (neighbours[c] & free) | {c}:
            want[f"k{x:02d}"] = f"k{c:02d}"
        free -= neighbours[c] | {c}
    assert {r.clonotypeKey: r.clusterId for r in cluster.set_cover(nodes, edges).collect()} == want


#: Sequences of the reassignment cases. Fixed values.
BASE, A1, A2, FAR2, FAR = "CASSLGETQYFW", "CASSLAETQYFW", "CDSSLGETQYFW", "CASSLAETQKKW", "KKKKKKKKKKKK"


@pytest.mark.parametrize("buckets, singles, want", [
    ([("R", BASE, 2)], {"s": A1}, {"s": "R"}),
    ([("R", BASE, 2)], {"s": FAR}, {"s": "s"}),
    ([("R", BASE, 2), ("Q", FAR2, 10)], {"s": A1}, {"s": "R"}),
    ([("SMALL", A1, 2), ("BIG", A2, 5)], {"s": BASE}, {"s": "BIG"}),
    ([("RB", A2, 2), ("RA", A1, 2)], {"s": BASE}, {"s": "RA"}),
    ([("R", BASE, 3)], {"s": A1, "t": FAR}, {"s": "R", "t": "t"}),
    ([("R", BASE, 2)], {}, {}),
    ([], {"s": BASE, "t": A1}, {"s": "s", "t": "t"}),
])
def test_reassign(spark, buckets, singles, want):
    clusters = [(rep, rep if k == 0 else f"{rep}-{k}") for rep, _, n in buckets for k in range(n)] + [(s, s) for s in singles]
    seqs = [(k, seq) for rep, seq, n in buckets for k in [rep, *[f"{rep}-{j}" for j in range(1, n)]]] + list(singles.items())
    out = reassign.reassign_singletons(
        spark.createDataFrame(clusters, "clusterId string, clonotypeKey string"), spark.createDataFrame(seqs, "clonotypeKey string, trimmed_fullSequence string"), 0.8
    ).collect()
    assert len(out) == len(clusters)
    got = {r.clonotypeKey: r.clusterId for r in out}
    assert {s: got[s] for s in singles} == want and all(got[k] == c for c, k in clusters if k not in singles)
