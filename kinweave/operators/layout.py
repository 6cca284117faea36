"""Members of a family laid out in columns: as cells (clusterId, chain, seq, pos, residue, weight)."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.exprs import blank, sanitize

#: Distinct members aligned per family and chain; the heaviest ones. Fixed value.
MAX_MEMBERS = 1000
_ROWS = "clusterId string, chain string, seq string, weight double, row string"


def member_rows(members: DataFrame, chains: list[str]) -> DataFrame:
    """One row a member and chain it has: clusterId, clonotypeKey, chain, raw, seq (sanitised), weight.

    members: clusterId, clonotypeKey, weight and the chains' columns.
    """
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("chain"), blank(F.col(c)).alias("raw")) for c in chains]))
    long = members.select("clusterId", "clonotypeKey", F.coalesce("weight", F.lit(1.0)).alias("weight"), each.alias("x")).filter("x.raw <> ''")
    return long.select("clusterId", "clonotypeKey", "x.chain", "x.raw", sanitize(F.col("x.raw")).alias("seq"), "weight")


def chain_rows(clusters: DataFrame, values: DataFrame, chains: list[str], weights: DataFrame) -> DataFrame:
    """member_rows() of clusters; values: clonotypeKey and the chains' columns, one row a key."""
    long = clusters.select("clusterId", "clonotypeKey").join(values, "clonotypeKey", "left").join(weights, "clonotypeKey", "left")
    return member_rows(long, chains)


def distinct_members(rows: DataFrame) -> DataFrame:
    """clusterId, chain, seq, weight: weights summed for each distinct sanitised sequence."""
    return rows.groupBy("clusterId", "chain", "seq").agg(F.sum("weight").alias("weight"))


def capped(members: DataFrame, most: int = MAX_MEMBERS) -> DataFrame:
    """With rn, the order (-weight, seq); at most `most` members a family and chain.

    Spark applies the limit before the shuffle as well, so of a huge family each task sends `most` rows at most.
    """
    order = W.partitionBy("clusterId", "chain").orderBy(F.desc("weight"), "seq")
    return members.withColumn("rn", F.row_number().over(order)).filter(F.col("rn") <= most)


def dropped(members: DataFrame, most: int = MAX_MEMBERS) -> DataFrame:
    """clusterId, chain, n_members, n_dropped: families of which capped() leaves members out."""
    counted = members.groupBy("clusterId", "chain").agg(F.count(F.lit(1)).alias("n_members"))
    return counted.filter(F.col("n_members") > most).withColumn("n_dropped", F.col("n_members") - most)


def cells_of_rows(laid: DataFrame) -> DataFrame:
    return laid.select("clusterId", "chain", "seq", "weight", F.posexplode(F.split("row", "")).alias("pos", "residue"))


def _codes(seq: str) -> np.ndarray:
    return np.frombuffer(seq.encode("ascii"), dtype=np.uint8)


_GAP = ord("-")


def place_ungapped(seqs: list[str], weights: list[float]) -> list[str]:
    """Rows without inner gaps, as wide as the longest sequence.

    One after the other, each sequence slides along the weights that the rows before it have left in the columns; of all
    its places, scored at once, the first of the best is its own.
    """
    coded = [_codes(s) for s in seqs]
    width = max(map(len, coded))
    held = np.zeros((width, 128))
    laid = np.full((len(coded), width), _GAP, dtype=np.uint8)
    for row, code, weight in zip(laid, coded, weights, strict=True):
        inside = np.arange(len(code))
        shifts = np.arange(width - len(code) + 1)
        at = int(held[shifts[:, None] + inside, code].sum(axis=1).argmax()) if len(shifts) > 1 else 0
        held[at + inside, code] += weight
        row[at + inside] = code
    return [row.tobytes().decode() for row in laid]


def place_gapped(seqs: list[str], weights: list[float], match: float = 2.0, mismatch: float = -1.0, gap: float = -3.0) -> list[str]:
    """Progressive alignment in the given order, each sequence to the weighted profile of those before it.

    Scores are averages over the profile's weight; ties prefer the diagonal, then a gap in the sequence. Members of equal
    length without a better gapped placement are simply stacked. The profile is kept from one sequence to the next, and
    a row of the score table is worked out at once: what a run of gaps in the profile carries to the right is a running
    maximum.
    """
    first = _codes(seqs[0])
    rows = first[None, :]
    held = np.zeros((len(first), 128))
    held[np.arange(len(first)), first] = weights[0]
    for seq, weight in zip(seqs[1:], weights[1:], strict=True):
        code = _codes(seq)
        total = held[:1].sum() if len(held) else 1.0
        path = _path(held[:, code] / total, 1.0 - held[:, _GAP] / total, match, mismatch, gap)
        column, inserted = np.cumsum(path != _LEFT) - 1, path == _LEFT
        wider = np.zeros((len(path), 128))
        wider[~inserted] = held[column[~inserted]]
        wider[inserted, _GAP] = total
        fresh = np.full(len(path), _GAP, dtype=np.uint8)
        fresh[path != _UP] = code
        wider[np.arange(len(path)), fresh] += weight
        if inserted.any():
            spread = np.full((len(rows), len(path)), _GAP, dtype=np.uint8)
            spread[:, ~inserted] = rows
            rows = spread
        rows, held = np.vstack([rows, fresh]), wider
    return [row.tobytes().decode() for row in rows]


_DIAGONAL, _UP, _LEFT = 0, 1, 2


def _path(same: np.ndarray, filled: np.ndarray, match: float, mismatch: float, gap: float) -> np.ndarray:
    """Steps of the best global alignment; same: share of each residue of the sequence in each column, filled: of non-gaps."""
    n, m = same.shape
    pair = match * same + mismatch * (filled[:, None] - same)
    run = gap * np.arange(m + 1)
    before, moves = run, np.full((n + 1, m + 1), _LEFT, dtype=np.uint8)
    for i in range(n):
        up = before + gap * filled[i]
        diagonal = np.concatenate(([-np.inf], before[:-1] + pair[i]))
        best = np.maximum.accumulate(np.maximum(up, diagonal) - run) + run
        moves[i + 1] = np.where(diagonal >= best - 1e-9, _DIAGONAL, np.where(up >= best - 1e-9, _UP, _LEFT))
        before = best
    i, j, back = n, m, []
    while i or j:
        step = int(moves[i, j])
        back.append(step)
        i, j = i - (step != _LEFT), j - (step != _UP)
    return np.array(back[::-1], dtype=np.uint8)


def laid_out(members: DataFrame, model: str) -> DataFrame:
    """clusterId, chain, seq, weight, row: members placed by `ungapped` or `gapped`, in the order of rn.

    Groups are bounded by the cap, so one family and chain is at most MAX_MEMBERS short sequences. Partitions are read
    sorted, group after group, which costs much less than a call for each of many small groups.
    """
    place = place_ungapped if model == "ungapped" else place_gapped
    names = ["clusterId", "chain", "seq", "weight"]

    def group_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*(b.column(c).to_pylist() for c in names), strict=True))
        out: list[tuple] = []
        for _, group in groupby(rows, key=lambda r: r[:2]):
            held = list(group)
            seqs, weights = [r[2] for r in held], [r[3] for r in held]
            equal = model == "ungapped" and len(set(map(len, seqs))) == 1
            out += [(*r, row) for r, row in zip(held, seqs if equal else place(seqs, weights), strict=True)]
            if len(out) >= 10_000:
                yield _batch(out)
                out = []
        if out:
            yield _batch(out)

    dealt = members.repartition("clusterId", "chain").sortWithinPartitions("clusterId", "chain", "rn")
    return dealt.select(*names).mapInArrow(group_rows, _ROWS)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], names=["clusterId", "chain", "seq", "weight", "row"])


def placed(members: DataFrame, model: str) -> DataFrame:
    """clusterId, chain, seq, weight, row of capped members; `stacked`: all members of a family have one length.

    Families of one length need no placing in the ungapped model, nor do single members; they skip the Python path.
    """
    if model == "stacked":
        return members.select("clusterId", "chain", "seq", "weight", F.col("seq").alias("row"))
    group = W.partitionBy("clusterId", "chain")
    sized = members.withColumns({"lo": F.min(F.length("seq")).over(group), "hi": F.max(F.length("seq")).over(group), "n": F.count(F.lit(1)).over(group)})
    simple = (F.col("lo") == F.col("hi")) if model == "ungapped" else (F.col("n") == 1)
    return placed(sized.filter(simple), "stacked").unionByName(laid_out(sized.filter(~simple), model))
