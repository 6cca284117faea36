"""Alignment scores of candidate pairs under a substitution matrix.

Matrices are inputs: a file in the usual text form (a header of letters, then a row of scores for each letter) is read
by read_matrix(); grouped_matrix() makes one from groups of like residues. A matrix is an alphabet squared of numbers, so
it goes to the tasks as an array.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Residues that replace each other easily: aliphatic, aromatic, basic, acidic and amides, small, and the rest alone.
GROUPS = ("ILMV", "FWY", "HKR", "DENQ", "AGPST", "C")
AMINO_ACIDS = "ACDEFGHIKLMNPQRSTVWY"
#: Bytes of a matrix file that are read at most; real ones have a few thousand.
MOST_BYTES = 1 << 20
#: Score of a residue that the matrix doesn't know, and of what fills up the shorter sequences of a block.
UNKNOWN, NOTHING = -1.0, -1e6
#: Cells of a row of score tables that are worked on at once.
CELLS = 1 << 20


def _empty() -> np.ndarray:
    matrix = np.full((128, 128), UNKNOWN)
    matrix[0, :] = matrix[:, 0] = NOTHING
    return matrix


def read_matrix(spark: SparkSession, path: str) -> np.ndarray:
    """A substitution matrix from a text file; lines that begin with # are comments."""
    lines, held = [], 0
    for row in spark.read.text(path).toLocalIterator():
        held += len(row["value"])
        if held > MOST_BYTES:
            raise ValueError(f"{path} is no substitution matrix: it is longer than {MOST_BYTES} bytes")
        lines.append(row["value"])
    rows = [x.split() for x in lines if x.strip() and not x.startswith("#")]
    matrix = _empty()
    for row in rows[1:]:
        for letter, score in zip(rows[0], row[1:], strict=False):
            if row[0].isascii() and letter.isascii():
                matrix[ord(row[0]), ord(letter)] = float(score)
    return matrix


def named_matrix(spark: SparkSession, name: str, folder: str) -> np.ndarray:
    """The matrix of this name (such as blosum62) from a folder of files: `name` itself, in either case, or with .out, .txt or .mat.

    FileNotFoundError if there is none, ValueError if it doesn't score all twenty amino acids, and alike both ways.
    """
    where = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = where.getFileSystem(spark._jsc.hadoopConfiguration())
    tried = [n + ending for n in (name, name.upper(), name.lower()) for ending in ("", ".out", ".txt", ".mat")]
    for file in tried:
        path = spark._jvm.org.apache.hadoop.fs.Path(where, file)
        if system.exists(path):
            matrix = read_matrix(spark, path.toString())
            block = matrix[np.ix_(*[[ord(x) for x in AMINO_ACIDS]] * 2)]
            if (np.diag(block) <= 0).any() or (block != block.T).any():
                raise ValueError(f"{path} is no matrix of the amino acids")
            return matrix
    raise FileNotFoundError(f"{folder} has no matrix {name} (looked for {', '.join(tried)})")


def grouped_matrix(same: float = 5.0, like: float = 1.0, other: float = -2.0, groups: tuple[str, ...] = GROUPS) -> np.ndarray:
    """Scores by rule: equal residues, residues of one group, all others; capitals and small letters alike."""
    matrix = _empty()
    of = {r: k for k, g in enumerate(groups) for r in g}
    for a in of:
        for b in of:
            score = same if a == b else like if of[a] == of[b] else other
            for x in (a, a.lower()):
                for y in (b, b.lower()):
                    matrix[ord(x), ord(y)] = score
    return matrix


def level_matrix(level: int) -> np.ndarray:
    """A matrix by rule, graded by level (40 .. 90): the higher, the more a replacement costs. It is none of the published ones."""
    return grouped_matrix(5.0, 2.5 - level / 40, -1.0 - level / 40)


def local_scores(a: list[str], b: list[str], matrix: np.ndarray, gap_open: float = 11.0, gap_extend: float = 1.0) -> np.ndarray:
    """Score of the best local alignment with affine gaps of each pair; a gap of n costs gap_open + (n - 1) gap_extend.

    All pairs of a block go through their score tables together, a row at a time; gaps along a row are a running maximum.
    """
    x, y = coded(a), coded(b)
    out = np.zeros(len(a))
    ramp = gap_extend * np.arange(y.shape[1] + 1)
    above, up = np.zeros((len(a), y.shape[1] + 1)), np.full((len(a), y.shape[1] + 1), NOTHING)
    for i in range(x.shape[1]):
        up = np.maximum(above - gap_open, up - gap_extend)
        row = np.maximum(up, 0.0)
        row[:, 1:] = np.maximum(row[:, 1:], above[:, :-1] + matrix[x[:, i, None], y])
        carried = np.maximum.accumulate(row + ramp, axis=1) - ramp
        row[:, 1:] = np.maximum(row[:, 1:], carried[:, :-1] - gap_open)
        row[:, 0] = 0.0
        np.maximum(out, row.max(axis=1), out=out)
        above = row
    return out


def coded(seqs: list[str]) -> np.ndarray:
    """Sequences as rows of ASCII codes, filled up with 0; other characters are residues that no matrix knows."""
    width = max(map(len, seqs), default=0)
    return np.frombuffer("".join(s.ljust(width, "\0") for s in seqs).encode("ascii", "replace"), dtype=np.uint8).reshape(len(seqs), width)


def own_scores(seqs: list[str], matrix: np.ndarray) -> np.ndarray:
    """Score of each sequence against itself: of residues that score at all."""
    return np.maximum(np.diag(matrix), 0.0)[coded(seqs)].sum(axis=1)


def score_bounds(x: np.ndarray, y: np.ndarray, matrix: np.ndarray) -> np.ndarray:
    """What no alignment of coded sequences x and y scores more than, by their residues alone.

    A residue of x is aligned once: to its like as often as y has it, else to another residue or to none.
    """
    other = matrix.copy()
    np.fill_diagonal(other, 0.0)
    other = np.maximum(other[1:].max(axis=1, initial=0.0), 0.0)
    like = np.maximum(np.diag(matrix)[1:], other)
    used, rows = np.unique(np.append(x, y)), np.arange(len(x))[:, None]
    used = used[used > 0]
    place = np.zeros(128, dtype=np.int64)
    place[used] = 1 + np.arange(len(used))
    n = len(used) + 1
    many, there = (np.bincount((rows * n + place[z]).ravel(), minlength=len(x) * n).reshape(len(x), n)[:, 1:] for z in (x, y))
    both = np.minimum(many, there)
    return both @ like[used - 1] + (many - both) @ other[used - 1]


def scored_pairs(pairs: DataFrame, matrix: np.ndarray, gap_open: float = 11.0, gap_extend: float = 1.0, least: float = 0.0) -> DataFrame:
    """a, b, score, similarity (the score's share of the lesser score of either against itself) of pairs (a, b, seq_a, seq_b).

    Only pairs with a similarity of `least` or more; those whose residues rule that out aren't aligned.
    """

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = ([s or "" for s in batch.column(c).to_pylist()] for c in ("seq_a", "seq_b"))
            widths = np.array([max(len(s), len(t)) for s, t in zip(x, y, strict=True)])
            order, found, most = np.argsort(widths, kind="stable"), np.zeros(len(x)), np.zeros(len(x))
            while len(order):  # the longest first, so many that a row of their tables has CELLS cells
                n = max(1, CELLS // (int(widths[order[-1]]) + 1))
                part, order = order[-n:], order[:-n]
                s, t = [x[k] for k in part], [y[k] for k in part]
                most[part] = np.minimum(own_scores(s, matrix), own_scores(t, matrix))
                if least > 0:
                    open_ = np.flatnonzero(score_bounds(coded(s), coded(t), matrix) >= least * most[part] - 1e-6)
                    part, s, t = part[open_], [s[k] for k in open_], [t[k] for k in open_]
                if len(part):
                    found[part] = local_scores(s, t, matrix, gap_open, gap_extend)
            share = np.divide(found, most, out=np.zeros(len(x)), where=most > 0)
            kept = pa.array(share >= least)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found), pa.array(share)], names=["a", "b", "score", "similarity"]).filter(kept)

    kinds = dict(pairs.dtypes)
    return pairs.select("a", "b", "seq_a", "seq_b").mapInArrow(score, f"a {kinds['a']}, b {kinds['b']}, score double, similarity double")
