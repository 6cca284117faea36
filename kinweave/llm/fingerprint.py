"""Document fingerprints by invertible Bloom lookup sketches of paragraph digests.

A text is cut at line ends and, inside a line, behind sentence ends into short paragraphs; each gets a 64-bit digest,
the k-th repeat of a paragraph one of its own. Every digest goes to three cells (one in each third of the sketch); a
cell holds a count, the digests xored and their checks (32 bits of another hash) xored. Sketches of two versions subtract
cell by cell, and peeling cells that hold a single digest recovers the digests that only one version has. What is peeled
has to agree with the sides' numbers of digests and with a sum of their 64-bit hashes. If it doesn't, or if peeling gets
stuck, the difference is larger than the sketch can tell, and both sketches are built again larger.

likeness = common / (common + digests of either alone), 1 for two texts without paragraphs.

Nulls: a null text counts as empty; documents with null ids come last in the descending order. Rows of equal doc_id
are ordered by a hash of their texts. Long texts are taken whole, one at a time with its edited version. The only document of a table is its own next one. An empty table gives an empty
result. Columns beside doc_id and text are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: Cells of the stored fingerprint (they come in thirds), and how much larger each retry is up to a size and beyond it.
CELLS, LARGER, LARGE, LARGER_THEN = 24, 8, 1 << 17, 2
#: A sketch isn't tried where each cell would have to tell more digests than this; peeling stops after so many rounds (of a third each).
FULLEST, ROUNDS = 0.8, 600
#: Cells of the sketches, and digests of the documents, that are worked on together.
CELLS_AT_ONCE, DIGESTS_AT_ONCE = 1 << 17, 1 << 15
_CELL = np.dtype([("count", "<i4"), ("key", "<u8"), ("check", "<u4")])
_ENDS = re.compile(r"(?<=[.!?])[ \t]+|[\r\n]+")
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93), np.uint64(0xC2B2AE3D27D4EB4F)
_HALF, _LOW = np.uint64(32), np.uint64(0xFFFFFFFF)


def digests(text: str) -> np.ndarray:
    """The distinct digests of a text's paragraphs, as uint64."""
    seen: dict[int, int] = {}
    out = []
    for part in _ENDS.split(text):
        if part:
            h = xxhash.xxh3_64_intdigest(part)
            k = seen[h] = seen.get(h, 0) + 1
            out.append(h if k == 1 else xxhash.xxh3_64_intdigest(part, seed=k))
    return np.unique(np.array(out, dtype=np.uint64))


def _mix(keys: np.ndarray) -> np.ndarray:
    z = keys * _M1
    z = (z ^ (z >> np.uint64(32))) * _M2
    return z ^ (z >> np.uint64(29))


def hashes(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each digest: three places of 32 bits and a check of 32 bits."""
    first = _mix(keys)
    return first, _mix(first + _M3)


class Side(NamedTuple):
    """The digests of one text of each pair, one after the other: their pair, their hashes, and sizes by pair."""

    keys: np.ndarray
    pair: np.ndarray
    first: np.ndarray
    second: np.ndarray
    sizes: np.ndarray
    totals: np.ndarray


def side(texts: list[np.ndarray]) -> Side:
    sizes = np.array([len(k) for k in texts], dtype=np.int64)
    keys = np.concatenate([np.empty(0, np.uint64), *texts])
    first, second = hashes(keys)
    pair = np.repeat(np.arange(len(texts)), sizes)
    return Side(keys, pair, first, second, sizes, _sums(first, sizes))


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums (modulo 2^64) of consecutive runs of these sizes."""
    ends = np.cumsum(sizes)
    running = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])
    return running[ends] - running[ends - sizes]


def _places(pair: np.ndarray, first: np.ndarray, second: np.ndarray, cells: int) -> np.ndarray:
    """The three cells of each digest, one in each third of its pair's cells: all first ones, all second ones, all third ones."""
    third, begin = np.uint64(cells // 3), (pair * cells).astype(np.uint64)
    at = np.concatenate(
        (((first >> _HALF) * third >> _HALF) + begin, ((first & _LOW) * third >> _HALF) + (third + begin), ((second >> _HALF) * third >> _HALF) + (third + third + begin))
    )
    return at.view(np.int64)


def _thrice(x: np.ndarray) -> np.ndarray:
    return np.concatenate((x, x, x))


class Sketch(NamedTuple):
    """The cells of all pairs: how many digests (of the first sides less those of the second), the digests xored, their checks xored."""

    count: np.ndarray
    key: np.ndarray
    check: np.ndarray


def sketch(of: Side, cells: int = CELLS) -> Sketch:
    n, at = len(of.sizes) * cells, _places(of.pair, of.first, of.second, cells)
    key, check = np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=np.uint64)
    np.bitwise_xor.at(key, at, _thrice(of.keys))
    np.bitwise_xor.at(check, at, _thrice(of.second & _LOW))
    return Sketch(np.bincount(at, minlength=n), key, check)


def subtract(a: Sketch, b: Sketch) -> Sketch:
    return Sketch(a.count - b.count, a.key ^ b.key, a.check ^ b.check)


def peel(diff: Sketch, cells: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What can be peeled from the pairs' cells: digests, their pairs, whose they are (1 or -1); and which pairs are left with nothing.

    A cell of count 1 or -1 is peeled if its check is that of its key and the key belongs there. A round takes one third
    of all pairs' cells, where a digest of a pair stands once. Peeling ends when all three thirds give nothing, or after
    ROUNDS, so it ends whatever it is given.
    """
    count, key, check = (x.copy() for x in diff)
    pairs, third = len(count) // cells, cells // 3
    view, got, idle, t = count.reshape(pairs, 3, third), [], 0, 0
    for _ in range(ROUNDS):
        p, c = np.nonzero(np.abs(view[:, t]) == 1)
        at = p * cells + t * third + c
        keys = key[at]
        first, second = hashes(keys)
        good = np.flatnonzero((second & _LOW) == check[at])
        if len(good):
            at, p, keys, first, second = at[good], p[good], keys[good], first[good], second[good]
            places = _places(p, first, second, cells)
            fits = np.flatnonzero(places[t * len(at) : (t + 1) * len(at)] == at)
            if len(fits) < len(at):
                at, p, keys, first, second = at[fits], p[fits], keys[fits], first[fits], second[fits]
                places = _places(p, first, second, cells)
            good = fits
        if len(good):
            sign = count[at]
            got.append((keys, p, sign))
            np.subtract.at(count, places, _thrice(sign))
            np.bitwise_xor.at(key, places, _thrice(keys))
            np.bitwise_xor.at(check, places, _thrice(second & _LOW))
            idle = 0
        else:
            idle += 1
            if idle == 3:
                break
        t = (t + 1) % 3
    left = (count != 0) | (key != 0) | (check != 0)
    keys, pair, sign = (np.concatenate([np.empty(0, k), *x]) for k, x in zip((np.uint64, np.int64, np.int64), zip(*got, strict=True) if got else ([], [], []), strict=True))
    return keys, pair, sign, ~left.reshape(pairs, cells).any(axis=1)


def differences(a: list[np.ndarray], b: list[np.ndarray], cells: int = CELLS) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each pair of sets of digests those of a alone and of b alone, by sketches alone; sketches grow until they can be peeled.

    A result has to explain the pair: its numbers of digests, its sums of hashes, no digest twice or on both sides. Sizes
    that can't even hold what the numbers of digests differ by are left out.
    """
    out: list = [None] * len(a)
    waiting = np.arange(len(a))
    apart = np.array([abs(len(x) - len(y)) for x, y in zip(a, b, strict=True)], dtype=np.int64)
    while len(waiting):
        tried = waiting[FULLEST * cells >= apart[waiting]]
        for some in np.array_split(tried, max(1, len(tried) * cells // CELLS_AT_ONCE)):
            if not len(some):
                continue
            ours, theirs = side([a[k] for k in some]), side([b[k] for k in some])
            keys, pair, sign, empty = peel(subtract(sketch(ours, cells), sketch(theirs, cells)), cells)
            order = np.lexsort((keys, pair))
            keys, pair, sign = keys[order], pair[order], sign[order]
            ends = np.searchsorted(pair, np.arange(len(some) + 1))
            repeated = np.zeros(len(some), dtype=bool)
            repeated[pair[1:][(keys[1:] == keys[:-1]) & (pair[1:] == pair[:-1])]] = True
            hashed = hashes(keys)[0]
            sums = _sums(np.where(sign > 0, hashed, np.uint64(0) - hashed), np.diff(ends))
            n = np.bincount(pair, weights=sign, minlength=len(some)).astype(np.int64)
            right = empty & ~repeated & (sums == ours.totals - theirs.totals) & (n == ours.sizes - theirs.sizes)
            for k in np.flatnonzero(right):
                own, plus = keys[ends[k] : ends[k + 1]], sign[ends[k] : ends[k + 1]] > 0
                out[some[k]] = (own[plus], own[~plus])
        waiting = np.array([k for k in waiting if out[k] is None], dtype=np.int64)
        cells *= LARGER if cells < LARGE else LARGER_THEN
    return out


def likenesses(a: list[np.ndarray], b: list[np.ndarray]) -> list[float]:
    out = []
    for x, y, (ours, theirs) in zip(a, b, differences(a, b), strict=True):
        common, apart = len(x) - len(ours), len(ours) + len(theirs)
        if common < 0 or len(y) - len(theirs) != common:
            raise AssertionError("a difference that doesn't fit its sets")
        out.append(common / (common + apart) if common + apart else 1.0)
    return out


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return likenesses([a], [b])[0]


def serialize(texts: list[np.ndarray]) -> list[str]:
    """Number of digests, sum of their hashes, and the cells, as text."""
    of = side(texts)
    out = np.empty((len(texts), CELLS), dtype=_CELL)
    for name, values in zip(_CELL.names, sketch(of), strict=True):
        out[name] = values.reshape(-1, CELLS)
    return [f"{n}:{total:x}:" + base64.b64encode(cells.tobytes()).decode() for n, total, cells in zip(of.sizes.tolist(), of.totals.tolist(), out, strict=True)]


def edited(text: str, other: str) -> str:
    """The last half of the code points, rounded down, replaced by as many (or all) of the other text's first."""
    half = len(text) // 2
    return text[: len(text) - half] + other[:half]


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _rows(held: list[tuple]) -> pa.RecordBatch:
    ids, lengths, shas, own, changed, following = zip(*held, strict=True)
    own, changed, following = list(own), list(changed), list(following)
    columns = [
        pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()), pa.array(shas), pa.array(serialize(own)), pa.array(serialize(changed)),
        pa.array(likenesses(own, changed)), pa.array(likenesses(own, following)),
    ]
    return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SCHEMA.split(", ")])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by bucket and place; the last of each bucket only serves as the next of the one before it.

    Documents are compared together until they have DIGESTS_AT_ONCE.
    """
    before, held, n = None, [], 0
    for batch in batches:
        for doc_id, text, bucket, is_next in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "bucket", "is_next")), strict=True):
            keys = digests(text)
            if before is not None and before[3] == bucket:
                b_id, b_text, b_keys, _ = before
                changed = edited(b_text, text)
                held.append((b_id, len(b_text), hashlib.sha256(changed.encode()).hexdigest(), b_keys, digests(changed), keys))
                n += len(b_keys) + len(keys)
                if n >= DIGESTS_AT_ONCE:
                    yield _rows(held)
                    held, n = [], 0
            before = None if is_next else (doc_id, text, keys, bucket)
    if held:
        yield _rows(held)


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited version, and their likeness to each other and to the next text.

    Documents are dealt to buckets, ranges of doc_id whose bounds are quantiles, a few for each shuffle partition.
    The first document of each bucket is also sent to the bucket before it, whose last document it follows; texts are
    shuffled once. The bounds and these first documents' ids are as many as the buckets.
    """
    spark = docs.sparkSession
    lowest = -(1 << 63)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumns(
        {"place": F.coalesce("doc_id", F.lit(lowest)), "tie": F.xxhash64("text")}
    )
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    wanted = [k / (4 * partitions) for k in range(1, 4 * partitions)]
    bounds = np.array(sorted(set(rows.select("place").approxQuantile("place", wanted, 0.0005))), dtype=np.float64)

    @F.pandas_udf("int")
    def bucket_of(place):
        import pandas as pd

        return pd.Series(len(bounds) - np.searchsorted(bounds, place.to_numpy().astype(np.float64), side="right"))

    dealt = rows.withColumn("bucket", bucket_of("place"))
    first = F.max(F.struct("place", "tie")).alias("first")
    firsts = [(r["bucket"], r["first"]["place"], r["first"]["tie"]) for r in dealt.groupBy("bucket").agg(first).orderBy("bucket").collect()]
    if not firsts:
        return spark.createDataFrame([], SCHEMA)
    # each bucket's first document follows the bucket before; the first of all follows the last bucket
    names = [b for b, *_ in firsts]
    heads = spark.createDataFrame([(p, t, names[k - 1]) for k, (_, p, t) in enumerate(firsts)], "place long, tie long, to_bucket int")
    own = dealt.withColumn("is_next", F.lit(False))
    # of equal first rows one goes
    sent = dealt.join(F.broadcast(heads), ["place", "tie"]).dropDuplicates(["to_bucket"])
    sent = sent.select("doc_id", "text", "place", "tie", F.col("to_bucket").alias("bucket"), F.lit(True).alias("is_next"))
    # inside a bucket places descend; the row sent by the next bucket comes last
    both = own.unionByName(sent).repartition(partitions, "bucket").sortWithinPartitions("bucket", "is_next", F.desc("place"), F.desc("tie"))
    return both.select("doc_id", "text", "bucket", "is_next").mapInArrow(_compare, SCHEMA)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))
