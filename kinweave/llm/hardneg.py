"""Hard negatives by lists that the anchors of a cluster share.

Anchors are clustered by direction (spherical k-means, fitted on a bounded sample of them). For a cluster with centre c and
widest angle w between c and a member, no member a can have an inner product with a row x beyond

    |a| |x| cos(max(0, angle(x, c) - w))

so the rows are sorted by |x| cos(...) once for the cluster, and all its members walk that list from its head. A member is
done when the bound at its place falls below the least score that could still change its result; this certifies the result
as exact, whatever the clusters are like. Scores are sums of products of whole numbers and are worked out exactly.

Two walks: the first finds each anchor's `positives` best other rows of its label; the second finds, for each anchor and
positive, the `negatives` best rows of other labels whose score lies in the window low * s .. high * s of the positive's
score s. The window's lower end bounds the second walk from its begin.

On Spark: anchors are the queries. They are taken in blocks of ANCHOR_VALUES numbers, a broadcast of fixed size; for each
block every task walks its own part of all rows, list by list, keeps its thresholds from one list to the next, and hands on a
few rows for each anchor, which are merged by a window over (anchor) or (anchor, positive). No row is shuffled or paired with
another; the work is that of anchors x rows less what the bounds cut off, so it grows with the square of the table if anchors
are a fixed share of it.

Rows without a label or a vector, or with a component that is null or not finite, take no part. Vectors of unequal lengths
count as filled up with zeros. Scores must be exact in a double: components whose squares could add up to 2^53 or more are an
error. Ties: the lesser vec_id, null ids last. Repeated rows are rows of their own, anchors included; a row is never its own
positive, but an equal row may be. A row with a null id can be found and isn't an anchor of the query. Empty tables, and
tables without anchors, give no rows. Columns beside those named are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialize, table

POSITIVES, NEGATIVES = 5, 3
#: The window for negatives, in hundredths of the positive's score.
LOW, HIGH = 50, 95
#: Clusters at most, anchors for each of them, and numbers (rows x components) in the sample that they are fitted on.
CLUSTERS, PER_CLUSTER, SAMPLE_VALUES = 64, 32, 1 << 18
#: Numbers in a block of anchors, and in a list of rows.
ANCHOR_VALUES, LIST_VALUES = 1 << 21, 1 << 20
#: Rows that a walk takes at a time, from the first to the largest step; members that walk together.
FIRST_STEP, STEP, TOGETHER = 64, 1024, 2048
_LAST = np.iinfo(np.int64).max


def matrix(vectors: pa.ListArray, dims: int) -> np.ndarray:
    """Vectors as rows of doubles, filled up with zeros."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    if (lengths == dims).all():
        return flat.reshape(len(lengths), dims).astype(np.float64)
    out = np.zeros((len(lengths), dims))
    out[np.arange(dims) < lengths[:, None]] = flat
    return out


def _directions(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    norm = np.sqrt((x * x).sum(axis=1))
    return x / np.where(norm > 0, norm, 1)[:, None], norm


def _angles(directions: np.ndarray, norm: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Angles to the centres; a zero vector is at angle 0 of all."""
    angles = np.arccos(np.clip(directions @ centres.T, -1, 1))
    angles[norm == 0] = 0
    return angles


def fit_centres(sample: np.ndarray, clusters: int, rounds: int = 8) -> np.ndarray:
    """Spherical k-means: at most `clusters` unit vectors. Centres begin at evenly spaced rows of the sample."""
    directions = _directions(sample)[0]
    centres = directions[np.linspace(0, len(sample) - 1, min(clusters, len(sample))).astype(int)]
    for _ in range(rounds):
        nearest = (directions @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, directions)
        moved, size = _directions(sums)
        centres = np.where(size[:, None] > 0, moved, centres)
    return centres


class Best:
    """The k best (score, then least id) of each of n slots."""

    def __init__(self, n: int, k: int):
        self.k = k
        self.score = np.full((n, k), -np.inf)
        self.id, self.row = np.full((n, k), _LAST), np.full((n, k), _LAST)

    def add(self, slot: np.ndarray, score: np.ndarray, id_: np.ndarray, row: np.ndarray) -> None:
        touched = np.unique(slot)
        slot = np.concatenate([slot, np.repeat(touched, self.k)])
        score, id_, row = (np.concatenate([new, old[touched].ravel()]) for new, old in ((score, self.score), (id_, self.id), (row, self.row)))
        order = np.lexsort((row, id_, -score, slot))
        slot = slot[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        order, slot, rank = (x[rank < self.k] for x in (order, slot, rank))
        self.score[slot, rank], self.id[slot, rank], self.row[slot, rank] = score[order], id_[order], row[order]


class Anchors:
    """A block of anchors by cluster, as every task holds it. windows: per anchor the (low, high) scores of each of its positives."""

    def __init__(self, block: pa.Table, dims: int, centres: np.ndarray, windows: np.ndarray | None = None):
        vectors = block.column("v").combine_chunks()
        x = matrix(vectors, dims)
        directions, norm = _directions(x)
        angles = _angles(directions, norm, centres)
        cluster = angles.argmin(axis=1)
        order = np.argsort(cluster, kind="stable")
        self.x, self.norm = x[order], norm[order]
        self.row, self.label = (block.column(c).to_numpy()[order] for c in ("row", "label"))
        self.windows = None if windows is None else windows[order]
        cluster = cluster[order]
        self.clusters = []  # centre, widest angle, members
        for c in np.unique(cluster):
            members = np.flatnonzero(cluster == c)
            width = angles[order[members], c].max()
            self.clusters += [(centres[c], width, members[k : k + TOGETHER]) for k in range(0, len(members), TOGETHER)]


class Walk:
    """One task's walk: lists of rows go in, the best of them for every anchor come out."""

    def __init__(self, anchors: Anchors, keep: int):
        self.a = anchors
        self.per = 1 if anchors.windows is None else anchors.windows.shape[1]
        self.best = Best(len(anchors.x) * self.per, keep)
        self.scored = 0

    def needed(self, members: np.ndarray) -> np.ndarray:
        """For members, and each of their positives in the second walk: the least score that could change the result."""
        worst = self.best.score[:, -1].reshape(-1, self.per)[members]
        if self.a.windows is None:
            return worst
        low, high = self.a.windows[members, :, 0], self.a.windows[members, :, 1]
        return np.where(low <= high, np.maximum(worst, low), np.inf)

    def take(self, x: np.ndarray, id_: np.ndarray, label: np.ndarray, row: np.ndarray) -> None:
        directions, norm = _directions(x)
        for centre, width, members in self.a.clusters:
            # the small amounts make up for rounding
            beyond = np.maximum(0, _angles(directions, norm, centre[None])[:, 0] - width - 1e-6)
            bound = norm * np.cos(beyond) * (1 + 1e-9)
            order = np.argsort(-bound)
            at, step = 0, FIRST_STEP
            while at < len(order):
                needed = self.needed(members)
                going = bound[order[at]] * self.a.norm[members] + 1e-6 >= needed.min(axis=1)
                members, needed = members[going], needed[going]
                if not len(members):
                    break
                some = order[at : at + step]
                at, step = at + step, min(2 * step, STEP)
                scores = self.a.x[members] @ x[some].T
                self.scored += scores.size
                same = self.a.label[members][:, None] == label[some]
                if self.a.windows is None:
                    same &= self.a.row[members][:, None] != row[some]
                for p in range(self.per):
                    hit = (scores >= needed[:, p, None]) & same if self.a.windows is None else (scores >= needed[:, p, None]) & (scores <= self.a.windows[members, p, 1][:, None]) & ~same
                    i, j = np.nonzero(hit)
                    if len(i):
                        self.best.add(members[i] * self.per + p, scores[i, j], id_[some[j]], row[some[j]])

    def found(self) -> pa.RecordBatch:
        slot, rank = np.nonzero(self.best.score > -np.inf)
        id_ = self.best.id[slot, rank]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(self.a.row[slot // self.per]), pa.array((slot % self.per).astype(np.int32)), pa.array(self.best.score[slot, rank].astype(np.int64)),
                pa.array(id_, mask=id_ == _LAST), pa.array(self.best.row[slot, rank]),
            ],
            names=[c.split()[0] for c in FOUND.split(", ")],
        )


FOUND = "anchor long, positive int, score long, id long, row long"


def _walk_all(rows: DataFrame, shared, dims: int, keep: int) -> DataFrame:
    """All rows walked by the broadcast anchors: each task's best, FOUND."""
    most = max(1, LIST_VALUES // max(1, dims))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, held, n = Walk(shared.value, keep), [], 0

        def take():
            t = pa.Table.from_batches(held).combine_chunks()
            ids = t.column("vec_id").fill_null(_LAST).to_numpy()
            own.take(matrix(t.column("v").combine_chunks(), dims), ids, t.column("label").to_numpy(), t.column("row").to_numpy())

        for batch in batches:
            for at in range(0, batch.num_rows, most):
                held.append(batch.slice(at, most))
                n += held[-1].num_rows
                if n >= most:
                    take()
                    held, n = [], 0
        if held:
            take()
        yield own.found()

    return rows.select("row", "vec_id", "label", "v").mapInArrow(walk, FOUND)


def _ranked(found: DataFrame, by: list[str], keep: int) -> DataFrame:
    order = W.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= keep)


def usable(embeddings: DataFrame, vector: str = "embedding") -> DataFrame:
    """The rows that take part; their vectors as whole numbers floor(256 x) in `v`."""
    x = F.col(vector)
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * 256).cast("double"))
    return embeddings.filter(F.col("label").isNotNull() & x.isNotNull()).filter(fine).withColumn("v", whole)


def mine(rows: DataFrame, anchors: str, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH) -> DataFrame:
    """Hard negatives: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    rows: vec_id, label, v (array of doubles that are whole numbers); anchors: a condition on these.
    """
    spark = rows.sparkSession
    taken = rows.select("vec_id", F.col("label").cast("long").alias("label"), "v", F.coalesce(F.expr(anchors), F.lit(False)).alias("is_anchor"))
    stored = materialize(taken.withColumn("row", F.monotonically_increasing_id()), "embeddings")
    most = F.max(F.array_max(F.transform("v", lambda c: F.abs(c))))
    told = stored.agg(F.max(F.size("v")).alias("dims"), most.alias("most"), F.count_if("is_anchor").alias("anchors")).first()
    dims, n_anchors = told["dims"] or 0, told["anchors"] or 0
    if dims * (told["most"] or 0) ** 2 >= 1 << 53:
        raise ValueError("components are too large for exact scores")
    empty = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n_anchors:
        return spark.createDataFrame([], empty)
    asking = stored.filter("is_anchor")
    sampled = asking.select("v", F.xxhash64("row").alias("h")).orderBy("h").limit(max(1, SAMPLE_VALUES // max(1, dims))).select("v").toArrow()
    centres = fit_centres(matrix(sampled.column("v").combine_chunks(), dims), max(1, min(CLUSTERS, n_anchors // PER_CLUSTER)))
    n_blocks = -(-n_anchors * max(1, dims) // ANCHOR_VALUES)
    out = []
    for block in range(n_blocks):
        own = asking.filter(F.pmod(F.xxhash64("row"), F.lit(n_blocks)) == block).select("row", "vec_id", "label", "v")
        held = own.toArrow()
        shared = spark.sparkContext.broadcast(Anchors(held, dims, centres))
        first = materialize(_ranked(_walk_all(stored, shared, dims, positives), ["anchor"], positives), "positives")
        windows = np.empty((held.num_rows, positives, 2))
        windows[:] = (1, 0)  # nothing lies there
        place = {row: k for k, row in enumerate(held.column("row").to_pylist())}
        for r in first.select("anchor", "rank", "score").collect():  # `positives` rows an anchor of the block
            windows[place[r["anchor"]], r["rank"] - 1] = (-(-low * r["score"] // 100), high * r["score"] // 100)
        shared_windows = spark.sparkContext.broadcast(Anchors(held, dims, centres, windows))
        second = materialize(_ranked(_walk_all(stored, shared_windows, dims, negatives), ["anchor", "positive"], negatives), "negatives")
        named = first.join(own.select(F.col("row").alias("anchor"), F.col("vec_id").alias("anchor_id")), "anchor")
        named = named.select("anchor", (F.col("rank") - 1).alias("positive"), "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
        both = named.join(second, ["anchor", "positive"])
        out.append(both.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")))
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = usable(table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding"))
    moved = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return mine(moved, "vec_id % 50 = 0")


ORACLE = f"""
WITH taking_part AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, a.label = b.label AS same, b.vec_id, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM taking_part a JOIN taking_part b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}
)
SELECT anchor_id, positive_id, row_number() OVER w::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND {LOW} * positive_score <= 100 * score AND 100 * score <= {HIGH} * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= {NEGATIVES}
"""
