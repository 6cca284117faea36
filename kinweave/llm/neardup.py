"""Near-duplicate groups by ProbMinHash over weighted word shingles.

A document is a weighted set: its shingles of five lower-cased words (runs of letters, digits and non-ASCII characters),
each weighing as often as it occurs. Every shingle runs a Poisson process of its own, with its weight as rate and its
hash as seed; each arrival claims one of the registers at random, the earliest arrival keeps it, and a process ends as
soon as its time passes the latest register (early termination). Two documents agree in a register with a chance equal
to their probability Jaccard similarity. Registers are hashed in bands; documents that share a band are candidates, and
candidates are verified by their exact probability Jaccard similarity, from the texts. Groups are the connected
components of verified pairs.

Documents with equal weighted sets form one class first, and only one of each goes on. Inside a band no pairs are
listed: members are compared to one leader, the one that shares bands with most others and so stands in the middle of
its group, and then, as long as that still joins many, to a leader outside the components that have led the band. What
the leaders leave open is decided exactly by prefix filtering (rarest shingles first), which loses no pair of the wanted
similarity: only members of bands that still hold several components take part, only pairs across components are met,
and each of those only if what comes before its first common shingle leaves the similarity possible. No band is capped.

Nulls: a null text counts as empty; all texts without words are equal to each other. A text of fewer than five words
is one shingle; a very long one is hashed in chunks, whole, in a block of its own. Rows are told apart by doc_id and text; a null doc_id is kept and counts as larger than others for
class_id unless all are null. Ties: class_id is the least doc_id of the group. Groups whose doc_ids are all null, or that
have their least doc_id in common, share a class_id; class_key (the least set hash of the group, in hexadecimal) tells
them apart, and deduplicate() goes by it. An empty table gives an empty result.
Extra columns are kept by deduplicate() and ignored by near_duplicates().
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import materialize, pack, table, unpack
from .shingles import blocks, mix, shingle_counts

#: A pair of similarity 0.8 shares no band of 24 with a chance of 7e-5; one of similarity 0.3 shares one in 6 %.
BANDS, ROWS, SIMILARITY, WIDTH = 24, 5, 0.8, 5
#: Shingles whose frequency orders the prefixes; see _prefixes().
FREQUENT = 200_000
#: Shingles before a posting that go with it, to tell where a pair has met before; see _across().
LAST = 6
#: Shingles whose arrivals are drawn at once.
DRAWN = 1 << 19
#: Leaders' rounds go on while a round joins more than this share of the members; what is left is decided anyway.
WORTH = 0.01
_U = np.uint64


def prob_minhash(doc: np.ndarray, keys: np.ndarray, weights: np.ndarray, n_docs: int, registers: int) -> np.ndarray:
    """The key that holds each register of each document: n_docs x registers; zeros for documents without keys."""
    time = np.full(n_docs * registers, np.inf)
    holder = np.zeros(n_docs * registers, dtype=np.uint64)
    latest = np.full(n_docs, np.inf)
    for begin in range(0, len(keys), DRAWN):
        part = slice(begin, begin + DRAWN)
        _arrivals(doc[part], keys[part], weights[part].astype(np.float64), time, holder, latest, registers)
    return holder.reshape(n_docs, registers)


def _arrivals(doc: np.ndarray, keys: np.ndarray, rate: np.ndarray, time: np.ndarray, holder: np.ndarray, latest: np.ndarray, registers: int) -> None:
    """Let the arrivals of these keys claim their registers."""
    at, k = np.zeros(len(keys)), 0
    while len(keys):
        k += 1
        draw = mix(keys + _U(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        at = at - np.log1p(-((draw >> _U(11)).astype(np.float64) * 2.0**-53)) / rate
        early = at < latest[doc]
        doc, keys, rate, at, draw = doc[early], keys[early], rate[early], at[early], draw[early]
        slot = doc * registers + (mix(draw ^ _U(0xA5A5A5A5A5A5A5A5)) % _U(registers)).astype(np.int64)
        np.minimum.at(time, slot, at)
        held = time[slot] == at
        holder[slot[held]] = keys[held]
        # only registers of documents that are still at work can have changed
        live = np.unique(doc)
        latest[live] = time.reshape(-1, registers)[live].max(axis=1)
        on = at < latest[doc]
        doc, keys, rate, at = doc[on], keys[on], rate[on], at[on]


def band_hashes(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    out = np.empty((len(signature), bands), dtype=np.uint64)
    for b in range(bands):
        h = np.full(len(signature), b + 1, dtype=np.uint64)
        for r in range(rows):
            h = mix(h * _U(0xD1342543DE82EF95) + signature[:, b * rows + r])
        out[:, b] = h
    return out


def set_keys(doc: np.ndarray, keys: np.ndarray, counts: np.ndarray, n_docs: int) -> np.ndarray:
    """16 bytes for each document, equal for equal weighted sets: n_docs x 2 words."""
    out = np.zeros((n_docs, 2), dtype=np.uint64)
    for side in range(2):
        h = mix(mix(keys + _U(side + 1)) + counts.astype(np.uint64) * _U(0x9E3779B97F4A7C15))
        np.add.at(out[:, side], doc, h)
    return out


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, ties, texts = batch.column("doc_id"), batch.column("tie"), batch.column("text").to_pylist()
        for begin, block in blocks(texts):
            n = len(block)
            doc, keys, counts = shingle_counts(block, WIDTH)
            signature = prob_minhash(doc, keys, counts, n, BANDS * ROWS)
            bands = band_hashes(signature, BANDS, ROWS).view(np.int64)
            nodes = set_keys(doc, keys, counts, n)
            lists = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * BANDS, bands.reshape(-1))
            node = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), n, [None, pa.py_buffer(nodes.tobytes())]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([ids.slice(begin, n), ties.slice(begin, n), node, lists], names=["doc_id", "tie", "node", "bands"])


def similarity(keys_a, counts_a, keys_b, counts_b) -> float:
    """Probability Jaccard similarity of two weighted sets (ascending keys)."""
    _, in_a, in_b = np.intersect1d(keys_a, keys_b, assume_unique=True, return_indices=True)
    if not len(in_a):
        return 1.0 if not len(keys_a) and not len(keys_b) else 0.0
    x, y = counts_a[in_a].astype(np.float64), counts_b[in_b].astype(np.float64)
    only_x, only_y = counts_a.sum() - x.sum(), counts_b.sum() - y.sum()
    # for a common key i: 1 / sum_j max(x_j / x_i, y_j / y_i), where x_j counts if x_j / y_j >= x_i / y_i
    ratio, at = np.unique(x / y, return_inverse=True)
    x_at, y_at = np.bincount(at, weights=x), np.bincount(at, weights=y)
    x_above = np.cumsum(x_at[::-1])[::-1] + only_x
    y_below = np.cumsum(y_at) - y_at + only_y
    return float((x_at / (x_above + ratio * y_below)).sum())


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        a, b = batch.column("a"), batch.column("b")
        texts = [t for pair in zip(batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist(), strict=True) for t in pair]
        alike = np.zeros(len(a), dtype=bool)
        last: list = []
        for begin, block in blocks(texts):
            doc, keys, counts = shingle_counts(block, WIDTH)
            cut = np.searchsorted(doc, np.arange(len(block) + 1))
            sets = last + [(keys[s:e], counts[s:e]) for s, e in zip(cut[:-1], cut[1:], strict=True)]
            pair = (begin - len(last)) // 2
            for k in range(0, len(sets) - 1, 2):
                alike[pair + k // 2] = similarity(*sets[k], *sets[k + 1]) >= SIMILARITY - 1e-12
            last = sets[-1:] if len(sets) % 2 else []
        keep = pa.array(alike)
        yield pa.RecordBatch.from_arrays([a.filter(keep), b.filter(keep)], names=["a", "b"])


def _verified(pairs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return materialize(pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b").mapInArrow(_verify, "a binary, b binary"), name)


def components(edges: DataFrame) -> DataFrame:
    """node, label (the component) for all ends of the edges (a, b), by contraction to least neighbours.

    Each round every node is replaced by its least neighbour (or itself) in all edges. Nodes are hashes, so the order is
    random and the number of rounds is logarithmic; each round's tables are stored.
    """
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = None
    while True:
        least = both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("to"))
        least = materialize(least, "least")
        if labels is None:
            labels = least.select("node", F.col("to").alias("label"))
        else:
            moved = labels.join(least.select(F.col("node").alias("label"), "to"), "label", "left")
            labels = materialize(moved.select("node", F.coalesce("to", "label").alias("label")), "labels")
        left = both.join(least.select(F.col("node").alias("a"), F.col("to").alias("x")), "a").select("b", "x")
        ends = left.join(least.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        both = materialize(ends.filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "edges")
        if both.isEmpty():
            return labels


def _stars(members: DataFrame, led: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """Pairs (a, b) of each member and its band's leader, of different components; and the components that have led.

    members: band, node, degree, label. led: band, label (of components as they are now), or None.
    """
    mixed = members.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("band")
    free = members if led is None else members.join(led, ["band", "label"], "left_anti")
    leaders = free.join(mixed, "band", "left_semi").groupBy("band").agg(F.max(F.struct("degree", "node", "label")).alias("leader"))
    leaders = materialize(leaders, "leaders")
    pairs = members.join(leaders, "band").filter(F.col("label") != F.col("leader.label"))
    pairs = pairs.select(F.least("node", "leader.node").alias("a"), F.greatest("node", "leader.node").alias("b")).distinct()
    now = leaders.select("band", F.col("leader.label").alias("label"))
    return pairs, now if led is None else led.unionByName(now)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row for each row of docs: doc_id, tie (hash of the text), class_id, class_size, class_key."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    signed = materialize(rows.mapInArrow(_sign, "doc_id long, tie long, node binary, bands array<long>"), "signatures")
    classes = signed.groupBy("node").agg(F.min(F.struct("doc_id", "tie")).alias("rep"), F.first("bands").alias("bands"))
    bands = classes.select("node", "rep", F.explode("bands").alias("band"))
    shared = bands.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    members = materialize(bands.join(shared, "band").select("band", "node", "rep", "n"), "band-members")
    wanted = members.select("node", "rep.doc_id", "rep.tie").dropDuplicates(["node"])
    found = rows.join(wanted.withColumnRenamed("doc_id", "_id"), (F.col("doc_id").eqNullSafe(F.col("_id"))) & (rows["tie"] == wanted["tie"]))
    texts = materialize(found.select("node", "text").dropDuplicates(["node"]), "candidate-texts")

    degrees = members.groupBy("node").agg(F.sum("n").alias("degree"))
    seated = materialize(members.select("band", "node").join(degrees, "node"), "seated")
    n_nodes = degrees.count()
    at, edges, led, tried, labels = seated.withColumn("label", F.col("node")), None, None, None, None
    while True:
        pairs, led = _stars(at, led)
        pairs = materialize(pairs if tried is None else pairs.join(tried, ["a", "b"], "left_anti"), "star-pairs")
        tried = pairs if tried is None else tried.unionByName(pairs)
        fresh = _verified(pairs, texts, "links")
        edges = fresh if edges is None else edges.unionByName(fresh)
        labels = components(edges)
        current = F.coalesce("label", "node").alias("label")
        at = materialize(seated.join(labels, "node", "left").select("band", "node", "degree", current), "labelled")
        if fresh.count() <= WORTH * n_nodes:
            break
        moved = led.withColumnRenamed("label", "node").join(labels, "node", "left")
        led = materialize(moved.select("band", current).distinct(), "led")
    fresh = _verified(_across(at, texts), texts, "links")
    if not fresh.isEmpty():
        labels = components(edges.unionByName(fresh))
    own = signed.select("doc_id", "tie", "node").join(labels, "node", "left").select("doc_id", "tie", "node", F.coalesce("label", "node").alias("label"))
    groups = own.groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"), F.hex(F.min("node")).alias("class_key"))
    return own.join(groups, "label").select("doc_id", "tie", "class_id", "class_size", "class_key")


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, block in blocks(batch.column("text").to_pylist()):
            yield pa.RecordBatch.from_arrays([pa.array(shingle_counts(block, WIDTH)[1].view(np.int64))], names=["h"])


def _prefixes(texts: DataFrame) -> DataFrame:
    """node, h, before, last, size: the first shingles of each text, in an order common to all texts, that hold over
    1 - SIMILARITY of its weight; the share of the weight that comes before each, the LAST shingles before it, and the
    number of the text's shingles if none of them is repeated, else 0.

    A term of the probability Jaccard similarity is at most the shingle's share of either text, so common shingles of a
    verified pair hold at least SIMILARITY of the weight of both, and the first common one is in both prefixes. Any order
    will do; this one puts frequent shingles (of the FREQUENT most frequent ones) last, so that passages which many
    texts share bring none of them together.
    """
    counts = texts.mapInArrow(_hashes, "h long").groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter("n >= 8")
    often = counts.orderBy(F.desc("n"), "h").limit(FREQUENT).toArrow()
    keys = np.sort(often.column("h").to_numpy())
    ranks = often.column("n").to_numpy()[np.argsort(often.column("h").to_numpy(), kind="stable")]
    shared = texts.sparkSession.sparkContext.broadcast((keys, ranks))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, ranks = shared.value
        for batch in batches:
            nodes = batch.column("node")
            for begin, block in blocks(batch.column("text").to_pylist()):
                doc, h, n = shingle_counts(block, WIDTH)
                h = h.view(np.int64)
                rank = np.zeros(len(h), dtype=np.int64)
                if len(keys):
                    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                    rank[keys[at] == h] = ranks[at[keys[at] == h]]
                order = np.lexsort((h, rank, doc))
                doc, h, n = doc[order], h[order], n[order].astype(np.float64)
                total = np.bincount(doc, weights=n, minlength=len(block))
                before = np.cumsum(n) - n
                before -= before[np.searchsorted(doc, doc)]
                before /= total[doc]
                keep = before <= 1 - SIMILARITY + 1e-9
                at = np.flatnonzero(keep)
                start = np.searchsorted(doc, doc)[at]
                n_last = np.minimum(LAST, at - start)
                last = pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(n_last)]).astype(np.int32), h[_runs(at - n_last, n_last)])
                plain = np.where(np.bincount(doc, minlength=len(block)) == total, total, 0)[doc[at]].astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [nodes.take(pa.array(begin + doc[at])), pa.array(h[at]), pa.array(before[at]), last, pa.array(plain)],
                    names=["node", "h", "before", "last", "size"],
                )

    return texts.mapInArrow(first, "node binary, h long, before double, last array<long>, size long")


def _runs(begin: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """begin, begin + 1, ... for each run, one run after the other."""
    return np.arange(lengths.sum()) + np.repeat(begin - np.cumsum(lengths) + lengths, lengths)


def _across(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) in different components that can be alike, among the members of bands with several components.

    This decides exactly what the stars left open, by prefix filtering in place of all pairs of a band. With shares x and
    y of the two texts' weight that aren't common, the similarity is at most (1 - x) (1 - y) / (1 - x y), as each term is
    at most a concave function of the two shares of its shingle; for texts without repeated shingles it is plain Jaccard
    similarity, with at most min((1 - x) size, (1 - y) size') shingles in common. What comes before the first common
    shingle isn't common. A pair is wanted once, at its first common shingle;
    where the shingles just before have one in common, it has been met there. Of each shingle's postings those of the
    component that holds most of them aren't joined with each other.
    """
    open_ = members.groupBy("band").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).filter("lo <> hi").select("band")
    left = members.join(open_, "band").groupBy("node").agg(F.first("label").alias("label"))
    left = materialize(left, "open-nodes")
    first = materialize(_prefixes(texts.join(left, "node", "left_semi")).join(left, "node"), "prefixes")
    by_label = first.groupBy("h", "label").agg(F.count(F.lit(1)).alias("n"))
    largest = by_label.groupBy("h").agg(F.max(F.struct("n", "label")).alias("top"), F.count(F.lit(1)).alias("labels")).filter("labels > 1")
    one = first.join(largest.select("h", F.col("top.label").alias("top")), "h")
    posting = ("node", "label", "before", "last", "size")
    rest = one.filter("label <> top").select("h", *[F.col(c).alias(f"{c}_a") for c in posting])
    every = one.select("h", "top", *[F.col(c).alias(f"{c}_b") for c in posting])

    def possible(x: Column, y: Column) -> Column:
        least, plain = F.lit(SIMILARITY - 1e-6), (F.col("size_a") > 0) & (F.col("size_b") > 0)
        common = F.least((1 - x) * F.col("size_a"), (1 - y) * F.col("size_b"))
        as_sets = common >= least * (F.col("size_a") + F.col("size_b") - common)
        return ((1 - x) * (1 - y) >= least * (1 - x * y)) & (~plain | as_sets)

    # two postings outside the largest component meet twice, so one of the ways is left out
    once = (F.col("label_b") == F.col("top")) | (F.col("node_a") < F.col("node_b"))
    can = (F.col("label_a") != F.col("label_b")) & once & possible(F.col("before_a"), F.col("before_b")) & ~F.arrays_overlap("last_a", "last_b")
    pairs = rest.join(every, "h").filter(can)
    return pairs.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()


def deduplicate(docs: DataFrame) -> DataFrame:
    """The rows of docs of which one of each group is kept: the one of least doc_id, then least hash of the text."""
    found = materialize(near_duplicates(docs), "classes")
    best = found.groupBy("class_key").agg(F.min(F.struct("doc_id", "tie")).alias("best")).select("best.*").withColumnRenamed("doc_id", "_id")
    packed = pack(docs, "doc_id", "text").withColumn("tie", F.xxhash64(F.coalesce("text", F.lit(""))))
    kept = packed.join(best, (F.col("doc_id").eqNullSafe(F.col("_id"))) & (packed["tie"] == best["tie"]), "left_semi")
    repeated = found.groupBy("doc_id", "tie").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return unpack(kept if repeated.isEmpty() else kept.dropDuplicates(["doc_id", "tie"]), docs)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "class_size", "class_key")
