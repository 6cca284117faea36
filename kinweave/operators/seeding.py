"""Candidate pairs of scored similarity, from inverted indexes of short words (k-mers).

Sequences are (key, seq). What a sequence is looked up by depends on itself and on how common its k-mers are, never on the
shortest or longest row of the table; sequences too short for a k-mer have no seeds and disturb no others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..storage import row_numbers, stored
from .scoring import UNKNOWN, coded, scored_pairs

#: Letters of a seed of the neighbourhood search; hits on one diagonal that make a candidate (meetings() is made for two); postings
#: beyond which a seed is lengthened, and the longest seed.
K, HITS, HOT, LONGEST = 3, 2, 100, 8
#: Common seeds of a length up to which they are broadcast.
HELD = 200_000
#: Seeds of linear-time clustering: letters, how many a sequence keeps; below SHORT letters a sequence has seeds of SHORT_K too.
LINEAR_K, LINEAR_SEEDS, SHORT, SHORT_K = 5, 20, 10, 3
#: Candidates of a sequence in the high-precision search.
TOP = 5000


def _lookalikes(matrix: np.ndarray, loss: float) -> dict[str, list[tuple[str, float]]]:
    """For each letter the others that may stand for it, with what the score loses."""
    letters = [chr(i) for i in range(1, 128) if matrix[i, i] > UNKNOWN]
    out = {}
    for c in letters:
        own = matrix[ord(c), ord(c)]
        out[c] = [(d, own - matrix[ord(c), ord(d)]) for d in letters if d != c and own - matrix[ord(c), ord(d)] <= loss]
    return out


def neighbours(kmers: DataFrame, matrix: np.ndarray, loss: float) -> DataFrame:
    """kmer, near: for each k-mer itself and all words whose score against it is at most `loss` below its own score."""
    alike = _lookalikes(matrix, loss)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, near = [], []
            for kmer in batch.column("kmer").to_pylist():
                words = [("", loss)]
                for c in kmer:
                    words = [(w + d, left - lost) for w, left in words for d, lost in [(c, 0.0), *alike.get(c, ())] if lost <= left]
                own += [kmer] * len(words)
                near += [w for w, _ in words]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.string()), pa.array(near, pa.string())], names=["kmer", "near"])

    return kmers.select("kmer").mapInArrow(expand, "kmer string, near string")


def seeds(seqs: DataFrame, k: int = K, hot: int = HOT, longest: int = LONGEST) -> DataFrame:
    """The index: key, pos (from 1), seed. A seed of more than `hot` postings gives way to the seeds one letter longer.

    So no posting list is longer than `hot`, and common words are told apart by what follows them; a place whose seed is
    still too common at `longest` letters, or at the sequence's end, has none. Places are worked out anew for each length, as
    they are many more than the common seeds, which alone are stored.
    """
    common, out, size = None, None, k
    while True:
        at = F.explode(F.sequence(F.lit(1), F.length("seq") - (size - 1)))
        here = seqs.filter(F.length("seq") >= size).select("key", "seq", at.alias("pos")).select("key", "pos", F.substring("seq", F.col("pos"), F.lit(size)).alias("seed"))
        if common is not None:  # a common seed's beginnings are common too, so the last one tells
            here = here.join(common.withColumnRenamed("seed", "begin"), F.left("seed", F.lit(size - 1)) == F.col("begin"), "left_semi")
        found = stored(here.groupBy("seed").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot).select("seed"))
        n = found.count()
        common = F.broadcast(found) if n <= HELD else found
        done = here.join(common, "seed", "left_anti").select("key", "pos", "seed")
        out = done if out is None else out.unionByName(done)
        if size == longest or not n:
            return out
        size += 1


def _places(words: DataFrame, matrix: np.ndarray, loss: float, k: int, hot: int, longest: int) -> DataFrame:
    """id, places: of each word (id, seq) its seeded places in order, as (pos, seed, near, before).

    near: the other seeds that it meets. before: first letter and length of the seed of the place before, 0 where there is none
    or where it goes on beyond this one. Only neighbours that some sequence has are there, and both ways: of two seeds only one need be near the other.
    """
    index = stored(seeds(words.select(F.col("id").alias("key"), "seq"), k, hot, longest).withColumnRenamed("key", "id"))
    short = F.length("seed") == k
    kmers = stored(index.filter(short).select(F.col("seed").alias("kmer")).distinct())
    near = neighbours(kmers, matrix, loss).filter("kmer <> near").join(kmers.withColumnRenamed("kmer", "near"), "near", "left_semi").select("kmer", "near")
    near = near.unionByName(near.select(F.col("near").alias("kmer"), F.col("kmer").alias("near")))
    lists = near.groupBy(F.col("kmer").alias("seed")).agg(F.collect_set("near").alias("near"))
    each = index.filter(short).join(lists, "seed", "left").unionByName(index.filter(~short).withColumn("near", F.lit(None).cast("array<string>")))
    placed = each.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("pos", "seed", "near"))).alias("places"))

    def told(x: Column, i: Column) -> Column:
        last = F.get("places", i - 1)
        tells = (last["pos"] == x["pos"] - 1) & (F.length(last["seed"]) <= F.length(x["seed"]) + 1)
        return F.struct(x["pos"].alias("pos"), x["seed"].alias("seed"), x["near"].alias("near"), F.when(tells, F.ascii(last["seed"]) * 64 + F.length(last["seed"])).otherwise(0).alias("before"))

    return placed.select("id", F.transform("places", told).alias("places"))


def meetings(words: DataFrame, matrix: np.ndarray, loss: float, k: int = K, hot: int = HOT, longest: int = LONGEST, carried: tuple[str, ...] = ()) -> DataFrame:
    """Pairs a < b of words (id, seq) with two seeds on one diagonal, and of words with room for one seed those with one.

    Words meet under two of their seeds and the distance between them, so nothing meets that is no pair: rows are two places
    of a word, and what the join makes is pairs (few of them more than once), not the many more hits of single seeds. `carried`
    are columns of the words that come along as x_a and x_b.
    """
    held = stored(_places(words, matrix, loss, k, hot, longest).join(words.select("id", "seq"), "id"))
    kept, nears = ["id", *carried], lambda c: F.concat(F.array(f"{c}.seed"), F.coalesce(f"{c}.near", F.array().cast("array<string>")))

    def twos(df: DataFrame) -> DataFrame:
        """Each two places x, y of a word, x first."""
        one = df.select(*kept, "places", F.posexplode("places").alias("at", "x"))
        return one.select(*kept, "x", F.explode(F.slice("places", F.col("at") + 2, F.size("places"))).alias("y"))

    def under(one: Column, two: Column) -> Column:
        """Two seeds and how far the second begins behind the first, as one string that tells them apart."""
        return F.concat(F.length(one), F.lit(" "), one, two, F.lit(" "), F.col("y.pos") - F.col("x.pos")).alias("seeds")

    second = F.when(F.col("y.pos") > F.col("x.pos") + 1, F.col("y.before")).otherwise(0)
    own = twos(held).select(*kept, under(F.col("x.seed"), F.col("y.seed")), F.col("x.before").alias("first"), second.alias("second"), F.lit(0).alias("asks"))
    # two seeds of which one at least is another of the neighbourhood; they ask, and what they find is as it is
    asking = twos(held.filter(F.exists("places", lambda p: p["near"].isNotNull()))).filter("x.near IS NOT NULL OR y.near IS NOT NULL")
    asking = asking.withColumn("s", F.explode(nears("x"))).withColumn("t", F.explode(nears("y"))).filter("s <> x.seed OR t <> y.seed")
    rows = own.unionByName(asking.select(*kept, under(F.col("s"), F.col("t")), F.lit(0).alias("first"), F.lit(0).alias("second"), F.lit(1).alias("asks")))
    # the same rows on both sides, so that they are shuffled once; a pair whose seeds also meet a place before needs not meet
    # here: of a run of places that meet, the first two are left
    again = lambda c: (F.col(f"x.{c}") > 0) & (F.col(f"x.{c}") == F.col(f"y.{c}"))
    columns = [F.col("x.id").alias("a"), F.col("y.id").alias("b"), *[F.col(f"{side}.{c}").alias(f"{c}_{d}") for c in carried for side, d in ("xa", "yb")]]
    meets = (F.col("x.seeds") == F.col("y.seeds")) & (F.col("x.id") < F.col("y.id")) & (F.col("x.asks") + F.col("y.asks") <= 1) & ~again("first") & ~again("second")
    met = rows.alias("x").join(rows.alias("y"), meets).select(columns)
    # words with room for one seed
    every = held.select(*kept, F.explode("places").alias("p"))
    single = held.filter(F.length("seq") == k).select(*kept, F.explode("places").alias("p")).select(*kept, F.explode(nears("p")).alias("seed"))
    pairs = single.alias("s").join(every.select(*kept, "p.seed").alias("e"), "seed")
    for x, y in (("s", "e"), ("e", "s")):
        met = met.unionByName(pairs.filter(F.col(f"{x}.id") < F.col(f"{y}.id")).select(F.col(f"{x}.id").alias("a"), F.col(f"{y}.id").alias("b"), *[F.col(f"{z}.{c}").alias(f"{c}_{d}") for c in carried for z, d in ((x, "a"), (y, "b"))]))
    return met


def numbered(seqs: DataFrame) -> DataFrame:
    """id, key, seq: numbers in the order of the keys."""
    return row_numbers(seqs.select("key", "seq"), ["key"], "id", "numbered")[0].select("id", "key", "seq")


def numbered_pairs(words: DataFrame, matrix: np.ndarray, loss: float, k: int = K, hot: int = HOT, longest: int = LONGEST) -> DataFrame:
    """The pairs of neighbour_pairs() as numbers a < b of words (id, seq), dealt by a."""
    return meetings(words, matrix, loss, k, hot, longest).repartition("a").distinct()


def with_keys(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """Pairs (a, b) of numbers as pairs of keys."""
    one, two = (words.select(F.col("id").alias(c), F.col("key").alias(f"key_{c}")) for c in "ab")
    return pairs.join(one, "a").join(two, "b").select(F.col("key_a").alias("a"), F.col("key_b").alias("b"))


def neighbour_pairs(seqs: DataFrame, matrix: np.ndarray, loss: float, k: int = K, hot: int = HOT, longest: int = LONGEST) -> DataFrame:
    """Pairs a < b with two seeds (HITS) on one diagonal: seeds of k letters meet within their neighbourhood, longer ones if equal.

    A sequence with fewer seeds than that needs only as many as it has room for. No seed and word of its neighbourhood has more
    than `hot` rows.
    """
    words = numbered(seqs)
    return with_keys(numbered_pairs(words, matrix, loss, k, hot, longest), words)


def scored_neighbours(seqs: DataFrame, matrix: np.ndarray, loss: float, least: float) -> DataFrame:
    """The pairs a < b of neighbour_pairs() with a similarity of `least` or more; they are scored where they meet."""
    words = numbered(seqs)
    met = meetings(words, matrix, loss, carried=("seq",))
    return with_keys(scored_pairs(met, matrix, least=least).select("a", "b").distinct(), words)


def with_sequences(pairs: DataFrame, seqs: DataFrame) -> DataFrame:
    """Pairs (a, b) with seq_a and seq_b."""
    one, two = (seqs.select(F.col("key").alias(c), F.col("seq").alias(f"seq_{c}")) for c in "ab")
    return pairs.join(one, "a").join(two, "b").select("a", "b", "seq_a", "seq_b")


def ungapped_scores(a: list[str], b: list[str], diagonal: list[int], matrix: np.ndarray) -> np.ndarray:
    """Best score of a run along the diagonal (place in b less place in a) of each pair, all pairs a place at a time."""
    x, y, d = coded(a), coded(b), np.array(diagonal, dtype=np.int64)
    out, run = np.zeros(len(a)), np.zeros(len(a))
    for i in range(x.shape[1]):
        j = i + d
        there = np.where((j >= 0) & (j < y.shape[1]), y[np.arange(len(y)), np.clip(j, 0, max(0, y.shape[1] - 1))], 0)
        # where either sequence has ended the matrix has a loss that no run survives
        run = np.maximum(run + matrix[x[:, i], there], 0.0)
        np.maximum(out, run, out=out)
    return out


def diagonal_candidates(seqs: DataFrame, matrix: np.ndarray, k: int = LINEAR_K, top: int = TOP) -> DataFrame:
    """query, target, score: for each sequence the `top` others by their best ungapped score on a diagonal with a common k-mer.

    Exhaustive: every pair with a common k-mer is scored, however common the k-mer. Ties go to the lesser key. The ranking
    keeps `top` rows a query in each task before it shuffles.
    """
    at = F.explode(F.sequence(F.lit(1), F.length("seq") - (k - 1)))
    index = seqs.filter(F.length("seq") >= k).select("key", "seq", at.alias("pos")).withColumn("kmer", F.substring("seq", F.col("pos"), F.lit(k)))
    here, there = (index.select(F.col("key").alias(c), F.col("seq").alias(f"seq_{c}"), F.col("pos").alias(f"pos_{c}"), "kmer") for c in "ab")
    # dealt by pair once; the sequences come along, as they are short
    met = here.join(there, "kmer").filter("a < b").select("a", "b", "seq_a", "seq_b", (F.col("pos_b") - F.col("pos_a")).alias("diagonal"))
    met = met.repartition("a", "b").distinct()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = ungapped_scores(*(batch.column(c).to_pylist() for c in ("seq_a", "seq_b", "diagonal")), matrix)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(found)], names=["a", "b", "score"])

    scored = met.mapInArrow(score, "a string, b string, score double")
    # grouping the other way again needs no other scores, as a diagonal's score is the same from both sides
    best = stored(scored.groupBy("a", "b").agg(F.max("score").alias("score")))
    both = best.select(F.col("a").alias("query"), F.col("b").alias("target"), "score").unionByName(best.select(F.col("b").alias("query"), F.col("a").alias("target"), "score"))
    order = W.partitionBy("query").orderBy(F.desc("score"), "target")
    return both.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).drop("rank")


def linear_seeds(seqs: DataFrame, k: int = LINEAR_K, most: int = LINEAR_SEEDS, short: int = SHORT, short_k: int = SHORT_K) -> DataFrame:
    """key, kmer: the `most` k-mers of least hash of each sequence, so rows grow with the sequences alone.

    Sequences below `short` letters also stand in an index of their own with k-mers of short_k letters.
    """

    def of(size: int, mark: str):
        starts = F.sequence(F.lit(1), F.length("seq") - (size - 1))
        words = F.array_distinct(F.transform(starts, lambda i: F.substring(F.col("seq"), i, F.lit(size))))
        hashed = F.array_sort(F.transform(words, lambda w: F.struct(F.md5(w.cast("binary")).alias("h"), F.concat(F.lit(mark), w).alias("kmer"))))
        return F.when(F.length("seq") >= size, F.slice(hashed, 1, most)).otherwise(F.array().cast("array<struct<h:string,kmer:string>>"))

    both = F.when(F.length("seq") < short, F.concat(of(k, ""), of(short_k, "short:"))).otherwise(of(k, ""))
    return seqs.select("key", F.explode(F.transform(both, lambda x: x["kmer"])).alias("kmer"))

