"""Clusterings of a similarity graph: components, one hop, set cover, and linear-time centres.

Edges are (a, b) of string keys; nodes (key). Clusters are (clusterId, clonotypeKey), where clusterId is the key of a member.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import stored


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Components; clusterId is the least key of each.

    Labels are contracted by least neighbours in the order of a hash of the keys, which takes a logarithmic number of
    rounds whatever the keys; the least key of each component is taken at the end.
    """
    h = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("k"))
    both = both_ways(edges).select(h("a").alias("a"), h("b").alias("b"))
    labels = None
    while True:
        least = stored(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("to")))
        if labels is None:
            labels = least.select("node", F.col("to").alias("label"))
        else:
            moved = labels.join(least.withColumnRenamed("node", "label"), "label", "left")
            labels = stored(moved.select("node", F.coalesce("to", "label").alias("label")))
        x = both.join(least.select(F.col("node").alias("a"), F.col("to").alias("x")), "a").select("b", "x")
        y = x.join(least.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        both = stored(y.filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
        if both.isEmpty():
            break
    labelled = nodes.join(labels.select(F.col("node.k").alias("key"), F.col("label.k").alias("label")), "key", "left")
    labelled = labelled.select("key", F.coalesce("label", "key").alias("label"))
    ids = labelled.groupBy("label").agg(F.min("key").alias("clusterId"))
    return labelled.join(ids, "label").select("clusterId", F.col("key").alias("clonotypeKey"))


def one_hop(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """One round of label propagation: each node joins its least neighbour that doesn't itself have a lesser one."""
    least = both_ways(edges).groupBy("a").agg(F.min("b").alias("b"))
    to = nodes.join(least, nodes["key"] == least["a"], "left").select("key", F.least("key", F.coalesce("b", "key")).alias("to"))
    heads = to.filter("key = to").select(F.col("key").alias("to"), F.lit(True).alias("head"))
    placed = to.join(heads, "to", "left")
    return placed.select(F.when(F.col("head"), F.col("to")).otherwise(F.col("key")).alias("clusterId"), F.col("key").alias("clonotypeKey"))


#: Steps in which a number of neighbours doubles: numbers up to eight are told apart exactly, larger ones within a fifth.
LEVELS = 4


def cover_rank(n: Column, key: Column) -> Column:
    """The order of set cover: level of the number of free neighbours (more first), then a hash of the key, then the key."""
    return F.struct((-F.floor(F.log2(n) * LEVELS)).alias("level"), F.xxhash64(key).alias("h"), key.alias("k"))


def set_cover(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Greedy set cover, in rounds of local maxima.

    In a round, each free node that comes before all free nodes within two hops in the order of cover_rank() becomes a
    centre and takes its free neighbours; two such centres share none, so the order among them is of no effect, and the
    result is that of the sequential greedy in this order. Levels are geometric and ties are hashed, so rounds grow with
    the logarithm of the table: runs of ascending keys or degrees don't wait for each other. Rounds go on until no edge
    between free nodes is left; who then is free stands alone.
    """
    free_edges, taken = stored(both_ways(edges)), None
    while not free_edges.isEmpty():
        degree = free_edges.groupBy("a").agg(F.count(F.lit(1)).alias("n"))
        rank = degree.select("a", cover_rank(F.col("n"), F.col("a")).alias("rank"))
        near = free_edges.join(rank.select(F.col("a").alias("b"), "rank"), "b").groupBy("a").agg(F.min("rank").alias("near"))
        near = rank.join(near, "a").select("a", "rank", F.least("rank", "near").alias("near"))
        best = free_edges.join(near.select(F.col("a").alias("b"), "near"), "b").groupBy("a").agg(F.min("near").alias("far"))
        centres = near.join(best, "a").filter(F.col("rank") == F.least("near", "far")).select(F.col("a").alias("centre"))
        members = free_edges.join(centres, F.col("a") == F.col("centre")).select(F.col("centre").alias("clusterId"), F.col("b").alias("clonotypeKey"))
        fresh = stored(members.unionByName(centres.select(F.col("centre").alias("clusterId"), F.col("centre").alias("clonotypeKey"))))
        taken = fresh if taken is None else taken.unionByName(fresh)
        gone = fresh.select(F.col("clonotypeKey").alias("g"))
        free_edges = stored(free_edges.join(gone, F.col("a") == F.col("g"), "left_anti").join(gone, F.col("b") == F.col("g"), "left_anti"))
    if taken is None:
        return nodes.select(F.col("key").alias("clusterId"), F.col("key").alias("clonotypeKey"))
    alone = nodes.join(taken.select(F.col("clonotypeKey").alias("key")), "key", "left_anti")
    return taken.unionByName(alone.select(F.col("key").alias("clusterId"), F.col("key").alias("clonotypeKey")))


def centre_pairs(seqs: DataFrame, seeds: DataFrame) -> DataFrame:
    """a, b, seq_a, seq_b: each sequence a with the longest sequence b (then the least key) of each of its seeds' groups.

    As many pairs as rows of `seeds` (key, kmer) at most, however large a group is.
    """
    sized = seqs.select("key", F.struct((-F.length("seq")).alias("l"), F.col("key").alias("k")).alias("rank"))
    ranked = seeds.join(sized, "key")
    centres = ranked.groupBy("kmer").agg(F.min("rank").alias("centre"))
    met = ranked.join(centres, "kmer").filter("centre < rank").select(F.col("key").alias("a"), F.col("centre.k").alias("b")).distinct()
    one, two = (seqs.select(F.col("key").alias(c), F.col("seq").alias(f"seq_{c}")) for c in "ab")
    return met.join(one, "a").join(two, "b").select("a", "b", "seq_a", "seq_b")


def linear_time(seqs: DataFrame, seeds: DataFrame, verify: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Centre per seed group: the longest sequence of each group is compared to its members, no others.

    seeds: (key, kmer); verify() leaves those pairs (a, b) of centre_pairs() that may be joined, b being the centre. A
    sequence joins its best centre (longest, then least key) that is itself in no longer one's cluster; others stand alone.
    """
    good = verify(centre_pairs(seqs, seeds)).select("a", "b")
    rank = seqs.select(F.col("key").alias("b"), F.struct((-F.length("seq")).alias("l"), F.col("key").alias("k")).alias("rank"))
    best = good.join(rank, "b").groupBy("a").agg(F.min("rank").alias("best"))
    joins = stored(best.select(F.col("a").alias("key"), F.col("best.k").alias("to")))
    heads = seqs.select("key").join(joins, "key", "left_anti").withColumn("head", F.lit(True))
    placed = seqs.select("key").join(joins, "key", "left").join(heads.select(F.col("key").alias("to"), "head"), "to", "left")
    return placed.select(F.when(F.col("head"), F.col("to")).otherwise(F.col("key")).alias("clusterId"), F.col("key").alias("clonotypeKey"))
