"""Singleton reassignment: a cluster of one representative joins the nearest larger cluster within the radius."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .candidates import bounded_edits, segment_pairs


def best_matches(clusters: DataFrame, seqs: DataFrame, identity: float) -> DataFrame:
    """member_key, new_clusterId, norm_dist, rep_size for singletons with a match.

    clusters: (clusterId, clonotypeKey) of representatives; seqs: (clonotypeKey, trimmed_fullSequence). The best match
    is the nearest, then the cluster of more representatives, then the lesser id. It is one pass: no chains.
    """
    radius = 1.0 - identity
    sizes = clusters.groupBy("clusterId").agg(F.count(F.lit(1)).alias("rep_size"))
    text = seqs.groupBy("clonotypeKey").agg(F.min("trimmed_fullSequence").alias("seq"))
    single = clusters.join(sizes.filter("rep_size = 1"), "clusterId", "left_semi").join(text, "clonotypeKey")
    single = single.select(F.col("clonotypeKey").alias("key"), "seq").filter(F.length("seq") > 0)
    target = sizes.filter("rep_size > 1").join(text, F.col("clusterId") == F.col("clonotypeKey")).select(F.col("clusterId").alias("key"), "seq", "rep_size")
    target = target.filter(F.length("seq") > 0)
    one = segment_pairs(target.select("key", "seq"), single, radius).select(
        F.col("short_key").alias("member_key"), F.col("short_seq").alias("m"), F.col("long_key").alias("clusterId"), F.col("long_seq").alias("c")
    )
    two = segment_pairs(single, target.select("key", "seq"), radius).select(
        F.col("long_key").alias("member_key"), F.col("long_seq").alias("m"), F.col("short_key").alias("clusterId"), F.col("short_seq").alias("c")
    )
    edits = bounded_edits(F.col("m"), F.col("c"), radius)
    norm = edits.cast("double") / F.greatest(F.length("m"), F.length("c"))
    near = one.unionByName(two).distinct().withColumn("edits", edits).filter("edits >= 0").withColumn("norm", norm)
    ranked = near.join(target.select(F.col("key").alias("clusterId"), "rep_size"), "clusterId")
    best = ranked.groupBy("member_key").agg(F.min(F.struct("norm", (-F.col("rep_size")).alias("s"), "clusterId")).alias("best"))
    return best.select("member_key", F.col("best.clusterId").alias("new_clusterId"), F.col("best.norm").alias("norm_dist"), (-F.col("best.s")).alias("rep_size"))


def sample(found: DataFrame, n: int = 10) -> DataFrame:
    """The nearest reassignments, for the log."""
    return found.orderBy("norm_dist", "member_key").limit(n)


def reassign_singletons(clusters: DataFrame, seqs: DataFrame, identity: float, observed: Observation | None = None) -> DataFrame:
    """The clusters with singletons moved; `observed` gets reassigned_singletons when the result is worked out."""
    if identity >= 1:
        return clusters.select("clusterId", "clonotypeKey")
    found = best_matches(clusters, seqs, identity)
    joined = clusters.join(found, clusters["clonotypeKey"] == found["member_key"], "left")
    if observed is not None:
        joined = joined.observe(observed, F.count("member_key").alias("reassigned_singletons"))
    return joined.select(F.coalesce("new_clusterId", clusters["clusterId"]).alias("clusterId"), "clonotypeKey")
