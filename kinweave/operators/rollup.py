"""Cluster sizes, labels, abundance roll-ups, top cuts, peptide labels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.exprs import cluster_label, fraction, label_body, ranked_label, sample_fraction

#: Clusters kept for plots. Fixed value.
TOP = 100


def expand(clusters: DataFrame, mapping: DataFrame) -> DataFrame:
    """(clusterId, clonotypeKey) of all keys, from clusters of representatives; unmatched representatives go."""
    reps = clusters.select("clusterId", F.col("clonotypeKey").alias("representativeKey"))
    return reps.join(mapping, "representativeKey").select("clusterId", "clonotypeKey")


def with_size(clusters: DataFrame) -> DataFrame:
    """size: members of the cluster. An aggregation and a join, since a window would hold a large cluster in one task."""
    sizes = clusters.groupBy("clusterId").agg(F.count("clonotypeKey").alias("size"))
    return clusters.join(sizes, "clusterId")


def with_label(clusters: DataFrame, labels: DataFrame) -> DataFrame:
    """clusterLabel: the label of the member that gives the cluster its id; labels: (clonotypeKey, clonotypeKeyLabel)."""
    own = labels.groupBy(F.col("clonotypeKey").alias("clusterId")).agg(cluster_label(F.min("clonotypeKeyLabel")).alias("clusterLabel"))
    return clusters.join(own, "clusterId", "left")


def abundances(clones: DataFrame, clusters: DataFrame) -> DataFrame:
    """sampleId, clusterId, abundance, abundance_normalized (share of the sample's clustered abundance)."""
    unique = clusters.select("clonotypeKey", "clusterId").dropDuplicates(["clonotypeKey"])
    cells = clones.select("sampleId", "clonotypeKey", "abundance").join(unique, "clonotypeKey").groupBy("sampleId", "clusterId").agg(F.sum("abundance").alias("abundance"))
    totals = cells.groupBy("sampleId").agg(F.sum("abundance").alias("_total"))
    share = sample_fraction(F.col("abundance"), F.col("_total"))
    return cells.join(totals, "sampleId").select("sampleId", "clusterId", "abundance", share.alias("abundance_normalized"))


def abundances_per_cluster(by_sample: DataFrame) -> DataFrame:
    sums = by_sample.groupBy("clusterId").agg(F.sum("abundance").alias("abundance_per_cluster"))
    total = sums.agg(F.sum("abundance_per_cluster").alias("_total"))  # one row
    share = fraction(F.col("abundance_per_cluster"), F.col("_total"))
    return sums.join(F.broadcast(total)).select("clusterId", "abundance_per_cluster", share.alias("abundance_fraction_per_cluster"))


def top_clusters(per_cluster: DataFrame, n: int = TOP) -> DataFrame:
    return per_cluster.orderBy(F.desc("abundance_per_cluster"), "clusterId").limit(n).select("clusterId")


def restrict(df: DataFrame, top: DataFrame) -> DataFrame:
    """Rows of the clusters in `top`, which holds TOP rows at most."""
    return df.join(F.broadcast(top), "clusterId", "left_semi")


def peptide_labels(plurality: DataFrame, column: str = "plurality_centroid_trimmed_fullSequence") -> DataFrame:
    """With peptideLabel: PC- and five letters of the digest, and the rank among different sequences of equal letters."""
    body = plurality.withColumn("_body", label_body(F.col(column)))
    rank = F.dense_rank().over(W.partitionBy("_body").orderBy(column))
    ranked = body.filter("_body IS NOT NULL").select(column, "_body").distinct().withColumn("_rank", rank)
    return body.join(ranked.select(F.col(column).alias("_seq"), "_rank"), F.col(column) == F.col("_seq"), "left").withColumn(
        "peptideLabel", ranked_label(F.col("_body"), F.col("_rank"))
    ).drop("_body", "_rank", "_seq")
