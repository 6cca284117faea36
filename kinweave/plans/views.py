"""Result views: clusters table, bubble plot, size histogram, MSA panel, anonymisation, centroid dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import row_numbers


def clusters_table(cluster_to_seq: DataFrame, radius: DataFrame, per_cluster: DataFrame) -> DataFrame:
    """One row a cluster: sequences, radius and abundance, joined on the cluster axis."""
    return cluster_to_seq.join(radius, "clusterId", "left").join(per_cluster, "clusterId", "left")


def bubble(abundances_top: DataFrame, sizes: DataFrame, least_size: int = 3) -> DataFrame:
    """x: cluster, y: sample, size: abundance, colour: cluster size; clusters of a few members are left out."""
    one = sizes.select("clusterId", "size").distinct().filter(F.col("size") >= least_size)
    return abundances_top.join(one, "clusterId")


def size_histogram(sizes: DataFrame, bins: int = 30) -> DataFrame:
    """bin (1 ..), lower, n: clusters by size, in `bins` equal bins from 1 to the largest size."""
    one = sizes.select("clusterId", "size").distinct()
    top = one.agg((F.max("size") + 1).cast("double").alias("top"))  # one row
    step = (F.col("top") - 1.0) / F.lit(float(bins))
    placed = one.join(F.broadcast(top)).select(F.least(F.floor((F.col("size") - 1) / step) + 1, F.lit(bins)).cast("long").alias("bin"), step.alias("step"))
    return placed.groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.round(F.max((F.col("bin") - 1) * F.col("step") + 1.0), 6).alias("lower"))


def msa_panel(link: DataFrame, selected: DataFrame, trimmed: DataFrame, distance: DataFrame, columns: list[str]) -> DataFrame:
    """Members of the selected clusters, through the linker, with sequences and distances."""
    members = link.join(selected.select("clusterId").distinct(), "clusterId", "left_semi").select("clusterId", "clonotypeKey")
    return members.join(trimmed.select("clonotypeKey", *columns), "clonotypeKey", "left").join(
        distance.select("clusterId", "clonotypeKey", "distanceToCentroid"), ["clusterId", "clonotypeKey"], "left"
    )


def anonymise(df: DataFrame, column: str, prefix: str = "S") -> tuple[DataFrame, DataFrame]:
    """df with opaque ids in `column`, and the inverse map (anonymised, original).

    The ids number the sorted distinct values by ranges, so no task sorts them all. Joins aren't told to broadcast, as
    nothing here bounds the map.
    """
    numbered, _ = row_numbers(df.select(F.col(column).alias("original")).filter("original IS NOT NULL").distinct(), ["original"], "n", "anonymised")
    mapping = numbered.select(F.concat(F.lit(prefix), F.col("n") + 1).alias("anonymised"), "original")
    hidden = df.join(mapping, F.col(column) == F.col("original")).withColumn(column, F.col("anonymised")).drop("anonymised", "original")
    return hidden, mapping


def deanonymise(df: DataFrame, column: str, mapping: DataFrame) -> DataFrame:
    """Original values back; values that the map doesn't have stay."""
    found = df.join(mapping, F.col(column) == F.col("anonymised"), "left")
    return found.withColumn(column, F.coalesce("original", column)).drop("anonymised", "original")


def centroid_dataset(abundances: DataFrame, plurality: DataFrame, sequence: str = "plurality_centroid_trimmed_fullSequence") -> DataFrame:
    """The clusters as a dataset of their own: abundance by sample and variantKey, with sequence, length and label."""
    own = plurality.select(
        F.col("clusterId").alias("variantKey"), F.col(sequence).alias("sequence"), F.length(sequence).cast("long").alias("sequenceLength"), F.col("peptideLabel").alias("label")
    )
    return abundances.select("sampleId", F.col("clusterId").alias("variantKey"), "abundance").join(own, "variantKey")
