"""Schemas of inputs and result relations, by number of chains, and empty relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

_S, _L, _D = StringType(), LongType(), DoubleType()


def _of(**columns) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


def sequence_table(n: int) -> StructType:
    return _of(clonotypeKey=_S, **{f"sequence_{k}": _S for k in range(n)})


def clone_table(n: int) -> StructType:
    return _of(sampleId=_S, clonotypeKey=_S, abundance=_L, **{f"sequence_{k}": _S for k in range(n)}, clonotypeKeyLabel=_S)


def result_schemas(n: int) -> dict[str, StructType]:
    """Every result relation for n chains."""
    seq, trim = [f"sequence_{k}" for k in range(n)], [f"trim_sequence_{k}" for k in range(n)]
    s = lambda names: {c: _S for c in names}
    full = "trimmed_fullSequence"
    cluster_to_seq = _of(
        clusterId=_S, clusterLabel=_S, size=_L, **s([*seq, *trim, full]), **s([f"centroid_{c}" for c in [*seq, *trim, full]]),
        **s([f"reference_centroid_{c}" for c in [*seq, *trim, full]]),
    )
    abundances = _of(sampleId=_S, clusterId=_S, abundance=_L, abundance_normalized=_D)
    radius = _of(clusterId=_S, clusterRadius=_D)
    return {
        "abundances": abundances,
        "cluster-to-seq": cluster_to_seq,
        "clone-to-cluster": _of(clusterId=_S, clonotypeKey=_S, clusterLabel=_S, link=_L),
        "abundances-per-cluster": _of(clusterId=_S, abundance_per_cluster=_L, abundance_fraction_per_cluster=_D),
        "distance_to_centroid": _of(clonotypeKey=_S, clusterId=_S, clonotypeKeyLabel=_S, clusterLabel=_S, distanceToCentroid=_D),
        "cluster-radius": radius,
        "abundances-top": abundances,
        "cluster-to-seq-top": cluster_to_seq,
        "cluster-radius-top": radius,
        "trimmed-sequences": _of(clonotypeKey=_S, trimmed_fullSequence=_S, **s(trim)),
        "plurality-centroid": _of(
            clusterId=_S, **s([f"plurality_centroid_{c}" for c in [*trim, full]]), **{f"plurality_centroid_length_{c}": _L for c in trim},
            clusterLabel=_S, clusterIdLink=_S, link=_L, peptideLabel=_S,
        ),
        "dedup_mapping": _of(representativeKey=_S, clonotypeKey=_S),
    }


def empty_results(spark: SparkSession, n: int) -> dict[str, DataFrame]:
    return {name: spark.createDataFrame([], schema) for name, schema in result_schemas(n).items()}
