"""The whole family analysis: from tables and parameters to all result relations, as lazy DataFrames."""

from __future__ import annotations

import logging
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..catalog import centroid_domain, profile_domain
from ..functions.exprs import CHAIN_SEPARATOR, coverage, residues, sequence_columns
from ..operators import dedup, layout, profile, rollup, scoring, seeding
from ..operators.candidates import bounded_edits, similar_pairs
from ..operators.cluster import linear_time, one_hop, set_cover
from ..operators.reassign import reassign_singletons
from ..params import ClusterParams, warnings
from ..schemas import empty_results
from ..storage import stored

log = logging.getLogger(__name__)


@dataclass
class ClusterResult:
    relations: dict[str, DataFrame]
    alignment: str
    input_empty: bool
    min_length: int | None
    warnings: list[str]
    #: Provenance that distances and centroids carry.
    domains: dict[str, dict[str, str]] = field(default_factory=dict)
    #: Rows of the stored tables, emptied sequences, reassigned singletons (high precision), members left out by the cap.
    metrics: dict[str, int] = field(default_factory=dict)

    def __getitem__(self, name: str) -> DataFrame:
        return self.relations[name]


def similarity_matrix(spark: SparkSession, p: ClusterParams, matrix: np.ndarray | None = None, matrices: str | None = None) -> np.ndarray | None:
    """The substitution matrix of the similarity asked for: the one given, or the one of its name in the folder `matrices`.

    None for exact similarity. ValueError where a matrix is asked for by name and neither is given: no other stands in for it.
    """
    if p.similarityType == "sequence-identity" or p.sequenceType != "aminoacid":
        return None
    if matrix is None and matrices is None:
        raise ValueError(f"similarity {p.similarityType} needs that matrix: give matrices= (a folder that holds its file) or matrix= (scores of your own)")
    return scoring.named_matrix(spark, p.similarityType, matrices) if matrix is None else matrix


#: What a seed's neighbourhood may lose, as a share of the mean score of a residue against itself.
NEIGHBOURHOOD = 0.9


def cluster_representatives(reps: DataFrame, p: ClusterParams, matrix: np.ndarray | None = None) -> DataFrame:
    """(clusterId, clonotypeKey) of representatives (clonotypeKey, sequence); matrix: see similarity_matrix().

    Edges are pairs within the identity and the coverage. Exact similarity is the normalised edit distance over all pairs
    within it. Scored similarity is the share that a pair's alignment score under the matrix has of the lesser score of
    either against itself, over pairs within the edit distance and pairs found by seeds: two seeds of a neighbourhood on a
    diagonal, or, with high precision, the best ungapped diagonals of all pairs with a common five-letter word. High
    precision takes one hop of component growth, the linear-time tool compares seed groups to their centres under either
    similarity, the default is greedy set cover.
    """
    seqs = stored(reps.select(F.col("clonotypeKey").alias("key"), F.col("sequence").alias("seq")))
    covered = lambda df: df.filter(coverage(p.coverageMode, F.length("seq_b"), F.length("seq_a"), p.coverageThreshold))

    def alike(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b, seq_a, seq_b) within the identity."""
        if matrix is None:
            return pairs.filter(bounded_edits(F.col("seq_a"), F.col("seq_b"), 1.0 - p.identity) >= 0).select("a", "b")
        return scoring.scored_pairs(pairs, matrix).filter(F.col("similarity") >= p.identity).select("a", "b")

    if p.identity <= 0 and matrix is None:
        raise ValueError("an identity of 0 makes all pairs alike; there is nothing to cluster")
    if p.clusteringTool == "easy-linclust":
        verify = lambda df: alike(df.filter(coverage(p.coverageMode, F.length("seq_a"), F.length("seq_b"), p.coverageThreshold)))
        return linear_time(seqs, seeding.linear_seeds(seqs), verify)
    pairs = similar_pairs(seqs, p.identity).select("a", "b") if p.identity > 0 else None
    if matrix is not None:
        if p.highPrecision:
            ranked = seeding.diagonal_candidates(seqs, matrix).select(F.least("query", "target").alias("a"), F.greatest("query", "target").alias("b")).distinct()
            scored = alike(seeding.with_sequences(ranked, seqs))
        else:
            known = np.diag(matrix)[[ord(x) for x in scoring.AMINO_ACIDS]]
            scored = seeding.scored_neighbours(seqs, matrix, NEIGHBOURHOOD * float(known.mean()), p.identity)
        pairs = scored if pairs is None else pairs.unionByName(scored).distinct()
    edges = stored(covered(seeding.with_sequences(pairs, seqs)).select("a", "b"))
    return one_hop(seqs.select("key"), edges) if p.highPrecision else set_cover(seqs.select("key"), edges)


def analyse(
    clones: DataFrame, params: ClusterParams, clusters: DataFrame | None = None, peptide: bool = True, single_cell: bool = False,
    matrix: np.ndarray | None = None, matrices: str | None = None,
) -> ClusterResult:
    """All result relations of a clone table; `clusters` of representatives may be given, else they are computed.

    matrix, matrices: what scored similarity scores by, see similarity_matrix().
    """
    p = params.effective()
    chains = sequence_columns(clones)
    spark = clones.sparkSession
    if clones.isEmpty():
        return ClusterResult(empty_results(spark, len(chains)), "gapped", True, None, warnings(True, None, peptide))
    if clusters is None:
        matrix = similarity_matrix(spark, p, matrix, matrices)
    # each is filled by the action that stores its table, so the figures cost no job of their own
    seen = {name: Observation(name) for name in ("clones", "values", "clusters", "distinct", "laid", "members")}
    n_rows = F.count(F.lit(1))
    clones = stored(dedup.report_columns(clones, p.trimStart, p.trimEnd).observe(seen["clones"], n_rows.alias("clone_rows")))
    trims, full = [f"trim_{c}" for c in chains], "trimmed_fullSequence"
    emptied = F.count_if(F.regexp_replace(full, CHAIN_SEPARATOR, "") == "").alias("emptied_sequences")
    values = stored(dedup.one_row_a_key(clones, [*chains, *trims, full, "clonotypeKeyLabel"]).observe(seen["values"], n_rows.alias("keys"), emptied))
    keyed = dedup.with_key_sequence(values.select("clonotypeKey", *chains), p.trimStart, p.trimEnd, single_cell)
    min_length = values.agg(F.min(F.length(chains[0]))).first()[0]
    mapping = dedup.dedup_mapping(keyed)
    if clusters is None:
        clusters = cluster_representatives(dedup.representatives(keyed), p, matrix)
    if p.highPrecision and p.identity < 1:
        clusters = stored(reassign_singletons(stored(clusters), values.select("clonotypeKey", full), p.identity, seen["clusters"]))
    else:
        del seen["clusters"]
    members = stored(rollup.with_label(rollup.with_size(rollup.expand(clusters, mapping)), values).observe(seen["members"], n_rows.alias("members")))
    weights = dedup.clone_weights(clones, p.weightByAbundance)
    shares = [r for c in trims if (r := dedup.modal_share(clones, c).first())["n"]]
    model = dedup.resolve_alignment(p.centroidAlignment, peptide, [r["modal_share"] for r in shares])

    rows = layout.chain_rows(members, values, trims, weights)
    left_out = layout.dropped(layout.distinct_members(rows))
    kept = layout.capped(layout.distinct_members(rows).observe(seen["distinct"], n_rows.alias("distinct_members")))
    laid = stored(layout.placed(kept, model).observe(seen["laid"], n_rows.alias("laid_members")))
    cols = stored(profile.columns(profile.tally(layout.cells_of_rows(laid)), p.gapThreshold))
    found = stored(profile.families(cols, p.consensusThreshold, p.keepGaps))
    centroid = found.drop("costs")
    plurality = profile.consensus(cols, 0.0, p.keepGaps)
    parts = stored(profile.distance_parts(rows, profile.member_distances(laid, found), centroid))
    distances = profile.distance_to_centroid(parts)
    medoids = profile.medoids(parts, centroid, trims)
    if p.trimStart or p.trimEnd:
        raw = layout.capped(layout.distinct_members(layout.chain_rows(members, values, chains, weights)))
        untrimmed = profile.consensus(profile.columns(profile.tally(layout.cells_of_rows(layout.placed(raw, model))), p.gapThreshold), p.consensusThreshold, p.keepGaps)
        untrimmed = untrimmed.unionByName(centroid)
    else:
        untrimmed = centroid.unionByName(centroid.withColumn("chain", F.substring("chain", len("trim_") + 1, F.lit(1 << 30))))
    own = members.select("clusterId", "clusterLabel", "size").distinct()
    wide = spread(untrimmed, [*chains, *trims], "centroid_")
    wide = wide.withColumn(f"centroid_{full}", F.concat_ws(CHAIN_SEPARATOR, *[f"centroid_{c}" for c in trims]))
    reps = values.select(F.col("clonotypeKey").alias("clusterId"), *chains, *trims, full)
    medoid_seqs = values.select(F.col("clonotypeKey").alias("medoid_key"), *[F.col(c).alias(f"reference_centroid_{c}") for c in [*chains, *trims, full]])
    reference = medoids.join(medoid_seqs, "medoid_key", "left").drop("medoid_key")
    to_seq = own.join(reps, "clusterId", "left").join(wide, "clusterId", "left").join(reference, "clusterId", "left")
    link = members.select("clusterId", "clonotypeKey", "clusterLabel", F.lit(1).cast("long").alias("link"))
    by_sample = rollup.abundances(clones, members)
    per_cluster = rollup.abundances_per_cluster(by_sample)
    top = rollup.top_clusters(per_cluster)
    distance = distance_relation(members, values, distances)
    radius = profile.cluster_radius(distance)
    relations = {
        "abundances": by_sample,
        "cluster-to-seq": to_seq,
        "clone-to-cluster": link,
        "abundances-per-cluster": per_cluster,
        "distance_to_centroid": distance,
        "cluster-radius": radius,
        "abundances-top": rollup.restrict(by_sample, top),
        "cluster-to-seq-top": rollup.restrict(to_seq, top),
        "cluster-radius-top": rollup.restrict(radius, top),
        "trimmed-sequences": values.select("clonotypeKey", full, *trims),
        "plurality-centroid": plurality_relation(plurality, own, trims, p.generateDataset),
        "dedup_mapping": mapping,
        "dropped-members": left_out,
    }
    told = ClusterResult(relations, model, False, min_length, warnings(False, min_length, peptide))
    told.metrics = {name: int(n) for o in seen.values() for name, n in o.get.items()}
    told.metrics["dropped_members"] = told.metrics["distinct_members"] - told.metrics["laid_members"]
    told.domains = {"distance": profile_domain(p), "centroid": centroid_domain(p)}
    log.info("%s: alignment %s, shortest sequence %s, %s", p.label(), model, min_length, told.metrics)
    return told


def distance_relation(members: DataFrame, values: DataFrame, distances: DataFrame) -> DataFrame:
    """One row a member with its label and its cluster's; 0 for members without a distance (no chain at all)."""
    labelled = members.join(values.select("clonotypeKey", "clonotypeKeyLabel"), "clonotypeKey", "left").join(distances, ["clusterId", "clonotypeKey"], "left")
    return labelled.select("clonotypeKey", "clusterId", "clonotypeKeyLabel", "clusterLabel", F.coalesce("distanceToCentroid", F.lit(0.0)).alias("distanceToCentroid"))


def spread(consensus: DataFrame, chains: list[str], prefix: str) -> DataFrame:
    """One column a chain, empty where the family lacks it."""
    pick = lambda c: F.coalesce(F.max(F.when(F.col("chain") == c, F.col("consensus"))), F.lit(""))
    return consensus.groupBy("clusterId").agg(*[pick(c).alias(f"{prefix}{c}") for c in chains])


def plurality_relation(plurality: DataFrame, own: DataFrame, trims: list[str], wanted: bool) -> DataFrame:
    full = "plurality_centroid_trimmed_fullSequence"
    wide = spread(plurality, trims, "plurality_centroid_")
    wide = wide.withColumn(full, F.concat_ws(CHAIN_SEPARATOR, *[f"plurality_centroid_{c}" for c in trims]))
    wide = wide.withColumns({f"plurality_centroid_length_{c}": residues(F.col(f"plurality_centroid_{c}")) for c in trims})
    out = own.select("clusterId", "clusterLabel").join(wide, "clusterId", "left")
    out = out.withColumns({"clusterIdLink": F.col("clusterId"), "link": F.lit(1).cast("long")})
    if wanted:
        return rollup.peptide_labels(out, full)
    empty = {c: F.lit(None).cast(t) for c, t in out.dtypes if c.startswith("plurality_")}
    return out.withColumns({**empty, "peptideLabel": F.lit(None).cast("string")})
