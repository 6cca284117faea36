"""The registered queries of the family analysis, and the same results in DuckDB SQL.

All run over the words of all documents (see sources.tables). Where a query needs families and not their search, they
are set by a rule that SQL can state too: representatives of equal length and equal first four letters.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import exprs
from ..operators import candidates, cluster, dedup, layout, profile, reassign, rollup, scoring, seeding
from ..params import ClusterParams
from ..schemas import clone_table as clone_schema
from ..sources import files, tables
from ..storage import shared_dir, stored
from . import analysis, views

TRIM_START, TRIM_END, IDENTITY = 0, 1, 0.9
#: Identity of linear-time clustering; scores of equal, like and other residues in whole numbers, and the loss of one like for an equal.
LINEAR_IDENTITY, WHOLE_SCORES, ONE_ALIKE = 0.8, (5.0, 1.0, -2.0), 4.0
TRIMS = {1: ["trim_sequence_0"], 2: ["trim_sequence_0", "trim_sequence_1"]}


def _clones(spark: SparkSession, sf: str, chains: int = 1) -> DataFrame:
    return dedup.report_columns(tables.clone_table(spark, sf, chains), TRIM_START, TRIM_END)


def _keyed(keys: DataFrame) -> DataFrame:
    return dedup.with_key_sequence(keys, TRIM_START, TRIM_END)


def _words_of(spark: SparkSession, sf: str, chains: int = 1) -> DataFrame:
    """clonotypeKey, sequence_*, clonotypeKeyLabel: one row a key."""
    return tables.as_clones(tables.word_counts(spark, sf).select("word").distinct(), chains)


def rule_clusters(reps: DataFrame) -> DataFrame:
    """Families by rule: (clusterId, clonotypeKey) of representatives."""
    rule = [F.length("sequence").alias("l"), F.left("sequence", F.lit(4)).alias("p")]
    ids = reps.groupBy(*rule).agg(F.min("clonotypeKey").alias("clusterId"))
    return reps.withColumns({"l": rule[0], "p": rule[1]}).join(ids, ["l", "p"]).select("clusterId", "clonotypeKey")


class Families:
    """The common inputs of the queries on families: words are counted once, and each key has one row of its own."""

    def __init__(self, spark: SparkSession, sf: str, chains: int = 1, counted: DataFrame | None = None):
        self.counted = stored(tables.word_counts(spark, sf)) if counted is None else counted
        self.trims = TRIMS[chains]
        self.clones = tables.as_clones(self.counted, chains)
        weight = exprs.guarded_weight(F.sum("abundance")).alias("weight")
        words = tables.as_clones(self.counted.groupBy("word").agg(weight), chains)
        self.values = dedup.report_columns(words, TRIM_START, TRIM_END)
        self.keyed = _keyed(self.values)

    @cached_property
    def mapping(self) -> DataFrame:
        return dedup.dedup_mapping(self.keyed)

    @cached_property
    def reps(self) -> DataFrame:
        return dedup.representatives(self.keyed)

    @cached_property
    def members(self) -> DataFrame:
        return stored(rollup.expand(rule_clusters(self.reps), self.mapping))

    @cached_property
    def wide(self) -> DataFrame:
        """Members with all columns of their keys."""
        return stored(self.members.join(self.values, "clonotypeKey"))

    def rows(self) -> DataFrame:
        return layout.member_rows(self.wide, self.trims)

    def laid(self) -> DataFrame:
        return layout.placed(layout.capped(layout.distinct_members(self.rows())), "stacked")

    def columns(self, laid: DataFrame) -> DataFrame:
        return profile.columns(profile.tally(layout.cells_of_rows(laid)), 0.5)

    def parts(self):
        laid = stored(self.laid())
        found = stored(profile.families(self.columns(laid), 0.6))
        return profile.distance_parts(self.rows(), profile.member_distances(laid, found), found), found.drop("costs")


def tables_chains(n: int) -> list[str]:
    return [f"sequence_{k}" for k in range(n)]


def _r(c: str) -> F.Column:
    return F.round(c, 9).alias(c)


def clone_table(spark, sf):
    return tables.clone_table(spark, sf, 2)


def seq_table(spark, sf):
    return _words_of(spark, sf, 2).drop("clonotypeKeyLabel")


def seq_trim(spark, sf):
    s = _words_of(spark, sf)
    return s.select("clonotypeKey", exprs.trim_key(F.col("sequence_0"), 2, 5).alias("key_side"), exprs.trim_report(F.col("sequence_0"), 2, 5).alias("report_side"))


def full_sequence_concat(spark, sf):
    s = _words_of(spark, sf, 2)
    each, both = dedup.key_sequence(s, 1, 1, per_chain=True), dedup.key_sequence(s, 1, 1)
    full = dedup.report_columns(s.withColumns({"per_chain": each, "as_one": both}), 1, 1)
    return full.select("clonotypeKey", "fullSequence", "trimmed_fullSequence", "per_chain", "as_one")


def cluster_label_regex(spark, sf):
    c = tables.clone_table(spark, sf)
    return c.select("clonotypeKey", exprs.cluster_label(F.col("clonotypeKeyLabel")).alias("clusterLabel")).distinct()


def sanitize_sequences(spark, sf):
    s = _words_of(spark, sf)
    return s.select("clonotypeKey", exprs.sanitize(F.col("sequence_0")).alias("sanitized"))


def dedup_mapping(spark, sf):
    return dedup.dedup_mapping(_keyed(_words_of(spark, sf)))


def fasta_diagnostics(spark, sf):
    return dedup.diagnostics(_keyed(_words_of(spark, sf)))


def input_empty_flag(spark, sf):
    c = tables.clone_table(spark, sf)
    return c.agg(F.when(F.count(F.lit(1)) == 0, "empty").otherwise("notEmpty").alias("inputState"), F.count(F.lit(1)).alias("n_rows"))


def min_peptide_length(spark, sf):
    return tables.clone_table(spark, sf).agg(F.min(F.length("sequence_0")).cast("long").alias("min_len"))


def modal_length_share(spark, sf):
    c = _clones(spark, sf, 2)
    one, two = dedup.modal_share(c, "trim_sequence_0"), dedup.modal_share(c, "trim_sequence_1")
    return one.withColumn("chain", F.lit(0)).unionByName(two.withColumn("chain", F.lit(1)))


def clonotype_weights(spark, sf):
    return dedup.clone_weights(tables.clone_table(spark, sf), True)


def unit_weights(spark, sf):
    return dedup.clone_weights(tables.clone_table(spark, sf), False)


def cluster_expand_size(spark, sf):
    return rollup.with_size(Families(spark, sf).members)


def cluster_labels(spark, sf):
    f = Families(spark, sf)
    return rollup.with_label(f.members, f.values)


def abundances(spark, sf):
    f = Families(spark, sf)
    return rollup.abundances(f.clones, f.members).withColumn("abundance_normalized", _r("abundance_normalized"))


def abundances_per_cluster(spark, sf):
    f = Families(spark, sf)
    per = rollup.abundances_per_cluster(rollup.abundances(f.clones, f.members))
    return per.withColumn("abundance_fraction_per_cluster", _r("abundance_fraction_per_cluster"))


def _top(f: Families) -> DataFrame:
    return rollup.top_clusters(rollup.abundances_per_cluster(rollup.abundances(f.clones, f.members)))


def top_clusters(spark, sf):
    f = Families(spark, sf)
    per = stored(rollup.abundances_per_cluster(rollup.abundances(f.clones, f.members)))
    return rollup.restrict(per.select("clusterId", "abundance_per_cluster"), rollup.top_clusters(per))


def abundances_top(spark, sf):
    f = Families(spark, sf)
    by_sample = stored(rollup.abundances(f.clones, f.members))
    return rollup.restrict(by_sample, rollup.top_clusters(rollup.abundances_per_cluster(by_sample))).withColumn("abundance_normalized", _r("abundance_normalized"))


def cluster_radius_top(spark, sf):
    f = Families(spark, sf, 2)
    parts, _ = f.parts()
    return rollup.restrict(profile.cluster_radius(profile.distance_to_centroid(parts)), _top(f))


def clone_to_cluster(spark, sf):
    f = Families(spark, sf)
    return rollup.with_label(f.members, f.values).withColumn("link", F.lit(1).cast("long"))


def levenshtein_pairs(spark, sf):
    """All pairs of representatives within the identity."""
    pairs = candidates.similar_pairs(stored(_words(spark, sf)), IDENTITY)
    return pairs.withColumn("distance", F.col("distance").cast("long"))


def _words(spark, sf) -> DataFrame:
    """key, seq: one key for each distinct sanitised word (DuckDB's levenshtein() counts bytes)."""
    words = _words_of(spark, sf).select("clonotypeKey", exprs.sanitize(F.col("sequence_0")).alias("seq"))
    return words.groupBy("seq").agg(F.min("clonotypeKey").alias("key")).select("key", "seq")


def _full_words(spark, sf) -> DataFrame:
    """key, seq: every word as it is, for queries that no SQL holds to sanitised words."""
    return _words_of(spark, sf).select(F.col("clonotypeKey").alias("key"), F.col("sequence_0").alias("seq"))


def connected_components(spark, sf):
    words = stored(_words(spark, sf))
    return cluster.connected_components(words.select("key"), stored(candidates.similar_pairs(words, IDENTITY)))


def one_hop_clusters(spark, sf):
    words = stored(_words(spark, sf))
    return cluster.one_hop(words.select("key"), stored(candidates.similar_pairs(words, IDENTITY)))


def set_cover_clusters(spark, sf):
    words = stored(_full_words(spark, sf))
    return cluster.set_cover(words.select("key"), stored(candidates.similar_pairs(words, IDENTITY)))


def linear_time_clusters(spark, sf):
    """Centres of the seeds of least hash, under the edit distance."""
    words = stored(_full_words(spark, sf))
    radius = F.lit(1.0 - LINEAR_IDENTITY)
    near = F.levenshtein("seq_a", "seq_b") / F.greatest(F.length("seq_a"), F.length("seq_b")).cast("double") <= radius
    return cluster.linear_time(words, seeding.linear_seeds(words), lambda pairs: pairs.filter(near))


def linear_time_scored(spark, sf):
    """The same under scored similarity."""
    words = stored(_full_words(spark, sf))
    alike = lambda pairs: scoring.scored_pairs(pairs, scoring.level_matrix(62)).filter(F.col("similarity") >= LINEAR_IDENTITY)
    return cluster.linear_time(words, seeding.linear_seeds(words), alike)


def linear_seeds(spark, sf):
    """The seeds that linear-time clustering keeps of each word."""
    return seeding.linear_seeds(_full_words(spark, sf))


def neighbour_pairs(spark, sf):
    """Pairs of words with two seeds of a neighbourhood on one diagonal, where one letter of a seed may be replaced by a like
    one: for each word how many greater words it is paired with, and the first and the last of them."""
    words = seeding.numbered(_full_words(spark, sf))
    pairs = seeding.numbered_pairs(words, scoring.grouped_matrix(*WHOLE_SCORES), ONE_ALIKE)
    told = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n_pairs"), F.min("b").alias("first_b"), F.max("b").alias("last_b"))
    for c in ("a", "first_b", "last_b"):
        told = told.join(words.select(F.col("id").alias(c), F.col("key").alias(f"key_of_{c}")), c)
    return told.select(F.col("key_of_a").alias("a"), "n_pairs", F.col("key_of_first_b").alias("first_b"), F.col("key_of_last_b").alias("last_b"))


def diagonal_candidates(spark, sf):
    """The high-precision search: how many partners each word has by ungapped score on a diagonal with a common 5-mer, and the best."""
    found = seeding.diagonal_candidates(stored(_full_words(spark, sf)), scoring.grouped_matrix(*WHOLE_SCORES))
    best = F.min(F.struct((-F.col("score")).alias("minus"), "target")).alias("b")
    told = found.groupBy("query").agg(F.count(F.lit(1)).alias("n_targets"), F.sum("score").alias("total_score"), best)
    return told.select("query", "n_targets", "total_score", F.col("b.target").alias("best_target"), (-F.col("b.minus")).alias("best_score"))


def kmer_candidates(spark, sf):
    return candidates.kmer_groups(_words(spark, sf), 5)


def coverage_modes(spark, sf):
    """For pairs within the identity, which coverage modes accept them at 0.95 of the length (b: query, a: target)."""
    pairs = candidates.similar_pairs(stored(_words(spark, sf)), IDENTITY)
    q, t = F.length("b") - 2, F.length("a") - 2  # keys begin with two more characters
    return pairs.select("a", "b", *[exprs.coverage(m, q, t, 0.95).alias(f"mode_{m}") for m in range(6)])


def reassign_singletons(spark, sf):
    """Rule families, whose lone members are reassigned."""
    f = Families(spark, sf)
    seqs = f.values.select("clonotypeKey", exprs.sanitize(F.col("trimmed_fullSequence")).alias("trimmed_fullSequence"))
    return reassign.reassign_singletons(stored(rule_clusters(f.reps)), seqs, IDENTITY)


def weighted_distinct_members(spark, sf):
    return layout.distinct_members(Families(spark, sf, 2).rows())


def capped_members(spark, sf):
    members = layout.capped(layout.distinct_members(Families(spark, sf).rows()), 20)
    return members.withColumn("rn", F.col("rn").cast("long"))


def column_tally(spark, sf):
    tallied = profile.tally(layout.cells_of_rows(Families(spark, sf).laid()))
    return tallied.withColumn("pos", F.col("pos").cast("long"))


def absent_columns(spark, sf):
    """Gap threshold 0.2 on the members laid out greedily without gaps over families of mixed lengths."""
    cells = _mixed_cells(spark, sf)
    cols = profile.columns(profile.tally(cells), 0.2)
    return cols.groupBy("clusterId", "chain").agg(F.count(F.lit(1)).alias("n_columns"), F.count_if("absent").alias("n_absent"))


def _mixed_members(spark, sf) -> tuple[Families, DataFrame]:
    f = Families(spark, sf)
    rule = F.left("sequence", F.lit(5))
    ids = f.reps.groupBy(rule.alias("p")).agg(F.min("clonotypeKey").alias("clusterId"))
    mixed = f.reps.withColumn("p", rule).join(ids, "p").select("clusterId", "clonotypeKey")
    f.__dict__["members"] = stored(rollup.expand(mixed, f.mapping))
    return f, layout.capped(layout.distinct_members(f.rows()))


def _mixed_cells(spark, sf) -> DataFrame:
    _, members = _mixed_members(spark, sf)
    return layout.cells_of_rows(layout.placed(members, "ungapped"))


def greedy_layout(spark, sf):
    """Families of words with the same first five letters, of mixed lengths, laid out without inner gaps."""
    _, members = _mixed_members(spark, sf)
    return layout.laid_out(members, "ungapped")


def gapped_layout(spark, sf):
    """The same families aligned with gaps; one row a family: width and consensus."""
    _, members = _mixed_members(spark, sf)
    laid = stored(layout.laid_out(members, "gapped"))
    cols = profile.columns(profile.tally(layout.cells_of_rows(laid)), 0.5)
    width = laid.groupBy("clusterId", "chain").agg(F.max(F.length("row")).alias("width"), F.count(F.lit(1)).alias("n"))
    return profile.consensus(cols, 0.6).join(width, ["clusterId", "chain"])


def consensus_centroid(spark, sf):
    f = Families(spark, sf, 2)
    return profile.consensus(f.columns(f.laid()), 0.6)


def plurality_centroid(spark, sf):
    f = Families(spark, sf, 2)
    out = profile.consensus(f.columns(f.laid()), 0.0)
    return out.select("clusterId", "chain", F.col("consensus").alias("plurality"), exprs.residues(F.col("consensus")).alias("plurality_length"))


def profile_distance(spark, sf):
    parts, _ = Families(spark, sf, 2).parts()
    return profile.distance_to_centroid(parts)


def cluster_radius(spark, sf):
    parts, _ = Families(spark, sf, 2).parts()
    return profile.cluster_radius(profile.distance_to_centroid(parts))


def medoid_reference(spark, sf):
    f = Families(spark, sf, 2)
    parts, lengths = f.parts()
    found = profile.medoids(parts, lengths, f.trims)
    seqs = f.values.select(F.col("clonotypeKey").alias("medoid_key"), F.col("trimmed_fullSequence").alias("reference_centroid_trimmed_fullSequence"))
    return found.join(seqs, "medoid_key", "left")


def _plurality(f: Families) -> DataFrame:
    plurality = profile.consensus(f.columns(f.laid()), 0.0)
    return analysis.plurality_relation(plurality, _own(f).select("clusterId", "clusterLabel"), f.trims, True)


def _own(f: Families) -> DataFrame:
    """clusterId, size, clusterLabel: one row a cluster."""
    sizes = f.members.groupBy("clusterId").agg(F.count("clonotypeKey").alias("size"))
    return rollup.with_label(sizes, f.values)


def peptide_label(spark, sf):
    return _plurality(Families(spark, sf, 2)).select("clusterId", "plurality_centroid_trimmed_fullSequence", "peptideLabel", "clusterIdLink", "link")


def cluster_to_seq(spark, sf):
    """Representatives' sequences, consensus and medoids, one row a cluster."""
    return _cluster_to_seq(Families(spark, sf, 2))


def _cluster_to_seq(f: Families) -> DataFrame:
    parts, lengths = f.parts()
    parts = stored(parts)
    wide = analysis.spread(lengths, f.trims, "centroid_").withColumn("centroid_trimmed_fullSequence", F.concat_ws("====", *[f"centroid_{c}" for c in f.trims]))
    own = _own(f)
    reps = f.values.select(F.col("clonotypeKey").alias("clusterId"), *tables_chains(2), *f.trims, "trimmed_fullSequence")
    ref = profile.medoids(parts, lengths, f.trims)
    names = [*tables_chains(2), *f.trims, "trimmed_fullSequence"]
    ref = ref.join(f.values.select(F.col("clonotypeKey").alias("medoid_key"), *[F.col(c).alias(f"reference_centroid_{c}") for c in names]), "medoid_key", "left").drop("medoid_key")
    return own.join(reps, "clusterId", "left").join(wide, "clusterId", "left").join(ref, "clusterId", "left")


def cluster_to_seq_top(spark, sf):
    """The largest clusters are those of the families of whole words."""
    f = Families(spark, sf, 2)
    return rollup.restrict(_cluster_to_seq(f), _top(Families(spark, sf, 1, f.counted)))


def trimmed_sequences(spark, sf):
    return dedup.one_row_a_key(_clones(spark, sf, 2), ["trimmed_fullSequence", *TRIMS[2]])


def anonymize_roundtrip(spark, sf):
    clones = tables.clone_table(spark, sf)
    hidden, mapping = views.anonymise(clones, "sampleId")
    by_hidden = hidden.groupBy("sampleId").agg(F.sum("abundance").alias("abundance"))
    back = views.deanonymise(by_hidden.withColumn("anonymised_id", F.col("sampleId")), "sampleId", mapping)
    return back.select("sampleId", "anonymised_id", "abundance")


def cluster_size_histogram(spark, sf):
    return views.size_histogram(rollup.with_size(Families(spark, sf).members))


def bubble_view(spark, sf):
    f = Families(spark, sf)
    by_sample = stored(rollup.abundances(f.clones, f.members))
    top = rollup.top_clusters(rollup.abundances_per_cluster(by_sample))
    return views.bubble(rollup.restrict(by_sample, top).select("sampleId", "clusterId", "abundance"), _own(f))


def msa_view(spark, sf):
    """The MSA panel with the largest clusters selected."""
    f = Families(spark, sf, 2)
    parts, _ = f.parts()
    chosen = rollup.with_size(f.members).select("clusterId", "size").distinct().orderBy(F.desc("size"), "clusterId").limit(10)
    return views.msa_panel(f.members, chosen, f.values, profile.distance_to_centroid(parts), f.trims)


def centroid_dataset(spark, sf):
    f = Families(spark, sf, 2)
    return views.centroid_dataset(rollup.abundances(f.clones, f.members), _plurality(f))


def clusters_view(spark, sf):
    """The clusters table: labels, radius and abundance."""
    f = Families(spark, sf, 2)
    parts, _ = f.parts()
    own = _own(f)
    per = rollup.abundances_per_cluster(rollup.abundances(f.clones, f.members)).withColumn("abundance_fraction_per_cluster", _r("abundance_fraction_per_cluster"))
    return views.clusters_table(own, profile.cluster_radius(profile.distance_to_centroid(parts)), per)


def clone_table_join(spark, sf):
    """The clone table from an abundance column, sequence columns and a label column."""
    counted = stored(tables.word_counts(spark, sf))
    keys = tables.as_clones(counted.select("word").distinct(), 2)
    abundance = tables.as_clones(counted, 1).select("sampleId", "clonotypeKey", "abundance")
    return tables.join_clone_table(abundance, keys.drop("clonotypeKeyLabel"), keys.select("clonotypeKey", "clonotypeKeyLabel"))


def key_uniqueness(spark, sf):
    return dedup.uniqueness(tables.clone_table(spark, sf), ["sampleId", "clonotypeKey"])


def distance_relation(spark, sf):
    f = Families(spark, sf, 2)
    parts, _ = f.parts()
    return analysis.distance_relation(rollup.with_label(f.members, f.values), f.values, profile.distance_to_centroid(parts))


def plurality_relation(spark, sf):
    return _plurality(Families(spark, sf, 2))


def plurality_unwanted(spark, sf):
    """The same relation where no dataset is asked for: its plurality columns are null."""
    f = Families(spark, sf, 2)
    plurality = profile.consensus(f.columns(f.laid()), 0.0)
    return analysis.plurality_relation(plurality, _own(f).select("clusterId", "clusterLabel"), f.trims, False)


def _untrimmed(f: Families) -> DataFrame:
    rows = layout.member_rows(f.wide, tables_chains(2))
    laid = layout.placed(layout.capped(layout.distinct_members(rows)), "stacked")
    return profile.consensus(f.columns(laid), 0.6)


def centroid_untrimmed(spark, sf):
    """Consensus of the chains as they were before the trim."""
    return _untrimmed(Families(spark, sf, 2))


def cluster_to_seq_full(spark, sf):
    """cluster_to_seq with the centroids of the untrimmed chains."""
    f = Families(spark, sf, 2)
    return _cluster_to_seq(f).join(analysis.spread(_untrimmed(f), tables_chains(2), "centroid_"), "clusterId", "left")


def padded_absent_columns(spark, sf):
    """Gap thresholds on families of mixed lengths whose members are filled up with gaps at their ends."""
    _, members = _mixed_members(spark, sf)
    widest = members.groupBy("clusterId", "chain").agg(F.max(F.length("seq")).alias("width"))
    laid = members.join(widest, ["clusterId", "chain"]).withColumn("row", F.rpad("seq", F.col("width"), F.lit("-")))
    cols = stored(profile.columns(profile.tally(layout.cells_of_rows(laid)), 0.2))
    absent = cols.groupBy("clusterId", "chain").agg(F.count(F.lit(1)).alias("n_columns"), F.count_if("absent").alias("n_absent"))
    return absent.join(profile.consensus(cols, 0.6, True), ["clusterId", "chain"])


def dropped_members(spark, sf):
    """What a cap of 20 members leaves out."""
    return layout.dropped(layout.distinct_members(Families(spark, sf).rows()), 20)


def reassignment_sample(spark, sf):
    f = Families(spark, sf)
    seqs = f.values.select("clonotypeKey", exprs.sanitize(F.col("trimmed_fullSequence")).alias("trimmed_fullSequence"))
    found = reassign.sample(reassign.best_matches(stored(rule_clusters(f.reps)), seqs, IDENTITY))
    return found.withColumn("norm_dist", F.round("norm_dist", 9))


def scored_pairs(spark, sf):
    """Words and the longest word of each of their 5-mers, scored under a matrix by rule."""
    words = stored(_full_words(spark, sf))
    pairs = cluster.centre_pairs(words, candidates.kmers(words, 5))
    return scoring.scored_pairs(pairs, scoring.level_matrix(62)).withColumns({"a": F.least("a", "b"), "b": F.greatest("a", "b")}).distinct()


def scored_clusters(spark, sf):
    """Set cover over the pairs of scored similarity that neighbourhood seeds find."""
    words = stored(_full_words(spark, sf))
    matrix = scoring.level_matrix(62)
    return cluster.set_cover(words.select("key"), stored(seeding.scored_neighbours(words, matrix, analysis.NEIGHBOURHOOD * 5.0, IDENTITY)))


def family_analysis(spark, sf):
    """The whole analysis with its own clustering: the clusters table."""
    out = analysis.analyse(tables.clone_table(spark, sf), ClusterParams(identity=IDENTITY, trimEnd=TRIM_END, weightByAbundance=True, generateDataset=True, centroidAlignment="ungapped"), matrix=scoring.level_matrix(62))
    return views.clusters_table(out["cluster-to-seq"], out["cluster-radius"], out["abundances-per-cluster"])


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/kinweave-{name}-{uuid.uuid4().hex}"


def tsv_round_trip(spark, sf):
    """The clone table through a TSV file with a header, every third label empty: what comes back, sample by sample."""
    third = F.pmod(F.length("sequence_0"), F.lit(3)) == 0
    clones = tables.clone_table(spark, sf).withColumn("clonotypeKeyLabel", F.when(~third, F.col("clonotypeKeyLabel")))
    path = _folder(spark, "tsv")
    files.write_tsv(clones.select(*clone_schema(1).names), path)
    back = files.read_tsv(spark, path, clone_schema(1))
    return back.groupBy("sampleId").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("abundance").alias("abundance"), F.count_if(F.col("clonotypeKeyLabel").isNull()).alias("n_unlabelled"),
        F.sum(F.length("sequence_0")).alias("n_letters"), F.min("clonotypeKey").alias("first_key"), F.max("clonotypeKey").alias("last_key"),
    )


def string_import(spark, sf):
    """The same file read as strings, cast by an import, written as a typed frame under its keys and read again."""
    path, frame = _folder(spark, "tsv"), _folder(spark, "frame")
    clones = tables.clone_table(spark, sf).select("sampleId", "clonotypeKey", "abundance", "sequence_0")
    files.write_tsv(clones, path)
    text = files.read_strings(spark, path, clones.columns)
    files.write_frame(files.import_frame(text, {"sampleId": "string", "clonotypeKey": "string"}, {"abundance": "long", "sequence_0": "string"}), frame, ["sampleId", "clonotypeKey"], 1)
    return spark.read.parquet(frame).select("sampleId", "clonotypeKey", "abundance", "sequence_0")


def cluster_list_scan(spark, sf):
    """The edge list of an external clustering: a TSV without a header, whose keys carry a prefix."""
    path = _folder(spark, "edges")
    rows = rule_clusters(dedup.representatives(_keyed(_words_of(spark, sf))))
    rows.select(*[F.concat(F.lit("s-"), c).alias(c) for c in ("clusterId", "clonotypeKey")]).write.csv(path, sep="\t", header=False, quote="")
    return files.read_clusters(spark, path)


def fasta_round_trip(spark, sf):
    """Representatives written as FASTA and read again."""
    path = _folder(spark, "fasta")
    files.write_fasta(dedup.representatives(_keyed(_words_of(spark, sf))), path)
    return files.read_fasta(spark, path)


def content_record(spark, sf):
    """The figures of the input as one NDJSON record, read again."""
    path = _folder(spark, "content")
    files.write_content(dedup.diagnostics(_keyed(_words_of(spark, sf))).select("n_sequences", "n_distinct", "min_length", "max_length"), path)
    return spark.read.schema("n_sequences long, n_distinct long, min_length int, max_length int").json(path)


def chain_order(spark, sf):
    """Words cut into twelve chains of two letters, given in no order: chains sort by their numbers, not as text."""
    words = _words_of(spark, sf).select("clonotypeKey", F.col("sequence_0").alias("word"))
    cut = words.select("clonotypeKey", *[F.substring("word", 2 * k + 1, 2).alias(f"sequence_{k}") for k in (10, 2, 0, 11, 1, 9, 3, 8, 4, 7, 5, 6)])
    full = dedup.report_columns(cut, 0, 1)
    return full.select("clonotypeKey", "fullSequence", "trimmed_fullSequence")


def alignment_model(spark, sf):
    """Which layout each language's words would get, and from what share of the most common length."""
    counted = stored(tables.word_counts(spark, sf))
    lengths = counted.select("sampleId", F.length("word").alias("l")).groupBy("sampleId", "l").agg(F.count(F.lit(1)).alias("c"))
    share = lengths.groupBy("sampleId").agg((F.max("c").cast("double") / F.sum("c").cast("double")).alias("modal_share"))
    rows = [(r["sampleId"], dedup.resolve_alignment("auto", peptide, [r["modal_share"]], least), peptide, least) for r in share.collect() for peptide in (True, False) for least in (0.1, 0.9)]
    return spark.createDataFrame(rows, "sampleId string, model string, peptide boolean, least double").join(share.withColumn("modal_share", F.round("modal_share", 9)), "sampleId")


_NAMES = """clone_table seq_table seq_trim full_sequence_concat cluster_label_regex sanitize_sequences dedup_mapping fasta_diagnostics
input_empty_flag min_peptide_length modal_length_share clonotype_weights unit_weights cluster_expand_size cluster_labels abundances
abundances_per_cluster top_clusters abundances_top cluster_radius_top clone_to_cluster levenshtein_pairs connected_components one_hop_clusters
set_cover_clusters linear_time_clusters kmer_candidates coverage_modes reassign_singletons weighted_distinct_members capped_members column_tally
absent_columns greedy_layout gapped_layout consensus_centroid plurality_centroid profile_distance cluster_radius medoid_reference peptide_label
cluster_to_seq cluster_to_seq_top trimmed_sequences anonymize_roundtrip cluster_size_histogram bubble_view msa_view centroid_dataset clusters_view
family_analysis clone_table_join key_uniqueness distance_relation plurality_relation plurality_unwanted centroid_untrimmed cluster_to_seq_full
padded_absent_columns dropped_members reassignment_sample scored_pairs scored_clusters
linear_seeds linear_time_scored neighbour_pairs diagonal_candidates
tsv_round_trip string_import cluster_list_scan fasta_round_trip content_record chain_order alignment_model""".split()
QUERIES = {name: globals()[name] for name in _NAMES}
