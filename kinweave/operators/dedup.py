"""Clustering keys, exact de-duplication, diagnostics, weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import blank, guarded_weight, join_chains, sequence_columns, trim_key, trim_report


def key_sequence(seqs: DataFrame, start: int = 0, end: int = 0, per_chain: bool = False) -> Column:
    """The sequence that is clustered: chains trimmed one by one and joined, or joined and then trimmed as one."""
    chains = [F.col(c) for c in sequence_columns(seqs)]
    if per_chain and len(chains) > 1:
        return join_chains(*[trim_key(c, start, end) for c in chains])
    return trim_key(join_chains(*chains), start, end)


def with_key_sequence(seqs: DataFrame, start: int = 0, end: int = 0, per_chain: bool = False) -> DataFrame:
    """clonotypeKey, sequence."""
    return seqs.select("clonotypeKey", key_sequence(seqs, start, end, per_chain).alias("sequence"))


def dedup_mapping(keyed: DataFrame) -> DataFrame:
    """representativeKey (the least key of equal sequences), clonotypeKey."""
    reps = keyed.groupBy("sequence").agg(F.min("clonotypeKey").alias("representativeKey"))
    return keyed.join(reps, "sequence").select("representativeKey", "clonotypeKey")


def representatives(keyed: DataFrame) -> DataFrame:
    """clonotypeKey, sequence of one key for each sequence that has a residue."""
    reps = keyed.groupBy("sequence").agg(F.min("clonotypeKey").alias("clonotypeKey"))
    return reps.filter(F.length(F.replace("sequence", F.lit("="), F.lit(""))) > 0).select("clonotypeKey", "sequence")


def diagnostics(keyed: DataFrame) -> DataFrame:
    n = F.length("sequence")
    return keyed.agg(
        F.count(F.lit(1)).alias("n_sequences"),
        F.count_distinct("sequence").alias("n_distinct"),
        F.min(n).alias("min_length"),
        F.max(n).alias("max_length"),
        F.round(F.avg(n), 6).alias("mean_length"),
        F.count_if(n == 0).alias("n_empty"),
        F.count_if(n < 6).alias("n_short"),
    )


def uniqueness(df: DataFrame, keys: list[str]) -> DataFrame:
    """n_rows, n_keys, is_unique: whether no two rows share the keys."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("long")
    counted = per_key.agg(F.coalesce(F.sum("n"), zero).alias("n_rows"), F.count(F.lit(1)).alias("n_keys"))
    return counted.withColumn("is_unique", F.col("n_rows") == F.col("n_keys"))


def report_columns(clones: DataFrame, start: int = 0, end: int = 0) -> DataFrame:
    """The clone table with trim_sequence_*, fullSequence and trimmed_fullSequence."""
    chains = sequence_columns(clones)
    filled = clones.withColumns({c: blank(F.col(c)) for c in chains})
    trimmed = filled.withColumns({f"trim_{c}": trim_report(F.col(c), start, end) for c in chains})
    return trimmed.withColumns(
        {"fullSequence": join_chains(*map(F.col, chains)), "trimmed_fullSequence": join_chains(*[F.col(f"trim_{c}") for c in chains])}
    )


def one_row_a_key(clones: DataFrame, columns: list[str]) -> DataFrame:
    """clonotypeKey and columns that depend on it alone."""
    return clones.groupBy("clonotypeKey").agg(*[F.min(c).alias(c) for c in columns])


def clone_weights(clones: DataFrame, by_abundance: bool) -> DataFrame:
    """clonotypeKey, weight: the summed abundance, or 1."""
    if not by_abundance or "abundance" not in clones.columns:
        return clones.select("clonotypeKey").distinct().withColumn("weight", F.lit(1.0))
    return clones.groupBy("clonotypeKey").agg(guarded_weight(F.sum("abundance").cast("double")).alias("weight"))


def modal_share(clones: DataFrame, column: str) -> DataFrame:
    """n, modal_length, modal_share of a chain's lengths over table rows; empty sequences don't count."""
    lengths = clones.select(F.length(F.col(column)).alias("l")).filter("l > 0").groupBy("l").agg(F.count(F.lit(1)).alias("c"))
    top = lengths.agg(F.sum("c").alias("n"), F.max_by("l", F.struct("c", -F.col("l"))).alias("l"), F.max("c").alias("c"))
    zero = F.lit(0)
    return top.select(
        F.coalesce("n", zero).cast("long").alias("n"),
        F.coalesce("l", zero).cast("long").alias("modal_length"),
        F.coalesce(F.col("c").cast("double") / F.col("n").cast("double"), F.lit(0.0)).alias("modal_share"),
    )


def resolve_alignment(wanted: str, peptide: bool, shares: list[float], least: float = 0.9) -> str:
    """auto: ungapped for peptides whose measurable chains all have a uniform length, else gapped."""
    if wanted != "auto":
        return wanted
    return "ungapped" if peptide and shares and min(shares) >= least else "gapped"
