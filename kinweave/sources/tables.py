"""The driver's tables as inputs of a family analysis.

The sequences are the words of all documents, in full: each distinct word (run of letters, lower case) is a clonotype,
each language a sample, and the abundance is the number of occurrences. With two chains a word is cut in the middle:
words of one letter lack the second chain.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def word_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """sampleId, word, abundance.

    A small table that is read in fewer pieces than there are cores is dealt out before its texts are split.
    """
    docs = read(spark, sf_dir, "documents").select("lang", "text")
    cores = spark.sparkContext.defaultParallelism
    if docs.rdd.getNumPartitions() < cores:
        docs = docs.repartition(cores)
    words = docs.select(F.coalesce("lang", F.lit("none")).alias("sampleId"), F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word")).filter("word <> ''")
    return words.groupBy("sampleId", "word").agg(F.count(F.lit(1)).alias("abundance"))


def as_clones(counted: DataFrame, chains: int = 1) -> DataFrame:
    """clonotypeKey, sequence_* and clonotypeKeyLabel in place of the word; other columns stay."""
    word = F.col("word")
    half = F.floor((F.length(word) + 1) / 2).cast("int")
    parts = [word] if chains == 1 else [F.left(word, half), F.substring(word, half + 1, F.lit(1 << 30))]
    sample = [c for c in counted.columns if c == "sampleId"]
    rest = [c for c in counted.columns if c not in ("sampleId", "word")]
    return counted.select(
        *sample, F.concat(F.lit("k-"), word).alias("clonotypeKey"), *rest, *[p.alias(f"sequence_{k}") for k, p in enumerate(parts)],
        F.concat(F.when(word < "m", "C-").otherwise("P-"), word).alias("clonotypeKeyLabel"),
    )


def clone_table(spark: SparkSession, sf_dir: str, chains: int = 1) -> DataFrame:
    """sampleId, clonotypeKey, abundance, sequence_*, clonotypeKeyLabel."""
    return as_clones(word_counts(spark, sf_dir), chains)


def sequence_table(clones: DataFrame) -> DataFrame:
    """clonotypeKey, sequence_*: one row a key."""
    chains = [c for c in clones.columns if c.startswith("sequence_")]
    return clones.groupBy("clonotypeKey").agg(*[F.min(c).alias(c) for c in chains])


def join_clone_table(abundance: DataFrame, sequences: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The clone table of typed columns: abundance (sampleId, clonotypeKey, abundance), sequences (clonotypeKey, sequence_*)
    and labels (clonotypeKey, clonotypeKeyLabel); ValueError where no label column was found."""
    if labels is None:
        raise ValueError("no label column for the clonotype keys")
    chains = [c for c in sequences.columns if c.startswith("sequence_")]
    joined = abundance.join(sequences.select("clonotypeKey", *chains), "clonotypeKey", "left").join(labels.select("clonotypeKey", "clonotypeKeyLabel"), "clonotypeKey", "left")
    return joined.select("sampleId", "clonotypeKey", "abundance", *chains, "clonotypeKeyLabel")
