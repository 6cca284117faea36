"""A corpus pipeline over `documents`: language ID, line dedup, near dedup, benchmark decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; the stages but the last return the
columns of documents. Every result is written as Parquet and read again.

All stages: columns beside doc_id, text, lang and n_chars are carried along as they are, whatever their names; an empty
table gives an empty result; repeated rows and null ids are rows like others unless a stage says more; long texts are
taken whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinweave.llm import decontaminate, language, linededup, neardup, packing
from kinweave.llm.common import drop_stored, materialize, n_stored, table


def _carried(docs: DataFrame, *needed: str) -> DataFrame:
    """The needed columns, and all columns as a struct, so that no name of an operator can meet one of the table's."""
    return docs.select(*needed, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_carried"))


def _restored(df: DataFrame, docs: DataFrame, **changed: Column) -> DataFrame:
    """The columns of docs from what _carried() took along, with those in `changed` put in."""
    ready = df.select("_carried", *[c.alias(f"_new{k}") for k, c in enumerate(changed.values())])
    new = {name: F.col(f"_new{k}") for k, name in enumerate(changed)}
    return ready.select(*[new.get(c, F.col("_carried").getField(c)).alias(c) for c in docs.columns])


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go: null or empty texts, and those without a letter.

    Where no row has a language to learn from, documents with a letter stay.
    """
    model = language.train(docs)
    if not model.languages:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    return _restored(language.identify(_carried(docs, "text"), model).filter("lang_pred <> 'und'"), docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier one go, and documents of which no line is left; n_chars follows the text.

    Null texts and texts that were blank before stay. Equal rows share their lines' fate.
    """
    cleaned = linededup.dedup_lines(_carried(docs, "doc_id", "text")).filter((F.col("removed") == 0) | (F.trim("text") != ""))
    size = F.when(F.col("removed") == 0, F.col("_carried.n_chars")).otherwise(F.length("text").cast("long"))
    return _restored(cleaned, docs, text=F.col("text"), n_chars=size)


def dedup_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of least doc_id stays, then of least hash of the text.

    Texts without words (null, empty) are one group. Of repeated rows one stays.
    """
    return neardup.deduplicate(docs)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a passage of the benchmark go. Null texts have none."""
    found = decontaminate.find(_carried(docs, "doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return _restored(found.filter("n_hit = 0"), docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens; one row a piece, with its ids. A null text counts as empty."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_near),
    ("decontamination", decontaminate_benchmark),
    ("packing", pack_sequences),
]

#: The language model and the packing can't be put in SQL; tests/llm compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before = n_stored()
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
        drop_stored(spark, before, keep=1)  # what the stage stored for itself
    return STAGES[-1][1](spark, docs, sf_dir)
