"""TSV, FASTA, Parquet and NDJSON sources and sinks; schemas are given, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.exprs import strip_file_prefix
from ..operators.dedup import uniqueness


def read_tsv(spark: SparkSession, path: str, schema: StructType, header: bool = True) -> DataFrame:
    """A TSV file or folder; empty fields are null, and words like NA are text."""
    return spark.read.csv(path, sep="\t", header=header, schema=schema, nullValue="", emptyValue="", quote="", enforceSchema=not header)


def read_strings(spark: SparkSession, path: str, columns: list[str], header: bool = True) -> DataFrame:
    return read_tsv(spark, path, StructType([StructField(c, StringType()) for c in columns]), header)


def write_tsv(df: DataFrame, path: str) -> None:
    df.write.csv(path, sep="\t", header=True, quote="", emptyValue="", nullValue="")


def read_clusters(spark: SparkSession, path: str) -> DataFrame:
    """The headerless edge list of an external clustering; its keys carry a prefix."""
    rows = read_strings(spark, path, ["clusterId", "clonotypeKey"], header=False)
    return rows.select(*[strip_file_prefix(F.col(c)).alias(c) for c in rows.columns])


def write_fasta(reps: DataFrame, path: str) -> None:
    """Records >s-<key> and the sequence."""
    reps.select(F.concat(F.lit(">s-"), "clonotypeKey", F.lit("\n"), "sequence")).write.text(path)


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """clonotypeKey, sequence; records may span lines.

    Records are cut before a > that begins a line, and nowhere else; files are read in splits.
    """
    raw = spark.read.text(path, lineSep="\n>").select(F.regexp_replace("value", r"^\s*>", "").alias("value")).filter(F.trim("value", F.lit(" \t\r\n")) != "")
    parts = F.split("value", "\n", 2)
    sequence = F.regexp_replace(F.coalesce(F.get(parts, F.lit(1)), F.lit("")), r"\s", "")
    return raw.select(strip_file_prefix(F.trim(parts[0], F.lit(" \t\r"))).alias("clonotypeKey"), sequence.alias("sequence"))


def import_frame(raw: DataFrame, axes: dict[str, str], columns: dict[str, str]) -> DataFrame:
    """Axes and columns by name, cast to their types (name: type); a name that isn't there raises ValueError."""
    if absent := [c for c in [*axes, *columns] if c not in raw.columns]:
        raise ValueError("no such columns: " + ", ".join(absent))
    return raw.select(*[F.col(c).cast(t).alias(c) for c, t in {**axes, **columns}.items()])


def write_frame(df: DataFrame, path: str, keys: list[str] | None = None, partition_keys: int = 0) -> None:
    """A typed Parquet frame, partitioned by the first `partition_keys` of its keys; double keys raise ValueError."""
    if keys and not (told := uniqueness(df, keys).first())["is_unique"]:
        raise ValueError(f"{told['n_rows']} rows have {told['n_keys']} keys ({', '.join(keys)})")
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*keys[:partition_keys]) if keys and partition_keys else writer).parquet(path)


def write_content(df: DataFrame, path: str) -> None:
    """A one-row aggregate as NDJSON."""
    df.limit(1).write.json(path)
