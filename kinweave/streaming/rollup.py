"""Abundance roll-up over a stream of (sampleId, clonotypeKey, abundance) against a fixed clustering.

The batch relations are recomputed as new files arrive: Structured Streaming keeps the running sums as its state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def abundance_stream(spark: SparkSession, path: str, schema: StructType, clusters: DataFrame) -> DataFrame:
    """Running abundance by sample and cluster of the files that arrive under `path`."""
    rows = spark.readStream.schema(schema).parquet(path)
    unique = clusters.select("clonotypeKey", "clusterId").dropDuplicates(["clonotypeKey"])
    return rows.join(unique, "clonotypeKey").groupBy("sampleId", "clusterId").agg(F.sum("abundance").alias("abundance"))


def start(stream: DataFrame, name: str, checkpoint: str) -> StreamingQuery:
    """Run over what is there, into an in-memory table, and stop."""
    writer = stream.writeStream.outputMode("complete").format("memory").queryName(name)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
