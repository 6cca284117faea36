"""Intermediate tables in the folder that driver and executors share, and numbers of their rows."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Folders of the tables stored so far; drop_stored() shortens the list.
_STORED: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; one of our own only where that setting is absent and all runs on this machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base


def stored(df: DataFrame, name: str = "") -> DataFrame:
    """df written as Parquet into the shared folder and read again: lineage ends here and lost executors cost nothing."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/kinweave-{name}{'-' if name else ''}{uuid.uuid4().hex}"
    df.write.parquet(path)
    _STORED.append(path)
    return spark.read.schema(df.schema).parquet(path)


def n_stored() -> int:
    return len(_STORED)


def drop_stored(spark: SparkSession, since: int = 0, keep: int = 0) -> int:
    """Delete the tables stored after the first `since`, but for the last `keep`; gives their number. Results that read them must be used up."""
    end = len(_STORED) - keep
    paths = _STORED[since:end]
    del _STORED[since:end]
    for path in paths:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return len(paths)


def row_numbers(df: DataFrame, order: list[str], out: str = "row_number", name: str = "rows") -> tuple[DataFrame, int]:
    """Number all rows 0 .. n-1 by `order`, without a single-partition sort; gives the numbered table and n.

    Rows are dealt by ranges of `order`, sorted, numbered inside their partition and stored; the offsets of the
    partitions (one row a partition, so bounded by the number of shuffle partitions) are then joined by broadcast.
    `df` should be narrow: all its columns are shuffled once.
    """
    mid = f"_{out}_in_partition"
    keys = [F.col(c).asc_nulls_first() for c in order]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(mid, F.monotonically_increasing_id())
    made = stored(ranged, name)
    pid, at = F.shiftright(F.col(mid), 33), F.col(mid).bitwiseAND(F.lit((1 << 33) - 1))
    counts = made.groupBy(pid.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    n = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("n")).first()["n"]
    numbered = made.withColumn("_pid", pid).join(F.broadcast(offsets), "_pid").withColumn(out, F.col("_offset") + at)
    return numbered.select(*df.columns, out), n
