"""Pieces that several operators share: columns, counted broadcasts, and the tables in the shared folder (kinweave.storage)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..storage import drop_stored, n_stored, row_numbers, shared_dir
from ..storage import stored as materialize

__all__ = ["ascii_lower", "div", "drop_stored", "levels", "materialize", "n_stored", "pack", "row_numbers", "shared_dir", "small", "table", "unpack"]

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows up to which small() broadcasts; the tables it is given have narrow rows, so this is below 100 MB.
BROADCAST_ROWS = 500_000


def small(df: DataFrame, most: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has been counted to hold few rows, else as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


def div(a: Column, b: Column | int) -> Column:
    """Integral division."""
    return F.call_function("div", a, F.lit(b) if isinstance(b, int) else b)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def levels(n: int, fan_out: int) -> int:
    """Levels that a tree of this fan-out needs above n leaves, one at least."""
    return max(1, math.ceil(math.log(n, fan_out) - 1e-12)) if n > 1 else 1


def pack(df: DataFrame, *wanted: str) -> DataFrame:
    """The wanted columns and all columns of df as one struct `_row`, so that no extra column can clash with ours."""
    return df.select(*wanted, F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"))


def unpack(df: DataFrame, packed: DataFrame, **new: Column) -> DataFrame:
    """The columns of `packed` (as it was before pack()) with those in `new` put in; a column of such a name is replaced."""
    taken = {name.lower() for name in new}
    kept = [F.col("_row").getField(c).alias(c) for c in packed.columns if c.lower() not in taken]
    # in two steps, or an expression could take up the alias of a kept column
    ready = df.select("_row", *[c.alias(f"_new{k}") for k, c in enumerate(new.values())])
    return ready.select(*kept, *[F.col(f"_new{k}").alias(name) for k, name in enumerate(new)])
