"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Every row gets a global number x in 0 .. n-1 (by doc_id, then size and checksum of the text). A keyed Feistel
network permutes a rectangle a x b that is at least n and less than n + a large; a value that falls outside
0 .. n-1 walks on along its cycle until it comes back inside, so the result is a permutation of 0 .. n-1 exactly.
Shard = permuted number mod shards and slot = permuted number div shards: counts of the shards differ by one at
most, slots are gapless, and both can be computed, and inverted, from (x, n, seed) alone.

Nulls: a null text counts as no bytes (size 1, checksum 0), an empty one too, and long ones are read once for their size
and checksum; null ids come first in the row order. Equal rows get
different numbers, their order among themselves being of no effect. An empty table gives an empty result. Columns
beside doc_id and text are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import div, row_numbers, table
from .sqlparts import CRC_TABLE, crc32_of_hex

ROUNDS = 4
#: A Mersenne prime: products of two residues stay below 2^62.
PRIME = (1 << 31) - 1
#: Walks written into one expression; see permute().
WALKS = 64


def round_keys(seed: int, rounds: int = ROUNDS) -> list[tuple[int, int, int]]:
    """Three numbers below PRIME for each round, from a 64-bit mixer run on the seed."""
    state, keys = seed & (1 << 64) - 1, []
    for _ in range(rounds):
        row = []
        for _ in range(3):
            state = (state + 0x9E3779B97F4A7C15) & (1 << 64) - 1
            z = ((state ^ state >> 30) * 0xBF58476D1CE4E5B9) & (1 << 64) - 1
            row.append(1 + ((z ^ z >> 29) >> 7) % (PRIME - 1))
        keys.append(tuple(row))
    return keys


def sides(n: int) -> tuple[int, int]:
    """The rectangle: a rows of b values, a * b >= n, less than a too large."""
    a = math.isqrt(max(n - 1, 0)) + 1
    return a, max(1, -(-n // a))


def _scramble(v: Column, key: tuple[int, int, int]) -> Column:
    y = (v * F.lit(key[0]) + F.lit(key[1])) % F.lit(PRIME)
    return (y * y + F.lit(key[2])) % F.lit(PRIME)


def feistel(x: Column, n: int, seed: int) -> Column:
    """One application of the network to x in 0 .. a*b-1."""
    a, b = sides(n)
    left, right = div(x, b), x % F.lit(b)
    for r, key in enumerate(round_keys(seed)):
        if r % 2 == 0:
            left = (left + _scramble(right, key)) % F.lit(a)
        else:
            right = (right + _scramble(left, key)) % F.lit(b)
    return left * F.lit(b) + right


def feistel_inverse(y: Column, n: int, seed: int) -> Column:
    a, b = sides(n)
    left, right = div(y, b), y % F.lit(b)
    for r, key in reversed(list(enumerate(round_keys(seed)))):
        if r % 2 == 0:
            left = F.pmod(left - _scramble(right, key), F.lit(a))
        else:
            right = F.pmod(right - _scramble(left, key), F.lit(b))
    return left * F.lit(b) + right


def _walk(x: Column, n: int, step) -> Column:
    """Follow the cycle until the value is below n.

    At most a*b - n values lie outside, so that many walks always suffice; beyond WALKS of them (n over 4,000) a row
    needs more with a chance below 65^-64, and such a row would raise an error, not get a wrong place.
    """
    a, b = sides(n)
    first, k = step(x), min(a * b - n, WALKS)
    if k == 0:
        return first
    on = F.aggregate(F.sequence(F.lit(1), F.lit(k)), first, lambda at, _: F.when(at < n, at).otherwise(step(at)))
    p = F.when(first < n, first).otherwise(on)
    return F.when(p < n, p).otherwise(F.raise_error(F.lit("cycle walk did not end")).cast("long"))


def permute(x: Column, n: int, seed: int = 0) -> Column:
    """The place of row number x in a reproducible shuffle of n rows."""
    return _walk(x, n, lambda v: feistel(v, n, seed))


def unpermute(p: Column, n: int, seed: int = 0) -> Column:
    """The row number that permute() sends to p."""
    return _walk(p, n, lambda v: feistel_inverse(v, n, seed))


def row_of(shard: Column, slot: Column, n: int, shards: int, seed: int = 0) -> Column:
    """The row number found in this slot of this shard."""
    return unpermute(slot * F.lit(shards) + shard, n, seed)


def shard_rows(docs: DataFrame, shards: int = 16, seed: int = 0) -> DataFrame:
    """doc_id, size, text_crc32, row_number, shard, slot of every row."""
    bytes_ = F.coalesce(F.octet_length("text").cast("long"), F.lit(0).cast("long"))
    narrow = docs.select("doc_id", (bytes_ + 1).alias("size"), F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"))
    rows, n = row_numbers(narrow, ["doc_id", "size", "text_crc32"], name="shard-rows")
    placed = rows.withColumn("_at", permute(F.col("row_number"), n, seed) if n else F.col("row_number"))
    shard = (F.col("_at") % F.lit(shards)).cast("int")
    return placed.select(*rows.columns, shard.alias("shard"), div(F.col("_at"), shards).alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = 16, seed: int = 0) -> None:
    """Write the documents as one folder a shard, in the order of their slots. ValueError if a doc_id is repeated or null."""
    if not docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 OR doc_id IS NULL").isEmpty():
        raise ValueError("doc_id has to be a key of the table")
    placed = shard_rows(docs, shards, seed).select("doc_id", "shard", "slot")
    out = docs.join(placed, "doc_id").repartition(shards, "shard").sortWithinPartitions("shard", "slot")
    out.write.partitionBy("shard").parquet(path)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_rows(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def _scramble_sql(v: str, key: tuple[int, int, int]) -> str:
    y = f"(({v}) * {key[0]} + {key[1]}) % {PRIME}"
    return f"((({y}) * ({y}) + {key[2]}) % {PRIME})"


def _network_sql(name: str, source: str, seed: int = 0) -> str:
    """CTEs that apply the network to column v of `source`, a round each."""
    parts, at = [f"{name}0 AS (SELECT id, n, a, b, v // b AS l, v % b AS r FROM {source})"], 0
    for r, key in enumerate(round_keys(seed)):
        l, rr = ("l", "r") if r % 2 else (f"(l + {_scramble_sql('r', key)}) % a", "r")
        if r % 2:
            rr = f"(r + {_scramble_sql('l', key)}) % b"
        parts.append(f"{name}{at + 1} AS (SELECT id, n, a, b, {l} AS l, {rr} AS r FROM {name}{at})")
        at += 1
    return ",\n".join(parts) + f",\n{name} AS (SELECT id, n, a, b, l * b + r AS v FROM {name}{at})"


def _inline_sql(v: str, seed: int = 0) -> str:
    left, right = f"(({v}) // b)", f"(({v}) % b)"
    for r, key in enumerate(round_keys(seed)):
        if r % 2 == 0:
            left = f"(({left} + {_scramble_sql(right, key)}) % a)"
        else:
            right = f"(({right} + {_scramble_sql(left, key)}) % b)"
    return f"{left} * b + {right}"


ORACLE = f"""
WITH RECURSIVE {CRC_TABLE},
hexed AS (
  SELECT doc_id, coalesce(octet_length(encode(text)), 0)::BIGINT + 1 AS size, hex(encode(coalesce(text, ''))) AS h FROM documents
), narrow AS (
  SELECT doc_id, size, {crc32_of_hex('h')} AS text_crc32 FROM hexed, crc_tab
), numbered AS (
  SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, size, text_crc32) - 1 AS v FROM narrow
), sized AS (
  SELECT n, a, ((n + a - 1) // a)::BIGINT AS b
  FROM (SELECT count(*)::BIGINT AS n, (floor(sqrt(greatest(count(*) - 1, 0))) + 1)::BIGINT AS a FROM narrow)
), src AS (SELECT v AS id, v, n, a, b FROM numbered, sized),
{_network_sql('f', 'src')},
walk AS (
  SELECT id, n, a, b, v FROM f
  UNION ALL
  SELECT id, n, a, b, {_inline_sql('v')} AS v FROM walk WHERE v >= n
)
SELECT numbered.doc_id, numbered.size, numbered.text_crc32, 'rows' AS law, (walk.v % 16)::INT AS shard, (walk.v // 16)::BIGINT AS slot,
       NULL::INT AS grown_shard
FROM numbered JOIN walk ON walk.id = numbered.v AND walk.v < walk.n
"""
