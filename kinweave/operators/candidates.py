"""Candidate pairs for fuzzy joins, by equi-joins that lose no pair within the bound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def max_edits(length: Column, radius: float) -> Column:
    """The most edits d with d / length <= radius, as doubles compare."""
    guess = F.floor(length * F.lit(float(radius))).cast("int") + 1
    return F.when(guess / length.cast("double") <= F.lit(float(radius)), guess).otherwise(
        F.when((guess - 1) / length.cast("double") <= F.lit(float(radius)), guess - 1).otherwise(F.greatest(guess - 2, F.lit(0)))
    )


def segment_pairs(longer: DataFrame, shorter: DataFrame, radius: float, least_edits: int = 0) -> DataFrame:
    """Pairs (long_key, long_seq, short_key, short_seq) that may be within the radius; len(long) >= len(short).

    Only pairs whose longer sequence has room for `least_edits` edits are looked for.

    Only keys go through the candidate join; the sequences are looked up for the distinct pairs that it leaves.

    Both inputs are (key, seq). With d edits allowed, a sequence cut into d + 1 segments keeps one of them whole, and
    moved by at most d places, in any partner within d edits. The shorter side emits its segments for each length that a
    partner can have, the longer side its substrings at the places where such a segment may be; equal (length, length,
    segment number, text) meet in a hash join on a 64-bit hash of these (pairs that only the hash brings together are
    candidates too many, which the distance rules out). The join's hot keys are left to the adaptive split of skewed
    partitions: nothing but the join stands on its key. Radius 1 or more lets all pairs in and is refused.
    """
    if not 0 <= radius < 1:
        raise ValueError("the radius must be in [0, 1)")
    zero = F.lit(0)
    s = shorter.select(F.col("key").alias("short_key"), F.col("seq").alias("short_seq"), F.length("seq").alias("ls")).filter("ls > 0")
    widest = F.floor(F.col("ls") / F.lit(1 - float(radius))).cast("int") + 1
    s = s.withColumn("ll", F.explode(F.sequence(F.col("ls"), widest))).withColumn("d", max_edits(F.col("ll"), radius)).filter((F.col("ll") - F.col("ls") <= F.col("d")) & (F.col("d") >= least_edits))
    s = s.withColumn("i", F.explode(F.sequence(zero, F.col("d"))))
    s = s.withColumns({"at": _cut(F.col("ls"), F.col("d"), F.col("i")), "to": _cut(F.col("ls"), F.col("d"), F.col("i") + 1)})
    s = s.select("short_key", F.xxhash64("ls", "ll", "i", F.substring("short_seq", F.col("at") + 1, F.col("to") - F.col("at"))).alias("segment"))
    r = longer.select(F.col("key").alias("long_key"), F.col("seq").alias("long_seq"), F.length("seq").alias("ll")).filter("ll > 0")
    r = r.withColumn("d", max_edits(F.col("ll"), radius)).filter(F.col("d") >= least_edits).withColumn("ls", F.explode(F.sequence(F.greatest(F.col("ll") - F.col("d"), F.lit(1)), F.col("ll"))))
    r = r.withColumn("i", F.explode(F.sequence(zero, F.col("d"))))
    r = r.withColumns({"at": _cut(F.col("ls"), F.col("d"), F.col("i")), "to": _cut(F.col("ls"), F.col("d"), F.col("i") + 1)})
    size = F.col("to") - F.col("at")
    low, high = F.greatest(F.col("at") - F.col("d"), zero), F.least(F.col("at") + F.col("d"), F.col("ll") - size)
    r = r.filter(low <= high).withColumn("p", F.explode(F.sequence(low, high)))
    r = r.select("long_key", F.xxhash64("ls", "ll", "i", F.substring("long_seq", F.col("p") + 1, size)).alias("segment"))
    return _looked_up(s.join(r, "segment").select("long_key", "short_key").distinct(), longer, shorter)


def _looked_up(pairs: DataFrame, longer: DataFrame, shorter: DataFrame) -> DataFrame:
    """Pairs (long_key, short_key) with long_seq and short_seq."""
    longs, shorts = (side.select(F.col("key").alias(f"{name}_key"), F.col("seq").alias(f"{name}_seq")) for side, name in ((longer, "long"), (shorter, "short")))
    return pairs.join(longs, "long_key").join(shorts, "short_key")


def one_edit_pairs(seqs: DataFrame, radius: float) -> DataFrame:
    """Pairs (long_key, long_seq, short_key, short_seq) within one edit, whose longer sequence has room for no other number.

    A sequence with room for an edit stands under its hash less each of its letters, every sequence under its own hash. Two
    of them meet under the same place with other letters (a replacement), as a whole under what the other is less a letter
    (an insertion), or as wholes (equal). So nothing meets but what is within the edit, and what only the hash brings together.
    """
    length = F.length("seq")
    room = max_edits(length, radius)
    wholes = seqs.filter(length > 0).filter(room <= 1).select("key", F.xxhash64("seq").alias("rest"), F.lit(0).alias("place"), F.lit(0).alias("letter"))
    cut = seqs.filter(length > 0).filter(room == 1).select("key", "seq", F.explode(F.sequence(F.lit(1), length)).alias("place"))
    rest = F.concat(F.left("seq", F.col("place") - 1), F.substring("seq", F.col("place") + 1, length))
    rows = wholes.unionByName(cut.select("key", F.xxhash64(rest).alias("rest"), "place", F.ascii(F.substring("seq", F.col("place"), F.lit(1))).alias("letter")))
    # the same rows on both sides, so that they are shuffled once
    x, y = rows.alias("x"), rows.alias("y")
    replaced = (F.col("x.place") == F.col("y.place")) & (F.col("x.key") < F.col("y.key")) & ((F.col("x.place") == 0) | (F.col("x.letter") != F.col("y.letter")))
    inserted = (F.col("x.place") == 0) & (F.col("y.place") > 0)
    met = x.join(y, (F.col("x.rest") == F.col("y.rest")) & (replaced | inserted))
    return _looked_up(met.select(F.col("y.key").alias("long_key"), F.col("x.key").alias("short_key")).distinct(), seqs, seqs)


def bounded_edits(a: Column, b: Column, radius: float) -> Column:
    """Edit distance, or -1 beyond the most edits within the radius of the longer one, where the built-in stops early."""
    return F.call_function("levenshtein", a, b, max_edits(F.greatest(F.length(a), F.length(b)), radius))


def _cut(length: Column, d: Column, i: Column) -> Column:
    """Where segment i of d + 1 begins."""
    return F.floor(length * i / (d + 1)).cast("int")


def similar_pairs(seqs: DataFrame, identity: float) -> DataFrame:
    """Pairs a < b of (key, seq) with normalised Levenshtein distance at most 1 - identity: a, b, distance.

    Lengths with room for one edit meet by what is left without a letter, longer ones by segments.
    """
    radius = 1.0 - identity
    pairs = segment_pairs(seqs, seqs, radius, 2).unionByName(one_edit_pairs(seqs, radius)).filter("long_key <> short_key")
    a, b = F.least("long_key", "short_key"), F.greatest("long_key", "short_key")
    edits = bounded_edits(F.col("long_seq"), F.col("short_seq"), radius)
    return pairs.select(a.alias("a"), b.alias("b"), edits.alias("distance")).filter("distance >= 0").distinct()


def kmers(seqs: DataFrame, k: int) -> DataFrame:
    """key, kmer: the distinct contiguous k-mers of each sequence."""
    starts = F.sequence(F.lit(1), F.length("seq") - (k - 1))
    parts = F.when(F.length("seq") >= k, F.array_distinct(F.transform(starts, lambda i: F.substring(F.col("seq"), i, F.lit(k)))))
    return seqs.select("key", F.explode(parts).alias("kmer"))


def kmer_groups(seqs: DataFrame, k: int) -> DataFrame:
    """kmer, n, centre: how many sequences have it, and the longest of them (then the least key)."""
    joined = kmers(seqs, k).join(seqs.select("key", F.length("seq").alias("l")), "key")
    best = F.min_by("key", F.struct(-F.col("l"), F.col("key")))
    return joined.groupBy("kmer").agg(F.count(F.lit(1)).alias("n"), best.alias("centre"))
