"""Scalar expressions on sequences, all built-in functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Separator of chains in joined sequences. Fixed value.
CHAIN_SEPARATOR = "===="


def sequence_columns(df: DataFrame, prefix: str = "sequence_") -> list[str]:
    """Chain columns in the order of their numbers."""
    found = [c for c in df.columns if c.startswith(prefix)]
    return sorted(found, key=lambda c: (not c[len(prefix) :].isdigit(), int(c[len(prefix) :]) if c[len(prefix) :].isdigit() else 0, c))


def blank(c: Column) -> Column:
    """null as the empty string."""
    return F.coalesce(c, F.lit(""))


def trim_key(c: Column, start: int, end: int) -> Column:
    """Trim for the clustering key: what is left after `start` and is no longer than `end` keeps its end."""
    rest = F.substring(blank(c), start + 1, 1 << 30) if start else blank(c)
    return F.when(F.length(rest) > end, F.left(rest, F.length(rest) - end)).otherwise(rest) if end else rest


def trim_report(c: Column, start: int, end: int) -> Column:
    """Trim for reports: what is left after `start` and is no longer than `end` becomes empty."""
    rest = F.substring(blank(c), start + 1, 1 << 30) if start else blank(c)
    return F.left(rest, F.greatest(F.length(rest) - end, F.lit(0))) if end else rest


def join_chains(*chains: Column) -> Column:
    return F.concat_ws(CHAIN_SEPARATOR, *[blank(c) for c in chains])


def cluster_label(c: Column) -> Column:
    return F.regexp_replace(c, "^[CP]-", "CL-")


def strip_file_prefix(c: Column) -> Column:
    return F.regexp_replace(c, "^s-", "")


def sanitize(c: Column) -> Column:
    """Everything but ASCII letters becomes X; the length stays."""
    return F.regexp_replace(c, "[^A-Za-z]", "X")


def guarded_weight(c: Column) -> Column:
    return F.when(c.isNull() | (c <= 0), F.lit(1.0)).otherwise(c.cast("double"))


def fraction(part: Column, total: Column) -> Column:
    """part / total, 0 where the total isn't positive."""
    return F.when(total > 0, part.cast("double") / total.cast("double")).otherwise(F.lit(0.0))


def sample_fraction(part: Column, total: Column) -> Column:
    """part / total, null where the total is 0."""
    return part.cast("double") / F.nullif(total.cast("double"), F.lit(0.0))


def percent(c: Column) -> Column:
    return F.floor(c * 100 + F.lit(0.5)).cast("int").cast("string")


def label_body(c: Column) -> Column:
    """First five letters of the base64 SHA-256 digest, in capitals; null for the empty string."""
    digest = F.base64(F.unhex(F.sha2(c, 256)))
    return F.when(F.length(c) > 0, F.upper(F.left(F.regexp_replace(digest, "[^A-Za-z]", ""), F.lit(5))))


def ranked_label(body: Column, rank: Column, prefix: str = "PC-") -> Column:
    suffix = F.when(rank > 1, F.concat(F.lit("-"), rank.cast("string"))).otherwise(F.lit(""))
    return F.when(body.isNotNull(), F.concat(F.lit(prefix), body, suffix))


def residues(c: Column) -> Column:
    """Number of symbols that aren't gaps."""
    return F.length(F.replace(c, F.lit("-"), F.lit(""))).cast("long")


def coverage(mode: int, query: Column, target: Column, threshold: float) -> Column:
    """The six coverage modes on lengths of a query and a target."""
    q, t, x = query.cast("double"), target.cast("double"), F.lit(float(threshold))
    aligned = F.least(q, t)
    return {
        0: (aligned / q >= x) & (aligned / t >= x),
        1: aligned / t >= x,
        2: aligned / q >= x,
        3: (t <= q) & (t / q >= x),
        4: (q <= t) & (q / t >= x),
        5: F.least(q, t) / F.greatest(q, t) >= x,
    }[mode]
